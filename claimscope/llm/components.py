"""Connected components by alternating large-star and small-star rounds.

Each round is two aggregations and two joins; rounds grow with the logarithm of the nodes. A node
with very many neighbours is aggregated before the shuffle and split by Spark's skew join. Every
round ends in a written table, so a lost executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimscope.llm.common import discard, materialize


def _large(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy(F.col("u").alias("k")).agg(F.min("v").alias("m")).select("k", F.least("k", "m").alias("m"))
    return both.where("v > u").join(least, F.col("u") == F.col("k")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy(F.col("u").alias("k")).agg(F.min("v").alias("m"))
    to_least = down.join(least, F.col("u") == F.col("k")).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return to_least.unionByName(least.select(F.col("k").alias("u"), F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """node and root (the least node of its component) for every node of ``edges`` (u, v) but the roots."""
    current = materialize(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    seen = None
    while True:
        state = current.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        if state["n"] == 0 or state == seen:
            return current.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = state
        after = materialize(_small(_large(current)), "edges")
        discard(current)
        current = after
