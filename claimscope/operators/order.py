"""Exact quantiles and running sums over whole columns, by more than one task a group.

A column is cut at approximate quantiles, which are one row a group; what is exact is computed
within the cuts. So no task sorts a group's rows, and only cuts and their sums are broadcast.
Approximate quantiles of the same rows differ with the order in which partial ones are merged, so the
cuts are computed once and brought to the driver; a plan that computed them twice would count by two scales.
Rows of one value stay together, except in running sums, whose ties are broken by a key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ACCURACY, CUTS = 10_000, 64


def _met(df: DataFrame, few: DataFrame, by: Sequence[str]) -> DataFrame:
    """``df`` with the columns of ``few``, which has one row for each value of ``by``, nulls too."""
    if not by:
        return df.crossJoin(F.broadcast(few))  # one row
    side = few.select(*[F.col(b).alias(f"__by{i}") for i, b in enumerate(by)], *[c for c in few.columns if c not in by])
    cond = F.lit(True)
    for i, b in enumerate(by):
        cond = cond & F.col(b).eqNullSafe(F.col(f"__by{i}"))
    return df.join(side, cond).drop(*[f"__by{i}" for i in range(len(by))])


def _pinned(few: DataFrame) -> DataFrame:
    """``few``, one row a group, as values: all that is placed by them is placed by the same ones."""
    return few.sparkSession.createDataFrame(few.toArrow(), few.schema)


def quantiles(df: DataFrame, by: Sequence[str], x: str, shares: dict[str, float]) -> DataFrame:
    """One row for each value of ``by``: the exact, interpolated quantiles of the non-null ``x``.

    Approximate quantiles bracket each one; the values below a bracket are counted, and only those
    inside are summed up by value.
    """
    rows = df.select(*by, F.col(x).cast("double").alias("__x")).where("__x is not null")
    ps = list(shares.values())
    near = [max(0.0, min(1.0, p + s * 4 / ACCURACY)) for p in ps for s in (-1, 1)]
    first = rows.groupBy(*by).agg(F.count("__x").alias("__n"), F.min("__x").alias("__lo"), F.max("__x").alias("__hi"), F.percentile_approx("__x", near, ACCURACY).alias("__q"))
    few = F.col("__n") < ACCURACY
    bounds = _pinned(first.select(*by, "__n", F.array(*[
        F.struct(F.when(few, F.col("__lo")).otherwise(F.col("__q")[2 * i]).alias("lo"), F.when(few, F.col("__hi")).otherwise(F.col("__q")[2 * i + 1]).alias("hi")) for i in range(len(ps))
    ]).alias("__b")))
    met = _met(rows, bounds, by)
    below = met.groupBy(*by).agg(F.array(*[F.count_if(F.col("__x") < F.col("__b")[i]["lo"]) for i in range(len(ps))]).alias("__below"))
    inside = F.array_compact(F.array(*[F.when((F.col("__x") >= F.col("__b")[i]["lo"]) & (F.col("__x") <= F.col("__b")[i]["hi"]), F.lit(i)) for i in range(len(ps))]))
    counted = met.select(*by, "__n", "__x", F.explode(inside).alias("__i")).groupBy(*by, "__i", "__x").agg(F.count(F.lit(1)).alias("__c"), F.first("__n").alias("__n"))
    up = Window.partitionBy(*by, "__i").orderBy("__x").rowsBetween(Window.unboundedPreceding, 0)
    summed = _met(counted.withColumn("__cum", F.sum("__c").over(up)), below, by)
    p = F.element_at(F.array(*map(F.lit, ps)), F.col("__i") + 1)
    at = (F.col("__n") - 1) * p
    reached = F.col("__cum") + F.col("__below")[F.col("__i")]
    ends = summed.groupBy(*by, "__i").agg(
        F.min(F.when(reached > F.floor(at), F.col("__x"))).alias("__a"), F.min(F.when(reached > F.ceil(at), F.col("__x"))).alias("__z"), F.first(at - F.floor(at)).alias("__f"),
    ).withColumn("__v", F.col("__a") + (F.col("__z") - F.col("__a")) * F.col("__f"))
    return ends.groupBy(*by).agg(*[F.max(F.when(F.col("__i") == i, F.col("__v"))).alias(name) for i, name in enumerate(shares)])


def running(df: DataFrame, x: Column, tie: Sequence[str], sums: dict[str, Column], by: Sequence[str] = (), rows: str | None = None) -> DataFrame:
    """Adds running sums, this row included, in the order of (``x``, ``tie``) within ``by``; null ``x`` is last.

    ``rows`` names a column for the number of rows of the group.
    """
    ready = df.withColumns({"__x": x.cast("double"), **{f"__s_{k}": v for k, v in sums.items()}})
    cuts = _pinned(ready.groupBy(*by).agg(F.percentile_approx("__x", [i / CUTS for i in range(1, CUTS)], 1000).alias("__cuts"), F.count(F.lit(1)).alias("__rows")))
    placed = _met(ready, cuts, by).withColumn("__at", F.when(F.col("__x").isNull(), CUTS).otherwise(F.size(F.filter("__cuts", lambda c: c < F.col("__x"))))).drop("__cuts")
    totals = placed.groupBy(*by, "__at").agg(*[F.sum(f"__s_{k}").alias(f"__t_{k}") for k in sums])
    before = Window.partitionBy(*by).orderBy("__at").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(*by, "__at", *[F.coalesce(F.sum(f"__t_{k}").over(before), F.lit(0)).alias(f"__t_{k}") for k in sums])  # at most CUTS + 1 rows a group
    within = Window.partitionBy(*by, "__at").orderBy(F.col("__x").asc_nulls_last(), *tie).rowsBetween(Window.unboundedPreceding, 0)
    local = placed.withColumns({f"__s_{k}": F.sum(f"__s_{k}").over(within) for k in sums})
    joined = _met(local, F.broadcast(starts), [*by, "__at"])
    return joined.select(*df.columns, *[(F.col(f"__s_{k}") + F.col(f"__t_{k}")).alias(k) for k in sums], *([F.col("__rows").alias(rows)] if rows else []))


def ranked(df: DataFrame, x: Column, tie: Sequence[str], name: str, by: Sequence[str] = (), rows: str | None = None) -> DataFrame:
    """Adds the 1-based rank of each row in the order of (``x``, ``tie``) within ``by``; null ``x`` is last."""
    return running(df, x, tie, {name: F.lit(1).cast("long")}, by, rows)
