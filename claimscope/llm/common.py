"""Shared pieces of the training-data operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Rows and bytes in one Arrow batch; a batch of very long texts stays within a worker's memory.
BATCH_ROWS, BATCH_BYTES = 512, 16 << 20

#: The word definition of the contracts, for Java's and DuckDB's regex engines.
WORD = r"[^\x20\x09-\x0D]+"

_private: dict[str, str] = {}


def tune(spark: SparkSession) -> None:
    """Session settings that the Arrow operators need. They stay set, as plans are run after an operator returns."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder. Where the session names none, a private one in local mode; else an error,
    as executors of a cluster don't see the driver's folders."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return _private.setdefault(spark.sparkContext.applicationId, tempfile.mkdtemp(prefix="claimscope-"))


_scopes: list[list[DataFrame]] = []


@contextmanager
def scratch():
    """Tables that materialize() writes inside are deleted at the end. For callers that have written their result."""
    _scopes.append([])
    try:
        yield
    finally:
        for table in _scopes.pop():
            discard(table)


#: Deletes the shuffle files of a query when it ends. Without it they go when the driver happens to collect garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df: DataFrame, label: str, clean: bool = False) -> DataFrame:
    """Writes ``df`` to the shared folder and reads it back: lineage ends at a replicated table. With ``clean``
    the shuffle files of the write are deleted at its end, for plans that nothing else reads."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, None)
    if clean:
        spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if clean:
            spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    if _scopes:
        _scopes[-1].append(out)
    return out


def discard(df: DataFrame) -> None:
    """Deletes a table made by materialize() that nothing reads any more; again does nothing."""
    for path in df.inputFiles()[:1]:
        folder = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path).getParent()
        folder.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(folder, True)


def input_partitions(df: DataFrame, text: str | None = None, bytes_each: int = 8 << 20) -> int:
    """Partitions of about ``bytes_each`` bytes of ``text``; one cheap scan, no cap."""
    total = df.agg(F.sum(F.octet_length(F.col(text)) + 16).alias("b")).first()["b"] or 0
    return max(1, -(-total // bytes_each))


def remainder(column: str, modulus: int) -> Column:
    """crc32(column as text) mod modulus; a null column counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % modulus


def ordinals(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str, seed: int, slices: int = 4096, extra: DataFrame | None = None) -> DataFrame:
    """Adds the 0-based rank of each row among the rows of equal ``keys`` in a seeded hash order.

    Rows are ranked within (keys, slice of the hash); slice offsets are summed over counts, which
    are at most ``slices`` rows a key. So a key with a third of all rows is ranked by many tasks.
    Rows that are equal in ``order`` get neighbouring ranks in any order. ``extra`` has one row for
    each of ``keys`` and further columns, which the result gets too.
    """
    draw = F.xxhash64(*[F.col(c) for c in order], F.lit(seed))
    dealt = df.withColumn("__draw", draw).withColumn("__slice", F.pmod(F.shiftrightunsigned("__draw", 20), F.lit(slices)).cast("int"))
    sizes = dealt.groupBy(*keys, "__slice").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*keys).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*keys, "__slice", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    if extra is not None:
        starts = attach(starts, extra.hint("merge"), keys)
    within = Window.partitionBy(*keys, "__slice").orderBy("__draw", *order)
    ranked = dealt.withColumn("__rn", F.row_number().over(within).cast("long") - 1)
    joined = attach(ranked, starts.hint("merge"), [*keys, "__slice"])  # counts grow with the input: never broadcast
    more = [c for c in (extra.columns if extra is not None else []) if c not in keys]
    return joined.select(*df.columns, (F.col("__rn") + F.col("__start")).alias(name), *more)


def attach(df: DataFrame, other: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """``df`` with the further columns of ``other``, joined where all ``keys`` are equal, nulls too."""
    more = [c for c in other.columns if c not in keys]
    side = other.select(*[F.col(k).alias(f"__on{i}") for i, k in enumerate(keys)], *more)
    cond = F.lit(True)
    for i, k in enumerate(keys):
        cond = cond & F.col(k).eqNullSafe(F.col(f"__on{i}"))
    return df.join(side, cond, how).select(*df.columns, *([] if how in ("left_semi", "left_anti") else more))
