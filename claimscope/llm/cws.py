"""Document fingerprints: consistent weighted sampling with gamma draws. Native.

A text is its words (A-Z lowered), weighted by how often they occur. For each of ``SAMPLES``
samples a word has draws r, c ~ Gamma(2, 1) and b ~ U(0, 1) that depend on the word and the sample
alone; with the weight w it has t = floor(ln w / r + b) and ln a = ln c - r (t - b + 1), and the word
of the least a, with its t, is the sample. Two texts agree in a sample with the generalised
Jaccard similarity sum min(w) / sum max(w) as probability.

The samples of a text are minima of packed longs (the order of a, then 24 bits that name word and
t), so they are made by hash aggregation in generated code, and texts of any length are summed up
as they stream by. Neighbours in the order of ids are found in buckets of that order, cut by
approximate quantiles of the ids alone: each bucket also gets the first text of the next one, so
no task sees more than its bucket, and a text is shuffled once.

Defined results: a null text is empty, an empty text has the empty fingerprint, which is like
another empty one (1) and like no other (0); equal ids are ordered by text, null ids come last; a
single document is its own neighbour; an empty table gives an empty result; other columns are
ignored. Ids that aren't numbers raise a ValueError; rows of one id are one bucket. With 32 samples a
likeness has a standard error of at most 0.09, and of sqrt(s (1 - s) / 32) at similarity s.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from claimscope.llm.common import input_partitions

SAMPLES = 32
DIGITS = 6
PARTITION_BYTES, BUCKETS_EACH, MOST_BUCKETS = 6 << 20, 4, 1 << 16


def _draw(k: int) -> str:
    """The packed sample k of a word (hash h) with the weight w, whose logarithm is lw."""
    h1, h2 = f"xxhash64(h, {k})", f"xxhash64(h, {k + 4096})"
    r = f"(-ln(((({h1}) & 4294967295L) + 1D) * (shiftrightunsigned({h1}, 32) + 1D) / 18446744073709551616D))"
    c = f"(-ln(((shiftrightunsigned({h2}, 16) & 16777215L) + 1D) * (shiftrightunsigned({h2}, 40) + 1D) / 281474976710657D))"
    b = f"((({h2}) & 65535L) / 65536D)"
    t = f"floor(lw / {r} + {b})"
    return f"shiftleft(cast((ln({c}) - {r} * ({t} - {b} + 1D) + 128D) * 2147483648D as bigint), 24) | (({h1} ^ ({t} * 40503L)) & 16777215L)"


def samples(words: DataFrame, keys: list[str], n: int = SAMPLES) -> DataFrame:
    """``keys`` and fingerprint of rows (keys, h, w): h a word's hash (null: no word), w its weight."""
    drawn = words.withColumn("lw", F.expr("ln(cast(w as double))"))
    least = drawn.groupBy(*keys).agg(*[F.min(F.expr(f"if(h is null, null, {_draw(k)})")).alias(f"s{k}") for k in range(n)])
    part = [F.lpad(F.hex(F.col(f"s{k}").bitwiseAND(F.lit(0xFFFFFF))), DIGITS, "0") for k in range(n)]
    return least.select(*keys, F.coalesce(F.concat(*part), F.lit("")).alias("fingerprint"))


def likeness(a: str, b: str, n: int = SAMPLES) -> Column:
    """The share of samples in which two fingerprints agree."""
    same = F.expr(f"size(filter(sequence(0, {n - 1}), i -> substring({a}, i * {DIGITS} + 1, {DIGITS}) = substring({b}, i * {DIGITS} + 1, {DIGITS}))) / {n}D")
    return F.when((F.col(a) == "") | (F.col(b) == ""), (F.col(a) == F.col(b)).cast("double")).otherwise(same)


def words_of(text: Column) -> Column:
    lowered = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.split(lowered, r"[\x20\x09-\x0D]+")


def fingerprints(df: DataFrame, key: str = "doc_id", text: str = "text", n: int = SAMPLES) -> DataFrame:
    """``key``, its columns and fingerprint for each row; rows with equal keys are one text together."""
    words = df.select(F.col(key), F.explode_outer(words_of(F.coalesce(F.col(text), F.lit("")))).alias("word"))
    counted = words.groupBy(key, F.expr("if(word <> '', xxhash64(word), null)").alias("h")).agg(F.count(F.lit(1)).alias("w"))
    return samples(counted, [key], n)


def _bucketed(docs: DataFrame, buckets: int) -> DataFrame:
    """Adds bucket, rising with id, by approximate quantiles of the ids; a search in two levels."""
    cuts = docs.agg(F.percentile_approx("id", F.lit([i / buckets for i in range(1, buckets)]) if buckets > 1 else F.lit([0.5]), max(10_000, 10 * buckets)).alias("c")).first()["c"]
    cuts = sorted(set(cuts or []))
    if not cuts or buckets < 2:
        return docs.withColumn("bucket", F.lit(0))
    width = max(1, int(len(cuts) ** 0.5))
    fine = [cuts[i : i + width] for i in range(0, len(cuts), width)]
    heads, rows = F.lit([f[0] for f in fine]), F.array(*[F.lit(f) for f in fine])
    coarse = F.greatest(F.lit(1), F.size(F.filter(heads, lambda c: c < F.col("id"))))
    return docs.withColumn("__c", coarse).withColumn("bucket", (F.col("__c") - 1) * width + F.size(F.filter(F.element_at(rows, F.col("__c")), lambda c: c < F.col("id")))).drop("__c")


def edited_neighbours(df: DataFrame, key: str = "doc_id", text: str = "text", n: int = SAMPLES) -> DataFrame:
    """Each text's fingerprint, that of the text with its second half replaced from the next document, and likenesses."""
    if not isinstance(df.schema[key].dataType, NumericType):
        raise ValueError(f"{key} must be a number")
    parts = input_partitions(df, text, PARTITION_BYTES)
    buckets = min(MOST_BUCKETS, BUCKETS_EACH * parts)
    docs = _bucketed(df.select(F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text")), buckets)
    # one row a bucket, at most MOST_BUCKETS
    first = docs.groupBy("bucket").agg(F.max("id").alias("id"))
    down = Window.orderBy(F.col("bucket").desc())
    follows = first.select(F.col("bucket").alias("before"), F.coalesce(F.lead("bucket").over(down), F.first("bucket").over(down)).alias("bucket"))
    named = F.broadcast(first.select(F.col("bucket").alias("__b"), F.col("id").alias("__i")))
    heads = docs.join(named, (F.col("bucket") == F.col("__b")) & F.col("id").eqNullSafe(F.col("__i")), "left_semi").groupBy("bucket", "id").agg(F.min("text").alias("text"))
    extra = heads.join(follows, "bucket").select(F.col("before").alias("bucket"), "id", "text", F.lit(0).alias("real"))
    both = docs.select("bucket", "id", "text", F.lit(1).alias("real")).unionByName(extra).repartition(parts, "bucket")
    order = Window.partitionBy("bucket").orderBy(F.col("real").desc(), F.col("id").desc_nulls_last(), "text")
    placed = both.withColumns({"rn": F.row_number().over(order), "next": F.lead("text").over(order)}).withColumn("half", F.expr("char_length(text) div 2"))
    edited = placed.withColumn("edited", F.expr("if(real = 1, concat(substring(text, 1, cast(char_length(text) - half as int)), substring(next, 1, cast(half as int))), '')"))
    none = "cast(null as struct<id: {0}, real: int, n_chars: bigint, sha: string>)".format(docs.schema["id"].dataType.simpleString())
    texts = edited.select("bucket", "rn", F.expr(f"""explode(array(
        struct(0 as which, text as body, {none} as meta),
        struct(1 as which, edited as body, {none} as meta),
        struct(2 as which, '' as body, struct(id, real, cast(char_length(text) as bigint) as n_chars, sha2(edited, 256) as sha) as meta)))""").alias("e"))
    words = texts.select("bucket", "rn", "e.which", "e.meta", F.explode(words_of(F.col("e.body"))).alias("word"))
    weighed = words.groupBy("bucket", "rn", "which", "meta", F.expr("if(word <> '', xxhash64(word), null)").alias("h")).agg(F.count(F.lit(1)).alias("w"))
    made = samples(weighed, ["bucket", "rn", "which", "meta"], n)
    whole = made.groupBy("bucket", "rn").agg(*[F.max(F.when(F.col("which") == i, F.col("fingerprint"))).alias(c) for i, c in enumerate(("fingerprint", "edited_fingerprint"))], F.max("meta").alias("meta"))
    seen = whole.withColumn("next_fingerprint", F.lead("fingerprint").over(Window.partitionBy("bucket").orderBy("rn"))).where("meta.real = 1")
    return seen.select(
        F.col("meta.id").alias(key), F.col("meta.n_chars").alias("n_chars"), F.col("meta.sha").alias("edited_sha256"), "fingerprint", "edited_fingerprint",
        likeness("fingerprint", "edited_fingerprint", n).alias("near_edited"), likeness("fingerprint", "next_fingerprint", n).alias("near_next"),
    )
