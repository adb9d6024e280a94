"""The corpus pipeline: language ID, near-duplicates, PII, source mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns
of documents. Stages are written as Parquet between one another.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimscope.llm import lang_id, mixing, near_dup, packing, pii
from claimscope.llm.common import discard, remainder, scratch, shared_dir
from claimscope.llm.queries import pii_key, tokenizer_path


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that no learned language is near to, or that have no letter."""
    model = lang_id.learn(docs, remainder("doc_id", lang_id.MODULUS) != lang_id.HELD_OUT)
    return lang_id.predict(docs, model).where(~F.col("rejected")).select(*docs.columns)


def near_dup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves one document of each group of near-duplicates (five words, similarity 0.8 or more)."""
    return near_dup.keep_one(docs)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by pseudonyms; n_chars follows the text."""
    done = pii.pseudonymise(docs, key=pii_key(spark), count=None)
    return done.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.char_length("text").cast(docs.schema["n_chars"].dataType))) if "n_chars" in docs.columns else done


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes each document as often as the source weights ask for."""
    return mixing.mix_rows(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokenizes the mix and gives every piece its place in a sequence."""
    return packing.pack_documents(docs, tokenizer_path(), with_ids=False)


STAGES = [("language_id", language_stage), ("near_dup", near_dup_stage), ("pii", pii_stage), ("mixing", mixing_stage), ("packing", packing_stage)]

#: Clustering, sketches, keyed permutations and plans aren't SQL; tests hold it against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        with scratch():  # a stage's own tables go once its result is written
            made = stage(spark, docs, sf_dir)
            made.write.parquet(path := f"{shared_dir(spark)}/stage-{name}-{uuid.uuid4().hex}")
        if before is not None:
            discard(before)
        docs = before = spark.read.schema(made.schema).parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
