"""Diagnosis of claims that meet no provider: classes of identifiers, codes, and whether the track is clean."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimscope.config import DEFAULT, Config
from claimscope.functions.ids import identifier_bucket

#: The class that may hold real providers who are missing from the registry.
AMBIGUOUS = "valid_not_registered"


def unmatched_ids(fact: DataFrame, raw: str = "billing_npi_raw") -> DataFrame:
    """Rows and dollars of each literal identifier that meets no provider, with its class."""
    found = fact.where(~F.coalesce(F.col("provider_matched"), F.lit(False))).groupBy(F.col(raw).alias("raw_value")).agg(F.count(F.lit(1)).alias("n_rows"), F.sum("total_paid").alias("paid"))
    return found.withColumn("bucket", identifier_bucket(F.col("raw_value")))


def bucket_shares(ids: DataFrame) -> DataFrame:
    """Distinct ids, rows, dollars and the share of unmatched dollars by class; a handful of rows."""
    per = ids.groupBy("bucket").agg(F.count(F.lit(1)).alias("distinct_ids"), F.sum("n_rows").alias("n_rows"), F.sum("paid").alias("paid"))
    return _with_share(per, ids)


def code_shares(fact: DataFrame, n: int = 25) -> DataFrame:
    """The n codes with most unmatched dollars, and their share of them."""
    lost = fact.where(~F.coalesce(F.col("provider_matched"), F.lit(False)))
    code = F.when(F.coalesce("hcpcs_code", F.lit("")) == "", "(blank)").otherwise(F.col("hcpcs_code"))
    per = lost.groupBy(code.alias("hcpcs_code")).agg(F.count(F.lit(1)).alias("n_rows"), F.sum("total_paid").alias("paid"))
    return _with_share(per, lost.select(F.col("total_paid").alias("paid"))).orderBy(F.col("paid").desc_nulls_last(), "hcpcs_code").limit(n)


def _with_share(per: DataFrame, whole: DataFrame) -> DataFrame:
    total = whole.agg(F.sum("paid").alias("__all"))  # one row
    return per.crossJoin(F.broadcast(total)).withColumn("paid_share", F.col("paid").cast("double") / F.nullif(F.col("__all").cast("double"), F.lit(0.0))).drop("__all")


def quarantine_accounting(ids: DataFrame, quarantined: DataFrame) -> DataFrame:
    """Rows and dollars on quarantined identifiers (raw_value, distinct), and their share of unmatched dollars."""
    bad = quarantined.select("raw_value").distinct().withColumn("__bad", F.lit(True))
    met = ids.withColumn("raw_value", F.trim("raw_value")).join(bad, "raw_value", "left")
    hit = F.col("__bad").isNotNull()
    sums = met.agg(F.count_if(hit).alias("n_ids"), F.coalesce(F.sum(F.when(hit, F.col("n_rows"))), F.lit(0)).alias("n_rows"), F.coalesce(F.sum(F.when(hit, F.col("paid"))), F.lit(0)).alias("paid"), F.sum("paid").alias("__all"))
    return sums.withColumn("paid_share", F.col("paid").cast("double") / F.nullif(F.col("__all").cast("double"), F.lit(0.0))).drop("__all")


def ambiguity(buckets: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """One row: the ambiguous class's share of unmatched dollars, and whether the aggregate track may be segregated."""
    share = F.coalesce(F.sum(F.when(F.col("bucket") == AMBIGUOUS, F.col("paid_share"))), F.lit(0.0))
    return buckets.agg(share.alias("ambiguous_share")).withColumn("segregate", F.col("ambiguous_share") < cfg.ambiguity_share)
