"""Attribution of claims to providers, partitions of the fact, coverage and quarantine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimscope.config import DEFAULT, Config
from claimscope.functions.dates import active_at_claim, month_index
from claimscope.functions.ids import canonical_npi, quarantined
from claimscope.operators import order


def attribute(claims: DataFrame, providers: DataFrame) -> DataFrame:
    """Claims (billing_npi_raw, ...) with canonical ids and their provider's columns; no row is lost or doubled.

    ``providers`` has one row an npi. Ids are canonicalised in place, so one join is enough.
    """
    ready = claims.withColumn("billing_npi", canonical_npi(F.col("billing_npi_raw")))
    dim = providers.withColumnRenamed("npi", "__npi").withColumn("provider_matched", F.lit(True))
    joined = ready.join(dim, F.col("billing_npi") == F.col("__npi"), "left").drop("__npi")
    return joined.withColumn("provider_matched", F.coalesce("provider_matched", F.lit(False))).withColumn(
        "active_at_claim", active_at_claim(F.col("service_month"), F.col("deactivated"), F.col("reactivated"))
    )


def clean_base(fact: DataFrame, ceiling: float = DEFAULT.paid_ceiling) -> DataFrame:
    return fact.where(F.col("provider_matched") & (F.coalesce(F.col("total_paid"), F.lit(0)) <= ceiling))


def partition_bucket(ceiling: float = DEFAULT.paid_ceiling) -> Column:
    """Every row is in exactly one: corrupt, aggregate (plausible, no provider) or base."""
    return F.when(F.coalesce(F.col("total_paid"), F.lit(0)) > ceiling, "corrupt").when(~F.coalesce(F.col("provider_matched"), F.lit(False)), "aggregate").otherwise("base")


def partition_summary(fact: DataFrame, ceiling: float = DEFAULT.paid_ceiling) -> DataFrame:
    return fact.groupBy(partition_bucket(ceiling).alias("bucket")).agg(F.count(F.lit(1)).alias("n_rows"), F.sum("total_paid").alias("paid"))


def coverage(fact: DataFrame) -> DataFrame:
    """Shares of rows and dollars with a provider, in one pass."""
    paid, hit = F.col("total_paid").cast("decimal(38,2)"), F.col("provider_matched")
    total = fact.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(hit).alias("n_matched"), F.sum(paid).alias("paid"), F.sum(F.when(hit, paid)).alias("paid_matched"))
    return total.withColumn("row_share", F.col("n_matched") / F.nullif(F.col("n_rows"), F.lit(0))).withColumn("paid_share", F.col("paid_matched").cast("double") / F.nullif(F.col("paid").cast("double"), F.lit(0.0)))


def coverage_split(fact: DataFrame) -> DataFrame:
    """Rows, dollars and spread with and without a provider; the two groups' quantiles are exact and no task sorts a group."""
    x = F.col("total_paid").cast("double")
    sums = fact.groupBy("provider_matched").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("total_paid").alias("paid"), F.max(x).alias("max_paid"))
    spread = order.quantiles(fact, ["provider_matched"], "total_paid", {"median_paid": 0.5, "p90_paid": 0.9})
    return order._met(sums, spread, ["provider_matched"]).select("provider_matched", "n_rows", "paid", "median_paid", "p90_paid", "max_paid")


def top_unmatched(fact: DataFrame, n: int = 25) -> DataFrame:
    grouped = fact.where(~F.col("provider_matched")).groupBy("billing_npi").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("total_paid").alias("paid"))
    return grouped.orderBy(F.col("paid").desc_nulls_last(), "billing_npi").limit(n)


def runout_flags(claims: DataFrame, months: int = DEFAULT.runout_months) -> DataFrame:
    """Adds is_runout: the month is among the last ``months`` of the data."""
    last = claims.agg(F.max(month_index(F.col("service_month"))).alias("__last"))
    return claims.crossJoin(F.broadcast(last)).withColumn("is_runout", month_index(F.col("service_month")) > F.col("__last") - months).drop("__last")  # last: one row


def quarantine(df: DataFrame, column: str, source: str) -> DataFrame:
    bad = df.where(quarantined(F.col(column)))
    return bad.select(F.lit(source).alias("source"), F.trim(F.col(column)).alias("raw_value"), F.lit("failed_luhn_or_format").alias("reason")).distinct()


def cohort(claims: DataFrame, key: str, threshold: float) -> DataFrame:
    """The claims of keys whose total is over ``threshold``."""
    big = claims.groupBy(key).agg(F.sum("total_paid").alias("t")).where(F.col("t") > threshold).select(key)
    return claims.join(big, key, "left_semi")


def best_record(df: DataFrame, key: list[str], scored: list[str], ties: list[str]) -> DataFrame:
    """One row a key: the most complete in ``scored``, ties by ``ties``."""
    score = sum((F.col(c).isNotNull().cast("int") for c in scored), F.lit(0))
    first = Window.partitionBy(*key).orderBy(score.desc(), *ties)
    return df.withColumn("completeness", score).withColumn("__n", F.row_number().over(first)).where("__n = 1").drop("__n")


def unambiguous(df: DataFrame, key: str, value: str) -> DataFrame:
    """Keys that have exactly one distinct value."""
    found = df.where(F.col(key).isNotNull() & F.col(value).isNotNull()).groupBy(key).agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
    return found.where("lo = hi").select(key, F.col("lo").alias(value))


def resolve_owner(edges: DataFrame, by_enrollment: DataFrame, by_pac: DataFrame) -> DataFrame:
    """facility_npi by enrollment id, else by a PAC id with one npi."""
    a = by_enrollment.select(F.col("enrollment_id"), F.col("npi").alias("__a"))
    b = unambiguous(by_pac, "pac_id", "npi").select("pac_id", F.col("npi").alias("__b"))
    return edges.join(a, "enrollment_id", "left").join(b, "pac_id", "left").withColumn("facility_npi", F.coalesce("__a", "__b")).drop("__a", "__b")
