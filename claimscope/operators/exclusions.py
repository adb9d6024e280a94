"""Exclusions: billing while excluded, month status, dispositions, owners."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimscope.functions.names import name_key, name_match, role_weight

#: Statuses from mild to severe; fixed values.
STATUSES = ("before", "reinstated", "waivered", "same_month", "clean_after")
#: Exclusion types that count as fraud in verification, and in the backtest; fixed values.
VERIFY_FRAUD_TYPES = ("1128a1", "1128a3", "1128b1", "1128b2", "1128b6", "1128b7")
BACKTEST_FRAUD_TYPES = ("1128a1", "1128a2", "1128a3", "1128b1", "1128b2", "1128b3", "1128b7")


def type_key(raw: Column) -> Column:
    return F.regexp_replace(F.lower(F.coalesce(raw, F.lit(""))), "[^a-z0-9]", "")


def billed_while_excluded(claims: DataFrame, exclusions: DataFrame) -> DataFrame:
    """For each listed provider that bills: dollars and months before and from the earliest exclusion month."""
    first = exclusions.where("npi is not null and excl_month is not null").groupBy("npi").agg(F.min("excl_month").alias("excl_month"))
    met = claims.join(first, F.col("billing_npi") == F.col("npi"))
    after = F.col("service_month") >= F.col("excl_month")
    return met.groupBy("npi", "excl_month").agg(
        F.sum(F.when(after, F.col("total_paid"))).alias("paid_after_exclusion"), F.count_distinct(F.when(after, F.col("service_month"))).alias("n_months_after"),
        F.min(F.when(after, F.col("service_month"))).alias("first_after"), F.max("service_month").alias("last_month"),
    ).withColumn("billed_after_exclusion", F.col("n_months_after") > 0).withColumn("excluded_after_billing", F.col("n_months_after") == 0)


def month_status(months: DataFrame, records: DataFrame) -> DataFrame:
    """The most severe status of each (npi, service_month) over the provider's exclusion records."""
    m, em, rm, wm = (F.col(c) for c in ("service_month", "excl_month", "rein_month", "waiver_month"))
    level = (
        F.when(em.isNull(), None).when(m < em, 1).when(m == em, 4)
        .when(rm.isNotNull() & (m >= rm), 2).when(wm.isNotNull() & (m >= wm), 3).otherwise(5)
    )
    met = months.join(records.select("npi", "excl_month", "rein_month", "waiver_month"), "npi")
    worst = met.groupBy(*months.columns).agg(F.coalesce(F.max(level), F.lit(1)).alias("level"))
    return worst.withColumn("status", F.element_at(F.array(*[F.lit(s) for s in STATUSES]), F.col("level"))).drop("level")


def dispositions(status: DataFrame) -> DataFrame:
    """One row a provider from months (npi, service_month, paid, claim_lines, status)."""
    paid = F.coalesce(F.col("paid"), F.lit(0))
    of = lambda *s: F.sum(F.when(F.col("status").isin(*s), paid).otherwise(F.lit(0)))
    clean_month = F.when((F.col("status") == "clean_after") & (paid > 0), F.col("service_month"))
    rolled = status.groupBy("npi").agg(
        of("clean_after").alias("paid_after"), F.count(clean_month).alias("n_clean_after_months"), F.sum(F.when(F.col("status") == "clean_after", F.col("claim_lines")).otherwise(F.lit(0))).alias("claim_lines_after"),
        of("same_month").alias("same_month_paid"), of("reinstated", "waivered").alias("reinstated_or_waivered_paid"), of("before").alias("billed_before_paid"),
        F.min(clean_month).alias("first_clean_after_month"), F.max(clean_month).alias("last_clean_after_month"),
    )
    verdict = F.when(F.col("paid_after") > 0, "QUALIFIED").when(F.col("same_month_paid") > 0, "AMBIGUOUS").when(F.col("reinstated_or_waivered_paid") > 0, "DISQUALIFIED").otherwise("CONTEXT_ONLY")
    return rolled.withColumn("disposition", verdict)


def top_codes_after(claims: DataFrame, status: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` codes with most dollars in a provider's clean-after months, as one string."""
    pairs = status.where((F.col("status") == "clean_after") & (F.col("paid") > 0)).select(F.col("npi").alias("billing_npi"), "service_month").distinct()
    paid = claims.join(pairs, ["billing_npi", "service_month"], "left_semi").groupBy("billing_npi", "hcpcs_code").agg(F.sum("total_paid").alias("paid"))
    best = paid.withColumn("rn", F.row_number().over(Window.partitionBy("billing_npi").orderBy(F.col("paid").desc(), "hcpcs_code"))).where(F.col("rn") <= n)
    label = F.concat("hcpcs_code", F.lit("($"), F.bround("paid").cast("bigint").cast("string"), F.lit(")"))
    return best.groupBy(F.col("billing_npi").alias("npi")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rn", label.alias("t")))), lambda x: x["t"]), "; ").alias("top_hcpcs_after"))


def owner_matches(owners: DataFrame, exclusions: DataFrame) -> DataFrame:
    """Owners with tier_a (npi listed) and tier_b (else, name listed): two flag joins, never an OR join."""
    npis = exclusions.where("npi is not null").select(F.col("npi").alias("owner_npi"), F.lit(True).alias("__a")).distinct()
    names = exclusions.where("coalesce(name_key, '') <> ''").select(F.col("name_key").alias("match_key"), F.lit(True).alias("__b")).distinct()
    key = F.when(F.upper(F.coalesce("owner_type", F.lit(""))) == "O", F.col("owner_org_name_key")).otherwise(F.col("owner_name_key"))
    keyed = owners.withColumn("match_key", F.when(F.coalesce(key, F.lit("")) != "", key).otherwise(F.col("owner_name_key")))
    met = keyed.join(npis, "owner_npi", "left").join(names, "match_key", "left")
    a = F.coalesce("__a", F.lit(False))
    return met.withColumn("tier_a", a).withColumn("tier_b", ~a & F.coalesce("__b", F.lit(False))).withColumn("role_weight", role_weight(F.col("owner_role"))).drop("__a", "__b")


def facility_flags(matches: DataFrame) -> DataFrame:
    """Facilities with a listed owner: counts and role weights of both tiers."""
    rolled = matches.where("facility_npi is not null").groupBy("facility_npi").agg(
        F.count(F.lit(1)).alias("n_owners"), F.count_if("tier_a").alias("n_high"), F.count_if("tier_b").alias("n_probable"),
        F.sum(F.when(F.col("tier_a"), F.col("role_weight")).otherwise(0.0)).alias("weighted_high"), F.sum(F.when(F.col("tier_b"), F.col("role_weight")).otherwise(0.0)).alias("weighted_probable"),
    )
    return rolled.where("n_high > 0 or n_probable > 0").withColumns({"has_high_excluded_owner": (F.col("n_high") > 0).cast("int"), "has_probable_excluded_owner": (F.col("n_probable") > 0).cast("int")})


def case_context(cases: DataFrame, records: DataFrame, providers: DataFrame) -> DataFrame:
    """Verified cases with their exclusion records' months and types, whether a type is fraud, and how the names agree.

    ``records``: exclusions with npi, excl_month, rein_month, waiver_state, excl_type, entity_name;
    ``providers``: npi, org_legal_name and further columns. The id decides; names are a check by eye.
    """
    listed = lambda c: F.array_join(F.array_sort(F.collect_set(F.nullif(F.trim(F.col(c)), F.lit("")))), "; ")
    per = records.where("npi is not null").groupBy("npi").agg(
        listed("excl_month").alias("excl_months"), listed("rein_month").alias("reinstated_months"), listed("waiver_state").alias("waiver_states"), F.count(F.lit(1)).alias("n_records"), listed("excl_type").alias("excl_types"),
        F.coalesce(F.bool_or(type_key(F.col("excl_type")).isin(*VERIFY_FRAUD_TYPES)), F.lit(False)).alias("fraud_related_type"),
        F.min_by("entity_name", F.struct(F.coalesce("excl_month", F.lit("9999-99")), "entity_name")).alias("listed_name"),
    )
    met = cases.join(per, "npi", "left").join(providers, "npi", "left")
    return met.withColumn("name_match", name_match(name_key(F.col("org_legal_name")), name_key(F.col("listed_name"))))
