"""The yearly track: roll-ups of a qualifying cohort, registry and exclusion facts, provider-year features and their ranking."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimscope.config import DEFAULT, Config
from claimscope.functions.dates import month_start
from claimscope.operators import attribution, ml, order, yearly

#: Model inputs in order, what readers see for them, and whether a high value is the odd one; fixed values.
LABELS = {
    "avg_claims_per_beneficiary": ("claims billed per beneficiary", True),
    "avg_paid_per_claim": ("average paid per claim", True),
    "paid_vs_peer_ratio": ("paid-per-claim vs same-specialty peers", True),
    "claims_vs_peer_ratio": ("claims-per-beneficiary vs same-specialty peers", True),
    "n_distinct_hcpcs_vs_peer": ("distinct procedure codes vs peers", True),
    "hcpcs_concentration": ("concentration of billing on a few procedure codes", True),
    "billing_on_deactivated_npi": ("billing after the NPI was deactivated", True),
    "npi_age_days_at_first_claim": ("NPI age (days) at first claim", False),
    "mom_paid_growth_volatility": ("month-on-month paid growth volatility", True),
    "cv_monthly_paid": ("volatility of monthly paid amounts", True),
    "peak_to_median_paid": ("peak-to-median monthly paid ratio", True),
    "onset_ramp_slope": ("ramp-up slope of billing at onset", True),
    "post_peak_dropoff": ("drop-off in billing after a peak", True),
    "new_hcpcs_fraction": ("fraction of procedure codes new this year", True),
    "excess_yoy_growth": ("year-over-year paid growth vs peers", True),
}
#: Inputs whose logarithm is taken; fixed values.
HEAVY_TAILED = ("avg_claims_per_beneficiary", "avg_paid_per_claim", "paid_vs_peer_ratio", "claims_vs_peer_ratio", "n_distinct_hcpcs_vs_peer", "npi_age_days_at_first_claim", "peak_to_median_paid", "cv_monthly_paid")


def qualifying(claims: DataFrame, min_total_paid: float = 10_000_000.0) -> DataFrame:
    """The claims (npi, ...) of providers whose lifetime payments are over the threshold."""
    return attribution.cohort(claims, "npi", min_total_paid)


def monthly(claims: DataFrame) -> DataFrame:
    """By (npi, code, month)."""
    return claims.groupBy("npi", "hcpcs_code", "service_month").agg(F.sum("total_claim_lines").alias("claims"), F.sum("total_patients").alias("beneficiaries"), F.sum("total_paid").alias("paid"))


def annual(months: DataFrame) -> DataFrame:
    """By (npi, year), from monthly()."""
    year = F.substring("service_month", 1, 4).alias("service_year")
    return months.groupBy("npi", year).agg(F.sum("claims").alias("claims"), F.sum("beneficiaries").alias("beneficiaries"), F.sum("paid").alias("paid"))


def summary(months: DataFrame) -> DataFrame:
    """One row a provider, from monthly(); left_censored: it bills in the first month of the data."""
    codes = months.groupBy("npi", "hcpcs_code").agg(F.sum("claims").alias("claims"), F.sum("beneficiaries").alias("beneficiaries"), F.sum("paid").alias("paid")).groupBy("npi").agg(
        F.count("hcpcs_code").alias("n_distinct_hcpcs"), F.sum("claims").alias("total_claims"), F.sum("beneficiaries").alias("total_beneficiaries"), F.sum("paid").alias("total_paid")
    )
    seen = months.groupBy("npi", "service_month").agg(F.count(F.lit(1)).alias("n")).groupBy("npi").agg(
        F.count("service_month").alias("n_active_months"), month_start(F.min("service_month")).alias("first_billing_month"), month_start(F.max("service_month")).alias("last_billing_month")
    )
    start = seen.agg(F.min("first_billing_month").alias("__start"))  # one row
    return codes.join(seen, "npi").crossJoin(F.broadcast(start)).withColumn("left_censored", F.coalesce(F.col("first_billing_month") == F.col("__start"), F.lit(False))).drop("__start")


def enriched(providers: DataFrame, registry: DataFrame, excluded: DataFrame) -> DataFrame:
    """Providers with their registry record and earliest exclusion; none is lost or doubled.

    ``registry``: npi, enumerated, deactivated, ...; ``excluded``: npi, excl_date, reinstate_date, excl_type.
    """
    first = excluded.where("npi is not null").groupBy("npi").agg(F.min(F.struct(F.col("excl_date").isNull().alias("none"), "excl_date", "reinstate_date", "excl_type")).alias("e"))
    listed = first.select("npi", F.col("e.excl_date").alias("excl_date"), F.col("e.reinstate_date").alias("reinstate_date"), F.col("e.excl_type").alias("excl_type"), F.lit(True).alias("__listed"))
    met = providers.join(registry, "npi", "left").join(listed, "npi", "left").withColumn("in_leie", F.coalesce("__listed", F.lit(False))).drop("__listed")
    return met.withColumns({"npi_age_days_at_first_claim": age_at_first_claim(), "billing_on_deactivated_npi": billed_when_deactivated()})


def age_at_first_claim() -> Column:
    """Days from the registry's enumeration date to the first claim month, at least 0."""
    return F.greatest(F.date_diff("first_billing_month", "enumerated"), F.when(F.col("enumerated").isNotNull() & F.col("first_billing_month").isNotNull(), F.lit(0)))


def billed_when_deactivated() -> Column:
    """1 if the last claim month is after a deactivation."""
    return F.coalesce((F.col("last_billing_month") > F.col("deactivated")).cast("int"), F.lit(0))


def excluded_at_year_end(year: Column) -> Column:
    """1 if the exclusion holds at the end of a service year."""
    end = F.make_date(year, F.lit(12), F.lit(31))
    return F.coalesce(((F.col("excl_date") <= end) & (F.col("reinstate_date").isNull() | (F.col("reinstate_date") > end))).cast("int"), F.lit(0))


def provider_years(months: DataFrame, providers: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """All model inputs by (npi, year) with the label, dollars and taxonomy; ``providers`` as enriched() makes them, with taxonomy_code."""
    split = months.withColumns({"year": F.substring("service_month", 1, 4).try_cast("int"), "month_num": F.substring("service_month", 6, 2).try_cast("int")}).where("year is not null and month_num between 1 and 12").drop("service_month")
    cells = yearly.cells(split)
    static = yearly.static(cells)
    tax = providers.select("npi", "taxonomy_code").where("coalesce(taxonomy_code, '') <> ''")
    vectors = yearly.monthly_vectors(split)
    shape = yearly.vector_features(vectors, cfg)
    onset = yearly.onset_slope(split).join(providers.select("npi", F.year("first_billing_month").alias("year")), "npi")
    growth = yearly.log_growth_vs_peer(static, tax, cfg)
    out = static.select("npi", "year", "avg_claims_per_beneficiary", "avg_paid_per_claim", "hcpcs_concentration", "total_paid")
    for part in (yearly.peer_ratios(cells, tax, cfg), yearly.code_count_ratio(cells, tax, cfg), yearly.winsorise(shape, ["peak_to_median_paid"], 0.0), onset, yearly.new_code_fraction(cells), growth):
        out = out.join(part, ["npi", "year"], "left")
    met = out.join(providers.select("npi", "taxonomy_code", "left_censored", "npi_age_days_at_first_claim", "billing_on_deactivated_npi", "excl_date", "reinstate_date", F.year("first_billing_month").alias("__first")), "npi", "left")
    censored = F.coalesce("left_censored", F.lit(False))
    return met.withColumns({
        "new_hcpcs_fraction": F.when(~censored & (F.col("year") != F.col("__first")), F.col("new_hcpcs_fraction")), "excess_yoy_growth": F.when(~censored, F.col("excess_yoy_growth")),
        "is_excluded": excluded_at_year_end(F.col("year")),
    }).withColumnsRenamed({"log_step_volatility": "mom_paid_growth_volatility", "monthly_variation": "cv_monthly_paid", "onset_slope": "onset_ramp_slope", "end_drop": "post_peak_dropoff"}).select(
        "npi", "year", *LABELS, "is_excluded", "total_paid", "taxonomy_code"
    )


def score_years(frame: DataFrame, contamination: float = 0.05, trees: int = 300, seed: int = 42) -> DataFrame:
    """Isolation-forest scores of provider-years: 0 to 1 by least and greatest, flag, top driver, importances.

    Inputs are logged, imputed by medians and standardised; the forest is that of ml.isolation_forest.
    """
    names = list(LABELS)
    ready = ml.standardise(frame.withColumn("__key", F.concat_ws("|", "npi", "year")), names, HEAVY_TAILED)
    raw = ml.isolation_forest(ready, "__key", names, trees=trees, seed=seed, fill=0.0).persist()  # scaled by its own ends
    ends = raw.agg(F.min("iforest_score").alias("lo"), F.max("iforest_score").alias("hi"))  # one row
    cut = order.quantiles(raw, [], "iforest_score", {"cut": 1 - contamination})
    top = F.element_at(F.array(*map(F.lit, names)), F.array_position("importance", F.array_max("importance")).cast("int"))
    spread = raw.crossJoin(F.broadcast(ends)).crossJoin(F.broadcast(cut)).select(
        "__key", F.when(F.col("hi") > F.col("lo"), (F.col("iforest_score") - F.col("lo")) / (F.col("hi") - F.col("lo"))).otherwise(0.0).alias("anomaly_score"),
        (F.col("iforest_score") > F.col("cut")).cast("int").alias("is_anomaly"), top.alias("top_driver"), "importance",
    )
    return frame.withColumn("__key", F.concat_ws("|", "npi", "year")).join(spread, "__key").drop("__key")


def ranking(scored: DataFrame, top: int | None = 200, described: int = 3) -> DataFrame:
    """Provider-years by score with rank and a description of what drives each; ``top`` rows, or all."""
    best = scored.orderBy(F.col("anomaly_score").desc(), "npi", "year").limit(top) if top else scored
    medians = scored.agg(*[F.median(f).alias(f"__m_{f}") for f in LABELS])  # one row
    met = order.ranked(best, -F.col("anomaly_score"), ["npi", "year"], "rank").crossJoin(F.broadcast(medians))
    parts = F.array(*[F.struct((-F.col("importance")[i]).alias("o"), F.lit(-i).alias("j"), _driver(f, label, high, F.col("importance")[i]).alias("text"), F.col("importance")[i].alias("w")) for i, (f, (label, high)) in enumerate(LABELS.items())])
    shown = F.transform(F.filter(F.slice(F.array_sort(parts), 1, described), lambda p: p["w"] >= 0.05), lambda p: p["text"])
    return met.withColumn("description", F.when(F.size(shown) > 0, F.array_join(shown, "; ")).otherwise("no dominant driver identified")).drop("importance", *[f"__m_{f}" for f in LABELS])


def _driver(feature: str, label: str, high_is_odd: bool, weight: Column) -> Column:
    x, m = F.col(feature).cast("double"), F.col(f"__m_{feature}")
    odd = (x > m) if high_is_odd else (x <= m)
    known = F.format_string(f"{label} is %s (value: %.3g, median: %.3g, importance: %.2f)", F.when(odd, "unusually high").otherwise("unusually low"), x, m, weight)
    return F.when(x.isNull() | m.isNull(), F.format_string(f"{label} (importance %.2f)", weight)).otherwise(known)


def provider_ranking(scored: DataFrame, top: int | None = 200) -> DataFrame:
    """One row a provider: worst and mean score, worst year and its driver, years seen and flagged, dollars, ever excluded, rank."""
    worst = F.max_by(F.struct("year", "top_driver", "taxonomy_code"), F.struct("anomaly_score", -F.col("year")))
    per = scored.groupBy("npi").agg(
        F.max("anomaly_score").alias("max_anomaly_score"), F.round(F.avg("anomaly_score"), 4).alias("mean_anomaly_score"), worst.alias("w"), F.count(F.lit(1)).alias("n_years"),
        F.sum("is_anomaly").alias("n_years_flagged"), F.round(F.sum("total_paid").cast("double"), 2).alias("total_paid_all_years"), F.max("is_excluded").alias("ever_excluded"),
    ).select("*", F.col("w.year").alias("worst_year"), F.col("w.top_driver").alias("worst_year_top_driver"), F.col("w.taxonomy_code").alias("taxonomy_code")).drop("w")
    best = per.orderBy(F.col("max_anomaly_score").desc(), "npi").limit(top) if top else per
    return order.ranked(best, -F.col("max_anomaly_score"), ["npi"], "rank")
