"""Provider-year features, from monthly cells (npi, hcpcs_code, year, month_num, paid, claims, beneficiaries)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimscope.config import DEFAULT, Config
from claimscope.functions.numbers import ratio
from claimscope.operators import order

YEAR = ["npi", "year"]


def cells(monthly: DataFrame) -> DataFrame:
    return monthly.groupBy(*YEAR, "hcpcs_code").agg(F.sum("claims").alias("claims"), F.sum("beneficiaries").alias("beneficiaries"), F.sum("paid").alias("paid"))


def static(cells_df: DataFrame) -> DataFrame:
    c = F.col("claims").cast("double")
    total = cells_df.groupBy(*YEAR).agg(F.sum("claims").alias("claims"), F.sum("beneficiaries").alias("beneficiaries"), F.sum("paid").alias("total_paid"), F.count("hcpcs_code").alias("n_hcpcs"), F.sum(c * c).alias("sq"))
    n = F.col("claims").cast("double")
    return total.select(*YEAR, ratio(F.col("claims"), F.col("beneficiaries")).alias("avg_claims_per_beneficiary"), ratio(F.col("total_paid"), F.col("claims")).alias("avg_paid_per_claim"), F.when(n > 0, F.col("sq") / (n * n)).alias("hcpcs_concentration"), "n_hcpcs", "total_paid")


def winsorise(df: DataFrame, columns: list[str], low: float = 0.01, high: float = 0.99) -> DataFrame:
    """Clips to exact quantiles of the whole column; all columns' bounds come from one pass, as one row."""
    df = df.persist()  # provider-years: read for the bounds and again for the result
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("double").alias("x")) for c in columns])).alias("e")).select("e.c", "e.x")
    ends = order.quantiles(long, ["c"], "x", {"lo": low, "hi": high})
    bounds = ends.agg(*[F.max(F.when(F.col("c") == c, F.col(q))).alias(f"__{c}{i}") for c in columns for i, q in enumerate(("lo", "hi"))])
    wide = df.crossJoin(F.broadcast(bounds))  # one row
    clip = lambda c: F.when(F.col(c).isNotNull(), F.greatest(F.least(F.col(c), F.col(f"__{c}1")), F.col(f"__{c}0"))).alias(c)
    return wide.select(*[clip(c) if c in columns else F.col(c) for c in df.columns])


def peer_ratios(cells_df: DataFrame, providers: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Claims-weighted geometric means of a provider's rates over those of its specialty for the same code and year.

    ``cells_df`` has one row for each (npi, year, code), so peers are rows.
    """
    group = ["taxonomy_code", "year", "hcpcs_code"]
    rated = cells_df.join(providers.where("taxonomy_code is not null"), "npi").withColumns({"paid_rate": ratio(F.col("paid"), F.col("claims")), "claims_rate": ratio(F.col("claims"), F.col("beneficiaries"))})
    peers = rated.groupBy(*group).agg(F.median("paid_rate").alias("paid_med"), F.median("claims_rate").alias("claims_med"), F.count(F.lit(1)).alias("n_peers"))
    met = rated.join(peers, group)

    def mean(kind: str) -> Column:
        rate, med = F.col(f"{kind}_rate"), F.col(f"{kind}_med")
        log = F.when((F.col("n_peers") >= cfg.yearly_min_peers) & (med > 0) & (rate > 0), F.ln(rate / med))
        w = F.when(log.isNotNull(), F.col("claims").cast("double"))
        return F.exp(F.sum(w * log) / F.nullif(F.sum(w), F.lit(0.0))).alias(f"{kind}_vs_peer_ratio")

    return winsorise(met.groupBy(*YEAR).agg(mean("paid"), mean("claims")), ["paid_vs_peer_ratio", "claims_vs_peer_ratio"])


def code_count_ratio(cells_df: DataFrame, providers: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    counts = cells_df.groupBy(*YEAR).agg(F.count("hcpcs_code").alias("n")).join(providers, "npi")
    peers = counts.where("taxonomy_code is not null").groupBy("taxonomy_code", "year").agg(F.median("n").alias("med"), F.count(F.lit(1)).alias("n_peers"))
    return counts.join(peers, ["taxonomy_code", "year"]).select(*YEAR, F.when((F.col("n_peers") >= cfg.yearly_min_peers) & (F.col("med") > 0), F.col("n") / F.col("med")).alias("n_distinct_hcpcs_vs_peer"))


def new_code_fraction(cells_df: DataFrame) -> DataFrame:
    first = cells_df.withColumn("first", F.min("year").over(Window.partitionBy("npi", "hcpcs_code")))
    return first.groupBy(*YEAR).agg((F.count_if(F.col("first") == F.col("year")) / F.count(F.lit(1))).alias("new_hcpcs_fraction"))


def log_growth_vs_peer(static_df: DataFrame, providers: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Log growth of dollars over the data's previous year, less the specialty's median, winsorised; null among few peers.

    A year without dollars, or with too few for a logarithm, has no growth.
    """
    years = static_df.select("year").distinct().withColumn("before", F.lag("year").over(Window.orderBy("year")))  # a few years
    own = static_df.select(*YEAR, F.col("total_paid").cast("double").alias("p")).where("p <> 0 and p > -1").withColumn("p", F.log1p("p"))
    last = own.select("npi", F.col("year").alias("before"), F.col("p").alias("q"))
    grown = own.join(F.broadcast(years), "year").join(last, ["npi", "before"]).withColumn("g", F.col("p") - F.col("q")).join(providers.where("taxonomy_code is not null"), "npi")
    typical = grown.groupBy("taxonomy_code", "year").agg(F.median("g").alias("m"), F.count(F.lit(1)).alias("n"))
    excess = F.when(F.col("n") >= cfg.yearly_min_peers, F.col("g") - F.col("m"))
    return winsorise(grown.join(typical, ["taxonomy_code", "year"]).select(*YEAR, excess.alias("excess_yoy_growth")), ["excess_yoy_growth"])


def monthly_vectors(monthly: DataFrame) -> DataFrame:
    """p1..p12 and c1..c12 (floored at 0), active_months, first_active_month."""
    def month(name: str, c: str, i: int) -> Column:
        return F.greatest(F.sum(F.when(F.col("month_num") == i, F.col(c)).otherwise(F.lit(0))), F.lit(0)).cast("double").alias(f"{name}{i}")

    wide = monthly.groupBy(*YEAR).agg(*[month("p", "paid", i) for i in range(1, 13)], *[month("c", "claims", i) for i in range(1, 13)])
    p = F.array(*[F.col(f"p{i}") for i in range(1, 13)])
    positive = F.transform(p, lambda x, i: F.when(x > 0, i + 1))
    return wide.withColumn("active_months", F.size(F.array_compact(positive))).withColumn("first_active_month", F.array_min(positive))


def vector_features(vectors: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Volatility, variation, peak over median and end drop of the twelve months; null below the active-month floors."""
    p = F.array(*[F.col(f"p{i}") for i in range(1, 13)])
    mean = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x) / F.size(a)
    var = lambda a: F.aggregate(F.transform(a, lambda x: (x - mean(a)) * (x - mean(a))), F.lit(0.0), lambda s, x: s + x) / (F.size(a) - 1)
    logs = F.transform(p, lambda x: F.log1p(x))
    steps = F.zip_with(F.slice(logs, 2, 11), F.slice(logs, 1, 11), lambda b, a: b - a)
    active = F.array_sort(F.filter(p, lambda x: x > 0))
    n = F.size(active)
    median = (F.try_element_at(active, ((n + 1) / 2).cast("int")) + F.try_element_at(active, ((n + 2) / 2).cast("int"))) / 2
    enough = F.col("active_months") >= cfg.yearly_min_active
    return vectors.select(
        *YEAR, F.when(enough, F.sqrt(var(steps))).alias("log_step_volatility"), F.when(enough, F.sqrt(var(p)) / (mean(p) + 1)).alias("monthly_variation"),
        F.when(F.col("active_months") >= 3, F.array_max(p) / (median + 1)).alias("peak_to_median_paid"), F.when(enough, 1 - mean(F.slice(p, 10, 3)) / (F.array_max(p) + 1)).alias("end_drop"),
    )


def onset_slope(monthly: DataFrame) -> DataFrame:
    """Least-squares slope of ln(paid + 1) over the first six positive months of a provider that starts inside the data."""
    by_month = monthly.groupBy("npi", (F.col("year") * 12 + F.col("month_num")).alias("m")).agg(F.greatest(F.sum("paid"), F.lit(0)).cast("double").alias("p"))
    start = by_month.agg(F.min("m").alias("m0"))
    active = by_month.where("p > 0").withColumn("rn", F.row_number().over(Window.partitionBy("npi").orderBy("m"))).crossJoin(F.broadcast(start))  # start: one row
    first = F.min("m").over(Window.partitionBy("npi"))
    early = active.withColumn("first", first).where("rn <= 6 and first > m0 and floor((m - 1) / 12) = floor((first - 1) / 12)")
    return early.groupBy("npi").agg(F.when(F.count(F.lit(1)) >= 4, F.regr_slope(F.ln(F.col("p") + 1), F.col("m").cast("double"))).alias("onset_slope"))


def provider_summary(scored_years: DataFrame, score: str = "score", flag: str = "is_anomaly") -> DataFrame:
    """One row a provider from scored years: worst year and score, mean score, years seen and flagged."""
    return scored_years.groupBy("npi").agg(
        F.max(F.struct(F.col(score), -F.col("year")))[score].alias("max_score"), (-F.max(F.struct(F.col(score), (-F.col("year")).alias("y")))["y"]).alias("worst_year"),
        F.avg(score).alias("mean_score"), F.count(F.lit(1)).alias("n_years"), F.count_if(F.col(flag)).alias("n_flagged"),
    )
