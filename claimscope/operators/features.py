"""Features at any grain, from claims (key, hcpcs_code, service_month, total_paid, ...).

A claim is read twice at most: once summed by (key, code), once by (key, month); what follows
works on these sums.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimscope.config import DEFAULT, Config
from claimscope.functions.dates import month_start, tenure_months
from claimscope.functions.numbers import ratio


def _paid() -> Column:
    return F.col("total_paid")


def _gross() -> Column:
    return F.sum(F.when(_paid() > 0, _paid()).otherwise(F.lit(0)))


def by_code(claims: DataFrame, key: str) -> DataFrame:
    return claims.groupBy(key, "hcpcs_code").agg(
        _gross().alias("gross_paid_code"), F.sum(_paid()).alias("net_paid_code"), F.sum("total_claim_lines").alias("claim_lines"), F.sum("total_patients").alias("patients")
    )


def by_month(claims: DataFrame, key: str) -> DataFrame:
    return claims.groupBy(key, "service_month").agg(
        F.sum(_paid()).alias("net_paid"), _gross().alias("gross_paid"), F.sum("total_claim_lines").alias("claim_lines")
    ).withColumn("month_date", month_start(F.col("service_month")))


def core(claims: DataFrame, key: str, carried: dict[str, str] | None = None) -> DataFrame:
    """Lifetime volumes and ratios; ``carried`` maps output names to columns of which the least is kept.

    Codes and months are counted as rows of the sums by (key, code) and (key, month), so no claim
    is repeated for the distinct counts.
    """
    least = {f"__c_{name}": c for name, c in (carried or {}).items()}
    codes = claims.groupBy(key, "hcpcs_code").agg(
        *[F.min(c).alias(name) for name, c in least.items()], _gross().alias("g"), F.sum(_paid()).alias("n"), F.sum(F.when(_paid() < 0, _paid()).otherwise(F.lit(0))).alias("r"),
        F.sum("total_claim_lines").alias("l"), F.sum("total_patients").alias("p"),
    )
    total = codes.groupBy(key).agg(
        *[F.min(f"__c_{name}").alias(name) for name in carried or {}],
        F.sum("g").alias("gross_paid"), F.sum("n").alias("net_paid"), F.sum("r").alias("reversal_amount"), F.sum("l").alias("total_claim_lines"), F.sum("p").alias("service_volume"), F.count("hcpcs_code").alias("n_distinct_hcpcs"),
    )
    months = claims.groupBy(key, "service_month").agg(F.count(F.lit(1)).alias("__n")).groupBy(F.col(key).alias("__key")).agg(
        F.count("service_month").alias("n_active_months"), F.min("service_month").alias("first_month"), F.max("service_month").alias("last_month")
    )
    met = total.join(months, F.col(key).eqNullSafe(F.col("__key"))).drop("__key")
    return with_ratios(met).withColumns({
        "reversal_ratio": ratio(F.abs("reversal_amount"), F.col("gross_paid")),
        "tenure_months": tenure_months(month_start(F.col("first_month")), month_start(F.col("last_month"))),
    })


def with_ratios(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "paid_per_claim_line": ratio(F.col("net_paid"), F.col("total_claim_lines")),
        "paid_per_patient_instance": ratio(F.col("net_paid"), F.col("service_volume")),
        "lines_per_patient_instance": ratio(F.col("total_claim_lines"), F.col("service_volume")),
    })


def concentration(codes: DataFrame, key: str) -> DataFrame:
    """Top share and Herfindahl index over the positive dollars of codes; one aggregation, no join."""
    g = F.col("gross_paid_code").cast("double")
    return codes.groupBy(key).agg(F.max(g).alias("top"), F.sum(g).alias("g"), F.sum(g * g).alias("sq")).select(
        key, ratio(F.col("top"), F.col("g")).alias("top_hcpcs_paid_share"), F.when(F.col("g") > 0, F.col("sq") / (F.col("g") * F.col("g"))).alias("hcpcs_hhi")
    )


def temporal(months: DataFrame, key: str, cfg: Config = DEFAULT) -> DataFrame:
    """Peak, volatility, growth and surge onset over mature months."""
    bounds = months.agg(F.max("month_date").alias("dmax"), F.min("month_date").alias("dmin"))
    back = lambda n: F.add_months("dmax", -n)
    mature = months.crossJoin(F.broadcast(bounds)).where(F.col("month_date") <= back(cfg.maturity_months))  # bounds: one row
    net, date, m = F.col("net_paid").cast("double"), F.col("month_date"), cfg.maturity_months
    found = mature.groupBy(key).agg(
        F.max(net).alias("max_single_month_net_paid"), F.avg(net).alias("mean"), F.stddev_samp(net).alias("sd"), F.median(net).alias("median"),
        (F.min(date) > F.min("dmin")).alias("starts_later"),
        F.sum(F.when(date > back(m + 12), net)).alias("recent"), F.sum(F.when((date <= back(m + 12)) & (date > back(m + 24)), net)).alias("prior"),
    )
    return found.select(
        key, "max_single_month_net_paid", F.when(F.col("mean") != 0, F.col("sd") / F.abs("mean")).alias("month_to_month_volatility"),
        (ratio(F.col("recent"), F.col("prior")) - 1).alias("yoy_growth_net_paid"),
        (F.col("starts_later") & (ratio(F.col("max_single_month_net_paid"), F.col("median")) >= cfg.surge_ratio)).alias("new_biller_surge_onset"),
    )


def rate_features(claims: DataFrame, key: str, cfg: Config = DEFAULT, codes: DataFrame | None = None, months: DataFrame | None = None) -> DataFrame:
    """Size-normalised features, the same at provider and company grain; by_code() and by_month() sums are reused if given."""
    codes, months = codes if codes is not None else by_code(claims, key), months if months is not None else by_month(claims, key)
    g = F.col("gross_paid_code").cast("double")
    totals = codes.groupBy(key).agg(
        F.sum("gross_paid_code").alias("gross_paid"), F.sum("net_paid_code").alias("net_paid"), F.sum("claim_lines").alias("total_claim_lines"), F.sum("patients").alias("service_volume"), F.count("hcpcs_code").alias("n_distinct_hcpcs"),
        F.max(g).alias("__top"), F.sum(g).alias("__g"), F.sum(g * g).alias("__sq"),
    )
    wide = with_ratios(totals).withColumns({
        "top_hcpcs_paid_share": ratio(F.col("__top"), F.col("__g")), "hcpcs_hhi": F.when(F.col("__g") > 0, F.col("__sq") / (F.col("__g") * F.col("__g"))),
    }).drop("__top", "__g", "__sq")
    return wide.join(temporal(months, key, cfg).drop("new_biller_surge_onset"), key, "left")


def rare_codes(claims: DataFrame, cell: list[str], who: str, cfg: Config = DEFAULT) -> DataFrame:
    """(cell, code) pairs billed by less than the rare share of the cell's ``who``."""
    return rare_pairs(claims.select(*cell, "hcpcs_code", who).distinct(), cell, who, cfg)


def rare_pairs(pairs: DataFrame, cell: list[str], who: str, cfg: Config = DEFAULT) -> DataFrame:
    """As rare_codes(), from distinct (cell, code, ``who``): by_code() sums with their cell."""
    of_code = pairs.groupBy(*cell, "hcpcs_code").agg(F.count(who).alias("n_code"))
    of_cell = pairs.select(*cell, who).distinct().groupBy(*cell).agg(F.count(who).alias("n_cell"))
    return of_code.join(of_cell, cell).where((F.col("n_cell") > 0) & (F.col("n_code") / F.col("n_cell") < cfg.rare_share)).select(*cell, "hcpcs_code", F.lit(True).alias("rare"))


def rare_share(codes: DataFrame, dims: DataFrame, rare: DataFrame, cell: list[str], key: str, name: str) -> DataFrame:
    """The share of a key's positive dollars on codes that are rare in its cell."""
    return share_of_rare(codes.join(dims.select(key, *cell), key), rare, cell, key, name)


def share_of_rare(placed: DataFrame, rare: DataFrame, cell: list[str], key: str, name: str) -> DataFrame:
    """As rare_share(), from by_code() sums with their cell."""
    placed = placed.join(rare, [*cell, "hcpcs_code"], "left")
    g = F.col("gross_paid_code").cast("double")
    return placed.groupBy(key).agg(ratio(F.sum(F.when(F.col("rare"), g).otherwise(0.0)), F.sum(g)).alias(name))
