"""Peer statistics and scoring.

Metrics are unpivoted to rows (key, group, metric, value), so all of them are ranked or summed up
in one exchange by (group, metric) instead of one for each metric.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimscope.config import DEFAULT, Config
from claimscope.functions.numbers import mean_tie_percentile

METRICS = ("net_paid", "paid_per_claim_line", "lines_per_patient_instance", "paid_per_patient_instance")
FEATURES = ("paid_per_patient_instance", "lines_per_patient_instance", "paid_per_claim_line", "top_hcpcs_paid_share", "hcpcs_hhi", "rare_share", "month_to_month_volatility", "yoy_growth_net_paid")
CONTEXT = "log_max_single_month"
#: Concepts and the features that stand for them; fixed values.
CONCEPTS = {
    "concentration": ("top_hcpcs_paid_share", "hcpcs_hhi"),
    "payment_intensity": ("paid_per_patient_instance", "paid_per_claim_line"),
    "service_intensity": ("lines_per_patient_instance",),
    "specialty_mismatch": ("rare_share",),
    "temporal": ("yoy_growth_net_paid", "month_to_month_volatility"),
}
Z = 1.4826


def unpivot(df: DataFrame, ids: list[str], metrics: tuple[str, ...]) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("x")) for m in metrics])
    return df.select(*ids, F.explode(pairs).alias("e")).select(*ids, "e.metric", "e.x")


def pivot(long: DataFrame, ids: list[str], metrics: tuple[str, ...], values: dict[str, str]) -> DataFrame:
    """One row for ids; column ``values[v].format(metric)`` holds v of that metric."""
    return long.groupBy(*ids).agg(*[F.max(F.when(F.col("metric") == m, F.col(v))).alias(name.format(m)) for m in metrics for v, name in values.items()])


def robust_z(long: DataFrame, group: str) -> DataFrame:
    """Adds z = 1.4826 (x - median) / MAD within (group, metric); null where the MAD is 0.

    The constant multiplies, as the scores that users compare with are defined that way.
    """
    stats = long.groupBy(group, "metric").agg(F.median("x").alias("med"))
    mid = long.join(stats, [group, "metric"])
    mads = mid.groupBy(group, "metric").agg(F.median(F.abs(F.col("x") - F.col("med"))).alias("mad"))
    return mid.join(mads, [group, "metric"]).withColumn("z", F.lit(Z) * (F.col("x") - F.col("med")) / F.nullif(F.col("mad"), F.lit(0.0)))


def peer_features(df: DataFrame, key: str, group: Column, suffix: str, metrics: tuple[str, ...] = METRICS, cfg: Config = DEFAULT) -> DataFrame:
    """For each key with a group: robust z and percent rank of each metric, group size, too-small flag."""
    grouped = df.withColumn("gk", group).where(F.col("gk").isNotNull())
    sizes = grouped.groupBy("gk").agg(F.count(F.lit(1)).alias("sz"))
    long = unpivot(grouped, [key, "gk"], metrics)
    ranked = robust_z(long, "gk").withColumn("p", F.percent_rank().over(Window.partitionBy("gk", "metric").orderBy(F.col("x").asc_nulls_last()))).join(sizes, "gk")
    big = F.col("sz") >= cfg.min_peers
    shown = ranked.withColumn("z", F.when(big, F.col("z"))).withColumn("p", F.when(big, F.col("p")))
    wide = pivot(shown, [key, "sz"], metrics, {"z": "{}_rz_" + suffix, "p": "{}_pct_" + suffix})
    return wide.withColumn(f"peer_group_too_small_{suffix}", F.col("sz") < cfg.min_peers).withColumnRenamed("sz", f"peer_group_size_{suffix}")


def not_scored_reason(has_taxonomy: Column, small: Column, gate: Column | None = None) -> Column:
    reason = F.when(F.col("gross_paid") <= 0, "degenerate_zero_gross_paid").when(~has_taxonomy, "missing_taxonomy")
    if gate is not None:
        reason = reason.when(~gate, "low_volume_unreliable")
    return reason.when(small, "peer_group_too_small(<30)").otherwise("")


def _has_taxonomy() -> Column:
    return F.coalesce(F.col("primary_taxonomy"), F.lit("")) != ""


def anomaly_v1(df: DataFrame, key: str, cfg: Config = DEFAULT) -> DataFrame:
    """Signals are clipped robust z of 3.5 or more among scorable taxonomy peers; the score sums them."""
    size = F.count(F.lit(1)).over(Window.partitionBy(F.when(_has_taxonomy(), F.col("primary_taxonomy")).otherwise(F.concat(F.lit("|"), F.col(key).cast("string")))))  # rows without a taxonomy stand alone
    sized = df.withColumn("small", _has_taxonomy() & (size < cfg.min_peers))
    scorable = (F.col("gross_paid") > 0) & _has_taxonomy() & ~F.col("small")
    base = sized.withColumn("scorable", scorable).withColumn("reason", not_scored_reason(_has_taxonomy(), F.col("small")))
    long = robust_z(unpivot(base.where("scorable"), [key, "primary_taxonomy"], FEATURES), "primary_taxonomy")
    z = F.greatest(F.lit(-cfg.z_clip), F.least(F.lit(cfg.z_clip), F.col("z")))
    hit = F.when(F.col("z").isNotNull(), z) >= cfg.z_cutoff
    scored = long.groupBy(key).agg(F.count_if(hit).alias("n_anomaly_signals"), F.coalesce(F.sum(F.when(hit, z)), F.lit(0.0)).alias("anomaly_score"), F.array_sort(F.collect_set(F.when(hit, F.col("metric")))).alias("signals"))
    return base.select(key, "scorable", F.col("reason").alias("not_scored_reason")).join(scored, key, "left").select(
        key, (~F.col("scorable")).alias("not_scored"), "not_scored_reason", F.coalesce("n_anomaly_signals", F.lit(0)).cast("int").alias("n_anomaly_signals"), "anomaly_score",
        F.coalesce("signals", F.array().cast("array<string>")).alias("signals"), (F.coalesce("n_anomaly_signals", F.lit(0)) >= cfg.min_signals).alias("anomaly_lead"),
    )


def _peer_sizes(df: DataFrame, base: Column, key: str) -> DataFrame:
    """Adds te_n and tax_n: scorable-base rows in the row's cell and taxonomy. One exchange; rows without a taxonomy stand alone."""
    group = F.when(_has_taxonomy(), F.col("primary_taxonomy")).otherwise(F.concat(F.lit("|"), F.col(key).cast("string")))
    counted = F.when(base, F.lit(1))
    sized = df.withColumn("__g", group).withColumn("tax_n", F.count(counted).over(Window.partitionBy("__g")))
    return sized.withColumn("te_n", F.count(counted).over(Window.partitionBy("__g", "entity_type"))).drop("__g")


def anomaly_v2(df: DataFrame, key: str, cfg: Config = DEFAULT) -> DataFrame:
    """Percentiles within (taxonomy, entity) if large enough, else among the rows that fell back to the taxonomy."""
    base = (F.col("gross_paid") > 0) & _has_taxonomy()
    sized = _peer_sizes(df, base, key)
    te = base & (F.col("te_n") >= cfg.min_peers)
    tax = base & (F.col("tax_n") >= cfg.min_peers)
    placed = sized.withColumn("peer_basis", F.when(te, "taxonomy_x_entity").when(tax, "taxonomy_only").otherwise("too_small"))
    placed = placed.withColumn("peer_key", F.when(te, F.concat_ws("|", "primary_taxonomy", "entity_type")).when(tax, F.col("primary_taxonomy")))
    scored = unpivot(placed.where("peer_key is not null"), [key, "peer_key"], FEATURES).withColumn("pct", mean_tie_percentile(F.col("x"), F.col("peer_key"), F.col("metric")))
    agg = scored.groupBy(key).agg(F.count_if(F.col("pct") >= cfg.extreme_pct).alias("n"), F.avg("pct").alias("mean_percentile"))
    return placed.select(key, "peer_basis", not_scored_reason(_has_taxonomy(), F.col("peer_key").isNull()).alias("not_scored_reason")).join(agg, key, "left").select(
        key, "peer_basis", "not_scored_reason", F.coalesce("n", F.lit(0)).cast("int").alias("n_extreme_p99"), F.col("mean_percentile").alias("anomaly_score_v2"), (F.coalesce("n", F.lit(0)) >= cfg.min_signals).alias("anomaly_lead_v2")
    )


def score_concepts(df: DataFrame, key: str, cfg: Config = DEFAULT) -> DataFrame:
    """Concept percentiles behind a volume gate; cells that are too small use the whole taxonomy.

    Needs primary_taxonomy, entity_type, gross_paid, service_volume, total_claim_lines, FEATURES
    and CONTEXT. The same for providers and companies.
    """
    gate = F.coalesce((F.col("service_volume") >= cfg.min_service_volume) & (F.col("total_claim_lines") >= cfg.min_claim_lines), F.lit(False))
    base = (F.col("gross_paid") > 0) & _has_taxonomy() & gate
    sized = _peer_sizes(df, base, key).withColumn("use_te", F.col("te_n") >= cfg.min_peers)
    large = F.col("use_te") | (F.col("tax_n") >= cfg.min_peers)
    placed = sized.withColumns({
        "scorable": base & large,
        "peer_basis": F.when(F.col("use_te"), "taxonomy_x_entity").when(F.col("tax_n") >= cfg.min_peers, "taxonomy_only").otherwise("too_small"),
        "not_scored_reason": not_scored_reason(_has_taxonomy(), ~large, gate),
    })
    tax, entity, metric, x = (F.col(c) for c in ("primary_taxonomy", "entity_type", "metric", "x"))
    long = unpivot(placed.where("scorable"), [key, "use_te", "primary_taxonomy", "entity_type"], (*FEATURES, CONTEXT))
    pct = long.withColumn("tx", mean_tie_percentile(x, tax, metric)).withColumn("te", mean_tie_percentile(x, tax, metric, entity)).withColumn("pct", F.when(F.col("use_te"), F.col("te")).otherwise(F.col("tx")))
    wide = pivot(pct, [key], (*FEATURES, CONTEXT), {"pct": "pct_{}"})
    concepts = wide.select(key, f"pct_{CONTEXT}", *[(F.greatest(*[F.col(f"pct_{f}") for f in fs]) if len(fs) > 1 else F.col(f"pct_{fs[0]}")).alias(c) for c, fs in CONCEPTS.items()])
    extreme = [F.coalesce(F.col(c) >= cfg.extreme_pct, F.lit(False)) for c in CONCEPTS]
    total = reduce(lambda a, b: a + b, [F.coalesce(F.col(c), F.lit(0.0)) for c in CONCEPTS])
    known = reduce(lambda a, b: a + b, [F.col(c).isNotNull().cast("int") for c in CONCEPTS])
    text = [F.when(e, F.format_string(f"{c}(pct=%.3f)", F.col(c))) for c, e in zip(CONCEPTS, extreme)]
    text.append(F.when(F.col(f"pct_{CONTEXT}") >= cfg.extreme_pct, F.format_string(f"{CONTEXT}(pct=%.3f,context)", F.col(f"pct_{CONTEXT}"))))
    scored = concepts.select(
        key, *CONCEPTS, reduce(lambda a, b: a + b, [e.cast("int") for e in extreme]).alias("n"), (total / F.nullif(known, F.lit(0))).alias("score"), F.array_compact(F.array(*text)).alias("why")
    )
    return placed.select(key, "scorable", "peer_basis", "not_scored_reason").join(scored, key, "left").select(
        key, "peer_basis", (~F.col("scorable")).alias("not_scored"), "not_scored_reason", *CONCEPTS, F.coalesce("n", F.lit(0)).alias("n_concept_signals"), F.col("score").alias("anomaly_score"),
        (F.coalesce("n", F.lit(0)) >= cfg.min_signals).alias("anomaly_lead"), F.coalesce("why", F.array().cast("array<string>")).alias("contributing_concepts"),
    )


def implausible(df: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    return df.withColumns({
        "rule_implausible_lines_per_patient": F.coalesce(F.col("lines_per_patient_instance") > cfg.max_lines_per_patient, F.lit(False)),
        "rule_implausible_paid_per_line": F.coalesce(F.col("paid_per_claim_line") > cfg.max_paid_per_line, F.lit(False)),
    })


#: Tiers in order of precedence; fixed values.
TIERS = ("1_L1_billed_after_exclusion", "2_L1_implausible_rate", "3_L1_excluded_after_billing", "4_L2_anomaly", "5_L3_probable_owner", "6_none")


def priority_tier(billed_after: Column, implausible_rate: Column, excluded_after: Column, anomaly: Column, owner: Column) -> Column:
    flags = [F.coalesce(c, F.lit(False)) for c in (billed_after, implausible_rate, excluded_after, anomaly, owner)]
    return F.coalesce(*[F.when(f, t) for f, t in zip(flags, TIERS)], F.lit(TIERS[-1]))


def rule_reasons() -> Column:
    """Reasons of the deterministic rules, as a list; empty where none applies."""
    billed = F.concat(F.lit("billed_after_exclusion(paid_after=$"), F.format_number(F.col("paid_after_exclusion").cast("double"), 0), F.lit(",months="), F.col("n_months_after").cast("string"), F.lit(")"))
    return F.array_compact(F.array(
        F.when(F.coalesce("billed_after_exclusion", F.lit(False)), billed),
        F.when(F.coalesce("excluded_after_billing", F.lit(False)), F.lit("excluded_after_billing(on_LEIE,billing_predates_exclusion)")),
        F.when(F.col("rule_implausible_lines_per_patient"), F.format_string("implausible_lines_per_patient(=%.1f)", F.col("lines_per_patient_instance"))),
        F.when(F.col("rule_implausible_paid_per_line"), F.concat(F.lit("implausible_paid_per_claim_line(=$"), F.format_number("paid_per_claim_line", 0), F.lit(")"))),
    ))
