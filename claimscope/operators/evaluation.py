"""Labels, deciles, lift, ranking metrics and score roll-ups."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimscope.config import DEFAULT, Config
from claimscope.functions.dates import timing_bucket
from claimscope.functions.names import bare_alnum, state_codes
from claimscope.functions.numbers import bin_of
from claimscope.operators import order


def labels(companies: DataFrame, by_npi: DataFrame, by_name: DataFrame) -> DataFrame:
    """hit, hit_npi, match_confidence and the earliest exclusion date of each company.

    Ids in npi_list are matched first; only without any, (name, state). ``by_npi`` has npi and
    excl_date, one row an npi; ``by_name`` has name_key, state and excl_date.
    """
    ids = companies.select("company_id", F.explode(F.array_distinct(F.regexp_extract_all("npi_list", F.lit(r"\b\d{10}\b"), 0))).alias("npi"))
    a = ids.join(by_npi, "npi").groupBy("company_id").agg(F.count(F.lit(1)).alias("n_npi"), F.min("excl_date").alias("a_date"))
    named = companies.select("company_id", bare_alnum(F.col("company_name")).alias("name_key"), F.explode(state_codes(F.col("states"))).alias("state"))
    b = named.join(by_name, ["name_key", "state"]).groupBy("company_id").agg(F.min("excl_date").alias("b_date"), F.lit(True).alias("by_name"))
    met = companies.join(a, "company_id", "left").join(b, "company_id", "left")
    npi = F.col("n_npi").isNotNull()
    confidence = F.when(npi, "npi").when(F.col("by_name"), "name").otherwise("")
    return met.select(*companies.columns, (confidence != "").cast("int").alias("hit"), npi.cast("int").alias("hit_npi"), confidence.alias("match_confidence"), F.when(npi, F.col("a_date")).otherwise(F.col("b_date")).alias("exclusion_date"))


def binned(df: DataFrame, score: str, tie: str, name: str, bins: int = 10, by: list[str] | None = None) -> DataFrame:
    """Adds the bin of each row's rank by (score, tie); ranks are counted in cuts of the score, not by one task."""
    df = df.persist()  # companies or providers: read for the cuts, their sums and the ranks
    met = order.ranked(df, F.col(score), [tie], "__rank", by or [], "__n")
    return met.select(*df.columns, bin_of(F.col("__rank"), F.col("__n"), bins).alias(name))


def lift_table(df: DataFrame, bin_column: str, hit: str = "hit") -> DataFrame:
    """n, hits, rate and lift over the base rate of each bin."""
    per = df.groupBy(bin_column).agg(F.count(F.lit(1)).alias("n"), F.sum(hit).alias("hits"))
    whole = Window.partitionBy()
    base = F.sum("hits").over(whole) / F.sum("n").over(whole)  # at most as many rows as bins
    return per.select(bin_column, "n", "hits", (F.col("hits") / F.col("n")).alias("rate"), (F.col("hits") / F.col("n") / F.nullif(base, F.lit(0.0))).alias("lift"))


def within_size_lift(df: DataFrame, score: str, size: str, tie: str, hit: str = "hit") -> DataFrame:
    """Top-decile lift inside each size quartile."""
    banded = binned(df, size, tie, "band", 4)
    ranked = binned(banded, score, tie, "decile", 10, ["band"])
    top = F.when(F.col("decile") == 10, F.col(hit))
    return ranked.groupBy("band").agg(F.avg(hit).alias("base"), (F.avg(top) / F.nullif(F.avg(hit), F.lit(0.0))).alias("top_lift"))


def at_k(df: DataFrame, score: str, label: str, tie: str, ks: tuple[int, ...]) -> DataFrame:
    """precision, recall and lift among the k rows of highest score; only the best max(ks) rows are sorted."""
    y = F.col(label).cast("long")
    best = df.select(F.col(score).alias("s"), F.col(tie).alias("t"), y.alias("y")).orderBy(F.col("s").desc_nulls_last(), "t").limit(max(ks))
    placed = best.withColumn("rn", F.row_number().over(Window.orderBy(F.col("s").desc_nulls_last(), "t")))
    hits = placed.groupBy().agg(*[F.coalesce(F.sum(F.when(F.col("rn") <= k, F.col("y"))), F.lit(0)).alias(f"h{k}") for k in ks])
    total = df.agg(F.count(F.lit(1)).alias("n"), F.sum(y).alias("p")).crossJoin(F.broadcast(hits))  # one row each
    rows = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col(f"h{k}").alias("hits")) for k in ks]))
    at = total.select("n", "p", rows.alias("e")).select("n", "p", "e.k", "e.hits")
    seen = F.least(F.col("k").cast("long"), F.col("n"))
    precision = F.col("hits") / F.nullif(seen, F.lit(0))
    return at.select("k", "hits", precision.alias("precision"), (F.col("hits") / F.nullif(F.col("p"), F.lit(0))).alias("recall"), (precision / F.nullif(F.col("p") / F.nullif(F.col("n"), F.lit(0)), F.lit(0.0))).alias("lift"))


def _by_score(df: DataFrame, score: str, label: str) -> DataFrame:
    """Rows n and positives y of each distinct score, and both summed from the highest score down to it."""
    per = df.where(F.col(score).isNotNull()).groupBy(F.col(score).alias("s")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(label).cast("long")).alias("y"))
    return order.running(per, -F.col("s"), ["s"], {"cn": F.col("n"), "cy": F.col("y")})


def ranking_metrics(df: DataFrame, score: str, label: str) -> DataFrame:
    """Average precision (steps over distinct scores) and ROC area (mean ranks), from counts by score."""
    cum = _by_score(df, score, label)
    neg = F.col("n") - F.col("y")
    sums = cum.agg(
        F.sum(F.col("y") * F.col("cy") / F.col("cn")).alias("ap"), F.sum("y").alias("p"), F.sum(neg).alias("q"),
        F.sum(neg * (F.col("cy") - F.col("y") / 2)).alias("auc"),
    )
    return sums.select((F.col("ap") / F.nullif(F.col("p"), F.lit(0))).alias("average_precision"), (F.col("auc") / F.nullif(F.col("p") * F.col("q"), F.lit(0))).alias("roc_auc"), F.col("p").alias("n_positive"))


def precision_recall_curve(df: DataFrame, score: str, label: str) -> DataFrame:
    """One point for each distinct score taken as threshold: rows at or above it, precision, recall."""
    cum = _by_score(df, score, label)
    total = cum.agg(F.sum("y").alias("p"))
    return cum.crossJoin(F.broadcast(total)).select(F.col("s").alias("threshold"), F.col("cn").alias("n"), (F.col("cy") / F.col("cn")).alias("precision"), (F.col("cy") / F.nullif(F.col("p"), F.lit(0))).alias("recall"))  # total: one row


def timing_lift(binned_df: DataFrame, bin_column: str, hit: str, ymd: str, low: int, high: int) -> DataFrame:
    """For exclusions before, during and after the billing years: hits, their base rate and top-bin lift.

    Only hits of a bucket count as positives there; the last bucket is the nearest to a forecast.
    """
    kinds = (f"before_{low}", f"during_{low}_{high}", f"after_{high}")
    bucket = timing_bucket(F.col(ymd), low, high)
    top = F.max(bin_column).over(Window.partitionBy())
    few = binned_df.groupBy(bin_column).agg(F.count(F.lit(1)).alias("n"), *[F.count_if((F.col(hit) == 1) & (bucket == k)).alias(k) for k in kinds]).withColumn("__top", F.col(bin_column) == top)  # one row a bin
    long = few.select("n", "__top", F.explode(F.array(*[F.struct(F.lit(k).alias("timing"), F.col(k).alias("h")) for k in kinds])).alias("e")).select("n", "__top", "e.timing", "e.h")
    sums = long.groupBy("timing").agg(F.sum("h").alias("hits"), F.sum("n").alias("n"), F.sum(F.when(F.col("__top"), F.col("h"))).alias("th"), F.sum(F.when(F.col("__top"), F.col("n"))).alias("tn"))
    base = F.col("hits") / F.nullif(F.col("n"), F.lit(0))
    return sums.select("timing", "hits", base.alias("base_rate"), (F.col("th") / F.nullif(F.col("tn"), F.lit(0)) / F.nullif(base, F.lit(0.0))).alias("top_lift"))


def company_scores(providers: DataFrame) -> DataFrame:
    """Company scores from reliable constituents: max, mean, and mean weighted by positive dollars."""
    ok = F.col("score_reliable")
    w = F.greatest(F.coalesce(F.col("net_paid").cast("double"), F.lit(0.0)), F.lit(0.0))
    agg = providers.groupBy("company_id").agg(
        F.count(F.lit(1)).alias("npi_count"), F.count_if(ok).alias("n_reliable"), F.max(F.when(ok, F.col("score"))).alias("max_score"), F.avg(F.when(ok, F.col("score"))).alias("mean_score"),
        F.sum(F.when(ok, F.col("score") * w)).alias("ws"), F.sum(F.when(ok, w)).alias("w"), F.sum("net_paid").alias("company_net_paid"),
    )
    return agg.withColumn("weighted_score", F.when(F.col("w") > 0, F.col("ws") / F.col("w")).otherwise(F.col("mean_score"))).drop("ws", "w")


def segments(providers: DataFrame) -> DataFrame:
    """Segment and reliability of scored providers (provider_on_leie, in_training, not_scored)."""
    unscored = F.coalesce(F.col("not_scored"), F.lit(True))
    kind = F.when(F.col("provider_on_leie"), "leie_positive").when(F.col("in_training"), "clean_negative_trained").when(unscored, "ambiguous_not_scored").otherwise("ambiguous_high_anomaly")
    return providers.withColumns({"segment": kind, "score_reliable": ~unscored})


def rank_reliable(providers: DataFrame, score: str = "score", tie: str = "npi") -> DataFrame:
    """Rank among reliable rows only, by score."""
    ranked = order.ranked(providers.where("score_reliable"), -F.col(score), [tie], "rank_reliable").withColumn("rank_reliable", F.col("rank_reliable").cast("int"))
    return ranked.unionByName(providers.where("not score_reliable").withColumn("rank_reliable", F.lit(None).cast("int")))


def null_tests(deciled: DataFrame, score: str, hit: str = "hit", draws: int = 1000, cfg: Config = DEFAULT) -> DataFrame:
    """Permutation p of the hits' summed score, and a bootstrap interval of the top-decile lift.

    A permutation puts the h hits on h of the n rows, so a permuted sum is that of h rows drawn
    without replacement (or of all less n - h ones) from the counts by distinct score, which are
    brought to the driver; rows are companies. The bootstrap depends on four counts alone.
    """
    x = F.coalesce(F.col(score), F.lit(0.0))
    top = F.col("score_decile") == 10
    r = deciled.agg(F.count(F.lit(1)).alias("n"), F.sum(hit).alias("h"), F.sum(F.when(F.col(hit) == 1, x)).alias("s"), F.count_if(top).alias("t"), F.sum(F.when(top, F.col(hit))).alias("th")).first()
    rng = np.random.default_rng(cfg.seed)
    n, h = r["n"] or 0, r["h"] or 0
    spark = deciled.sparkSession
    schema = "n long, hits long, permutation_p double, lift double, lift_low double, lift_high double"
    if n < 2 or not h or not r["t"]:
        return spark.createDataFrame([(n, h, None, None, None, None)], schema)
    by_score = deciled.groupBy(x.cast("double").alias("x")).agg(F.count(F.lit(1)).alias("c")).toPandas().sort_values("x")
    scores, ends = by_score["x"].to_numpy(), np.cumsum(by_score["c"].to_numpy())
    few = min(h, n - h)
    drawn = np.array([scores[np.searchsorted(ends, rng.choice(n, few, replace=False, shuffle=False), side="right")].sum() for _ in range(draws)])
    sums = drawn if few == h else float(scores @ by_score["c"].to_numpy()) - drawn
    # sums of the same scores in another order are equal
    beyond = int((sums >= r["s"] - 1e-9 * max(1.0, abs(r["s"]))).sum())
    t, th = r["t"], r["th"] or 0
    cells = rng.multinomial(n, np.array([th, t - th, h - th, n - t - h + th]) / n, draws)
    tops, hits = cells[:, 0] + cells[:, 1], cells[:, 0] + cells[:, 2]
    lifts = (cells[:, 0] / np.maximum(tops, 1)) / np.maximum(hits / n, 1e-12)
    low, high = np.percentile(lifts, [2.5, 97.5])
    return spark.createDataFrame([(n, h, (beyond + 1) / (draws + 1), (th / t) / (h / n), float(low), float(high))], schema)
