"""Models: isolation forest with path importance, and boosted trees on positives and unlabelled rows."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import Imputer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimscope.config import DEFAULT, Config

#: Columns that encode the label, or the sampling of negatives; fixed values.
LEAKAGE = ("provider_on_leie", "facility_has_excluded_owner_high", "facility_has_excluded_owner_probable", "facility_excluded_owner_n_high", "facility_excluded_owner_n_probable", "excluded_owner_role", "any_billed_after_exclusion", "billed_after_exclusion", "excluded_after_billing")
LEAKAGE_PARTS = ("excluded_owner", "billed_after_exclusion", "probable_excluded")
DETECTOR = ("anomaly_score", "n_anomaly_signals", "anomaly_lead", "not_scored", "not_scored_reason")


def model_features(columns: list[str], ids: tuple[str, ...] = ("npi", "label")) -> list[str]:
    out = [c for c in columns if c not in (*LEAKAGE, *DETECTOR, *ids) and not any(p in c for p in LEAKAGE_PARTS)]
    assert not set(out) & set(LEAKAGE), "leaking features"
    return out


def _harmonic(n: float) -> float:
    """Mean path length of an unsuccessful search among n rows."""
    return 0.0 if n <= 1 else 2 * (np.log(n - 1) + np.euler_gamma) - 2 * (n - 1) / n


def grow(x: np.ndarray, depth: int, limit: int, rng: np.random.Generator) -> tuple:
    """A tree as nested (feature, cut, left, right), or (size,) at a leaf."""
    spread = np.flatnonzero(x.max(0) > x.min(0)) if len(x) else np.empty(0, int)
    if depth >= limit or len(x) <= 1 or not len(spread):
        return (len(x),)
    f = int(rng.choice(spread))
    cut = rng.uniform(x[:, f].min(), x[:, f].max())
    left = x[:, f] < cut
    return f, float(cut), grow(x[left], depth + 1, limit, rng), grow(x[~left], depth + 1, limit, rng)


def _walk(tree: tuple, x: np.ndarray, rows: np.ndarray, depth: int, lengths: np.ndarray, importance: np.ndarray) -> None:
    if len(tree) == 1:
        lengths[rows] += depth + _harmonic(tree[0])
        return
    f, cut, low, high = tree
    importance[rows, f] += 1 / (depth + 1)
    left = x[rows, f] < cut
    _walk(low, x, rows[left], depth + 1, lengths, importance)
    _walk(high, x, rows[~left], depth + 1, lengths, importance)


def isolation_forest(df: DataFrame, key: str, features: list[str], trees: int = 120, sample: int = 256, seed: int = 0, fill: float = 0.5) -> DataFrame:
    """key, iforest_score (higher is odder) and importance (depth-weighted path shares of features).

    The trees are built on the driver from at most ``trees * sample`` rows, which is the method's
    own bound; all rows are scored by executors.
    """
    x = [F.coalesce(F.when(~F.isnan(F.col(f).cast("double")), F.col(f).cast("double")), F.lit(fill)).alias(f) for f in features]
    ready = df.select(key, *x).persist()  # counted, drawn from and scored
    # the least hashes: below a threshold that holds about twice as many, so only those are sorted
    draw, most = F.xxhash64(F.col(key), F.lit(seed)), trees * sample
    share = min(1.0, 2 * most / max(ready.count(), 1))
    least = ready.where(draw <= int((share * 2 - 1) * (2**63 - 1))) if share < 1 else ready
    drawn = least.orderBy(draw, key).limit(most).select(*features).toPandas().to_numpy(float)
    rng = np.random.default_rng(seed)
    size = min(sample, len(drawn))
    limit = int(np.ceil(np.log2(max(size, 2))))
    forest = [grow(drawn[rng.choice(len(drawn), size, replace=False)], 0, limit, rng) for _ in range(trees)] if size else []
    shared = df.sparkSession.sparkContext.broadcast(forest)
    norm = max(_harmonic(size), 1e-9)

    def score(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            values = frame[features].to_numpy(float)
            lengths, importance = np.zeros(len(values)), np.zeros(values.shape)
            for tree in shared.value:
                _walk(tree, values, np.arange(len(values)), 0, lengths, importance)
            total = importance.sum(1, keepdims=True)
            share = importance / np.where(total > 0, total, 1)
            yield pd.DataFrame({key: frame[key], "iforest_score": 2 ** (-lengths / max(len(shared.value), 1) / norm), "importance": list(share)})

    kind = df.schema[key].dataType.simpleString()
    return ready.mapInPandas(score, f"{key} {kind}, iforest_score double, importance array<double>")


def contaminated(scored: DataFrame, contamination: float = 0.05) -> DataFrame:
    """Adds is_anomaly: the score is in the top ``contamination`` share (exact quantile, one row)."""
    cut = scored.agg(F.percentile("iforest_score", 1 - contamination).alias("__cut"))
    return scored.crossJoin(F.broadcast(cut)).withColumn("is_anomaly", F.col("iforest_score") > F.col("__cut")).drop("__cut")


def standardise(df: DataFrame, columns: list[str], heavy: tuple[str, ...] = ()) -> DataFrame:
    """log1p of heavy-tailed columns, median imputation, population standard scores."""
    logged = df.withColumns({c: (F.log1p(F.greatest(F.col(c).cast("double"), F.lit(0.0))) if c in heavy else F.col(c).cast("double")) for c in columns})
    medians = logged.agg(*[F.coalesce(F.median(c), F.lit(0.0)).alias(f"__m_{c}") for c in columns])
    full = logged.crossJoin(F.broadcast(medians)).withColumns({c: F.coalesce(F.col(c), F.col(f"__m_{c}")) for c in columns}).drop(*[f"__m_{c}" for c in columns])
    stats = full.agg(*[F.avg(c).alias(f"__a_{c}") for c in columns], *[F.stddev_pop(c).alias(f"__s_{c}") for c in columns])
    wide = full.crossJoin(F.broadcast(stats))
    return wide.withColumns({c: F.coalesce((F.col(c) - F.col(f"__a_{c}")) / F.nullif(F.col(f"__s_{c}"), F.lit(0.0)), F.lit(0.0)) for c in columns}).select(*df.columns)


def stratified_split(df: DataFrame, key: str, label: str, cfg: Config = DEFAULT) -> DataFrame:
    """Adds is_val: a seeded share of each label, the same in every run."""
    by = Window.partitionBy(label)
    rank = F.row_number().over(by.orderBy(F.xxhash64(F.col(key), F.lit(cfg.seed)), key))
    return df.withColumn("is_val", rank <= F.floor(F.count(F.lit(1)).over(by) * F.lit(cfg.val_fraction)))


def fit_boosted(df: DataFrame, numeric: list[str], categorical: list[str], label: str = "label", rounds: int = 20, cfg: Config = DEFAULT) -> PipelineModel:
    """Gradient-boosted trees with class weights; rows with is_val stop the rounds early.

    Every stage reads ``df``, so its columns in use are kept once (a row a key) instead of being derived from
    claims by each of them.
    """
    df = df.select(*numeric, *categorical, label, "is_val").persist()
    counts = df.where("not is_val").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(label).cast("long")).alias("p")).first()
    weight = (counts["n"] - counts["p"]) / max(counts["p"], 1)
    ready = df.withColumns({c: F.col(c).cast("double") for c in numeric}).withColumn("weight", F.when(F.col(label) == 1, weight).otherwise(1.0))
    stages = [Imputer(strategy="median", inputCols=numeric, outputCols=[f"{c}__f" for c in numeric])]
    stages += [StringIndexer(inputCol=c, outputCol=f"{c}__i", handleInvalid="keep") for c in categorical]
    stages += [VectorAssembler(inputCols=[*[f"{c}__f" for c in numeric], *[f"{c}__i" for c in categorical]], outputCol="features", handleInvalid="keep"), GBTClassifier(labelCol=label, weightCol="weight", validationIndicatorCol="is_val", maxIter=rounds, maxDepth=4, maxBins=64, seed=cfg.seed)]
    try:
        return Pipeline(stages=stages).fit(ready)
    finally:
        df.unpersist()


def score_boosted(model: PipelineModel, df: DataFrame, numeric: list[str], key: str) -> DataFrame:
    ready = df.withColumns({c: F.col(c).cast("double") for c in numeric})
    return model.transform(ready).select(key, vector_to_array("probability")[1].alias("score"))


def describe(scored: DataFrame, frame: DataFrame, key: str, features: list[str], top: int = 3) -> DataFrame:
    """Adds description: the ``top`` features of each row's path importance, with their side of the median.

    Meant for the rows that are shown; medians are one row over ``frame``.
    """
    medians = frame.agg(*[F.median(f).alias(f"__m_{f}") for f in features])
    met = scored.join(frame.select(key, *features), key).crossJoin(F.broadcast(medians))
    parts = F.array(*[
        F.struct((-F.col("importance")[i]).alias("o"), F.lit(f).alias("f"), F.when(F.col(f) > F.col(f"__m_{f}"), "high").when(F.col(f) < F.col(f"__m_{f}"), "low").otherwise("typical").alias("d"), F.col("importance")[i].alias("i"))
        for i, f in enumerate(features)
    ])
    best = F.filter(F.slice(F.array_sort(parts), 1, top), lambda x: x["i"] > 0)
    text = F.transform(best, lambda x: F.concat(x["f"], F.lit(" "), x["d"], F.lit(" ("), F.bround(x["i"] * 100).cast("int").cast("string"), F.lit("%)")))
    return met.withColumn("description", F.array_join(text, "; ")).select(*scored.columns, "description")


def importances(model: PipelineModel, names: list[str]) -> DataFrame:
    """feature, gain (normalised) and splits of a fitted boosted model, by gain; one row a feature."""
    boosted = model.stages[-1]
    gain = boosted.featureImportances.toArray()
    splits = [0] * len(names)
    for tree in boosted.trees:
        for found in re.findall(r"If \(feature (\d+) ", tree.toDebugString):
            splits[int(found)] += 1
    rows = [(n, float(g), s) for n, g, s in zip(names, gain, splits)]
    return SparkSession.active().createDataFrame(sorted(rows, key=lambda r: (-r[1], r[0])), "feature string, gain double, splits long")
