"""Language identification by nearest centroids.

A text is the TF-IDF vector of its byte trigrams (lower case, words only), hashed into ``DIMS``
dimensions, with sublinear counts, scaled to length 1. Document frequencies cover all labelled
training rows. Each language has several centroids: spherical k-means over at most
``SAMPLE`` distinct training texts of the language, those of the least seeded hashes; copies of a
text count once, so they neither fill the sample nor empty it. A text gets the language of
the centroid of largest cosine; it is rejected if that cosine is far below those of the sample's
texts of its size that are nearest to the same centroid (see bounds()).

Defined results: a null text or one without a letter is ``und`` with score 0, and rejected; rows
with a null language train nothing; without any training row all texts are ``und``; repeated rows
get equal results; an empty table gives an empty result; columns that clash with the result's are
replaced. Texts are read whole, very long ones in pieces; equal cosines go to the first centroid, by
language. More than ``MOST_LANGUAGES`` languages raise a ValueError, as the model is broadcast.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimscope.llm.common import tune

DIMS, CENTROIDS, SAMPLE, SEED = 4096, 4, 400, 4
#: Rejection: the share of a quantile of cosines, by classes of text sizes in bytes.
REJECT, QUANTILE, SHORTEST, CLASSES, FEW = 0.4, 0.02, 32, 8, 20
MODULUS, HELD_OUT = 5, 0
#: Bytes of text that are turned into counts at once.
CHUNK = 2 << 20
MOST_LANGUAGES = (256 << 20) // (4 * DIMS * CENTROIDS)
UNKNOWN = "und"

_KEEP = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))


def clean(raw: bytes | None) -> bytes | None:
    """Lower-case words of letters between single blanks; None where there is no letter."""
    if not raw:
        return None
    text = raw.decode("utf-8", "replace").lower()
    out = b" ".join(text.encode().translate(_KEEP).split())
    if out.isascii():
        return b" " + out + b" " if out else None
    if not any(65 <= c <= 122 for c in out) and not any(c.isalpha() for c in text):
        return None
    return b" " + out + b" "


def counts(texts: list[bytes]) -> np.ndarray:
    """A row of DIMS trigram counts for each cleaned text."""
    out = np.zeros((len(texts), DIMS), np.float32)
    part: list[tuple[int, bytes]] = []
    size = 0
    for i, text in enumerate(texts):
        for a in range(0, max(1, len(text) - 2), CHUNK):
            piece = text[a : a + CHUNK + 2]
            part.append((i, piece))
            size += len(piece)
            if size >= CHUNK:
                _count(part, out)
                part, size = [], 0
    if part:
        _count(part, out)
    return out


def _count(part: list[tuple[int, bytes]], out: np.ndarray) -> None:
    b = np.frombuffer(b"".join(p for _, p in part), np.uint8).astype(np.uint32)
    if len(b) < 3:
        return
    row = np.repeat(np.arange(len(part), dtype=np.int64), [len(p) for _, p in part])
    gram = ((b[:-2] << np.uint32(16)) | (b[1:-1] << np.uint32(8)) | b[2:]) * np.uint32(0x9E3779B1) >> np.uint32(20)
    at = row[:-2] * DIMS + gram
    inside = row[:-2] == row[2:]
    found = np.bincount(at[inside], minlength=len(part) * DIMS).reshape(len(part), DIMS)
    np.add.at(out, [i for i, _ in part], found.astype(np.float32))


def vectors(texts: list[bytes], idf: np.ndarray) -> np.ndarray:
    x = np.log1p(counts(texts)) * idf
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def cluster(x: np.ndarray, k: int = CENTROIDS, rounds: int = 12) -> np.ndarray:
    """Spherical k-means from k equal parts of the texts, in their order along the widest direction.

    Texts that are far from all others would be centroids of their own if they were starting points.
    """
    if len(x) <= k:
        return np.unique(x, axis=0)
    flat = x - x.mean(0)
    along = np.linspace(-1, 1, x.shape[1])
    for _ in range(10):  # power steps
        along = flat.T @ (flat @ along)
        along /= max(np.linalg.norm(along), 1e-12)
    own = np.empty(len(x), int)
    own[np.argsort(flat @ along, kind="stable")] = np.arange(len(x)) * k // len(x)
    for _ in range(rounds):
        sums = np.array([x[own == j].sum(0) for j in range(k) if (own == j).any()])
        c = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
        own, k = np.argmax(x @ c.T, axis=1), len(c)
    return c


def size_class(size: np.ndarray) -> np.ndarray:
    """The class of texts of ``size`` bytes: 0 below SHORTEST, then by doubling."""
    return np.clip(np.floor(np.log2(np.maximum(size, 1) / SHORTEST)) + 1, 0, CLASSES - 1).astype(int)


def bounds(cleaned: list[bytes], idf: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """For each centroid and size class the least cosine that isn't rejected.

    A short text is farther from any centroid than a long one. So the sample's texts are also cut
    to the sizes of the classes, and a bound is ``REJECT`` times the ``QUANTILE`` of the cosines of those
    that have the centroid as nearest (of all of the language, where they are few). Texts below
    SHORTEST bytes aren't rejected.
    """
    out = np.zeros((len(centroids), CLASSES))
    for k in range(1, CLASSES):
        size = SHORTEST << (k - 1)
        cut = [t[:size] for t in cleaned if len(t) >= size]
        if len(cut) < FEW:
            out[:, k] = out[:, k - 1]
            continue
        cosine = vectors(cut, idf) @ centroids.T
        own, best = cosine.argmax(1), cosine.max(1)
        for j in range(len(centroids)):
            some = best[own == j]
            out[j, k] = REJECT * np.quantile(some if len(some) >= FEW else best, QUANTILE)
    out[:, 0] = out[:, 1] / 4
    return out


def _document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """Over all rows; one vector a task, summed in 64 groups before the driver sees them."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(DIMS), 0
        for batch in batches:
            cleaned = [c for c in map(clean, batch.column(0).to_pylist()) if c]
            total += (counts(cleaned) > 0).sum(0)
            n += len(cleaned)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId() % 64], pa.int32()), pa.array([np.append(total, n).tobytes()], pa.binary())], names=["part", "df"])

    def add(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"df": [np.sum([np.frombuffer(x) for x in group["df"]], axis=0).tobytes()]})

    made = texts.mapInArrow(run, "part int, df binary").groupBy("part").applyInPandas(add, "df binary").collect()
    total = np.sum([np.frombuffer(r["df"]) for r in made], axis=0) if made else np.zeros(DIMS + 1)
    return total[:-1], int(total[-1])


def learn(df: DataFrame, training: Column, text: str = "text", lang: str = "lang") -> dict:
    """idf, centroids, their languages and rejection bounds, from the rows of ``df`` where ``training`` holds."""
    rows = df.where(training & F.col(lang).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).cast("binary").alias("raw"))
    df_, n = _document_frequencies(rows.select("raw"))
    idf = (np.log((n + 1) / (df_ + 1)) + 1).astype(np.float32)
    drawn = rows.where("raw is not null").withColumn("draw", F.xxhash64("raw", F.lit(SEED)))
    # hashes are drawn at a rate for four times the sample among distinct texts: never too few;
    # one row a language, at most as many as the model may have centroids
    langs = drawn.groupBy("lang").agg(F.approx_count_distinct("draw").alias("n")).limit(MOST_LANGUAGES + 1).collect()
    if len(langs) > MOST_LANGUAGES:
        raise ValueError("too many languages for one model")
    share = F.create_map(*[x for r in langs for x in (F.lit(r["lang"]), F.lit(4.0 * SAMPLE / r["n"]))]) if langs else F.create_map().cast("map<string,double>")
    few = drawn.where(F.shiftrightunsigned("draw", 11) / F.lit(9007199254740992.0) < F.try_element_at(share, F.col("lang")))
    texts = few.groupBy("lang", "draw").agg(F.min("raw").alias("raw"))
    sample = texts.withColumn("nth", F.row_number().over(Window.partitionBy("lang").orderBy("draw"))).where(F.col("nth") <= SAMPLE)

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        cleaned = [c for c in map(clean, group["raw"]) if c]
        if not cleaned:
            return pd.DataFrame({"lang": [], "bound": [], "centroid": []})
        c = cluster(vectors(cleaned, idf))
        return pd.DataFrame({"lang": group["lang"].iloc[0], "bound": [b.tobytes() for b in bounds(cleaned, idf, c)], "centroid": [v.astype(np.float32).tobytes() for v in c]})

    fitted = sample.groupBy("lang").applyInPandas(fit, "lang string, bound binary, centroid binary")
    rows_ = fitted.collect()  # at most CENTROIDS rows a language
    rows_.sort(key=lambda r: (r["lang"], r["centroid"]))
    return {"idf": idf, "langs": [r["lang"] for r in rows_], "bounds": np.array([np.frombuffer(r["bound"]) for r in rows_]).reshape(-1, CLASSES), "centroids": np.array([np.frombuffer(r["centroid"], np.float32) for r in rows_]).reshape(-1, DIMS)}


RESULT = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())])


def predict(df: DataFrame, model: dict, text: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """``keep`` (default: all columns), lang_pred, score (cosine) and rejected of each row."""
    tune(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(model)
    keep = [c for c in (df.columns if keep is None else keep) if c not in RESULT.names]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            cleaned = [clean(x) for x in batch.column(batch.num_columns - 1).to_pylist()]
            known = [i for i, c in enumerate(cleaned) if c] if len(m["langs"]) else []
            lang, score, rejected = [UNKNOWN] * len(cleaned), np.zeros(len(cleaned)), np.ones(len(cleaned), bool)
            for a in range(0, len(known), 256):
                part = known[a : a + 256]
                cosine = vectors([cleaned[i] for i in part], m["idf"]) @ m["centroids"].T
                best = np.argmax(cosine, axis=1)
                value = np.clip(cosine[np.arange(len(part)), best], 0, 1).astype(float)
                size = size_class(np.array([len(cleaned[i]) for i in part]))
                score[part], rejected[part] = value, value < m["bounds"][best, size]
                for i, j in zip(part, best):
                    lang[i] = m["langs"][j]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(lang, pa.string()), pa.array(score), pa.array(rejected)], names=[*batch.schema.names[:-1], *RESULT.names])

    narrow = df.select(*[F.col(f"`{c}`") for c in keep], F.col(text).cast("binary").alias("__raw"))
    return narrow.mapInArrow(run, T.StructType([*narrow.schema.fields[:-1], *RESULT.fields]))
