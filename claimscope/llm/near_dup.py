"""Near-duplicates: fast similarity sketches, banding, exact verification.

A document is the set of its distinct word shingles. Its sketch has ``T`` coordinates, filled in
rounds: in each of the first T rounds every shingle falls into a hashed bin, in the next T rounds
into bin 1, 2, ... in turn; a bin keeps the least value of the first round that reached it, and a
document is done when all its bins are full. After 2T rounds every bin of a non-empty set is
full. Two sketches agree in a coordinate with the sets' Jaccard similarity as probability, more
concentrated than independent MinHashes, in time n + T log T. ``BANDS`` keys over ``ROWS``
coordinates each propose candidates: at similarity 0.8 a pair is missed with probability
(1 - 0.8^6)^40, about 5 in a million, and a document of a larger group only if all its links are.

Documents with equal sets are one node, whose text is read once more. Nodes that share a key are
verified on whole sets, as hashes, in two steps, so that no link between different nodes is lost
though few are compared:

* stars: each node with the least node of each of its keys (its hubs, at most BANDS). What is linked
  gets one root, so a group of near-copies of any size takes one comparison a node;
* the rest: only keys that still have nodes of several roots are left. Their nodes are joined into
  groups; in each, the nodes that aren't of the largest root are compared with all, in blocks, every
  pair of blocks in a task of its own.

A set is sent once for each of its hubs, and in the second step once for each block of the other side.
The second step's worst case stays quadratic: a group of many candidates that aren't linked.

Defined results: letters A-Z are lowered; a text with fewer words than a shingle is one shingle;
null texts and texts without words have no shingles and are linked with nothing; repeated rows
get equal results; where a ``key`` repeats with different texts each row is a node of its own.
A null key is less than any other only in that it is ignored by ``component_id`` unless all keys
of a component are null. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimscope.llm.common import WORD, materialize, tune
from claimscope.llm.components import components

WIDTH, PERCENT = 5, 80
ROWS, BANDS = 6, 40
COORDINATES = ROWS * BANDS
#: Nodes and shingles of one block of a candidate group, and spokes of one part of a star.
BLOCK_NODES, BLOCK_SHINGLES, STAR = 256, 200_000, 4096
CACHE_WORDS = 300_000

_U = np.uint64
_rng = np.random.default_rng(5)
_ODD = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) * _U(2) + _U(1)
_ROUND = _rng.integers(1, 1 << 63, 2 * COORDINATES, dtype=np.uint64)
_FULL = _U((1 << 64) - 1)


class _WordHash(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        h = xxhash.xxh3_64_intdigest(word)
        self[word] = h
        return h


_word_hash = _WordHash()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(31))) * _U(0x9E3779B97F4A7C15)
    x = (x ^ (x >> _U(29))) * _U(0xBF58476D1CE4E5B9)
    return x ^ (x >> _U(32))


def shingles(raw: bytes | None, width: int = WIDTH) -> np.ndarray:
    """The sorted 64-bit hashes of the distinct shingles of a UTF-8 text."""
    words = (raw or b"").lower().split()
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(_word_hash.__getitem__, words), np.uint64, n)
    k = min(width, n)
    out = h[: n - k + 1] * _ODD[0]
    for j in range(1, k):
        out += h[j : n - k + 1 + j] * _ODD[j]
    return np.unique(_mix(out + _U(k)))


def sketches(sets: list[np.ndarray], t: int = COORDINATES) -> np.ndarray:
    """A row of t values for each set; the sets aren't empty."""
    out = np.full(len(sets) * t, _FULL)
    if not sets:
        return out.reshape(0, t)
    x = np.concatenate(sets)
    base = np.repeat(np.arange(len(sets)) * t, [len(s) for s in sets])
    for i in range(2 * t):
        g = _mix(x + _ROUND[i])
        value = (_mix(g + _ODD[9]) >> _U(10)) | (_U(i) << _U(54))
        at = base + ((g >> _U(32)) * _U(t) >> _U(32)).astype(np.int64) if i < t else base + (i - t)
        np.minimum.at(out, at, value)
        open_ = (out.reshape(-1, t) == _FULL).any(1)
        if not open_.any():
            break
        if not open_.all():
            left = open_[base // t]
            x, base = x[left], base[left]
    return out.reshape(-1, t)


def bands(sketch: np.ndarray) -> np.ndarray:
    """BANDS signed 64-bit keys a row; a key belongs to one band only."""
    parts = sketch.reshape(len(sketch), BANDS, ROWS)
    key = parts[:, :, 0] * _ODD[20] + (np.arange(BANDS, dtype=np.uint64) * _ODD[30])[None, :]
    for j in range(1, ROWS):
        key = _mix(key) + parts[:, :, j] * _ODD[20 + j]
    return _mix(key).view(np.int64)


def _sketched(width: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(x, width) for x in batch.column(1).to_pylist()]
            full = [i for i, s in enumerate(sets) if len(s)]
            keys = bands(sketches([sets[i] for i in full]))
            sig: list = [None] * len(sets)
            key: list = [None] * len(sets)
            for i, row in zip(full, keys):
                sig[i] = hashlib.blake2b(sets[i].tobytes(), digest_size=16).digest()
                key[i] = row
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(sig, pa.binary()), pa.array(key, pa.list_(pa.int64())), batch.column(2)], names=["key", "n_shingles", "sig", "bands", "tid"])

    return run


def _digest(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def _sets_of(width: int):
    """(nid, sig, raw) -> nid, sig and the shingles' hashes, for the texts that are the node's; neighbouring repeats once."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            out = []
            for nid, sig, raw in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if sig != last and _digest(s := shingles(raw, width)) == sig:
                    out.append((nid, sig, s.tobytes()))
                    last = sig
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], t) for i, t in enumerate((pa.int64(), pa.binary(), pa.binary()))], names=["nid", "sig", "hashes"])

    return run


def alike(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    """Whether two sorted sets are linked, compared whole."""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if 100 * len(small) < percent * len(large):
        return False
    at = np.searchsorted(large, small)
    both = int((large[np.minimum(at, len(large) - 1)] == small).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


def _edges(found: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.binary()) for i in (0, 1)], names=["u", "v"])


def _star(percent: int):
    """Rows (hub, salt, spoke, sig, hashes) in this order: the links of each hub with its spokes, one spoke at a time."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, hubs = None, {}
        for batch in batches:
            found = []
            for hub, salt, spoke, sig, raw in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if (hub, salt) != at:
                    at, hubs = (hub, salt), {}
                s = np.frombuffer(raw, np.uint64)
                if not spoke:
                    hubs[sig] = s
                else:
                    found += [(sig, other) for other, h in hubs.items() if other != sig and alike(s, h, percent)]
            yield _edges(found)

    return run


def crossed(queries: list[np.ndarray], sets: list[np.ndarray], percent: int = PERCENT) -> np.ndarray:
    """Which queries are linked with which sets, compared whole: a boolean matrix."""
    q, m = len(queries), len(sets)
    size_q, size_m = (np.array([len(s) for s in x], np.int64) for x in (queries, sets))
    x = np.concatenate([*queries, *sets])
    row = np.repeat(np.arange(q + m), np.concatenate([size_q, size_m]))
    _, term, times = np.unique(x, return_inverse=True, return_counts=True)
    shared = times[term] > 1  # others are in no intersection
    row, term = row[shared], np.unique(term[shared], return_inverse=True)[1]
    both = np.zeros((q, m), np.float32)  # counts below 2^24 are exact
    step = max(256, (1 << 22) // (q + m))
    order = np.argsort(term, kind="stable")
    row, term = row[order], term[order]
    for a in range(0, int(term[-1]) + 1 if len(term) else 0, step):
        low, high = np.searchsorted(term, [a, a + step])
        has = np.zeros((q + m, step), np.float32)
        has[row[low:high], term[low:high] - a] = 1
        both += has[:q] @ has[q:].T
    inter = both.astype(np.int64)
    return 100 * inter >= percent * (size_q[:, None] + size_m[None, :] - inter)


def _blocks(percent: int):
    """Rows (g, i, j, asks, root, sig, hashes) in the order of the first three: links between asking and other nodes of different roots."""

    def links(group: list[tuple]) -> list[tuple[bytes, bytes]]:
        asking = {sig: (root, s) for asks, root, sig, s in group if asks}
        others = {sig: (root, s) for asks, root, sig, s in group if not asks}
        if not asking or not others:
            return []
        us, vs = list(asking), list(others)
        hit = crossed([asking[u][1] for u in us], [others[v][1] for v in vs], percent)
        joined: set = set()
        out = []
        for i, j in np.argwhere(hit).tolist():
            pair = (asking[us[i]][0], others[vs[j]][0])
            if pair[0] != pair[1] and pair not in joined:  # one link between two roots is enough
                joined.add(pair)
                out.append((us[i], vs[j]))
        return out

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, group = None, []
        for batch in batches:
            found = []
            keys = list(zip(*(batch.column(i).to_pylist() for i in range(3))))
            for key, asks, root, sig, raw in zip(keys, *(batch.column(i).to_pylist() for i in range(3, 7))):
                if key != at:
                    found += links(group)
                    at, group = key, []
                group.append((asks, root, sig, np.frombuffer(raw, np.uint64)))
            yield _edges(found)
        yield _edges(links(group))

    return run


def _rooted(edges: DataFrame) -> DataFrame:
    """sig and root of all nodes of ``edges``, the roots too."""
    found = components(edges)
    return found.select(F.col("node").alias("sig"), "root").unionByName(found.select(F.col("root").alias("sig"), "root").distinct())


def _links(nodes: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Links (u, v: sigs) that join the same nodes as all links do."""
    keyed = nodes.select("nid", F.explode("bands").alias("band"))
    hubs = keyed.groupBy("band").agg(F.min("nid").alias("hub"), F.count(F.lit(1)).alias("m")).where("m > 1").drop("m")
    met = materialize(keyed.join(hubs, "band"), "candidates")
    spokes = met.where("nid <> hub").select("nid", "hub").distinct()
    some = nodes.join(met.select("nid").distinct(), "nid", "left_semi").select("nid", "sig", F.col("row.key").alias("node_key"), F.col("row.tid").alias("node_tid"))
    texts = some.hint("merge").join(docs, F.col("node_key").eqNullSafe(F.col("key")) & (F.col("node_tid") == F.col("tid"))).select("nid", "sig", "raw")
    sets = materialize(texts.mapInArrow(_sets_of(width), "nid long, sig binary, hashes binary"), "sets")

    # every node with the hubs of its keys; a hub's spokes are dealt over as many tasks as they need
    salts = spokes.groupBy("hub").agg(F.ceil(F.count(F.lit(1)) / F.lit(STAR)).cast("int").alias("salts"))
    out = spokes.join(salts, "hub").join(sets.hint("merge"), "nid").select("hub", F.pmod(F.xxhash64("nid", F.lit(2)), "salts").cast("int").alias("salt"), F.lit(1).alias("spoke"), "sig", "hashes")
    mid = salts.join(sets.hint("merge"), F.col("hub") == F.col("nid")).select("hub", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(0).alias("spoke"), "sig", "hashes")
    star = out.unionByName(mid).repartition("hub", "salt").sortWithinPartitions("hub", "salt", "spoke").mapInArrow(_star(percent), "u binary, v binary")
    first = materialize(_rooted(star), "roots")

    # keys whose nodes are of several roots now: their nodes may have links that no star has
    label = sets.select("nid", "sig").join(first, "sig", "left").select("nid", "sig", F.coalesce("root", "sig").alias("root"))
    mixed = met.join(label, "nid").groupBy("band").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("band")
    open_ = met.join(mixed, "band", "left_semi").where("nid <> hub").select(F.col("nid").alias("u"), F.col("hub").alias("v"))
    group = components(open_)
    member = group.select(F.col("node").alias("nid"), F.col("root").alias("g")).unionByName(group.select(F.col("root").alias("nid"), F.col("root").alias("g")).distinct()).join(label, "nid").join(nodes.select("sig", "n"), "sig")
    named = materialize(member, "open")
    by_root = named.groupBy("g", "root").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("n"))
    # nodes of a group's largest root are joined already: only the others ask, and they ask all
    sizes = by_root.groupBy("g").agg(F.max_by("root", F.struct("m", "root")).alias("most"), F.sum("m").alias("m"), F.sum("n").alias("n"), F.max("m").alias("m1")).select("g", "most", _parts("m", "n").alias("nj"), _parts("m - m1", "n").alias("ni"))
    dealt = named.join(sizes, "g")
    own = lambda seed, parts: F.pmod(F.xxhash64("nid", F.lit(seed)), parts).cast("int")
    asking = dealt.where("root <> most").select("g", own(3, "ni").alias("i"), F.explode(F.sequence(F.lit(0), F.col("nj") - 1)).alias("j"), F.lit(True).alias("asks"), "root", "nid", "sig")
    others = dealt.select("g", F.explode(F.sequence(F.lit(0), F.col("ni") - 1)).alias("i"), own(4, "nj").alias("j"), F.lit(False).alias("asks"), "root", "nid", "sig")
    rows = asking.unionByName(others).join(sets.select("sig", "hashes").hint("merge"), "sig").select("g", "i", "j", "asks", "root", "sig", "hashes")
    more = rows.repartition("g", "i", "j").sortWithinPartitions("g", "i", "j").mapInArrow(_blocks(percent), "u binary, v binary")
    return first.where("sig <> root").select(F.col("sig").alias("u"), F.col("root").alias("v")).unionByName(more)


def _parts(nodes: str, shingles_: str):
    """Blocks for so many nodes and shingles; a block has a node at least."""
    return F.expr(f"cast(ceil(greatest(({nodes}) / {BLOCK_NODES}D, least({shingles_} / {BLOCK_SHINGLES}D, {nodes}))) as int)")


def _rows_and_roots(df: DataFrame, key: str, text: str, width: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """key, tid (a hash of the text), n_shingles and sig of each row; and sig, key, tid and root of those with shingles."""
    tune(df.sparkSession)
    docs = df.select(F.col(key).alias("key"), F.col(text).cast("binary").alias("raw")).withColumn("tid", F.xxhash64("raw"))
    fields = [docs.schema["key"], T.StructField("n_shingles", T.LongType()), T.StructField("sig", T.BinaryType()), T.StructField("bands", T.ArrayType(T.LongType())), T.StructField("tid", T.LongType())]
    rows = materialize(docs.mapInArrow(_sketched(width), T.StructType(fields)), "sketches")
    whole = rows.where("sig is not null")
    # a 64-bit name of a node: two nodes of one name would only be candidates of each other
    nodes = materialize(whole.groupBy("sig").agg(F.min(F.struct(F.col("key").isNull().alias("none"), "key", "tid")).alias("row"), F.max("n_shingles").alias("n"), F.any_value("bands").alias("bands")).withColumn("nid", F.xxhash64("sig")), "nodes")
    final = components(_links(nodes, docs, width, percent))
    least = whole.select("sig", "key", "tid").join(final.select(F.col("node").alias("sig"), "root"), "sig", "left").select("sig", F.coalesce("root", "sig").alias("root"), "key", "tid")
    return rows.select("key", "tid", "n_shingles", "sig"), least


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """``key``, n_shingles, component_id (least key of the component) and kept (key is component_id) of each row."""
    rows, least = _rows_and_roots(df, key, text, width, percent)
    smallest = least.groupBy("root").agg(F.min("key").alias("component_id"))
    member = least.select("sig", "root").distinct().join(smallest, "root").select("sig", "component_id")
    out = rows.join(member, "sig", "left").withColumn("component_id", F.coalesce("component_id", "key"))
    return out.select(F.col("key").alias(key), "n_shingles", "component_id", F.col("key").eqNullSafe(F.col("component_id")).alias("kept"))


def keep_one(df: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """The rows of ``df`` without near-duplicates: one row of each component, columns unchanged.

    It is the row of the least key (nulls last). Texts without words are components of their own: one
    row of each such text and key is kept, and all without a key.
    """
    bare = F.col(key).isNull() & ~F.coalesce(F.col(text).rlike(WORD), F.lit(False))
    docs = df.where(~bare)
    rows, least = _rows_and_roots(docs, key, text, width, percent)
    first = least.groupBy("root").agg(F.min(F.struct(F.col("key").isNull().alias("none"), "key", "tid")).alias("row")).select("row.key", "row.tid")
    chosen = first.unionByName(rows.where("sig is null").select("key", "tid").distinct())

    def same(key: str) -> dict:
        return {"__no_key": F.col(key).isNull(), "__key": F.coalesce(F.col(key).cast("string"), F.lit(""))}

    found = chosen.select(*[c.alias(k) for k, c in same("key").items()], F.col("tid").alias("__tid"))
    # the join and the window deal the texts out by the same columns, so they are shuffled once
    on = [*same(key), "__tid"]
    met = docs.withColumns({**same(key), "__tid": F.xxhash64(F.col(text).cast("binary"))}).join(found, on, "left_semi")
    one = Window.partitionBy(*on).orderBy(F.col(text).desc_nulls_last())
    return met.withColumn("__nth", F.row_number().over(one)).where("__nth = 1").select(*df.columns).unionByName(df.where(bare))
