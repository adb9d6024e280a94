"""Language-model scoring by online logistic context mixing.

A text is its words (A-Z lowered) and one end; the model codes each token by binary decisions given
the tokens before it. Pair and triple counts of the running text tell which words followed the last
two tokens and the last one. The decisions are: is the token one that followed the last two (its
share there then names it), else one that followed the last token, else a word of the training
texts (its share of all tokens names it); else the word is new, and its bytes and a blank are coded
bit by bit. Each decision's probability comes from several predictors, which hold how often a 0 and
a 1 followed in a hashed context: for the first three decisions, contexts of how often the last two
and the last token were seen and of how the two tokens before were coded; for the bits of a new
word, the bits of the byte so far with the place in the word, with the last one, two and three
bytes, and with the whole word so far. Predictions are mixed in the logistic domain by a weight
set that a gate selects, learned online, and refined by an adaptive map from the mixture to the
observed rate.

Which token it is, is mixed once more, in the linear domain, where no sum over all words is needed:
the decisions' probability, the token's share after the last token and among all tokens, and its share
after the last token and among all tokens of its own text so far, which also tells words that the
training texts don't have. A gate selects the weights, learned from all training texts, each
without its own occurrences; a prediction that has nothing to go by (known before the token) sleeps.
While a text is scored, its tables grow with each token, and the weights move by how much each
prediction was due and used so far. -log2 over all tokens, divided by the bytes, is bits per byte.

What is gathered grows with the input: exact counts of all words, pairs and triples of the training
texts, in ranges of their hashes (words by 64 bits; pairs and triples by 32 bits within a range of about
``RANGE`` keys, so about 1 in 4,000 that weren't seen is met by chance).
Only tables of fixed size are broadcast. A batch of texts sends its distinct keys to the ranges and
gets their counts back, so a frequent pair is one key a batch, and no task holds a key's rows.

Learning is the same for any partitioning: decision statistics are sums by ``SLICES`` hash slices of
the texts, which the online mixer passes in order; a token's own occurrence is taken off its counts
first, so that a text doesn't vouch for itself. The speller learns from the words that occur once,
also by slices and in order. A state in which asking for the longer context costs more bits than
it saves, over all training texts, skips that decision. Words excluded by a decision keep their
share in the next one, so probabilities of all token sequences sum to at most one, and so do those
of the last mixture, whose weights sum to one before each token.

Defined results: a null text is empty, only the end is scored; a null id is a row like any other;
without any training row the base has c = 0, N = 0, V = 0, and a word is spelled by bits of
probability one half; repeated rows get equal scores; an empty table gives an empty result; other
columns are ignored. Texts are scored whole, very long ones in a batch of their own; very long new
words restart the speller's contexts every ``PIECE`` bytes.
"""

from __future__ import annotations

import ctypes
import math
import pickle
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimscope.llm.common import discard, materialize, tune

MODULUS, HELD_OUT = 7, 2
#: Text of one batch, and keys of one range, in about these numbers.
BATCH_TEXT, RANGE = 4 << 20, 1 << 20
ORDERS, SLOT_BITS = 5, (16, 16, 18, 18, 18)
SLOTS = tuple(1 << b for b in SLOT_BITS)
STARTS = tuple(int(x) for x in np.cumsum((0, *SLOTS)))
#: Numbers in one row of the distributed tables.
BLOCK = 1 << 14
PLACES, SURE = 8, 6
GATES = PLACES * SURE
CLASSES, STEPS = 8, 33
RATE, BATCH_WORDS = 0.05, 1024
PIECE, BATCH_BYTES = 4096, 1 << 16
SLICES = 16
#: Classes of the last two tokens' count, of the last one's, of the two levels before (START: before the text).
PAIRS, LASTS, LEVELS, START = 12, 16, 4, 4
CELLS = PAIRS * LASTS * 25
#: The last mixture: its predictions, their classes of likelihood, its gates, tokens taken at once, and the
#: tokens that the learned weights count for against what a gate, and a text so far, shows.
MIXED, KINDS, DOORS, CHUNK = 5, 11, 40, 1 << 16
FIRM, ROUNDS = 16, 60
END = b""
LN10 = math.log(10)

_U = np.uint64


def in_arrow(df: DataFrame, run: Callable, schema: str | T.StructType) -> DataFrame:
    """mapInArrow whose worker gives freed memory back at a task's end, as workers outlive their tasks."""

    def lean(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # of glibc only
            trim(0)

    return df.mapInArrow(lean, schema)


def _hash(x: np.ndarray, order: int) -> np.ndarray:
    x = (x + _U(0x9E3779B97F4A7C15 * (order + 1) & (1 << 64) - 1)) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(29))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(32))


# --- the speller: bits of new words -------------------------------------------------------------


def codes(words: list[bytes]) -> tuple[list[bytes], list[int]]:
    """The words' bytes with the blank, very long ones in pieces that restart the contexts; and whose they are."""
    out, owner = [], []
    for i, w in enumerate(words):
        w += b" "
        for a in range(0, len(w), PIECE):
            out.append(w[a : a + PIECE])
            owner.append(i)
    return out, owner


def coded(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each bit of the codes: slots (ORDERS rows), bit, word, place and class of the last byte."""
    data = np.frombuffer(b"".join(words), np.uint8)
    size = np.array([len(w) for w in words])
    word = np.repeat(np.arange(len(words)), size)
    start = np.repeat(np.cumsum(size) - size, size)
    place = np.arange(len(data)) - start
    wide = data.astype(np.uint64)
    last = np.zeros((4, len(data)), np.uint64)  # the last 1, 2, 3 bytes; 0 before the word
    for j in (1, 2, 3):
        before = np.zeros(len(data), np.uint64)
        before[j:] = wide[:-j]
        before[place < j] = 0
        last[j] = last[j - 1] | (before << _U(8 * (j - 1)))
    # the whole word so far: prefix sums of powers, less those at the word's start
    with np.errstate(over="ignore"):
        term = (wide + _U(1)) * _hash(place.astype(np.uint64), 7)
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(term, dtype=np.uint64)])
        prefix = total[np.arange(len(data))] - total[start]
        bits = np.arange(8, dtype=np.uint64)
        so_far = (_U(1) << bits)[None, :] | (wide[:, None] >> (_U(8) - bits)[None, :])
        spread = so_far * _U(0x9E3779B97F4A7C15)
        slots = np.empty((ORDERS, len(data) * 8), np.int64)
        near = np.minimum(place, 15).astype(np.uint64)
        contexts = (near, last[1], last[2], last[3], prefix)
        for o, c in enumerate(contexts):
            h = (_hash(c, o)[:, None] ^ spread) * _U(0xBF58476D1CE4E5B9)
            h >>= _U(64 - SLOT_BITS[o])
            h += _U(STARTS[o])
            slots[o] = h.view(np.int64).ravel()
    bit = ((data[:, None] >> (7 - np.arange(8, dtype=np.uint8))[None, :]) & 1).ravel()
    previous = last[1].astype(np.int64)
    kind = np.select([previous == 0, previous < 97, previous < 104, previous < 110, previous < 116, previous < 128, previous < 192], range(7), 7)
    return slots, bit, np.repeat(word, 8), np.repeat(np.minimum(place, PLACES - 1), 8), np.repeat(kind, 8)


def predictions(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """Stretched predictions from counts of zeros and ones."""
    return np.log((n1 + np.float32(0.4)) / (n0 + np.float32(0.4)))


def certainty(n: np.ndarray) -> np.ndarray:
    """The gate's class of how often the longest context was seen."""
    return np.minimum(np.log2(n + np.float32(1)).astype(np.int64) // 2, SURE - 1)


def squash(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -12, 12)))


def empty_speller() -> dict:
    return {"n0": np.zeros(STARTS[-1], np.float32), "n1": np.zeros(STARTS[-1], np.float32), "weights": np.full((GATES, ORDERS), 0.3), "map": identity_map()}


def identity_map() -> np.ndarray:
    return np.tile(squash(np.linspace(-12, 12, STEPS)), (CLASSES, 1))


def _batches(words: list[bytes]) -> Iterator[tuple[list[bytes], list[int]]]:
    """Codes and their words, at most BATCH_WORDS codes of about 64 kB at once."""
    parts, owner = codes(words)
    at = 0
    while at < len(parts):
        end, size = at, 0
        while end < len(parts) and end - at < BATCH_WORDS and size < BATCH_BYTES:
            size += len(parts[end])
            end += 1
        yield parts[at:end], owner[at:end]
        at = end


def bit_probabilities(parts: list[bytes], speller: dict, without_self: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """For each bit of the codes: the probability of the bit that it is; and its code."""
    stretch, bit, gate, word, kind = _seen(parts, speller, without_self)
    p = _refined(_mixed(stretch, speller["weights"][gate]), kind, speller["map"])
    return np.where(bit == 1, p, 1 - p), word


def spelled(words: list[bytes], speller: dict) -> np.ndarray:
    """Natural log probabilities of the words' bytes and blanks."""
    out = np.zeros(len(words))
    for parts, owner in _batches(words):
        p, word = bit_probabilities(parts, speller)
        np.add.at(out, np.array(owner), np.bincount(word, np.log(p), len(parts)))
    return out


def _seen(parts: list[bytes], speller: dict, without_self: bool):
    slots, bit, word, place, kind = coded(parts)
    own = bit.astype(np.float32) if without_self else None
    n0, n1 = speller["n0"][slots], speller["n1"][slots]
    if without_self:
        n0, n1 = np.maximum(n0 - (1 - own), 0), np.maximum(n1 - own, 0)
    return predictions(n0, n1), bit, place * SURE + certainty(n0[-1] + n1[-1]), word, kind


def _mixed(stretch: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return np.clip(np.einsum("ob,bo->b", stretch, weights), -11.9, 11.9)


def _step(mixed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The place of a mixture in the map, between two steps."""
    at = (mixed + 12) * (STEPS - 1) / 24
    low = at.astype(np.int64)
    return low, at - low


def _refined(mixed: np.ndarray, kind: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The mean of the mixture and the adaptive map's interpolated rate; strictly between 0 and 1."""
    low, part = _step(mixed)
    rate = table[kind, low] * (1 - part) + table[kind, low + 1] * part
    return np.clip((squash(mixed) + rate) / 2, 1e-6, 1 - 1e-6)


def _sums_schema() -> str:
    return "block int, sums binary"


def _blocks(vector: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The non-zero blocks of a vector, as rows."""
    for b in range(0, len(vector), BLOCK):
        part = vector[b : b + BLOCK]
        if part.any():
            yield pa.RecordBatch.from_arrays([pa.array([b // BLOCK], pa.int32()), pa.array([part.astype("f8").tobytes()], pa.binary())], names=["block", "sums"])


def _added(df: DataFrame, length: int) -> np.ndarray:
    """The sum of vectors given as blocks(), added on the cluster; ``length`` is fixed by the model."""

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                new = np.frombuffer(v, "f8")
                totals[k] = totals[k] + new if k in totals else new
        if totals:
            yield pa.RecordBatch.from_arrays([pa.array(list(totals), pa.int32()), pa.array([t.tobytes() for t in totals.values()], pa.binary())], names=["block", "sums"])

    out = np.zeros(length)
    for r in in_arrow(df.repartition("block"), add, _sums_schema()).toLocalIterator():
        part = np.frombuffer(r["sums"], "f8")
        out[r["block"] * BLOCK : r["block"] * BLOCK + len(part)] += part
    return out


def learn_speller(novel: DataFrame) -> dict:
    """The speller of the rows (slice, word) of ``novel``: tables over all, mixer and map by slices."""

    def tables(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, STARTS[-1]))
        for batch in batches:
            for parts, _ in _batches(batch.column(1).to_pylist()):
                slots, bit, *_ = coded(parts)
                for value in (0, 1):
                    some = bit == value
                    for o in range(ORDERS):
                        counts[value, STARTS[o] : STARTS[o + 1]] += np.bincount(slots[o][some] - STARTS[o], minlength=SLOTS[o])
        yield from _blocks(counts.ravel())

    speller = empty_speller()
    speller["n0"], speller["n1"] = _added(in_arrow(novel, tables, _sums_schema()), 2 * STARTS[-1]).astype(np.float32).reshape(2, -1)
    dealt = novel.repartition("slice").sortWithinPartitions("slice", "word")
    for fit, size, finish in ((_online, GATES * ORDERS + 1, _averaged), (_observed, 2 * CLASSES * STEPS, _rates)):
        shared = novel.sparkSession.sparkContext.broadcast(speller)
        rows = in_arrow(dealt, _by_slice(fit, shared, size), "slice int, sums binary").collect()  # one row a slice
        if rows:
            finish(speller, np.sum([np.frombuffer(r["sums"]) for r in sorted(rows, key=lambda r: r["slice"])], axis=0))
    return speller


def _by_slice(fit, shared, size: int):
    """Runs ``fit`` over each slice's words in their order; one row a slice, whatever the batches are."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, waiting = None, None, []

        def flush(all_: bool) -> None:
            while len(waiting) >= BATCH_WORDS or (all_ and waiting):
                for parts, _ in _batches(waiting[:BATCH_WORDS]):
                    fit(parts, shared.value, state)
                del waiting[:BATCH_WORDS]

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([_state_sums(state).tobytes()], pa.binary())], names=["slice", "sums"])

        for batch in batches:
            slices = batch.column(0).to_numpy()
            words = batch.column(1).to_pylist()
            for a, b in zip(*_runs(slices)):
                if slices[a] != now:
                    if now is not None:
                        flush(True)
                        yield row()
                    now, state = int(slices[a]), _new_state(size)
                waiting.extend(words[a:b])
                flush(False)
        if now is not None:
            flush(True)
            yield row()

    return run


def _runs(x: np.ndarray) -> tuple[list[int], list[int]]:
    edges = np.flatnonzero(np.diff(x)) + 1
    return [0, *edges.tolist()] if len(x) else [], [*edges.tolist(), len(x)] if len(x) else []


def _new_state(size: int) -> dict:
    return {"sums": np.zeros(size), "weights": np.full((GATES, ORDERS), 0.3), "power": np.full((GATES, ORDERS), 1e-6), "words": 0, "online": size == GATES * ORDERS + 1}


def _state_sums(state: dict) -> np.ndarray:
    return np.append(state["weights"].ravel() * state["words"], state["words"]) if state["online"] else state["sums"]


def _online(parts: list[bytes], speller: dict, state: dict) -> None:
    stretch, bit, gate, _, _ = _seen(parts, speller, True)
    error = bit - squash(_mixed(stretch, state["weights"][gate]))
    times = np.maximum(np.bincount(gate, minlength=GATES), 1)
    for o in range(ORDERS):
        slope = np.bincount(gate, error * stretch[o], GATES) / times
        state["power"][:, o] += slope * slope
        state["weights"][:, o] += RATE * slope / np.sqrt(state["power"][:, o])
    state["words"] += len(parts)


def _observed(parts: list[bytes], speller: dict, state: dict) -> None:
    stretch, bit, gate, _, kind = _seen(parts, speller, True)
    low, part = _step(_mixed(stretch, speller["weights"][gate]))
    hits, ones = state["sums"].reshape(2, -1)
    for at, share in ((low, 1 - part), (low + 1, part)):
        hits += np.bincount(kind * STEPS + at, share, CLASSES * STEPS)
        ones += np.bincount(kind * STEPS + at, share * bit, CLASSES * STEPS)


def _averaged(speller: dict, sums: np.ndarray) -> None:
    speller["weights"] = (sums[:-1] / sums[-1]).reshape(GATES, ORDERS)


def _rates(speller: dict, sums: np.ndarray) -> None:
    hits, ones = sums.reshape(2, CLASSES, STEPS)
    speller["map"] = (ones + 4 * speller["map"]) / (hits + 4)


# --- tokens of a batch and their counts ---------------------------------------------------------


def shut(*arrays: np.ndarray) -> bytes:
    """Non-negative integer arrays in few bytes: least width, byte planes, compressed."""
    out = []
    for a in arrays:
        a = a.astype(np.min_scalar_type(int(a.max()) if len(a) else 0))
        out.append((a.dtype.str, a.view(np.uint8).reshape(-1, a.itemsize).T.tobytes()))
    return zstandard.ZstdCompressor(1).compress(pickle.dumps(out))


def opened(blob: bytes) -> list[np.ndarray]:
    out = []
    for dtype, raw in pickle.loads(zstandard.ZstdDecompressor().decompress(blob)):
        width = np.dtype(dtype).itemsize
        out.append(np.frombuffer(np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(width, -1).T).tobytes(), dtype))
    return out


def word_list(data: np.ndarray, n: int) -> list[bytes]:
    return data.tobytes().split(b"\n") if n else []


def token_keys(words: list[bytes], index: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the distinct words; and of each token with the one before, and with the two before."""
    own = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    at = own[index]
    with np.errstate(over="ignore"):
        before = np.empty_like(at)
        before[1:] = at[:-1]
        before[starts] = _U(1)
        pair = _hash(_hash(before, 1) + at, 2)
        earlier = np.empty_like(at)
        earlier[1:] = before[:-1]
        earlier[starts] = _U(2)
        return _hash(own, 5), pair, _hash(_hash(earlier, 3) + pair, 4)


def batch_keys(words: list[bytes], index: np.ndarray, size: np.ndarray):
    """For words, pairs and triples: the sorted distinct keys, and each word's or token's place among them."""
    starts = np.cumsum(size) - size
    return [np.unique(k, return_inverse=True) for k in token_keys(words, index, starts)]


def packed(docs: DataFrame) -> DataFrame:
    """Batches of docs (key, trains, reported, slice, raw): the keys and the tokens as numbers."""
    kind = docs.schema["key"].dataType
    schema = T.StructType([T.StructField("keys", T.ArrayType(kind)), *(T.StructField(c, T.LongType()) for c in ("n", "train_docs", "train_tokens")), T.StructField("blob", T.BinaryType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            ends = np.cumsum([len(x or b"") + 64 for x in batch.column(4).to_pylist()])
            a = 0
            while a < len(ends):
                b = min(len(ends), a + 1 + int(np.searchsorted(ends[a:] - (ends[a - 1] if a else 0), BATCH_TEXT - size)))
                held.append(batch.slice(a, b - a))
                size += int(ends[b - 1] - (ends[a - 1] if a else 0))
                a = b
                if size >= BATCH_TEXT:
                    yield row(pa.Table.from_batches(held))
                    held, size = [], 0
        if held:
            yield row(pa.Table.from_batches(held))

    def row(t: pa.Table) -> pa.RecordBatch:
        texts = [(x or b"").lower().split() for x in t.column(4).to_pylist()]
        sizes = np.array([len(x) + 1 for x in texts])
        nbytes = np.array([sum(map(len, x)) + len(x) + 1 for x in texts])
        tokens: list[bytes] = []
        for x in texts:
            tokens += x
            tokens.append(END)
        found = pa.array(tokens, pa.binary()).dictionary_encode()
        words = found.dictionary.to_pylist()
        trains, reported, slices = (t.column(i).to_numpy().astype(np.int64) for i in (1, 2, 3))
        blob = shut(trains, reported, slices, sizes, nbytes, np.array([len(words)]), np.frombuffer(b"\n".join(words), np.uint8), found.indices.to_numpy())
        keys = t.column(0).combine_chunks()
        keys = pa.ListArray.from_arrays(pa.array([0, len(keys)], pa.int32()), keys if isinstance(keys, pa.Array) else keys.chunk(0))
        return pa.RecordBatch.from_arrays([keys, *(pa.array([int(v)], pa.int64()) for v in (sizes.sum(), trains.sum(), sizes[trains > 0].sum())), pa.array([blob], pa.binary())], names=schema.names)

    return in_arrow(docs, run, schema)


def asked(rows: DataFrame, bits: int) -> DataFrame:
    """For each batch and range of hashes: the distinct keys and how many training tokens have them."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                trains, _, _, size, _, n, data, index = opened(blob)
                words = word_list(data, int(n[0]))
                teach = np.repeat(trains > 0, size)
                sent = []
                for order, (keys, place) in enumerate(batch_keys(words, index, size)):
                    place = place[index] if order == 0 else place
                    counts = np.bincount(place[teach], minlength=len(keys))
                    range_ = (keys >> _U(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
                    cut = np.searchsorted(range_, np.arange((1 << bits) + 1))
                    sent.append((keys if order == 0 else (keys >> _U(32 - bits)).astype(np.uint32), counts, cut))
                for r in range(1 << bits):
                    parts = [(k[c[r] : c[r + 1]], n_[c[r] : c[r + 1]]) for k, n_, c in sent]
                    if any(len(k) for k, _ in parts):
                        out = shut(*(x for p in parts for x in p))
                        yield pa.RecordBatch.from_arrays([pa.array([r], pa.int32()), pa.array([name], pa.int64()), pa.array([out], pa.binary())], names=["range", "batch", "blob"])

    return in_arrow(rows.select("batch", "blob"), run, "range int, batch long, blob binary")


def answered(questions: DataFrame) -> DataFrame:
    """The counts over all batches of each question's keys; and of each range, the distinct training words (batch -1)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, waiting = None, []
        for batch in batches:
            for r, name, blob in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if r != now and waiting:
                    yield from answer(now, waiting)
                    waiting = []
                now = r
                waiting.append((name, blob))
        if waiting:
            yield from answer(now, waiting)

    def answer(r: int, waiting: list) -> Iterator[pa.RecordBatch]:
        parts = [opened(blob) for _, blob in waiting]
        found, words = [], 0
        for order in range(3):
            keys, counts = (np.concatenate([p[2 * order + i] for p in parts]) for i in (0, 1))
            distinct, place = np.unique(keys, return_inverse=True)
            total = np.bincount(place, counts, len(distinct)).astype(np.int64)
            words += int((total > 0).sum()) if order == 0 else 0
            found.append(np.split(total[place], np.cumsum([len(p[2 * order]) for p in parts])[:-1]))
        for (name, _), *counts in zip(waiting, *found):
            yield out(name, r, 0, shut(*counts))
        yield out(-1, r, words, b"")

    def out(name: int, r: int, words: int, blob: bytes) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([name], pa.int64()), pa.array([r], pa.int32()), pa.array([words], pa.int64()), pa.array([blob], pa.binary())], names=["batch", "range", "words", "blob"])

    return in_arrow(questions.repartition("range").sortWithinPartitions("range", "batch"), run, "batch long, range int, words long, blob binary")


def counted(rows: DataFrame, answers: DataFrame) -> DataFrame:
    """The batches with the counts of each word, and of each token's pair and triple; and the words that occur once."""
    keys = rows.schema["keys"].dataType
    both = rows.select("batch", F.lit(-1).alias("range"), "keys", "blob").unionByName(answers.where("batch >= 0").select("batch", "range", F.lit(None).cast(keys).alias("keys"), "blob"))
    schema = T.StructType([T.StructField("keys", keys), T.StructField("novel", T.ArrayType(T.BinaryType())), T.StructField("blob", T.BinaryType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, parts = None, []
        for batch in batches:
            for i, (r, blob) in enumerate(zip(batch.column(1).to_pylist(), batch.column(3).to_pylist())):
                if r < 0:
                    if own is not None:
                        yield row(own, parts)
                    own, parts = (batch.column(2).slice(i, 1), blob), []
                else:
                    parts.append(opened(blob))
        if own is not None:
            yield row(own, parts)

    def row(own: tuple, parts: list) -> pa.RecordBatch:
        trains, reported, slices, size, nbytes, n, data, index = opened(own[1])
        words = word_list(data, int(n[0]))
        counts = [np.concatenate([p[order] for p in parts])[place] for order, (_, place) in enumerate(batch_keys(words, index, size))]
        once = np.bincount(index[np.repeat(trains > 0, size)], minlength=len(words)) > 0
        novel = [words[i] for i in np.flatnonzero(once & (counts[0] == 1)).tolist()]
        blob = shut(trains, reported, slices, size, nbytes, n, data, index, *counts)
        return pa.RecordBatch.from_arrays([own[0], pa.array([novel], pa.list_(pa.binary())), pa.array([blob], pa.binary())], names=schema.names)

    return in_arrow(both.repartition("batch").sortWithinPartitions("batch", "range"), run, schema)


def text_runs(size: np.ndarray) -> Iterator[tuple[slice, slice]]:
    """Runs of whole texts of about ``CHUNK`` tokens, and their tokens."""
    ends = np.cumsum(size)
    a = at = 0
    while a < len(size):
        b = max(a + 1, int(np.searchsorted(ends, at + CHUNK, "right")))
        yield slice(a, b), slice(at, int(ends[b - 1]))
        a, at = b, int(ends[b - 1])


# --- the decisions -------------------------------------------------------------------------------


def states(c0: np.ndarray, c1: np.ndarray, c2: np.ndarray, size: np.ndarray, texts: int, less: np.ndarray):
    """Of each token: its level (3: followed the last two, 2: followed the last, 1: known, 0: new), the
    counts (own, pair, triple, before, two before) and the cell. ``less`` is taken off all counts."""
    starts = np.cumsum(size) - size
    total1, total2 = np.empty_like(c0), np.empty_like(c0)
    total1[1:], total2[1:] = c0[:-1], c1[:-1]
    total1[starts] = total2[starts] = texts
    c0, c1, c2, total1, total2 = (np.maximum(x - less, 0) for x in (c0, c1, c2, total1, total2))
    known, after, after2 = c0 > 0, c1 > 0, c2 > 0
    level = known.astype(np.int64) + (known & after) + (known & after & after2)
    last, earlier = np.empty_like(level), np.empty_like(level)
    last[1:] = level[:-1]
    last[starts] = START
    earlier[1:] = last[:-1]
    earlier[starts] = START
    a = np.minimum(np.log2(total2 + 1.0).astype(np.int64), PAIRS - 1)
    b = np.minimum(np.log2(total1 + 1.0).astype(np.int64), LASTS - 1)
    return level, (c0, c1, c2, total1, total2), (a * LASTS + b) * 25 + last * 5 + earlier


def statistics(rows: DataFrame, texts: int, tokens: int) -> tuple[np.ndarray, np.ndarray]:
    """Training tokens by (slice, cell, level), and the summed bits that their shares at each order would cost by (order, cell, level)."""
    split = SLICES * CELLS * LEVELS

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(split + 3 * CELLS * LEVELS)
        for batch in batches:
            for blob in batch.column(0).to_pylist():
                trains, _, slices, size, _, _, _, index, c0, c1, c2 = opened(blob)
                trains, slices, size = (x.astype(np.int64) for x in (trains, slices, size))
                for ts, at in text_runs(size):
                    own = np.repeat(trains[ts], size[ts])
                    level, (k0, k1, k2, t1, t2), cell = states(*(x.astype(np.int64) for x in (c0[index[at]], c1[at], c2[at])), size[ts], texts, own)
                    state, some = cell * LEVELS + level, own > 0
                    sums[:split] += np.bincount((np.repeat(slices[ts], size[ts]) * CELLS * LEVELS + state)[some], minlength=split)
                    for order, (n, total) in enumerate(((k0, np.int64(max(tokens - 1, 1))), (k1, t1), (k2, t2))):
                        named = some & (level > order)
                        total = np.broadcast_to(total, n.shape)[named]
                        bits = np.rint(np.log2(total / n[named]) * 65536)  # whole numbers: sums don't depend on their order
                        sums[split + order * CELLS * LEVELS :][: CELLS * LEVELS] += np.bincount(state[named], bits, CELLS * LEVELS)
        yield from _blocks(sums)

    sums = _added(in_arrow(rows.select("blob"), run, _sums_schema()), split + 3 * CELLS * LEVELS)
    return sums[:split].reshape(SLICES, CELLS, LEVELS), sums[split:].reshape(3, CELLS, LEVELS) / 65536


def _parts_of_cells() -> tuple[np.ndarray, ...]:
    cell = np.arange(CELLS)
    return cell // 25 // LASTS, cell // 25 % LASTS, cell % 25, cell % 25 // 5


def _bits(ones: np.ndarray, zeros: np.ndarray) -> np.ndarray:
    """About the bits of coding so many ones and zeros adaptively."""
    n = ones + zeros
    with np.errstate(divide="ignore", invalid="ignore"):
        exact = np.nan_to_num(ones * np.log2(n / ones)) + np.nan_to_num(zeros * np.log2(n / zeros))
    return exact + np.log2(n + 1) / 2


def learn_decisions(seen: np.ndarray, shares: np.ndarray) -> dict:
    """By cell: which decisions are asked (``ask``, orders 2 and 1) and the probabilities of a yes (``yes``, orders 0 to 2)."""
    a, b, h, last = _parts_of_cells()
    n = seen.sum(0)
    i0, i1, i2 = shares
    costs = {
        (1, 1): _bits(n[:, 3], n[:, :3].sum(1)) + _bits(n[:, 2], n[:, :2].sum(1)) + _bits(n[:, 1], n[:, 0]) + i2[:, 3] + i1[:, 2] + i0[:, 1],
        (1, 0): _bits(n[:, 3], n[:, :3].sum(1)) + _bits(n[:, 1:3].sum(1), n[:, 0]) + i2[:, 3] + i0[:, 1:3].sum(1),
        (0, 1): _bits(n[:, 2:].sum(1), n[:, :2].sum(1)) + _bits(n[:, 1], n[:, 0]) + i1[:, 2:].sum(1) + i0[:, 1],
        (0, 0): _bits(n[:, 1:].sum(1), n[:, 0]) + i0[:, 1:].sum(1),
    }
    best = np.argmin(np.array(list(costs.values())), axis=0)
    ask2, ask1 = (best < 2) & (a > 0), (best % 2 == 0) & (b > 0)
    yes2 = np.where(ask2, seen[..., 3], 0)
    yes1 = np.where(ask1, seen[..., 2] + np.where(ask2, 0, seen[..., 3]), 0)
    no2, no1 = np.where(ask2, seen[..., :3].sum(-1), 0), np.where(ask1, seen[..., :2].sum(-1), 0)
    yes0 = seen[..., 1] + np.where(ask1, 0, seen[..., 2]) + np.where(ask1 | ask2, 0, seen[..., 3])
    return {"ask": (ask1, ask2), "yes": [mixed_decision(*x, (a, b, h, last)) for x in ((yes0, seen[..., 0]), (yes1, no1), (yes2, no2))]}


def mixed_decision(ones: np.ndarray, zeros: np.ndarray, parts: tuple) -> np.ndarray:
    """Mixes the predictors' contexts online over the slices; the probability of a one in each cell."""
    a, b, h, last = parts
    contexts = [a, b, h, a * 5 + last, b * 5 + last, np.arange(CELLS)]
    weights, power = np.full((25, len(contexts)), 1 / len(contexts)), np.full((25, len(contexts)), 1e-6)
    hits, hit_ones, before = np.zeros((CLASSES, STEPS)), np.zeros((CLASSES, STEPS)), np.zeros((2, CELLS))

    def stretches() -> np.ndarray:
        n1, n0 = before
        return np.array([np.log((np.bincount(c, n1)[c] + 0.4) / (np.bincount(c, n0)[c] + 0.4)) for c in contexts])

    def mixture(x: np.ndarray) -> np.ndarray:
        return np.clip(np.einsum("oc,co->c", x, weights[h]), -11.9, 11.9)

    for y1, y0 in zip(ones, zeros):
        x = stretches()
        low, part = _step(mixture(x))
        for at, share in ((low, 1 - part), (low + 1, part)):
            np.add.at(hits, (last, at), (y1 + y0) * share)
            np.add.at(hit_ones, (last, at), y1 * share)
        times = np.maximum(np.bincount(h, y1 + y0, 25), 1)
        for _ in range(8):
            error = y1 - (y1 + y0) * squash(mixture(x))
            for o in range(len(contexts)):
                slope = np.bincount(h, error * x[o], 25) / times
                power[:, o] += slope * slope
                weights[:, o] += RATE * slope / np.sqrt(power[:, o])
        before += np.array([y1, y0])
    return _refined(mixture(stretches()), last, (hit_ones + 4 * identity_map()) / (hits + 4))


# --- the last mixture ----------------------------------------------------------------------------


def places(group: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each token: how many of its group came before it, how many there are, and the group's number. Groups are below ``most``."""
    width = len(group).bit_length()
    if most.bit_length() + width < 63:
        both = np.sort((group << width) | np.arange(len(group)))
        at, group = both & ((1 << width) - 1), both >> width
    else:
        at = np.argsort(group, kind="stable")
        group = group[at]
    first = np.flatnonzero(np.diff(group, prepend=-1))
    sizes = np.diff(np.append(first, len(group)))
    number = np.repeat(np.arange(len(first)), sizes)
    out = [np.empty_like(at) for _ in range(3)]
    for x, values in zip(out, (np.arange(len(at)) - first[number], sizes[number], number)):
        x[at] = values
    return tuple(out)


def own_counts(index: np.ndarray, size: np.ndarray, n_words: int, whole: bool) -> tuple[np.ndarray, ...]:
    """What each token's text shows before it: the pair and how often the last token was followed, the word and
    the tokens; with ``whole``, then how often its whole text has the word, the pair and the triple."""
    n, texts, starts = len(index), len(size), np.cumsum(size) - size
    rank, words, number = places(np.repeat(np.arange(texts), size) * n_words + index, texts * n_words)
    out, followed, total = [], np.empty_like(rank), [words]
    followed[1:] = rank[:-1]
    followed[starts] = 0
    for _ in range(1 + whole):  # the pair's group is that of the last token with the word, the triple's that of the last pair
        before = np.empty_like(number)
        before[1:] = number[:-1]
        before[starts] = n + np.arange(texts)
        again, same, number = places(before * n_words + index, (n + texts) * n_words)
        out.append(again)
        total.append(same)
    return (out[0], followed, rank, np.arange(n) - np.repeat(starts, size), *(total if whole else ()))


def known_shares(counts: tuple, tokens: np.ndarray, own: tuple) -> list[tuple[np.ndarray, np.ndarray]]:
    """The token's share after the last token, among all tokens, in its text after the last token and in its text; and
    whether there is such a prediction at all, which doesn't depend on the token."""
    c0, c1, _, t1, _ = counts
    out = []
    for n, total in ((c1, t1), (c0, tokens), own[:2], own[2:4]):
        out.append((np.minimum(n, total) / np.maximum(total, 1), total > 0))
    return out


def door(cell: np.ndarray) -> np.ndarray:
    """The gate of the last mixture: classes of how often the last two and the last token were seen, and whether the last was named after two."""
    return (np.minimum(cell // (25 * LASTS), 4) * 4 + cell // 25 % LASTS // 4) * 2 + (cell % 25 // 5 == 3)


def likelihoods(rows: DataFrame, model: dict, texts: int, tokens: int) -> np.ndarray:
    """Training tokens by gate and by the classes of how much likelier each share makes them than the decisions
    do. The whole text's occurrences are taken off all counts, as a text to be scored has none there."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    length = DOORS * KINDS ** (MIXED - 1)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(length)
        for batch in batches:
            for blob in batch.column(0).to_pylist():
                trains, _, _, size, _, n, data, index, c0, c1, c2 = opened(blob)
                words, some = word_list(data, int(n[0])), np.repeat(trains > 0, size)
                index, c1, c2, size = (x.astype(np.int64) for x in (index[some], c1[some], c2[some], size[trains > 0]))
                for ts, at in text_runs(size):
                    sums += np.bincount(classes(words, size[ts], index[at], c0[index[at]].astype(np.int64), c1[at], c2[at]), minlength=length)
        yield from _blocks(sums)

    def classes(words: list[bytes], size: np.ndarray, index: np.ndarray, c0: np.ndarray, c1: np.ndarray, c2: np.ndarray) -> np.ndarray:
        *own, n0, n1, n2 = own_counts(index, size, len(words), True)
        rest = tokens - np.repeat(size, size)
        level, counts, cell = states(*(np.maximum(c - n, 0) for c, n in ((c0, n0), (c1, n1), (c2, n2))), size, texts - 1, np.int64(0))
        lp = token_scores(counts, cell, level, rest, shared.value)
        again = np.flatnonzero((level == 0) & (own[2] > 0))  # new but for its own text; other new ones have no share anywhere
        if len(again):
            distinct, place = np.unique(index[again], return_inverse=True)
            lp[again] += spelled([words[i] for i in distinct.tolist()], shared.value["speller"])[place]
        code = door(cell)
        for p, awake in known_shares(counts, rest, own):
            with np.errstate(divide="ignore"):
                kind = 2 + np.clip(np.floor(((np.log(p) - lp) / math.log(2) + 5) / 2), 0, KINDS - 3)
            code = code * KINDS + np.where(awake, np.where(p > 0, kind, 1), 0).astype(np.int64)
        return code

    return _added(in_arrow(rows.select("blob"), run, _sums_schema()), length).reshape(DOORS, -1)


def learn_mixture(seen: np.ndarray) -> np.ndarray:
    """By gate: the weights that make the training tokens likeliest; all on the decisions where nothing was seen."""
    gate, code = np.nonzero(seen)
    n = seen[gate, code]
    kinds = code[:, None] // KINDS ** np.arange(MIXED - 2, -1, -1) % KINDS
    awake = np.hstack([np.ones((len(n), 1), bool), kinds > 0])
    gain = np.hstack([np.ones((len(n), 1)), np.where(kinds > 1, 2.0 ** (2 * (kinds - 2) - 4), 0)])
    weights = np.full((DOORS, MIXED), 1 / MIXED)
    for _ in range(ROUNDS):
        used = weights[gate] * awake
        used /= used.sum(1, keepdims=True)
        due = used * gain
        due /= due.sum(1, keepdims=True)
        for k in range(MIXED):
            weights[:, k] *= (np.bincount(gate, n * due[:, k], DOORS) + 1) / (np.bincount(gate, n * used[:, k], DOORS) + 1)
        weights /= weights.sum(1, keepdims=True)
    trust = seen.sum(1, keepdims=True) / (seen.sum(1, keepdims=True) + FIRM)
    return weights * trust + (1 - trust) * (np.arange(MIXED) == 0)


def blended(lp: np.ndarray, shares: list, gate: np.ndarray, size: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Natural log of the mixture of the decisions' probability (``lp`` its log) and the shares. Within a text the
    weights move online: each is multiplied by how much its prediction was due before the token against how much it was used."""
    used = [weights[gate, 0], *(weights[gate, k] * awake for k, (_, awake) in enumerate(shares, 1))]
    whole = sum(used)
    used = [w / whole for w in used]
    with np.errstate(divide="ignore"):
        logs = [lp, *(np.where(w > 0, np.log(p), -np.inf) for w, (p, _) in zip(used[1:], shares))]
    top = np.maximum.reduce(logs)
    gain = [np.exp(x - top) for x in logs]
    due = [w * g for w, g in zip(used, gain)]
    whole = sum(due)
    starts = np.cumsum(size) - size
    moved = []
    for w, d in zip(used, due):
        factor = [_before(np.rint(x * 65536).astype(np.int64), starts, size) + FIRM * 65536 for x in (d / whole, w)]  # whole numbers, as above
        moved.append(w * (factor[0] / factor[1]))
    return top + np.log(sum(w * g for w, g in zip(moved, gain)) / sum(moved))


def _before(x: np.ndarray, starts: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The sum over the tokens before each one in its text."""
    total = np.cumsum(x) - x
    return total - np.repeat(total[starts], size)


# --- scoring -------------------------------------------------------------------------------------


def token_scores(counts: tuple, cell: np.ndarray, level: np.ndarray, tokens: int, model: dict) -> np.ndarray:
    """Natural log probability of each token, without the spelling of new ones."""
    c0, c1, c2, t1, t2 = counts
    out, open_ = np.zeros(len(cell)), np.ones(len(cell), bool)
    for order, (n, total) in ((2, (c2, t2)), (1, (c1, t1)), (0, (c0, np.full(len(cell), tokens)))):
        here = open_ & (model["ask"][order - 1][cell] & (total > 0) if order else np.full(len(cell), tokens > 0))
        hit = here & (level > order)
        p = model["yes"][order][cell]
        out[hit] += np.log(p[hit]) + np.log(n[hit] / total[hit])
        out[here & ~hit] += np.log1p(-p[here & ~hit])
        open_ &= ~hit
    return out


def scored(rows: DataFrame, model: dict, texts: int, tokens: int, distinct: int) -> DataFrame:
    kind = rows.schema["keys"].dataType.elementType
    schema = T.StructType([T.StructField("key", kind), *(T.StructField(c, T.LongType()) for c in ("n_tokens", "n_known", "n_bytes")), *(T.StructField(c, T.DoubleType()) for c in ("base", "lp"))])
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, blob in enumerate(batch.column(1).to_pylist()):
                _, reported, _, size, nbytes, n, data, index, c0, c1, c2 = opened(blob)
                words, size, c0 = word_list(data, int(n[0])), size.astype(np.int64), c0.astype(np.int64)
                new, likely = np.zeros(len(words)), np.log10(c0 + 1.0)
                some = np.flatnonzero(c0 == 0)
                new[some] = spelled([words[j] for j in some.tolist()], shared.value["speller"])
                columns = [size, np.empty_like(size), nbytes.astype(np.int64), np.empty(len(size)), np.empty(len(size))]
                for ts, at in text_runs(size):
                    here, starts = index[at].astype(np.int64), np.cumsum(size[ts]) - size[ts]
                    level, counts, cell = states(c0[here], c1[at].astype(np.int64), c2[at].astype(np.int64), size[ts], texts, np.int64(0))
                    lp = token_scores(counts, cell, level, tokens, shared.value) + new[here]
                    if "mixture" in shared.value:
                        shares = known_shares(counts, np.int64(tokens), own_counts(here, size[ts], len(words), False))
                        lp = blended(lp, shares, door(cell), size[ts], shared.value["mixture"])
                    base = likely[here] - math.log10(tokens + distinct + 1)
                    for column, values in ((1, (c0 > 0)[here].astype(np.int64)), (3, base), (4, lp)):
                        columns[column][ts] = np.add.reduceat(values, starts)
                out = pa.array(reported > 0)
                keys = batch.column(0).slice(i, 1).flatten()
                yield pa.RecordBatch.from_arrays([keys.filter(out), *(pa.array(c).filter(out) for c in columns)], names=schema.names)

    return in_arrow(rows.select("keys", "blob"), run, schema)


def learned(docs: DataFrame) -> dict:
    """docs: key, trains, reported, slice, raw. The batches with their counts, and the model of the training rows."""
    tune(docs.sparkSession)
    rows = materialize(packed(docs).withColumn("batch", F.monotonically_increasing_id()), "lm-packed")
    size = rows.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n", "train_docs", "train_tokens"))).first()
    texts, tokens = size["train_docs"], size["train_tokens"]
    bits = min(31, max(0, math.ceil(math.log2(max(1, 2 * size["n"] / RANGE)))))
    answers = materialize(answered(asked(rows, bits)), "lm-answers", clean=True)  # the questions' shuffle is the largest, and isn't read again
    distinct = answers.agg(F.coalesce(F.sum("words"), F.lit(0))).first()[0]
    full = materialize(counted(rows, answers), "lm-counted", clean=True)
    for done in (rows, answers):
        discard(done)
    model = learn_decisions(*statistics(full, texts, tokens))
    novel = full.select(F.explode("novel").alias("word")).select(F.pmod(F.xxhash64("word"), F.lit(SLICES)).cast("int").alias("slice"), "word")
    model["speller"] = learn_speller(novel)
    return {"rows": full, "model": model, "texts": texts, "tokens": tokens, "distinct": distinct}


def mixed(found: dict) -> dict:
    """What learned() found, with the weights of the last mixture, which are learned over its decisions and speller."""
    seen = likelihoods(found["rows"], found["model"], found["texts"], found["tokens"])
    return {**found, "model": {**found["model"], "mixture": learn_mixture(seen)}}


def _result(found: dict, key: str) -> DataFrame:
    return scored(**found).select(
        F.col("key").alias(key), "n_tokens", "n_known", F.lit(found["tokens"]).cast("long").alias("train_tokens"), F.col("base").alias("base_score"),
        (F.col("lp") / F.lit(LN10)).alias("score"), (-F.col("lp") / F.lit(math.log(2)) / F.col("n_bytes")).alias("bits_per_byte"),
    )


def _docs(df: DataFrame, key: str, text: str, trains: Column, reported: bool) -> DataFrame:
    slice_ = F.pmod(F.xxhash64(F.col(text).cast("string")), F.lit(SLICES))
    return df.select(F.col(key).alias("key"), F.coalesce(trains, F.lit(False)).alias("trains"), F.lit(reported).alias("reported"), slice_.alias("slice"), F.col(text).cast("binary").alias("raw"))


def score(df: DataFrame, training: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, n_tokens, n_known, train_tokens, base_score, score and bits_per_byte of each row of ``df``, learning from ``training``."""
    return _result(mixed(learned(_docs(training, key, text, F.lit(True), False).unionByName(_docs(df, key, text, F.lit(False), True)))), key)


def score_held_out(df: DataFrame, held_out: Column, key: str = "doc_id", text: str = "text") -> DataFrame:
    """As score(), learning from the rows of ``df`` where ``held_out`` is false."""
    return _result(mixed(learned(_docs(df, key, text, ~held_out, True))), key)
