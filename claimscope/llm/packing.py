"""Best-fit packing of token sequences by linear grouping.

Texts are tokenized and cut into pieces. Planning needs only the number of pieces of each exact
length, which is at most ``capacity`` rows whatever the corpus holds. On the driver:

1. large lengths (over ``capacity / SMALL_PART``) are split, in descending order, into groups of
   equal cardinality, and each is rounded up to its group's largest length;
2. the cutting-stock program over these few sizes is solved by column generation (patterns priced
   by a knapsack recurrence); whole multiples of its patterns are taken, and what the rounding
   down leaves is packed by best fit;
3. the actual lengths take the places of the rounded ones, the longest first;
4. small lengths go, longest first, where they fit best.

The plan is made of runs of equal bins, so its size depends on the capacity alone. Executors then
give each piece its place from its length and its rank among the pieces of that length.

Defined results: a null text is tokenized as an empty one (only the end id); texts longer than the
capacity are cut, no other is; repeated rows are packed as often as they occur; an empty table
gives an empty result. Columns of the input that clash with the output's are replaced. A very long single word is
tokenized whole, like any text.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimscope.llm.common import materialize, ordinals, tune

CAPACITY, END_ID = 4096, 1
GROUPS, SMALL_PART = 48, 16
#: Words whose ids a worker remembers.
CACHE_WORDS = 400_000


class _WordIds(dict):
    """Ids of one blank-separated word as little-endian bytes.

    Two generations: when one is full it becomes the old one, and words that are met again move
    over, so frequent words stay.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.encode = Tokenizer.from_file(path).encode
        self.old: dict[bytes, bytes] = {}

    def __missing__(self, word: bytes) -> bytes:
        out = self.old.get(word)
        if out is None:
            # a point or comma after a letter is a token of its own, so the word itself is shared
            if len(word) > 1 and word[-1] in b".," and 97 <= word[-2] <= 122:
                out = self[word[:-1]] + self[word[-1:]]
            else:
                out = np.array(self.encode(word.decode("utf-8", "replace"), add_special_tokens=False).ids, "<u4").tobytes()
        if len(word) <= 64:
            if len(self) >= CACHE_WORDS:
                self.old = dict(self)
                self.clear()
            self[word] = out
        return out


def words(raw: bytes) -> list[bytes]:
    """The text's words. The tokenizer lowers A-Z itself; where it might see a control string, it shall."""
    return (raw if b"<|" in raw else raw.lower()).split()


_word_ids: dict[str, _WordIds] = {}


def word_ids(path: str) -> _WordIds:
    if path not in _word_ids:
        _word_ids[path] = _WordIds(path)
    return _word_ids[path]


def pieces(df: DataFrame, tokenizer_path: str, text: str = "text", keep: Sequence[str] = ("doc_id",), capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """``keep``, piece, start, length and ids (little-endian unsigned 32-bit) of each piece.

    The tokenizer must treat words between blanks one by one, as BPE with white space dropped does.
    """
    tune(df.sparkSession)
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = word_ids(tokenizer_path)
        step = 4 * capacity
        for batch in batches:
            row, piece, start, ids = [], [], [], []
            for i, raw in enumerate(batch.column(batch.num_columns - 1).to_pylist()):
                whole = b"".join(map(ids_of.__getitem__, words(raw or b""))) + end
                for at in range(0, len(whole), step):
                    row.append(i)
                    piece.append(at // step)
                    start.append(at // 4)
                    ids.append(whole[at : at + step])
                if len(row) >= 4096:
                    yield made(batch, row, piece, start, ids)
                    row, piece, start, ids = [], [], [], []
            yield made(batch, row, piece, start, ids)

    def made(batch: pa.RecordBatch, row: list, piece: list, start: list, ids: list) -> pa.RecordBatch:
        kept = [c.take(pa.array(row, pa.int64())) for c in batch.columns[:-1]]
        return pa.RecordBatch.from_arrays([*kept, pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())], names=[*batch.schema.names[:-1], "piece", "start", "length", "ids"])

    keep = [c for c in keep if c not in ("piece", "start", "length", "ids")]
    narrow = df.select(*[F.col(f"`{c}`") for c in keep], F.col(text).cast("binary").alias("__raw"))
    fields = [*narrow.schema.fields[:-1], T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("ids", T.BinaryType())]
    return narrow.mapInArrow(run, T.StructType(fields))


def _patterns(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """Whole multiples of the patterns that an optimal fractional packing of the rounded sizes uses."""
    k = len(sizes)
    columns = np.diag(capacity // sizes).astype(float)
    offers = [(j, 1 << p, int(x) << p) for j, x in enumerate(sizes) for p in range(13) if int(x) << p <= capacity]
    for _ in range(40 * k):
        inverse = np.linalg.inv(columns)
        x = inverse @ demand
        price = np.ones(k) @ inverse
        # the most valuable pattern: a knapsack over 1, 2, 4, ... copies of each size
        best, taken = np.zeros(capacity + 1), []
        for j, copies, weight in offers:
            worth = best[:-weight] + copies * price[j]
            taken.append(worth > best[weight:] + 1e-12)
            best[weight:] = np.maximum(best[weight:], worth)
        if best[capacity] <= 1 + 1e-7:
            break
        pattern, c = np.zeros(k), capacity
        for (j, copies, weight), took in zip(reversed(offers), reversed(taken)):
            if c >= weight and took[c - weight]:
                pattern[j] += copies
                c -= weight
        direction = inverse @ pattern
        usable = direction > 1e-9
        ratio = np.where(usable, np.maximum(x, 0) / np.where(usable, direction, 1), np.inf)
        columns[:, int(np.argmin(ratio))] = pattern
    x = np.floor(np.maximum(np.linalg.solve(columns, demand), 0) + 1e-9).astype(int)
    return [(columns[:, j].astype(int), int(x[j])) for j in range(k) if x[j] > 0]


class _Plan:
    """Runs of equal bins. A slot is (length, copies in each bin, first rank, first bin, bins, offset)."""

    def __init__(self, counts: dict[int, int], capacity: int) -> None:
        self.capacity, self.counts = capacity, counts
        self.used = dict.fromkeys(counts, 0)
        self.slots: list[tuple[int, int, int, int, int, int]] = []
        self.gaps: list[tuple[int, int, int]] = []  # sorted (gap, first bin, bins)
        self.bins = 0

    def open(self, n: int) -> int:
        self.bins += n
        return self.bins - n

    def put(self, length: int, copies: int, first: int, n: int, offset: int) -> None:
        self.slots.append((length, copies, self.used[length], first, n, offset))
        self.used[length] += copies * n

    def gap(self, gap: int, first: int, n: int) -> None:
        if n and gap:
            bisect.insort(self.gaps, (gap, first, n))

    def best_fit(self, length: int, count: int) -> None:
        while count:
            i = bisect.bisect_left(self.gaps, (length, -1, -1))
            if i < len(self.gaps):
                gap, first, n = self.gaps.pop(i)
            else:
                q = self.capacity // length
                n = -(-count // q)
                gap, first = self.capacity, self.open(n)
            q = min(gap // length, count)
            full = min(n, count // q)
            self.put(length, q, first, full, self.capacity - gap)
            self.gap(gap - q * length, first, full)
            count -= q * full
            self.gap(gap, first + full, n - full)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> _Plan:
    """The whole packing, from the number of pieces of each length."""
    out = _Plan(counts, capacity)
    large = sorted((x for x in counts if x * SMALL_PART > capacity), reverse=True)
    total = sum(counts[x] for x in large)
    left = {x: counts[x] for x in large}
    if total:
        each = -(-total // GROUPS)
        groups: list[list[list[int]]] = [[]]  # of [length, count], descending
        room = each
        for x in large:
            n = counts[x]
            while n:
                take = min(n, room)
                groups[-1].append([x, take])
                n, room = n - take, room - take
                if not room:
                    groups.append([])
                    room = each
        groups = [g for g in groups if g]
        merged: dict[int, list[list[int]]] = {}
        for g in groups:  # groups of one rounded size are one item type
            merged.setdefault(g[0][0], []).extend(g)
        sizes = np.array(list(merged))
        demand = np.array([sum(n for _, n in g) for g in merged.values()], float)
        queues = list(merged.values())
        for pattern, times in _patterns(sizes, demand, capacity):
            uses = [(g, int(c)) for g, c in enumerate(pattern) if c]
            while times:
                # bins alike as long as each slot's queue keeps the same length
                times_left = min([times, *(sum(n for _, n in queues[g]) // c for g, c in uses)])
                if not times_left:
                    break
                run, takes = times_left, []
                for g, c in uses:
                    queue = queues[g]
                    if queue[0][1] >= c:
                        run = min(run, queue[0][1] // c)
                        takes.append((g, None))
                    else:
                        run = 1
                        takes.append((g, c))
                first, offset = out.open(run), 0
                for (g, mixed), (_, c) in zip(takes, uses):
                    need = c
                    while need:
                        x, n = queues[g][0]
                        copies = c if mixed is None else min(need, n)
                        out.put(x, copies, first, run, offset)
                        offset += copies * x
                        left[x] -= copies * run
                        queues[g][0][1] -= copies * run
                        if not queues[g][0][1]:
                            queues[g].pop(0)
                        need -= copies
                out.gap(capacity - offset, first, run)
                times -= run
    for x in large:
        if left[x]:
            out.best_fit(x, left[x])
    for x in sorted((x for x in counts if x * SMALL_PART <= capacity), reverse=True):
        out.best_fit(x, counts[x])
    return out


def pack(df: DataFrame, order: Sequence[str], capacity: int = CAPACITY, seed: int = 6, label: str = "pieces") -> DataFrame:
    """Adds sequence_id and offset (both long) to rows with a ``length`` of 1 to ``capacity``.

    ``order`` names the columns that tell pieces apart; they and the seed fix the result.
    """
    tune(df.sparkSession)
    kept = df.drop("sequence_id", "offset")
    stored = materialize(kept, label)
    counts = {r["length"]: r["n"] for r in stored.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most capacity rows
    made = plan(counts, capacity)
    ranked = ordinals(stored, ["length"], list(order), "__rank", seed)
    slots = sorted((x, rank, copies, bin_, offset) for x, copies, rank, bin_, n, offset in made.slots if n and copies)
    table = np.array(slots, np.int64).reshape(-1, 5)
    shared = df.sparkSession.sparkContext.broadcast((table, (table[:, 0] << 48) | table[:, 1]))

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, keys = shared.value
        for batch in batches:
            names = batch.schema.names
            length, rank = (batch.column(names.index(c)).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("length", "__rank"))
            at = np.searchsorted(keys, (length << 48) | rank, "right") - 1
            _, first, copies, bin_, offset = table[at].T
            nth = rank - first
            i = names.index("__rank")
            yield pa.RecordBatch.from_arrays([*batch.columns[:i], pa.array(bin_ + nth // copies), pa.array(offset + length * (nth % copies))], names=[*names[:i], "sequence_id", "offset"])

    fields = [*stored.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
    return ranked.mapInArrow(place, T.StructType(fields))


def pack_documents(df: DataFrame, tokenizer_path: str, text: str = "text", key: Sequence[str] = ("doc_id",), capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = True) -> DataFrame:
    """``key``, piece, start, length, ids_crc32, [ids,] sequence_id, offset: every piece and its place."""
    cut = pieces(df, tokenizer_path, text, key, capacity, end_id).withColumn("ids_crc32", F.crc32("ids"))
    return pack(cut if with_ids else cut.drop("ids"), [*key, "piece", "ids_crc32"], capacity)
