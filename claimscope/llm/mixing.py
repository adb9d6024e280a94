"""Mixing sources to target weights by subset-sum budget fitting.

A source's target is its share of all words by weight, capped at ``MAX_REPEATS`` times what it
has; what a cap cuts off goes to the others by weight. A source is taken whole as often as fits,
and the rest of its target is a subset-sum over its documents. The subset is chosen over counts
of documents by exact length: each length first gives its proportional part, then a bounded-knapsack
recurrence, which takes more of some lengths and gives others back, meets the budget exactly, or
comes as near below it as any choice of documents can. Which documents of a length are taken is
decided by their rank in a seeded hash order, so reruns agree.

Only the counts by (source, length) meet in one task, never documents; ranks within one hot
(source, length) are given by many tasks.

Defined results: a null text has no words; a null source is a source of its own, last in order;
documents without words take 0 words; repeated rows count as often as they occur; an empty table
gives an empty result. Input columns that clash with the result's are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimscope.llm.common import attach, materialize, ordinals

WEIGHTS, MAX_REPEATS, SEED = (1, 2, 3), 3, 7
#: The first window of the recurrence, in words around the proportional start.
WINDOW = 1 << 12


def word_count(text: str) -> Column:
    trimmed = F.btrim(F.coalesce(F.col(text), F.lit("")), F.lit(" \t\n\x0b\x0c\r"))
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, r"[\x20\x09-\x0D]+"))).cast("long")


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = 1.0) -> DataFrame:
    """For each source of ``sizes`` (source, size, n): source_size and target.

    The capped targets are min(cap, level * weight) for the one level at which they sum to the
    budget; it is found over the sources in the order in which they reach their caps.
    """
    total = sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weighted = total.withColumn("w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int"))).withColumn("cap", (F.col("source_size") * MAX_REPEATS).cast("double"))
    everything, up_to = Window.partitionBy(), Window.orderBy(F.expr("cap / w"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    stepped = weighted.withColumns({
        "budget": F.sum("source_size").over(everything) * F.lit(share),
        "capped": F.coalesce(F.sum("cap").over(up_to), F.lit(0.0)),
        "open_w": F.sum("w").over(everything) - F.coalesce(F.sum("w").over(up_to), F.lit(0.0)),
    }).withColumn("level", F.expr("(budget - capped) / open_w"))
    # the first source, in that order, whose cap isn't reached at its level fixes the level
    levelled = stepped.withColumn("level", F.min(F.when(F.expr("level * w <= cap"), F.struct(F.expr("cap / w").alias("at"), F.col("level")))).over(everything)["level"])
    return levelled.select("source", "source_size", F.expr("coalesce(least(cap, level * w), cap)").alias("target"))


def fit(lengths: list[int], counts: list[int], budget: int) -> list[int]:
    """How many of each length to take: at most ``counts``, with the greatest sum that isn't over ``budget``.

    A proportional start is corrected by the bounded-knapsack recurrence, which may take more of a
    length or give some back, over the sums within a window of the start. The window grows until
    the budget is met, or is so wide that no wider one can do better: all there is, or twice the
    square of the longest length (moves of a best correction can be ordered so that no partial sum
    repeats, and none is farther from the start than the longest length).
    """
    some = [i for i, (x, n) in enumerate(zip(lengths, counts)) if x > 0 and n > 0]
    taken = list(counts)
    unit = math.gcd(*(lengths[i] for i in some)) if some else 1
    sizes, goal = {i: lengths[i] // unit for i in some}, max(0, budget) // unit
    whole = sum(sizes[i] * counts[i] for i in some)
    if goal >= whole:
        return taken
    for i in some:
        taken[i] = counts[i] * goal // whole
    longest = max(sizes.values())
    limit, window = min(whole, (2 * longest + 1) * longest), max(WINDOW, longest)
    order = sorted(some, key=lambda i: (-sizes[i], i))
    miss = goal - sum(sizes[i] * taken[i] for i in some)  # at most one of each length
    for i in order:
        more = min(counts[i] - taken[i], miss // sizes[i])
        taken[i] += more
        miss -= more * sizes[i]
    while miss:
        steps, first, best = _corrections(order, sizes, counts, taken, min(window, limit), miss)
        if best == miss or window >= limit:
            at = best
            while at:
                i, part = steps[first[at + min(window, limit)]]
                taken[i] += part
                at -= part * sizes[i]
            break
        window *= 8
    return taken


def _corrections(order: list[int], sizes: dict[int, int], counts: list[int], taken: list[int], window: int, miss: int) -> tuple[list[tuple[int, int]], np.ndarray, int]:
    """The steps (length, how many; negative: given back), for each sum from -window to window the step
    that first reached it, and the greatest sum up to ``miss`` that was reached."""
    first = np.full(2 * window + 1, -1, np.int32)
    reach = np.zeros(2 * window + 1, bool)
    reach[window] = True
    steps: list[tuple[int, int]] = []
    for i in order:
        size = sizes[i]
        for sign, left in ((1, counts[i] - taken[i]), (-1, taken[i])):
            left, part = min(left, 2 * window // size), 1
            while left:
                part = min(part, left)
                by = part * size
                moved = np.zeros_like(reach)
                if sign > 0:
                    moved[by:] = reach[:-by]
                else:
                    moved[:-by] = reach[by:]
                moved &= ~reach
                first[moved] = len(steps)
                reach |= moved
                steps.append((i, sign * part))
                if reach[window + miss]:
                    return steps, first, miss
                left, part = left - part, part * 2
    return steps, first, int(np.flatnonzero(reach[window : window + miss + 1])[-1])


def _choose(group: pd.DataFrame) -> pd.DataFrame:
    """Whole repeats of a source, and the documents of each length that are taken once more."""
    source_size, target = int(group["source_size"].iloc[0]), float(group["target"].iloc[0])
    repeats = min(MAX_REPEATS, int(target // source_size)) if source_size else 0
    budget = round(target - repeats * source_size) if repeats < MAX_REPEATS else 0
    out = group.assign(repeats=repeats).sort_values("size")
    out["once_more"] = fit(out["size"].tolist(), out["n"].tolist(), max(0, budget)) if source_size else 0
    return out[["source", "size", "source_size", "target", "repeats", "once_more"]]


def assign(sized: DataFrame, order: Sequence[str] = ("doc_id",), weights: Sequence[int] = WEIGHTS, share: float = 1.0, seed: int = SEED) -> DataFrame:
    """Adds source_size, target and copies (how often the mix takes the document) to rows with source and size."""
    hist = materialize(sized.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "lengths")
    goals = targets(hist, weights, share)
    joined = attach(hist, goals, ["source"])
    kind = sized.schema["source"].dataType.simpleString()
    chosen = joined.groupBy("source").applyInPandas(_choose, f"source {kind}, size long, source_size long, target double, repeats int, once_more long")
    ranked = ordinals(sized, ["source", "size"], list(order), "__rank", seed, extra=materialize(chosen, "budgets"))
    return ranked.select(*sized.columns, "source_size", "target", F.expr("repeats + if(__rank < once_more, 1, 0)").alias("copies"))


def mix_sizes(df: DataFrame, text: str = "text", key: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``key``, source, size, source_size, target, copies, taken (size times copies) of each document."""
    sized = materialize(df.select(*key, "source", word_count(text).alias("size")), "sizes")
    return assign(sized, key).withColumn("taken", F.col("size") * F.col("copies"))


def mix_rows(df: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The mixed documents themselves: each row as often as the mix takes it, columns unchanged."""
    same = [key, "source", "__size"]
    full = df.withColumn("__size", word_count(text)).withColumn("__nth", F.row_number().over(Window.partitionBy(*same).orderBy(text)))
    sized = materialize(df.select(key, "source", word_count(text).alias("size")), "sizes")
    nth = Window.partitionBy(key, "source", "size").orderBy("copies")
    picked = assign(sized, [key]).where("copies > 0").select(key, "source", F.col("size").alias("__size"), F.row_number().over(nth).alias("__nth"), "copies")
    met = attach(full, picked, [*same, "__nth"], "inner")
    return met.withColumn("__copy", F.explode(F.sequence(F.lit(1), "copies"))).select(*df.columns)
