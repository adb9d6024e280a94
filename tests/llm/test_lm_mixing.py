import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from claimscope.llm import lm_mixing
from claimscope.llm.common import CLEANUP

DOCS = "doc_id long, text string"
HELD = "doc_id % 7 = 2"


def words(rng, n):
    return " ".join("".join(rng.choices("abcdefgh", k=rng.choice((1, 1, 2, 3)))) for _ in range(n))


def corpus():
    rng = random.Random(2)
    texts = [words(rng, rng.randrange(1, 80)) for _ in range(60)] + [None, "", "The the THE", "z" * 9000, " \x0b a\tb "]
    texts[9] = texts[10]  # 9 is held out, its copy is not
    return [*enumerate(texts), (3, texts[3]), (None, "a b a"), (None, "other")]


def tokens_of(text):
    return [*(text or "").lower().encode().split(), b""]


def brute_force(rows, found):
    """Each row's base and model score from plain dictionaries of counts and the learned probabilities."""
    c0, c1, c2, texts = Counter(), Counter(), Counter(), 0
    for i, t in rows:
        if i is None or i % 7 != 2:
            x = [1, 0, *tokens_of(t)]
            texts += 1
            c0.update(x[2:])
            c1.update(zip(x[1:], x[2:]))
            c2.update(zip(x, x[1:], x[2:]))
    n, v, model = sum(c0.values()), len(c0), found["model"]
    out = []
    for i, t in rows:
        x, last, earlier, base, score = [1, 0, *tokens_of(t)], 4, 4, 0.0, 0.0
        for u, w, z in zip(x, x[1:], x[2:]):
            before1 = texts if w == 0 else c0[w]
            before2 = texts if w == 0 else c1[u, w]
            base += math.log10((c0[z] + 1) / (n + v + 1))
            level = (c0[z] > 0) + (c1[w, z] > 0) + (c2[u, w, z] > 0)
            cell = (min(int(math.log2(before2 + 1)), 11) * 16 + min(int(math.log2(before1 + 1)), 15)) * 25 + last * 5 + earlier
            for order, count, total in ((2, c2[u, w, z], before2), (1, c1[w, z], before1), (0, c0[z], n)):
                if total and (order == 0 or model["ask"][order - 1][cell]):
                    p = model["yes"][order][cell]
                    if level > order:
                        score += math.log10(p * count / total)
                        break
                    score += math.log10(1 - p)
            if level == 0:
                score += lm_mixing.spelled([z], model["speller"])[0] / math.log(10)
            last, earlier = level, last
        out.append((i, len(x) - 2, base, score))
    return n, v, out


def test_scores_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(lm_mixing, "BATCH_TEXT", 600)  # many batches
    monkeypatch.setattr(lm_mixing, "RANGE", 500)  # many ranges of keys
    rows = corpus()
    df = spark.createDataFrame(rows, DOCS).withColumn("n_tokens", F.lit("clash"))
    found = lm_mixing.learned(lm_mixing._docs(df, "doc_id", "text", ~F.coalesce(F.expr(HELD), F.lit(False)), True))
    n, v, want = brute_force(rows, found)
    assert (found["tokens"], found["distinct"]) == (n, v)
    got = lm_mixing._result(found, "doc_id").collect()
    order = lambda r: (r[0] is None, r[0] or 0, r[1], r[2])
    got = sorted(((r["doc_id"], r["n_tokens"], r["base_score"], r["score"]) for r in got), key=order)
    for a, b in zip(got, sorted(want, key=order), strict=True):
        assert a[:2] == b[:2] and a[2] == pytest.approx(b[2]) and a[3] == pytest.approx(b[3])


def test_same_scores_for_any_partitioning_and_copies_stand_out(spark):
    rows = [r for r in corpus() if r[0] is not None]
    df = spark.createDataFrame(rows, DOCS)
    one, many = (sorted((r["doc_id"], r["score"], r["bits_per_byte"]) for r in lm_mixing.score_held_out(df.repartition(k), F.expr(HELD)).collect()) for k in (1, 7))
    assert one == many
    held = {i: b for i, _, b in one if i % 7 == 2 and len((dict(rows)[i] or "").split()) > 10}
    assert held[9] < min(b for i, b in held.items() if i != 9) / 2


def test_order_of_words_matters(spark):
    text = " ".join(f"w{i}" for i in range(60))
    mixed = text.split()
    random.Random(1).shuffle(mixed)
    train = spark.createDataFrame([(i, text) for i in range(8)] + [(9, words(random.Random(3), 300))], DOCS)
    got = {r["doc_id"]: r["score"] for r in lm_mixing.score(spark.createDataFrame([(1, text), (2, " ".join(mixed))], DOCS), train).collect()}
    assert got[1] > got[2] + 10


def test_bits_make_a_distribution_and_the_mixture_follows_rates():
    speller = lm_mixing.empty_speller()
    assert sum(np.prod(lm_mixing.bit_probabilities([bytes([b])], speller)[0]) for b in range(256)) == pytest.approx(1)
    rng = np.random.default_rng(1)
    rate = np.where(np.arange(lm_mixing.CELLS) % 5 < 2, 0.9, 0.2)
    n = rng.integers(0, 50, (lm_mixing.SLICES, lm_mixing.CELLS))
    ones = rng.binomial(n, rate)
    p = lm_mixing.mixed_decision(ones, n - ones, lm_mixing._parts_of_cells())
    assert np.abs(p - rate).mean() < 0.05


def test_probabilities_sum_to_at_most_one(spark):
    rows = [(1, "a b a b c"), (3, "a c a b"), (4, "b a b a")]
    train = spark.createDataFrame(rows, DOCS)
    texts = [" ".join(x) for x in [[], *[[a] for a in "abc"], *[[a, b] for a in "abc" for b in "abc"]]]
    got = lm_mixing.score(spark.createDataFrame([*enumerate(texts)], DOCS), train).collect()
    assert 0 < sum(10 ** r["score"] for r in got) < 1


def test_empty_and_unseen(spark):
    df = spark.createDataFrame([(1, "a a a b c"), (2, "b q"), (2, "b q")], DOCS)
    got = {r["doc_id"]: r for r in lm_mixing.score(df, df.where("doc_id = 1")).collect()}
    assert got[2]["n_known"] == 2 and got[2]["base_score"] == pytest.approx(math.log10(2 / 11) * 2 + math.log10(1 / 11))
    bare = lm_mixing.score(df, df.limit(0)).collect()
    assert len(bare) == 3 and all(r["score"] == pytest.approx(-8 * math.log10(2) * {1: 11, 2: 5}[r["doc_id"]]) for r in bare)
    assert lm_mixing.score(df.limit(0), df.limit(0)).count() == 0


def test_batches_of_numbers_round_trip():
    arrays = [np.arange(0), np.array([0]), np.array([3, 70000, 1 << 40]), np.frombuffer(b"a\nb", np.uint8)]
    assert all(a.tolist() == b.tolist() for a, b in zip(arrays, lm_mixing.opened(lm_mixing.shut(*arrays)), strict=True))


def test_shuffles_of_stored_tables_are_deleted_at_once(spark, monkeypatch):
    def files():
        found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {name for i in range(found.size()) if (name := found.apply(i).getName()).startswith("shuffle_")}

    seen, counted, statistics = [], lm_mixing.counted, lm_mixing.statistics
    monkeypatch.setattr(lm_mixing, "counted", lambda *a: seen.append(files()) or counted(*a))
    monkeypatch.setattr(lm_mixing, "statistics", lambda *a: seen.append(files()) or statistics(*a))
    monkeypatch.setattr(lm_mixing, "packed", lambda docs, run=lm_mixing.packed: seen.append(files()) or run(docs))
    df = spark.createDataFrame([(i, f"some words and {i}") for i in range(200)], DOCS).repartition(4)
    lm_mixing.learned(lm_mixing._docs(df, "doc_id", "text", F.lit(True), True))
    before, questions, all_ = seen
    new = {name.split("_")[1] for name in (questions | all_) - before}
    assert len(new) <= 3, new  # the input's and the small sums' shuffles, not the questions' nor the counts'
    assert spark.conf.get(CLEANUP) == "false"
