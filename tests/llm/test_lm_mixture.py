import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from claimscope.llm import lm_mixing

DOCS = "doc_id long, text string"


def topics(n=60, repeat=4):
    """Texts that repeat words of their own among words that all share."""
    rng = random.Random(5)
    common = [f"c{i}" for i in range(12)]
    out = []
    for i in range(n):
        own = ["".join(rng.choices("klmnopqr", k=5)) for _ in range(4)]
        out.append((i, " ".join(rng.choice(common if rng.random() < 0.5 else own) for _ in range(rng.randrange(8, 15 * repeat)))))
    return out


def tokens_of(text):
    return [*(text or "").lower().encode().split(), b""]


def brute_force(rows, trains, found):
    """Each text's score, token by token, from plain dictionaries and the learned weights."""
    c0, c1, c2, texts, model = Counter(), Counter(), Counter(), 0, found["model"]
    for i, t in rows:
        if trains(i):
            x = [1, 0, *tokens_of(t)]
            texts += 1
            c0.update(x[2:])
            c1.update(zip(x[1:], x[2:]))
            c2.update(zip(x, x[1:], x[2:]))
    n = sum(c0.values())
    out = []
    for i, t in rows:
        x, last, earlier, score = [1, 0, *tokens_of(t)], 4, 4, 0.0
        due, used, seen, pairs, followed = [0.0] * 5, [0.0] * 5, Counter(), Counter(), Counter()
        for at, (u, w, z) in enumerate(zip(x, x[1:], x[2:])):
            before1 = texts if w == 0 else c0[w]
            before2 = texts if w == 0 else c1[u, w]
            level = (c0[z] > 0) + (c1[w, z] > 0) + (c2[u, w, z] > 0)
            a, b = min(int(math.log2(before2 + 1)), 11), min(int(math.log2(before1 + 1)), 15)
            cell, lp = (a * 16 + b) * 25 + last * 5 + earlier, 0.0
            for order, count, total in ((2, c2[u, w, z], before2), (1, c1[w, z], before1), (0, c0[z], n)):
                if total and (order == 0 or model["ask"][order - 1][cell]):
                    p = model["yes"][order][cell]
                    lp += math.log(p * count / total) if level > order else math.log(1 - p)
                    if level > order:
                        break
            if level == 0:
                lp += lm_mixing.spelled([z], model["speller"])[0]
            shares = [(c1[w, z], before1), (c0[z], n), (pairs[w, z], followed[w]), (seen[z], at)]
            weights = model["mixture"][(min(a, 4) * 4 + b // 4) * 2 + (last == 3)] * [1, *(total > 0 for _, total in shares)]
            weights = weights / weights.sum()
            p = np.array([math.exp(lp), *(count / max(total, 1) for count, total in shares)])
            moved = weights * (np.array(due) + lm_mixing.FIRM) / (np.array(used) + lm_mixing.FIRM)
            score += math.log10((moved * p).sum() / moved.sum())
            due, used = due + weights * p / (weights * p).sum(), used + weights
            seen[z] += 1
            pairs[w, z] += w != 0
            followed[w] += w != 0
            last, earlier = level, last
        out.append((i, score))
    return out


def test_every_token_is_mixed_and_weights_move_within_a_text(spark):
    rows = [*topics(), (60, None), (61, ""), (62, "c1 c2 c1 c2 c1 c2 new new new new"), (63, "z" * 300)]
    df = spark.createDataFrame(rows, DOCS)
    found = lm_mixing.mixed(lm_mixing.learned(lm_mixing._docs(df, "doc_id", "text", F.expr("doc_id % 7 != 2"), True)))
    weights = found["model"]["mixture"]
    assert weights.sum(1) == pytest.approx(1) and (weights[:, 0] > 0).all() and (weights[:, 1:].sum(1) > 0.1).any()
    got = {r["doc_id"]: r["score"] for r in lm_mixing._result(found, "doc_id").collect()}
    for i, want in brute_force(rows, lambda i: i % 7 != 2, found):
        assert got[i] == pytest.approx(want, rel=1e-4), i


def test_a_new_word_gets_cheaper_as_its_text_repeats_it(spark):
    train = spark.createDataFrame(topics(), DOCS)
    texts = [(k, " ".join(["wxyz"] * k)) for k in (0, 1, 19, 20)]
    got = {r["doc_id"]: r["score"] for r in lm_mixing.score(spark.createDataFrame(texts, DOCS), train).collect()}
    assert got[0] - got[1] > 4 * (got[19] - got[20])


def test_mixture_weights_against_known_rates():
    """Tokens drawn from a mixture of two predictions give back its weights; where nothing was seen, the decisions have all."""
    seen = np.zeros((lm_mixing.DOORS, lm_mixing.KINDS ** (lm_mixing.MIXED - 1)))
    # only the share among all words is awake: it gives all to tokens of kind 6, 16 times what the decisions give them, and none to kind 1
    for kind, own, share in ((6, 1 / 16, 1), (1, 15 / 16, 0)):
        seen[3, kind * lm_mixing.KINDS**2] = 1e6 * (0.75 * own + 0.25 * share)
    weights = lm_mixing.learn_mixture(seen)
    assert weights[3, 0] / weights[3, 2] == pytest.approx(3, rel=0.01)
    assert weights[0].tolist() == [1, 0, 0, 0, 0]


def test_places_and_runs_of_texts():
    rng = np.random.default_rng(3)
    group = rng.integers(0, 9, 200)
    for most in (9, 1 << 61):
        rank, size, number = lm_mixing.places(group, most)
        for i, g in enumerate(group):
            assert rank[i] == (group[:i] == g).sum() and size[i] == (group == g).sum()
        assert len(set(zip(group.tolist(), number.tolist()))) == len(set(group.tolist()))
    size = np.array([3, lm_mixing.CHUNK + 5, 1, lm_mixing.CHUNK - 1, 2])
    runs = list(lm_mixing.text_runs(size))
    assert [x for ts, _ in runs for x in range(ts.start, ts.stop)] == list(range(5))
    assert all(at.stop - at.start == size[ts].sum() for ts, at in runs) and len(runs) == 4
