import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from claimscope.llm import cws, lang_id, lm_mixing, mixing, near_dup, packing
from claimscope.llm.components import components
from claimscope.llm.queries import tokenizer_path

DOCS = "doc_id long, text string"


def words(rng, n, letters="abcdefgh"):
    return " ".join("".join(rng.choices(letters, k=rng.randrange(2, 6))) for _ in range(n))


def groups(texts, width, percent=80):
    sets = {}
    for i, t in texts.items():
        w = (t or "").lower().split()
        k = min(width, len(w))
        sets[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if w else set()
    root = {i: i for i in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(texts)
    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                p, q = sorted((find(a), find(b)))
                root[q] = p
    return {i: find(i) for i in texts}, {i: len(s) for i, s in sets.items()}


def variants(rng, base, n):
    for _ in range(n):
        w = base.split()
        for _ in range(rng.randrange(0, 5)):
            w[rng.randrange(len(w))] = "changed"
        yield " ".join(w)


def near_texts():
    rng = random.Random(5)
    texts = [None, "", " \n", "one two", "ONE two", "one two three four", "w " * 4000]
    for n in (30, 60, 200):
        base = words(rng, n)
        texts += [base, *variants(rng, base, 12)]
    texts += [words(rng, 40) for _ in range(10)]
    return dict(enumerate(texts))


@pytest.mark.parametrize("blocks", [(256, 200_000), (3, 200_000)])
def test_near_dup_against_brute_force(spark, monkeypatch, blocks):
    monkeypatch.setattr(near_dup, "BLOCK_NODES", blocks[0])
    texts = near_texts()
    want, sizes = groups(texts, 4)
    df = spark.createDataFrame([*texts.items(), (7, texts[7])], DOCS).withColumn("component_id", F.lit("clash"))
    got = near_dup.near_duplicates(df, width=4).collect()
    assert len(got) == len(texts) + 1
    assert {r["doc_id"]: r["component_id"] for r in got} == want
    assert {r["doc_id"]: r["n_shingles"] for r in got} == sizes
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_keep_one_leaves_one_of_each(spark):
    texts = near_texts()
    want, _ = groups(texts, 5)
    df = spark.createDataFrame([*texts.items(), (7, texts[7]), (7, "another text of the same id")], DOCS)
    kept = [r["doc_id"] for r in near_dup.keep_one(df).collect()]
    # the other text of id 7 is a component of its own
    assert sorted(kept) == sorted([*{i for i, c in want.items() if i == c}, 7])
    assert near_dup.near_duplicates(df.limit(0)).count() == 0


def test_sketches_fill_and_concentrate():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 1 << 63, 1200, dtype=np.uint64)
    a, b = np.unique(x[:1000]), np.unique(x[200:])  # similarity 800 / 1200
    s = near_dup.sketches([a, b, a[:1], a])
    assert (s != near_dup._FULL).all() and (s[0] == s[3]).all()
    assert abs((s[0] == s[1]).mean() - 2 / 3) < 0.12


def test_components(spark):
    edges = [(i, i + 1) for i in range(60) if i % 7] + [(100, 200), (200, 300), (5, 5)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got[300] == 100 and got[200] == 100 and 5 not in {k for k, v in got.items() if k == v}
    for i in range(1, 60):
        if (i - 1) % 7:
            assert got[i] == 1 + (i - 1) // 7 * 7
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_language_id(spark):
    rng = random.Random(3)
    rows = [(i, words(rng, 40, letters), lang) for i, (letters, lang) in enumerate([("abcdefg", "x"), ("mnopqrs", "y")] * 60)]
    df = spark.createDataFrame([*rows, (900, None, "x"), (901, "12 34 !", "y"), (902, "", None), (903, "абв где жзи", None), (904, "ab " * 4000, None), (904, "ab " * 4000, None)], "doc_id long, text string, lang string").withColumn("score", F.lit("clash"))
    model = lang_id.learn(df, F.col("doc_id") % 5 != 0)
    got = {r["doc_id"]: r for r in lang_id.predict(df, model).collect()}
    assert all(got[i]["lang_pred"] == lang for i, _, lang in rows)
    assert all(got[i]["lang_pred"] == "und" and got[i]["score"] == 0 and got[i]["rejected"] for i in (900, 901, 902))
    assert got[903]["rejected"] and not got[0]["rejected"] and all(0 <= r["score"] <= 1 for r in got.values())
    assert lang_id.predict(df.limit(0), model).count() == 0
    empty = lang_id.learn(df, F.lit(False))
    assert {r["lang_pred"] for r in lang_id.predict(df, empty).collect()} == {"und"}


def test_language_id_against_brute_force(spark):
    """Document frequencies, TF-IDF, cosines and bounds again, from dictionaries."""
    rng = random.Random(4)
    rows = [(i, words(rng, rng.randrange(1, 60), ("abcdefg", "mnopqrs", "éüabxyz")[i % 3]), "xyz"[i % 3]) for i in range(150)]
    rows += [(500, "ab " * 400, None), (501, "!!", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = lang_id.learn(df, F.col("doc_id") % 5 != 0)

    def grams(text):
        out = Counter()
        b = lang_id.clean(text.encode()) or b""
        for j in range(len(b) - 2):
            out[((b[j] << 16 | b[j + 1] << 8 | b[j + 2]) * 0x9E3779B1 & 0xFFFFFFFF) >> 20] += 1
        return out

    training = [grams(t) for i, t, lang in rows if i % 5 and lang]
    seen = Counter(k for g in training for k in g)
    idf = {k: math.log((len(training) + 1) / (n + 1)) + 1 for k, n in seen.items()}
    other = math.log(len(training) + 1) + 1
    assert all(model["idf"][k] == pytest.approx(v, rel=1e-5) for k, v in idf.items())
    sizes = {lang: sum(x == lang for x in model["langs"]) for lang in "xyz"}
    assert all(2 <= n <= lang_id.CENTROIDS for n in sizes.values())
    for r in lang_id.predict(df, model).collect():
        g = {k: math.log1p(n) * idf.get(k, other) for k, n in grams(r["text"]).items()}
        if not g:
            assert (r["lang_pred"], r["score"], r["rejected"]) == ("und", 0.0, True)
            continue
        norm = math.sqrt(sum(v * v for v in g.values()))
        cosines = [sum(v * float(c[k]) for k, v in g.items()) / norm for c in model["centroids"]]
        best = max(range(len(cosines)), key=cosines.__getitem__)
        assert r["score"] == pytest.approx(cosines[best], abs=1e-4) and r["lang_pred"] == model["langs"][best]
        size = int(lang_id.size_class(np.array([len(lang_id.clean(r["text"].encode()))]))[0])
        assert r["rejected"] == (r["score"] < model["bounds"][best, size])
        assert r["doc_id"] >= 500 or not r["rejected"]


def test_centroids_are_groups_not_outliers():
    rng = np.random.default_rng(2)
    x = np.abs(np.concatenate([np.eye(6)[i] + rng.normal(0, 0.05, (60, 6)) for i in range(3)] + [np.eye(6)[3:]]))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    c = lang_id.cluster(x, 3)
    assert np.bincount((x @ c.T).argmax(1)).min() >= 50
    assert len(lang_id.cluster(x[:2], 3)) == 2


def check_packed(rows, capacity):
    bins = {}
    for r in rows:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for found in bins.values():
        at = 0
        for o, n in sorted(found):
            assert o == at
            at += n
        assert at <= capacity
    return len(bins)


def test_packing(spark):
    from tokenizers import Tokenizer

    rng = random.Random(4)
    texts = [None, "", "Hello, <|endoftext|> World.", "a " * 9000] + [words(rng, rng.randrange(1, 900)) for _ in range(60)]
    df = spark.createDataFrame([*enumerate(texts), (2, texts[2]), (2, texts[2])], DOCS).withColumn("offset", F.lit("clash"))
    got = packing.pack_documents(df, tokenizer_path()).collect()
    encode = Tokenizer.from_file(tokenizer_path()).encode
    want = Counter()
    for i, t in [*enumerate(texts), (2, texts[2]), (2, texts[2])]:
        ids = [*encode(t or "", add_special_tokens=False).ids, 1]
        want.update([(i, k, 4096 * k, tuple(ids[4096 * k : 4096 * (k + 1)])) for k in range(-(-len(ids) // 4096))])
    assert Counter((r["doc_id"], r["piece"], r["start"], tuple(np.frombuffer(r["ids"], "<u4").tolist())) for r in got) == want
    assert check_packed(got, 4096) <= math.ceil(sum(r["length"] for r in got) / 4096) + 1
    assert packing.pack_documents(df.limit(0), tokenizer_path()).count() == 0


def test_plans_are_near_the_bound():
    rng = np.random.default_rng(0)
    for sizes in (rng.integers(1, 4097, 3000), np.full(1000, 1366), np.full(5, 4096), np.exp(rng.normal(6, 1, 20_000)).astype(int).clip(1, 4096)):
        counts = {int(k): int(v) for k, v in Counter(sizes.tolist()).items()}
        made = packing.plan(counts)
        assert made.used == counts
        best = max(-(-int(sizes.sum()) // 4096), int((sizes > 2048).sum()), -(-int(((sizes > 1365) & (sizes <= 2048)).sum()) // 2) if (sizes > 1365).all() else 0)
        assert made.bins <= 1.05 * best + 3
    assert packing.plan({}).bins == 0


def test_subset_sums_against_brute_force():
    rng = random.Random(6)
    assert sum(k * x for k, x in zip(mixing.fit([3, 39], [4, 4], 160), (3, 39))) == 159
    for _ in range(1500):
        lengths = sorted(rng.sample(range(0, 60), rng.randrange(1, 6)))
        counts = [rng.randrange(0, 6) for _ in lengths]
        whole = sum(x * n for x, n in zip(lengths, counts))
        budget = rng.randrange(0, whole + 5)
        taken = mixing.fit(lengths, counts, budget)
        assert all(0 <= k <= n for k, n in zip(taken, counts))
        sums = {0}
        for x, n in zip(lengths, counts):
            sums = {s + x * k for s in sums for k in range(n + 1)}
        assert sum(x * k for x, k in zip(lengths, taken)) == max(s for s in sums if s <= budget)


def test_large_budgets_are_met():
    rng = random.Random(9)
    for lengths, counts in ((list(range(1, 9001)), [rng.randrange(1, 10**6) for _ in range(9000)]), ([1000, 1001, 7777], [10**6] * 3)):
        budget = sum(x * n for x, n in zip(lengths, counts)) * 37 // 100 + 13
        assert sum(x * k for x, k in zip(lengths, mixing.fit(lengths, counts, budget))) == budget


def test_mixing(spark):
    rng = random.Random(8)
    rows = [(i, rng.choice(["b", "a", None, "tiny"]) if i else "tiny", " ".join(["w"] * rng.randrange(0, 30))) for i in range(300)]
    rows = [r if r[1] != "tiny" or r[0] < 3 else (r[0], "c", r[2]) for r in rows] + [(1000, "a", None), (5, *rows[5][1:])]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string").withColumn("target", F.lit("clash"))
    got = mixing.mix_sizes(df).collect()
    assert len(got) == len(rows)
    size, target, taken = {}, {}, Counter()
    for r in got:
        size[r["source"]], target[r["source"]] = r["source_size"], r["target"]
        taken[r["source"]] += r["taken"]
        assert r["taken"] <= 3 * r["size"] and (r["size"] == 0 or r["taken"] % r["size"] == 0)
    order = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(order)}
    fixed, total = {}, sum(size.values())
    while True:
        w = sum(weight[s] for s in order if s not in fixed)
        t = {s: fixed.get(s, (total - sum(fixed.values())) * weight[s] / w if w else 0) for s in order}
        over = [s for s in order if s not in fixed and t[s] > 3 * size[s]]
        if not over:
            break
        fixed |= {s: 3 * size[s] for s in over}
    for s in order:
        assert target[s] == pytest.approx(t[s]) and abs(taken[s] - t[s]) <= 1
    again = mixing.mix_sizes(df)
    assert Counter((r["doc_id"], r["taken"]) for r in got) == Counter((r["doc_id"], r["taken"]) for r in again.collect())
    mixed = Counter(r["doc_id"] for r in mixing.mix_rows(df.drop("target")).collect())
    assert mixed == sum((Counter({r["doc_id"]: r["copies"]}) for r in got), Counter())
    assert mixing.mix_sizes(df.limit(0)).count() == 0


def spark_hash(value, *rest):
    """xxhash64 of a string or long and integers, as Spark's function."""
    import struct

    import xxhash

    raw = value.encode() if isinstance(value, str) else struct.pack("<q", value)
    h = xxhash.xxh64_intdigest(raw, 42)
    for k in rest:
        h = xxhash.xxh64_intdigest(struct.pack("<i", k), h)
    return h


def sampled(text, n):
    """The fingerprint of a text by its definition."""
    out = []
    for k in range(n):
        least = None
        for word, w in Counter((text or "").lower().split()).items():
            h = spark_hash(word)
            h = h - (1 << 64) if h >> 63 else h
            h1, h2 = spark_hash(h, k), spark_hash(h, k + 4096)
            r = -math.log(((h1 & 0xFFFFFFFF) + 1) * ((h1 >> 32) + 1.0) / 18446744073709551616.0)
            c = -math.log((((h2 >> 16) & 0xFFFFFF) + 1) * ((h2 >> 40) + 1.0) / 281474976710657.0)
            b = (h2 & 0xFFFF) / 65536.0
            t = math.floor(math.log(w) / r + b)
            packed = (int((math.log(c) - r * (t - b + 1) + 128) * 2147483648.0) << 24) | ((h1 ^ (t * 40503)) & 0xFFFFFF)
            least = packed if least is None or packed < least else least
        out.append("" if least is None else f"{least & 0xFFFFFF:06X}")
    return "".join(out)


def test_fingerprints_against_brute_force(spark):
    rng = random.Random(12)
    texts = [words(rng, rng.randrange(1, 60)) for _ in range(12)] + [None, "", " \n", "one", "One one ONE", "w " * 3000]
    rows = list(enumerate(texts))
    got = {r["doc_id"]: r for r in cws.edited_neighbours(spark.createDataFrame(rows, DOCS)).collect()}
    for i, t in rows:
        t, after = t or "", texts[i - 1] or ""
        half = len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        prints = [sampled(x, cws.SAMPLES) for x in (t, edited, after)]
        assert (got[i]["fingerprint"], got[i]["edited_fingerprint"]) == tuple(prints[:2])
        for column, other in (("near_edited", prints[1]), ("near_next", prints[2])):
            a = prints[0]
            like = float(a == other) if "" in (a, other) else sum(a[k : k + 6] == other[k : k + 6] for k in range(0, len(a), 6)) / cws.SAMPLES
            assert got[i][column] == pytest.approx(like)


def test_neighbours_over_many_buckets(spark, monkeypatch):
    monkeypatch.setattr(cws, "PARTITION_BYTES", 200)
    rows = [(i, f"word{i} same") for i in range(200)] + [(None, "none"), (7, "again")]
    got = cws.edited_neighbours(spark.createDataFrame(rows, DOCS)).collect()
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    want = Counter()
    for (i, t), (_, after) in zip(order, order[1:] + order[:1]):
        half = len(t) // 2
        want[i, __import__("hashlib").sha256((t[: len(t) - half] + after[:half]).encode()).hexdigest()] += 1
    assert Counter((r["doc_id"], r["edited_sha256"]) for r in got) == want


def test_fingerprints(spark):
    rng = random.Random(9)
    base = words(rng, 300)
    texts = {1: base, 2: base, 3: words(rng, 300), 4: None, 5: "", 6: "é" * 7, 7: base + " " + words(rng, 100), 8: "w " * 3000}
    df = spark.createDataFrame([*texts.items(), (8, texts[8])], DOCS).withColumn("bucket", F.lit("clash"))
    got = cws.edited_neighbours(df).collect()
    assert len(got) == 9
    by = {r["doc_id"]: r for r in got}
    order = sorted([*texts, 8], reverse=True)
    import hashlib

    for i, d in enumerate(order[1:], 1):
        t, nx = texts[d] or "", texts[order[(i + 1) % len(order)]] or ""
        h = len(t) // 2
        assert by[d]["edited_sha256"] == hashlib.sha256((t[: len(t) - h] + nx[:h]).encode()).hexdigest() and by[d]["n_chars"] == len(t)
    assert by[1]["fingerprint"] == by[2]["fingerprint"] != by[3]["fingerprint"] and by[2]["near_next"] == 1
    assert by[4]["fingerprint"] == by[5]["fingerprint"] == "" and by[5]["near_next"] == 1 and by[6]["near_next"] == 0
    a, b = Counter(texts[7].split()), Counter(base.split())
    truth = sum((a & b).values()) / sum((a | b).values())
    both = {r["doc_id"]: r["fingerprint"] for r in cws.fingerprints(df.where("doc_id in (1, 7)"), n=256).collect()}
    same = np.mean([both[1][k : k + 6] == both[7][k : k + 6] for k in range(0, 256 * 6, 6)])
    assert abs(same - truth) < 0.12
    one = cws.edited_neighbours(df.where("doc_id = 3")).first()
    assert one["near_next"] == 1
    assert cws.edited_neighbours(df.limit(0)).count() == 0
