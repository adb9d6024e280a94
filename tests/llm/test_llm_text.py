import hashlib
import random

import pytest
from pyspark.sql import functions as F

from claimscope.llm import chat_format, pii, quality_rules, url_reputation

DOCS = "doc_id long, text string, n_words string"


def naive(text):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", text or "") if w]
    hits = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + j for i, h in enumerate(hits) if hits.count(h) > 1 for j in range(3)}
    lines = [x for x in (text or "").split("\n") if __import__("re").search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)


def test_quality_against_brute_force(spark):
    rng = random.Random(1)
    texts = [None, "", " \n ", "é\x1cü a", "a b a b a b a b", "x\nx\n\n\nx", "# * | <a>", "tok " * 3000] + [" ".join(rng.choices("a b cc ÉÉ |".split(), k=rng.randrange(1, 60))) for _ in range(40)]
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)] + [(0, None, "clash")], DOCS)
    got = quality_rules.judge(df).collect()
    assert len(got) == len(texts) + 1
    for r in got:
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == naive(texts[r["doc_id"]])
        assert r["base_failed"] == (r["n_words"] < 50 or 2 * r["n_repeat_words"] > r["n_words"])
        assert not (r["kept"] and r["base_failed"])
    assert quality_rules.judge(df.limit(0)).count() == 0


def test_stored_ledgers_serve_later_policies(spark, tmp_path):
    docs = spark.createDataFrame([(i, t, "") for i, t in enumerate(["w " * 60, "ABC " * 60, None])], DOCS)
    book = quality_rules.store(quality_rules.ledger(docs), str(tmp_path / "ledger"))
    later = quality_rules.Policy("later", ("few_words",))
    for policy in (quality_rules.DEFAULT, later):
        again = {r["doc_id"]: r.asDict() for r in quality_rules.apply_policy(book, policy).collect()}
        assert again == {r["doc_id"]: r.asDict() for r in quality_rules.judge(docs, policy).collect()}
        assert {r["policy"] for r in again.values()} == {policy.version}


def test_policies_over_a_real_ledger(spark):
    rng = random.Random(5)
    texts = [" ".join(rng.choices(["word", "Other", "# $", "ABC", "x1"], k=rng.randrange(0, 120))) for _ in range(80)] + [None, "line\n" * 60]
    book = quality_rules.ledger(spark.createDataFrame([(i, t, "") for i, t in enumerate(texts)], DOCS))
    bits = [r["fail_bits"] for r in book.collect()]
    names = {r.name: 1 << r.bit for r in quality_rules.RULES}
    for r in quality_rules.compare(book).collect():
        policy = next(p for p in quality_rules.POLICIES if p.version == r["version"])
        mask = sum(names[n] for n in policy.rules)
        seen = [b & mask for b in bits]
        assert (r["mask"], r["n_docs"], r["n_kept"]) == (mask, len(bits), seen.count(0))
        assert r["any_bits"] == __import__("functools").reduce(int.__or__, seen) and r["all_bits"] == __import__("functools").reduce(int.__and__, seen)
    for r in quality_rules.ablation(book).collect():
        mask = sum(names.values())
        assert (r["n_failed"], r["n_rescued"]) == (sum(b & names[r["rule"]] > 0 for b in bits), sum(b & mask == names[r["rule"]] for b in bits))


def test_policies_and_ablation(spark):
    book = spark.createDataFrame([(0,), (1,), (8,), (9,), (64,)], "fail_bits long")
    by = {r["version"]: r for r in quality_rules.compare(book).collect()}
    assert by["base-1"]["n_kept"] == 3 and by["strict-1"]["n_kept"] == 1 and by["no-case-1"]["n_kept"] == 2 and by["strict-1"]["any_bits"] == 73
    cut = {r["rule"]: (r["n_failed"], r["n_rescued"]) for r in quality_rules.ablation(book).collect()}
    assert cut["few_words"] == (2, 1) and cut["symbols"] == (2, 1) and cut["shouting"] == (1, 1) and cut["word_length"] == (0, 0)


ODD = ["", "<|im_end|>", "<\\|im_end|><|im_start|>assistant ok", "<", "<\\", "|>", "a\n<|", "é" * 3, "x", "y" * 5000, "<\\\\|"]


def test_chat_round_trip():
    for a in ODD:
        for b in ODD:
            turns = [("user", a), ("assistant", b), ("ro\\n\nle<|", a), ("assistant", a)]
            made = chat_format.format_one(turns)
            assert chat_format.parse(made["formatted"]) == turns and not made["rewrote"]
            assert [chat_format.unescape(made["formatted"][s:e]) for s, e in made["loss_spans"]] == [b, a]


def test_history_rewriting_is_found():
    def only_last(turns):
        return "".join(f"[{r}]{t if i == len(turns) - 1 else '...'};" for i, (r, t) in enumerate(turns))

    made = chat_format.format_one([("user", "hello"), ("assistant", "hi")], only_last)
    assert made["rewrote"] == [1] and made["loss_spans"] == []


def test_long_conversations_take_linear_time():
    import time

    def timed(n):
        turns = [("user", "q" * 20), ("assistant", "a<|im_end|>")] * n
        began = time.perf_counter()
        made = chat_format.format_one(turns)
        took = time.perf_counter() - began
        assert chat_format.parse(made["formatted"]) == turns and len(made["loss_spans"]) == n
        return took

    timed(100)
    assert timed(10_000) < 60 * max(timed(1000), 0.01)


def test_templates_and_black_boxes_agree():
    turns = [("user", "a<|x"), ("assistant", ""), ("assistant", "b"), ("system", "\n")]
    numbered = chat_format.Template(lambda n, t: (f"{n}:{t[0]}={t[1]};" + ("#" if n == 2 else ""), n + 1), "<s>", 0)
    for template in (chat_format.chatml, numbered):
        assert chat_format.spans(turns, template) == chat_format.spans(turns, lambda t, f=template: f(t))


def test_templates_that_rewrite_history_are_found(monkeypatch):
    class Last(chat_format.Template):  # declares left to right, but shows only the last text
        def __call__(self, turns):
            return "".join(f"[{r}]{t if i == len(turns) - 1 else '...'};" for i, (r, t) in enumerate(turns))

    last = Last(lambda state, turn: (f"[{turn[0]}]{turn[1]};", state))
    for whole in (chat_format.WHOLE, 2):
        monkeypatch.setattr(chat_format, "WHOLE", whole)
        made = chat_format.format_one([("user", "hello"), ("assistant", "hi"), ("user", "what?")], last)
        assert made["rewrote"] == [1, 2] and made["loss_spans"] == []


def test_every_prefix_of_the_default_template_is_rendered(monkeypatch):
    seen = []
    render = chat_format.Template.__call__
    monkeypatch.setattr(chat_format.Template, "__call__", lambda self, turns: seen.append(len(turns)) or render(self, turns))
    chat_format.format_one([("user", "q"), ("assistant", "a")] * 20)
    assert set(seen) == set(range(41)) and len(seen) == 1 + 3 * 40


def test_chat_table(spark):
    rows = [(1, 1, "assistant", None), (1, 0, None, "q"), (2, 0, "assistant", "a"), (2, 0, "assistant", "a"), (None, 0, "user", "<|im_start|>")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r["conv_id"]: r for r in chat_format.digests(chat_format.format_conversations(df.withColumn("formatted", F.lit(1)))).collect()}
    assert got[1]["turns_sha256"] == hashlib.sha256(b"\nq\nassistant\n\n").hexdigest() and got[1]["loss_chars"] == 0
    assert got[2]["n_turns"] == 2 and got[2]["loss_sha256"] == hashlib.sha256(b"aa").hexdigest() and None in got
    assert chat_format.format_conversations(df.limit(0)).count() == 0


KEY = "a key"


def feistel_decimal(digits, kind, key=KEY):
    a, b = digits[: len(digits) // 2], digits[len(digits) // 2 :]
    for i in range(pii.ROUNDS):
        f = int(hashlib.sha256(f"{key}|{kind}|{i}|{len(a)}|{b}".encode()).hexdigest()[:15], 16)
        a, b = b, str((int(a) + f) % 10 ** len(a)).zfill(len(a))
    return a + b


def luhn(d):
    return sum((int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10))) for i, c in enumerate(reversed(d))) % 10


def card(digits):
    q = feistel_decimal(digits[:-1], "card")
    return q + str((10 - luhn(q + "0")) % 10)


def test_pii_against_brute_force(spark):
    rows = [
        (1, "pay 4111 1111 1111 1111, 4111-1111-1111-1111 and 4111111111111111.", 3), (2, "bad 4111111111111112 v4.0.1 300.1.1.1 2023-02-30 0000000000000000", 0), (3, None, 0), (4, "", 0), (5, "plain text 1.", 0),
        (6, "a.b1@x.org twice a.b1@x.org", 2), (7, "on 2001-02-03, 03.02.2001 and 03/02/2001", 3), (8, "+1 (017) 555-7713 or +10175557713", 2), (9, "10.0.0.1 " * 3000, 3000), (10, 'token = "' + "aB" * 20 + '"###', 1),
    ]
    df = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(1, rows[0][1])], "doc_id long, text string").withColumn("n_replaced", F.lit("clash"))
    got = {r["doc_id"]: r for r in pii.pseudonymise(df, key=KEY).collect()}
    assert {i: got[i]["n_replaced"] for i, _, _ in rows} == {i: n for i, _, n in rows}
    for i in (2, 3, 4, 5):
        assert got[i]["text"] == rows[i - 1][1]
    q = card("4111111111111111")
    assert luhn(q) == 0 and got[1]["text"] == f"pay {' '.join(q[k : k + 4] for k in range(0, 16, 4))}, {'-'.join(q[k : k + 4] for k in range(0, 16, 4))} and {q}."
    phone = "1" + feistel_decimal("0175557713", "phone")
    assert got[8]["text"] == f"+{phone[0]} ({phone[1:4]}) {phone[4:7]}-{phone[7:]} or +{phone}"
    y, a, b = (got[7]["text"].split()[k].strip(",") for k in (1, 2, 4))
    assert y == "-".join(reversed(a.split("."))) and a.replace(".", "/") == b
    assert len(set(got[9]["text"].split())) == 1 and "10.0.0.1" not in got[9]["text"]
    x = got[6]["text"].split()
    assert x[0] == x[2] != "a.b1@x.org" and x[0].endswith(".invalid")
    assert "aB" * 20 not in got[10]["text"] and len(got[10]["text"]) == len(rows[9][1])
    assert pii.pseudonymise(df.limit(0), key=KEY).count() == 0


def test_feistel_is_a_permutation(spark):
    d = spark.range(1000).select(F.lpad(F.col("id").cast("string"), 3, "0").alias("s"), F.col("id"))
    assert d.select(F.expr(pii._decimal("s", "k", "t")).alias("p")).distinct().count() == 1000
    n = spark.range(600).select(F.expr(pii._numeric("id", 20, 30, "k", "t")).alias("p")).agg(F.count_distinct("p"), F.min("p"), F.max("p")).first()
    assert tuple(n) == (600, 0, 599)


def prf(kind, i, size, half):
    return int(hashlib.sha256(f"{KEY}|{kind}|{i}|{size}|{half}".encode()).hexdigest()[:15], 16)


def feistel_numeric(v, a, b, kind):
    x, y = divmod(v, b)
    for i in range(pii.ROUNDS):
        if i % 2 == 0:
            x = (x + prf(kind, i, a, y)) % a
        else:
            y = (y + prf(kind, i, b, x)) % b
    return x * b + y


def classed(value, kind):
    low = value.lower()
    whole = hashlib.sha512(low.encode()).hexdigest()
    out = []
    for i, c in enumerate(value):
        k = i // 64
        stream = hashlib.sha512(f"{KEY}|{kind}|{k}|{low if k < 2 else whole}".encode()).hexdigest()
        draw = int(stream[2 * (i % 64) : 2 * (i % 64) + 2], 16)
        last = ("f", "F") if kind == "secret" else ("z", "Z")
        for first, end in (("0", "9"), ("a", last[0]), ("A", last[1])):
            if first <= c <= end:
                c = chr(ord(first) + draw % (ord(end) - ord(first) + 1))
                break
        out.append(c)
    return "".join(out)


def ssn(text):
    a, g, n = map(int, text.split("-"))
    x = feistel_numeric(((a - (2 if a > 666 else 1)) * 99 + g - 1) * 9999 + n - 1, 898, 989901, "ssn")
    a = x // 989901 + 1
    return f"{a + (a >= 666):03d}-{x % 989901 // 9999 + 1:02d}-{x % 9999 + 1:04d}"


def day(text):
    import datetime

    first = datetime.date(1900, 1, 1)
    d = datetime.date.fromisoformat(text)
    return (first + datetime.timedelta(days=feistel_numeric((d - first).days, 250, 292, "date"))).isoformat()


def address(text):
    n = 0
    for part in text.split("."):
        n = n * 256 + int(part)
    n = feistel_numeric(n, 65536, 65536, "ipv4")
    return ".".join(str(n >> s & 255) for s in (24, 16, 8, 0))


def test_every_kind_against_brute_force(spark):
    rng = random.Random(8)
    mails = ["Jo.Doe+x9@mail.example.org", "a" * 60 + "@" + "b" * 60 + ".com"]
    want = {m: classed(m.rsplit(".", 1)[0], "email") + ".invalid" for m in mails}
    want |= {x: classed(x, "secret") for x in ("0aF9" * 8, "DEAD" * 60)}
    want |= {x: address(x) for x in ("1.2.3.4", "255.255.255.255", "0.0.0.0")}
    want |= {x: day(x) for x in ("1900-01-01", "2024-02-29", "2099-11-12")}
    numbers = [f"{rng.choice([1, 665, 667, 899, rng.randrange(1, 665)]):03d}-{rng.randrange(1, 100):02d}-{rng.randrange(1, 10000):04d}" for _ in range(40)]
    want |= {x: ssn(x) for x in numbers}
    same = ["666-12-1234", "900-12-1234", "000-12-1234", "123-00-1234", "123-45-0000", "1.2.3.256", "2099-11-13", "1899-12-31"]
    want |= {x: x for x in same}
    df = spark.createDataFrame([(k, f"see {k} there") for k in want], "k string, text string")
    got = {r["k"]: r["text"] for r in pii.pseudonymise(df, key=KEY).collect()}
    assert got == {k: f"see {v} there" for k, v in want.items()}
    valid = [want[x] for x in numbers]
    assert len(set(valid)) == len(set(numbers)) and all(v[:3] not in ("000", "666") and v[0] != "9" and v[4:6] != "00" and v[7:] != "0000" for v in valid)


def test_a_key_is_needed(spark):
    df = spark.createDataFrame([(1, "1.2.3.4")], "doc_id long, text string")
    with pytest.raises(ValueError):
        pii.pseudonymise(df)
    spark.conf.set(pii.KEY_SETTING, "it's \\ a key")
    try:
        assert pii.pseudonymise(df).first()["text"] != pii.pseudonymise(df, key=KEY).first()["text"] != "1.2.3.4"
    finally:
        spark.conf.unset(pii.KEY_SETTING)


def test_runs_like_addresses(spark):
    long = "a." * 5000 + "@" + "b-" * 5000
    df = spark.createDataFrame([(1, long), (2, "x@" * 5000), (3, long + "c.org " + "jo@x.org")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in pii.pseudonymise(df, key=KEY).collect()}
    assert got[2]["n_replaced"] == 0 and "jo@x.org" not in got[3]["text"] and len(got[1]["text"]) == len(long)


def test_urls(spark):
    urls = ["HTTPS://A.Example.COM/en/7?q#f", "http://example.net/de/8", "x.com/en/", None, "http://b.net/de/1", "http://notcom/en/1", "http://q.org/es/", "http://k.com/3.html", "a://bad.co.uk/x", "http://k.com/en/#a", "http://l.com/" + "x/" * 20000 + "9" * 19]
    pages = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(urls)] + [(100 + i, f"http://spam.zz/p/{100 + i}/", "") for i in range(30)] + [(3, None, "")], "page_id long, url string, host string")
    labels = spark.createDataFrame([(100 + i, True) for i in range(30)] + [(3, False), (3, False), (None, True), (7, None)], "item long, bad boolean")
    got = {r["page_id"]: r for r in url_reputation.judge(pages, labels).collect()}
    assert (got[0]["host"], got[0]["path"], got[0]["rule"], got[0]["verdict"]) == ("a.example.com", "/en/7", "example.com/en/7", "allow")
    assert [got[i]["verdict"] for i in (1, 4, 6, 9)] == ["block", "allow", "block", "block"]
    assert got[2]["host"] == got[3]["host"] == "" and got[5]["rule"] is None and got[7]["path"] == "/3.html"
    assert got[100]["verdict"] == "block" and got[7]["verdict"] == "allow"
    assert url_reputation.judge(pages.limit(0), labels).count() == 0
    assert {r["verdict"] for r in url_reputation.judge(pages, labels.limit(0)).where("rule is null").collect()} == {"allow"}


def test_shown_documents(spark):
    paths = {"/en/7817": 7817, "/en/25/": 25, "/a/8.html": 8, "/en/x9": None, "/": None, "": None, "/9/b": None, "/" + "1" * 19: None, None: None}
    df = spark.createDataFrame([(p,) for p in paths], "path string").withColumn("d", url_reputation.shown_document())
    assert {r["path"]: r["d"] for r in df.collect()} == paths


def planted(spark, hosts):
    """Verdict and lower bound of hosts (name, labelled pages, bad ones), each with one page more."""
    rows, labels = [], []
    for name, n, bad in hosts:
        for i in range(n + 1):
            rows.append((len(rows), f"http://{name}/p/{len(rows)}"))
            if i < n:
                labels.append((len(rows) - 1, i < bad))
    df, out = spark.createDataFrame(rows, "page_id long, url string"), spark.createDataFrame(labels, "item long, bad boolean")
    return {r["host"]: (r["verdict"], r["lower_bound"]) for r in url_reputation.judge(df, out, rules=()).select("host", "verdict", "lower_bound").distinct().collect()}


def test_each_level_of_reputation_moves_verdicts(spark):
    """Hosts are blocked by their own outcomes, by their domain's and by their suffix's."""
    good = [(f"h{i}.good{i}.aa", 40, 2) for i in range(30)]
    got = planted(spark, [*good, ("own.good0.aa", 60, 55), ("few.good1.aa", 2, 2)])
    assert got["own.good0.aa"][0] == "block" and got["h0.good0.aa"][0] == "allow"
    assert got["few.good1.aa"][0] == "allow"  # two bad outcomes in a good domain aren't enough
    got = planted(spark, [*good, *((f"h{i}.bad.aa", 40, 39) for i in range(12)), ("new.bad.aa", 0, 0), ("new.good3.aa", 0, 0), ("few.bad.aa", 1, 1)])
    assert got["new.bad.aa"][0] == got["few.bad.aa"][0] == "block" and got["new.good3.aa"][0] == "allow"  # no outcomes of its own
    got = planted(spark, [*good, *((f"h.d{i}.zz", 40, 39) for i in range(12)), ("new.new.zz", 0, 0), ("new.new.aa", 0, 0)])
    assert got["new.new.zz"][0] == "block" and got["new.new.aa"][0] == "allow"  # nor of its domain
    got = planted(spark, [*good, *((f"h{i}.bad.aa", 40, 39) for i in range(12)), ("fine.bad.aa", 200, 0)])
    assert got["fine.bad.aa"][0] == "allow"  # enough good outcomes of its own


def test_levels(spark):
    df = spark.createDataFrame([("a.b.example.com",), ("x.co.uk",), ("a.x.co.uk",), ("localhost",), ("",)], "host string").withColumns(url_reputation.levels())
    assert {r["host"]: (r["domain"], r["suffix"]) for r in df.collect()} == {"a.b.example.com": ("example.com", "com"), "x.co.uk": ("x.co.uk", "co.uk"), "a.x.co.uk": ("x.co.uk", "co.uk"), "localhost": ("localhost", "localhost"), "": ("", "")}


@pytest.mark.parametrize("name", ["op1_quality_rules", "op3_chat_format", "op5_minhash_near_dup", "op10_url_reputation"])
def test_query_against_sql(spark, name):
    import os

    duckdb = pytest.importorskip("duckdb")
    from claimscope.llm import queries

    sf = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
    if not os.path.isdir(sf):
        pytest.skip("no tables")
    con = duckdb.connect()
    for t in ("documents", "pages", "labels", "conversations"):
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    df = queries.queries()[name](spark, sf)
    rel = con.sql(queries.oracle_sql()[name])
    cols = sorted(df.columns)
    at = [rel.columns.index(c) for c in cols]
    assert sorted(map(str, (tuple(r[c] for c in cols) for r in df.collect()))) == sorted(map(str, (tuple(r[i] for i in at) for r in rel.fetchall())))
