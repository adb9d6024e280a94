import re

from claimscope.llm import pii

CARD, PHONE, IP = "4111 1111 1111 1111", "+1 (826) 555-4081", "190.137.223.20"


def test_neighbouring_digits_hide_nothing(spark):
    alone = [PHONE, IP, CARD, "+44 20 7946 0958", "123-45-6789", "2001-02-03"]
    cases = [
        (f"{PHONE} {IP}", [PHONE, IP]), (f"+44 20 7946 0958 {IP}", ["+44 20 7946 0958", IP]), (f"{PHONE} {CARD}", [PHONE, CARD]), (f"{PHONE} 22", [PHONE]),
        (f"{CARD} 03/27", [CARD]), (f"2 {CARD}", [CARD]), (f"2 {CARD} 03 5", [CARD]), (f"{CARD} {IP}", [CARD, IP]),
        (f"{CARD} 123-45-6789", [CARD, "123-45-6789"]), (f"7 {CARD} 2001-02-03", [CARD, "2001-02-03"]), (f"{CARD} {CARD}", [CARD, CARD]),
        ("0 " * 8000 + CARD, [CARD]), (f"1 22 1 22 1 22 {CARD}", [CARD]),
    ]
    df = spark.createDataFrame([*enumerate(alone), *((100 + i, t) for i, (t, _) in enumerate(cases))], "doc_id long, text string")
    got = {r["doc_id"]: r for r in pii.pseudonymise(df, key="k").collect()}
    new = {v: got[i]["text"] for i, v in enumerate(alone)}
    assert all(v != p for v, p in new.items())
    for i, (text, found) in enumerate(cases):
        want = text
        for v in set(found):
            want = want.replace(v, new[v])
        assert (got[100 + i]["text"], got[100 + i]["n_replaced"]) == (want, len(found)), text


def test_secrets_of_any_length(spark):
    texts = ["ab12" * n for n in (8, 32, 33, 600)]
    got = [r["text"] for r in pii.pseudonymise(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), key="k").orderBy("doc_id").collect()]
    for old, new in zip(texts, got):
        assert old != new and re.sub("[0-9]", "0", re.sub("[a-f]", "a", old)) == re.sub("[0-9]", "0", re.sub("[a-f]", "a", new))
    # draws don't repeat along a long secret
    assert len({got[3][k : k + 128] for k in range(0, 2304, 128)}) == 18
