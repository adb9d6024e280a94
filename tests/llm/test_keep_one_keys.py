from collections import Counter

from claimscope.llm import near_dup


def test_each_component_keeps_a_row_whatever_the_keys(spark):
    texts = ["one two three four five six", "alpha beta gamma delta epsilon zeta", "red green blue cyan black white", "un deux trois quatre cinq six", "eins zwei drei vier fuenf sechs"]
    rows = [(None, texts[0]), (None, texts[1]), (None, texts[1]), (3, texts[1]), (5, texts[2]), (5, texts[3]), (6, texts[3]), (7, texts[3]), (7, texts[4]), (8, texts[4]), (9, ""), (9, ""), (None, None), (None, " ")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter((r["doc_id"], r["text"]) for r in near_dup.keep_one(df).collect())
    assert got == Counter([(None, texts[0]), (3, texts[1]), (5, texts[2]), (5, texts[3]), (7, texts[4]), (9, ""), (None, None), (None, " ")])
    assert near_dup.keep_one(df.limit(0)).count() == 0
