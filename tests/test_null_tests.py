from claimscope.operators import evaluation


def p(spark, rows):
    df = spark.createDataFrame([(float(x), h, 10 if i == 0 else 1) for i, (x, h) in enumerate(rows)], "score double, hit long, score_decile int")
    return evaluation.null_tests(df, "score").first()["permutation_p"]


def test_permuted_sums_of_few_hits(spark):
    # the one hit has the one high score: 1 permutation in 100, which a normal tail never reaches
    assert 0.004 < p(spark, [(1, 1)] + [(0, 0)] * 99) < 0.02
    assert 0.004 < p(spark, [(1, 1)] + [(1, 1)] * 98 + [(0, 0)]) < 0.02
    assert p(spark, [(0.1, 1)] * 30) == 1
