import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from claimscope.operators import attribution, companies, evaluation, exclusions, features, ml, peers, quality, screening
from claimscope.sources import readers, writers

CLAIMS = "npi string, hcpcs_code string, service_month string, total_paid decimal(18,2), total_claim_lines bigint, total_patients bigint"


def claims(spark, rows):
    from decimal import Decimal

    return spark.createDataFrame([(n, c, m, Decimal(str(p)), ln, pt) for n, c, m, p, ln, pt in rows], CLAIMS)


def test_core_and_zero_gross(spark):
    df = claims(spark, [("a", "x", "2020-01", 10, 2, 1), ("a", "y", "2020-03", -4, 1, 1), ("b", "x", "2020-01", -1, 0, 0)])
    got = {r["npi"]: r for r in features.core(df, "npi").collect()}
    assert got["a"]["tenure_months"] == 3 and got["a"]["reversal_ratio"] == pytest.approx(0.4)
    assert got["b"]["reversal_ratio"] is None and got["b"]["paid_per_claim_line"] is None
    conc = {r["npi"]: r for r in features.concentration(features.by_code(df, "npi"), "npi").collect()}
    assert conc["a"]["top_hcpcs_paid_share"] == 1.0 and conc["b"]["hcpcs_hhi"] is None


def test_robust_z_multiplies_and_small_groups_are_null(spark):
    rows = [(str(i), "t", float(i)) for i in range(40)] + [("n", None, 1.0), ("s", "small", 1.0)]
    df = spark.createDataFrame(rows, "npi string, tax string, x double")
    got = {r["npi"]: r for r in peers.peer_features(df, "npi", F.col("tax"), "t", ("x",)).collect()}
    assert got["39"]["x_rz_t"] == pytest.approx(1.4826 * 19.5 / 10)
    assert "n" not in got and got["s"]["x_rz_t"] is None and got["s"]["peer_group_too_small_t"]


def test_month_status_precedence(spark):
    months = spark.createDataFrame([("a", m, 1.0, 1) for m in ("2019-12", "2020-01", "2020-02", "2021-01", "2021-06")], "npi string, service_month string, paid double, claim_lines int")
    rec = spark.createDataFrame([("a", "2020-01", "2021-06", "2021-01"), ("a", None, None, None)], "npi string, excl_month string, rein_month string, waiver_month string")
    got = {r["service_month"]: r["status"] for r in exclusions.month_status(months, rec).collect()}
    assert got == {"2019-12": "before", "2020-01": "same_month", "2020-02": "clean_after", "2021-01": "waivered", "2021-06": "reinstated"}
    assert exclusions.dispositions(exclusions.month_status(months, rec)).first()["disposition"] == "QUALIFIED"


def test_company_precedence(spark):
    df = spark.createDataFrame([("1", "p", "o", "X LLC"), ("2", "", "o", "X LLC"), ("3", None, "o", "Y"), ("4", None, "z", "Z Inc"), ("5", None, None, ""), ("6", None, None, None)], "npi string, pac_id string, owner_key string, org_legal_name string")
    got = {r["npi"]: r["company_id"] for r in companies.link(df).collect()}
    assert got == {"1": "pac:p", "2": "owner:o", "3": "owner:o", "4": "name:Z", "5": "npi:5", "6": "npi:6"}


def test_partition_is_exact_and_conserved(spark):
    fact = spark.createDataFrame([(1.0, True), (2.0, False), (9.0, True), (None, None)], "total_paid double, provider_matched boolean")
    got = {r["bucket"]: r["n_rows"] for r in attribution.partition_summary(fact, 5.0).collect()}
    assert got == {"base": 1, "aggregate": 2, "corrupt": 1}
    quality.conserved(fact, fact, "total_paid")
    with pytest.raises(AssertionError):
        quality.conserved(fact, fact.limit(2), "total_paid")
    with pytest.raises(AssertionError):
        quality.unique_key(fact.unionByName(fact), "total_paid")


def test_bins_equal_qcut(spark):
    for n in (11, 23, 40, 97):
        df = spark.createDataFrame([(i, float((i * 37) % n)) for i in range(n)], "id int, s double")
        got = evaluation.binned(df, "s", "id", "d").orderBy("id").toPandas()["d"]
        x = pd.Series([float((i * 37) % n) for i in range(n)])
        assert got.tolist() == pd.qcut(x.rank(method="first"), 10, labels=range(1, 11)).astype(int).tolist()


def test_average_precision(spark):
    df = spark.createDataFrame([(0.9, 1), (0.8, 0), (0.8, 1), (0.1, 0)], "s double, y int")
    r = evaluation.ranking_metrics(df, "s", "y").first()
    assert r["average_precision"] == pytest.approx(0.5 * 1 + 0.5 * 2 / 3) and r["roc_auc"] == pytest.approx((1 + 1 + 1 + 0.5) / 4)


def test_forest_finds_the_outlier(spark):
    rng = np.random.default_rng(0)
    rows = [(i, *map(float, rng.normal(size=2))) for i in range(300)] + [(999, 9.0, -9.0)]
    got = ml.isolation_forest(spark.createDataFrame(rows, "id int, a double, b double"), "id", ["a", "b"], trees=60)
    best = got.orderBy(F.col("iforest_score").desc()).first()
    assert best["id"] == 999 and 0 < best["iforest_score"] < 1 and sum(best["importance"]) == pytest.approx(1)


def test_leakage_is_dropped():
    assert ml.model_features(["npi", "x", "provider_on_leie", "my_excluded_owner_n", "anomaly_score"]) == ["x"]


def test_split_is_stratified_and_stable(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("npi"), (F.col("id") % 10 == 0).cast("int").alias("label"))
    a, b = (ml.stratified_split(df, "npi", "label") for _ in range(2))
    assert a.exceptAll(b).count() == 0
    assert {r["label"]: r["n"] for r in a.where("is_val").groupBy("label").agg(F.count("*").alias("n")).collect()} == {0: 180, 1: 20}


def test_boosting_derives_its_rows_once(spark):
    derived = spark.sparkContext.accumulator(0)

    def count(i):
        derived.add(1)
        return float(i * 37 % 101)

    df = spark.range(200).select(F.col("id").cast("string").alias("npi"), (F.col("id") % 10 == 0).cast("int").alias("label"), F.udf(count, "double").asNondeterministic()("id").alias("x"), F.lit("a").alias("kind"))
    model = ml.fit_boosted(df.withColumn("is_val", F.col("npi").cast("int") % 5 == 1), ["x"], ["kind"], rounds=2)
    assert derived.value == 200 and ml.importances(model, ["x", "kind"]).count() == 2


def test_screening_reconciles(spark):
    df = spark.createDataFrame([("City of X", ""), ("Acme", "")], "name string, specialty string")
    kept, removed = screening.screen(df, "name", "specialty", check=True)
    assert [r["name"] for r in kept.collect()] == ["Acme"] and removed.first()["removed_reason"] == "government"


def test_sources_round_trip(spark, tmp_path):
    p = tmp_path / "in.csv"
    p.write_text('Billing Provider_NPI,TOTAL PAID\n"0123","1.5"\n')
    df = readers.read_table(spark, str(p), {"npi": ["billing_provider_npi"], "paid": ["total_paid"], "x": ["nothing"]}, ("npi",))
    assert df.first().asDict() == {"npi": "0123", "paid": "1.5", "x": None}
    with pytest.raises(ValueError):
        readers.read_table(spark, str(p), {"npi": ["absent"]}, ("npi",))
    listed = spark.createDataFrame([("0123", ["a", "b"])], "npi string, why array<string>")
    writers.write_csv(listed, str(tmp_path / "out"))
    assert readers.read_any(spark, str(tmp_path / "out")).first().asDict() == {"npi": "0123", "why": "a; b"}
    assert "| npi |" in writers.markdown("T", {"s": listed.select("npi")})
    both = readers.union_files([listed, listed.drop("why").withColumn("z", F.lit(1))])
    assert both.columns == ["npi", "why", "z"]


def test_stream_totals(spark, tmp_path):
    from claimscope.streaming.monthly import windowed_totals

    rows = [("2024-01-01 00:10:00", "a", 1.0), ("2024-01-01 00:50:00", "a", 2.0), ("2024-01-01 01:10:00", "b", 3.0)]
    df = spark.createDataFrame(rows, "t string, event_type string, value double").select(F.to_timestamp("t").alias("ts"), "event_type", "value")
    df.write.parquet(str(tmp_path / "s"))
    q = windowed_totals(spark.readStream.schema(df.schema).parquet(str(tmp_path / "s"))).writeStream.format("memory").queryName("totals").outputMode("complete").start()
    q.processAllAvailable()
    q.stop()
    assert {(r["event_type"], r["n"], r["total"]) for r in spark.table("totals").collect()} == {("a", 2, 3.0), ("b", 1, 3.0)}


def test_descriptions_summaries_and_reasons(spark):
    from claimscope.operators import yearly

    frame = spark.createDataFrame([(1, 5.0, 1.0), (2, 1.0, 1.0), (3, 2.0, 9.0)], "id int, a double, b double")
    scored = spark.createDataFrame([(1, 0.9, [0.7, 0.3])], "id int, iforest_score double, importance array<double>")
    assert ml.describe(scored, frame, "id", ["a", "b"]).first()["description"] == "a high (70%); b typical (30%)"
    years = spark.createDataFrame([("x", 2001, 0.2, False), ("x", 2002, 0.8, True), ("x", 2003, 0.8, True)], "npi string, year int, score double, is_anomaly boolean")
    assert tuple(yearly.provider_summary(years).first())[1:] == (0.8, 2002, pytest.approx(0.6), 3, 2)
    rules = spark.createDataFrame([(True, False, 1234.4, 2, True, False, 120.0, 1.0), (None, None, None, None, False, False, 1.0, 1.0)], "billed_after_exclusion boolean, excluded_after_billing boolean, paid_after_exclusion double, n_months_after int, rule_implausible_lines_per_patient boolean, rule_implausible_paid_per_line boolean, lines_per_patient_instance double, paid_per_claim_line double")
    got = [r["r"] for r in rules.select(peers.rule_reasons().alias("r")).collect()]
    assert got == [["billed_after_exclusion(paid_after=$1,234,months=2)", "implausible_lines_per_patient(=120.0)"], []]


def test_models_read_a_stored_frame_equal_to_the_scoring_frame(spark, monkeypatch):
    from claimscope.operators import ml
    from claimscope.plans import catalogue
    from claimscope.plans.adapter import Tables

    class Seen(Exception):
        pass

    def seen(df, *args, **kwargs):
        raise Seen(df._jdf.queryExecution().analyzed().toString())

    monkeypatch.setattr(ml, "fit_boosted", seen)
    for name in ("boosted_tree_scores", "feature_importance"):
        with pytest.raises(Seen) as plan:
            catalogue.queries()[name](spark, "/root/testdata/sf0.001")
        assert "l_orderkey" not in str(plan.value)  # claims aren't joined anew by each reading
    t = Tables(spark, "/root/testdata/sf0.001")
    plain, stored = t.provider_scoring(), t.stored_scoring()
    assert stored.columns == plain.columns and plain.count() == 150
    assert plain.exceptAll(stored).count() == 0 == stored.exceptAll(plain).count()
