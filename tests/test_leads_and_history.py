"""Look-ups, screens, exports, quantiles and the yearly track on small frames."""

import csv
import glob
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from claimscope.functions import lookups, screening
from claimscope.operators import evaluation, history, leads, order, quality
from claimscope.sources import readers, writers


def one(spark, column, **values):
    row = spark.range(1).select(*[F.lit(v).cast("string").alias(k) for k, v in values.items()])
    return row.select(column.alias("r")).first()["r"]


@pytest.mark.parametrize("name, lead, advert", [
    ("Hospital Service District No 1", "government", None), ("Alaska Native Health", "tribal", None), ("Healthcare Authority of X", "government", None), ("Good Samaritan Society", None, "national_nonprofit"),
    ("Evangelical Lutheran Homes", None, "national_nonprofit"), ("Tribal County", "government", "tribal"), ("Kern County", "government", "government"), ("County of Kern", "government", "government"),
    ("Mercy Hospital", "hospital_name", None), ("Palco Fiscal", None, "fiscal_intermediary"), ("Plain LLC", None, None), ("", None, None), (None, None, None),
])
def test_screens_have_their_own_lists(spark, name, lead, advert):
    assert (one(spark, screening.lead_class(F.col("n"), F.lit("")), n=name), one(spark, screening.advert_class(F.col("n")), n=name)) == (lead, advert)


def test_what_a_screen_matched(spark):
    assert one(spark, screening.lead_matched(F.col("n"), F.lit("x 282N00000X")), n="a") == "282N00000X"
    assert one(spark, screening.lead_matched(F.col("n"), F.lit("")), n="Kern County") == "ENDS WITH COUNTY"
    assert one(spark, screening.advert_matched(F.col("n")), n="Smith, John") == "person-name"


def test_states_and_specialties(spark):
    assert one(spark, lookups.full_states(F.col("s")), s="tx; California/NY, texas;;Elsewhere") == ["Texas", "California", "New York", "Elsewhere"]
    assert one(spark, lookups.full_states(F.col("s")), s=None) == []
    assert one(spark, lookups.specialty(F.col("c")), c="207Q00000X") == "Family Medicine" and one(spark, lookups.specialty(F.col("c")), c=None).startswith("Unknown")
    assert one(spark, lookups.lead_specialty(F.col("c")), c="1") == "1 (taxonomy code)"


def test_quantiles_and_ranks_against_numpy(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(rng.choice(["a", "b", None]), rng.choice([None, *[round(rng.expovariate(1), 2) for _ in range(9)]]), i) for i in range(4000)] + [("one", 5.0, 9999), ("none", None, 9998)]
    df = spark.createDataFrame(rows, "g string, x double, i long")
    for accuracy in (10_000, 50):  # the second brackets for real
        monkeypatch.setattr(order, "ACCURACY", accuracy)
        got = {r["g"]: (r["lo"], r["mid"], r["hi"]) for r in order.quantiles(df, ["g"], "x", {"lo": 0.01, "mid": 0.5, "hi": 0.9}).collect()}
        for g in ("a", "b", None, "one"):
            x = [v for k, v, _ in rows if k == g and v is not None]
            assert got[g] == pytest.approx(tuple(np.quantile(x, [0.01, 0.5, 0.9])))
        assert "none" not in got
    ranks = {r["i"]: r["k"] for r in order.ranked(df, F.col("x"), ["i"], "k", ["g"]).collect()}
    for g in ("a", None, "one", "none"):
        want = sorted(((v is None, v or 0, i) for k, v, i in rows if k == g))
        assert [ranks[i] for _, _, i in want] == list(range(1, len(want) + 1))
    assert order.ranked(df.limit(0), F.col("x"), ["i"], "k").count() == 0 and order.quantiles(df.limit(0), [], "x", {"q": 0.5}).first()["q"] is None


def test_ranks_and_quantiles_when_approximate_quantiles_vary(spark, monkeypatch):
    def vary(xs):
        return xs and [x + random.SystemRandom().random() * (20, -20)[i % 2 == 0] for i, x in enumerate(xs)]

    real, varied = F.percentile_approx, F.udf(vary, "array<double>").asNondeterministic()
    monkeypatch.setattr(order.F, "percentile_approx", lambda *args: varied(real(*args)))
    monkeypatch.setattr(order, "ACCURACY", 50)
    df = spark.range(1000).select("id", (F.col("id") * 7919 % 1009).cast("double").alias("x"))
    x = sorted(i * 7919 % 1009 for i in range(1000))
    ranks = {r["x"]: (r["k"], r["n"]) for r in order.ranked(df, F.col("x"), ["id"], "k", rows="n").collect()}
    assert ranks == {v: (i + 1, 1000) for i, v in enumerate(x)}
    assert order.quantiles(df, [], "x", {"mid": 0.5, "hi": 0.9}).first() == pytest.approx(tuple(np.quantile(x, [0.5, 0.9])))
    lift = evaluation.lift_table(evaluation.binned(df.withColumn("hit", (F.col("id") % 50 == 0).cast("int")), "x", "id", "decile"), "decile")
    place = {v: max(1, -(-i * 10 // 999)) for i, v in enumerate(x)}  # the SQL's bins
    assert {r["decile"]: (r["n"], r["hits"]) for r in lift.collect()} == {d: (sum(p == d for p in place.values()), sum(place[i * 7919 % 1009] == d for i in range(0, 1000, 50))) for d in range(1, 11)}


def test_curve_and_timing(spark):
    df = spark.createDataFrame([(0.9, 1, "20250101"), (0.9, 0, None), (0.5, 1, "20170101"), (0.1, 0, None)], "s double, y int, d string")
    curve = [(r["threshold"], r["n"], r["precision"], r["recall"]) for r in evaluation.precision_recall_curve(df, "s", "y").orderBy("n").collect()]
    assert curve == [(0.9, 2, 0.5, 0.5), (0.5, 3, pytest.approx(2 / 3), 1.0), (0.1, 4, 0.5, 1.0)]
    binned = df.withColumn("b", F.when(F.col("s") > 0.4, 2).otherwise(1))
    got = {r["timing"]: (r["hits"], r["top_lift"]) for r in evaluation.timing_lift(binned, "b", "y", "d", 2018, 2024).collect()}
    assert got["after_2024"] == (1, pytest.approx(4 / 3)) and got["during_2018_2024"] == (0, None)


def test_quality_checks(spark):
    df = spark.createDataFrame([(1, 0.1), (2, 0.2)], "k long, paid double")
    quality.partitioned(df, df.where("k = 1"), df.where("k = 2"), measure="paid")
    with pytest.raises(AssertionError):
        quality.partitioned(df, df.where("k = 1"))
    with pytest.raises(AssertionError):
        quality.conserved(df, df.withColumn("paid", F.col("paid") + 0.01), "paid")


def test_malformed_lines_are_kept_apart(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text('a,b\n1,2\n3\n4,"5,5"\n6,7,8\n')
    assert sorted((r["a"], r["b"]) for r in readers.read_any(spark, str(path)).collect()) == [("1", "2"), ("4", "5,5")]
    assert sorted(r["line"] for r in readers.malformed(spark, str(path)).collect()) == ["3", "6,7,8"]


def test_cached_conversion_and_search(spark, tmp_path):
    source = tmp_path / "in" / "t.csv"
    source.parent.mkdir()
    source.write_text("a\n1\n")
    copy = writers.cached_parquet(spark, str(source), str(tmp_path))
    first = glob.glob(f"{copy}/part*")
    assert writers.cached_parquet(spark, str(source), str(tmp_path)) == copy and glob.glob(f"{copy}/part*") == first
    time.sleep(1.1)
    source.write_text("a\n1\n2\n")
    writers.cached_parquet(spark, str(source), str(tmp_path))
    assert spark.read.parquet(copy).count() == 2
    assert readers.find_input(spark, "t.csv", [str(tmp_path / "no"), str(tmp_path / "in")]).endswith("/in/t.csv")
    assert readers.find_input(spark, "t.csv", [str(tmp_path)], deep=True).endswith("/in/t.csv")
    with pytest.raises(FileNotFoundError):
        readers.find_input(spark, "u.csv", [str(tmp_path)], deep=True)


def test_forced_quotes(spark, tmp_path):
    df = spark.createDataFrame([("007", 'a "b", c', None), ("8", "plain", "x")], "npi string, name string, z string")
    writers.write_csv(df, str(tmp_path / "out"), force_quote=("npi",))
    lines = [x for f in sorted(glob.glob(f"{tmp_path}/out/part*")) for x in open(f).read().splitlines()]
    assert '"007","a ""b"", c",' in lines and '"8",plain,x' in lines
    found = [r for f in glob.glob(f"{tmp_path}/out/part*") for r in csv.DictReader(open(f))]
    assert sorted((r["npi"], r["name"]) for r in found) == [("007", 'a "b", c'), ("8", "plain")]


def test_named_companies(spark):
    members = spark.createDataFrame([("1", "c1", 5.0, "207Q00000X", ""), ("2", "c1", 9.0, None, " "), ("3", "c2", 1.0, "x", "Org"), ("4", "c3", None, None, None)], "npi string, company_id string, net_paid double, primary_taxonomy string, org_legal_name string")
    names = spark.createDataFrame([("2", "DOE, JANE"), ("4", "")], "npi string, provider_name string")
    found = leads.company_lookups(members, names)
    rows = spark.createDataFrame([("c1", "", "2_on_leie"), ("c2", "npi:3", "x"), ("c3", None, "5_none"), ("c4", "Own", "5_none")], "company_id string, company_name string, priority_tier string")
    got = {r["company_id"]: r for r in leads.named(rows, found).collect()}
    assert [got[c]["company_name"] for c in ("c1", "c2", "c3", "c4")] == ["DOE, JANE", "Org", "UNKNOWN NAME (NPI 4)", "Own"]
    assert got["c1"]["specialty"] == "Family Medicine" and got["c1"]["top_npi"] == "2" and got["c3"]["name_unresolved"] and not got["c2"]["name_unresolved"]


def test_yearly_facts(spark):
    months = spark.createDataFrame([("a", "x", "2018-01", 2.0, 1.0, 5.0), ("a", "y", "2019-03", 1.0, 1.0, 7.0), ("b", "x", "2018-02", 1.0, 1.0, 1.0)], "npi string, hcpcs_code string, service_month string, claims double, beneficiaries double, paid double")
    registry = spark.sql("select 'a' as npi, date'2017-12-31' as enumerated, date'2019-01-01' as deactivated union all select 'b', date'2020-01-01', null")
    listed = spark.sql("select 'a' as npi, date'2018-06-01' as excl_date, date'2019-06-01' as reinstate_date, 't' as excl_type union all select 'a', date'2019-01-01', null, 'u'")
    got = {r["npi"]: r for r in history.enriched(history.summary(months), registry, listed).collect()}
    assert (got["a"]["npi_age_days_at_first_claim"], got["a"]["billing_on_deactivated_npi"], got["a"]["left_censored"], got["a"]["in_leie"]) == (1, 1, True, True)
    assert (got["b"]["npi_age_days_at_first_claim"], got["b"]["billing_on_deactivated_npi"], got["b"]["left_censored"], got["b"]["in_leie"]) == (0, 0, False, False)
    years = history.enriched(history.summary(months), registry, listed).where("npi = 'a'").select(F.explode(F.array(*map(F.lit, (2017, 2018, 2019)))).alias("y"), "excl_date", "reinstate_date")
    assert {r["y"]: r["e"] for r in years.select("y", history.excluded_at_year_end(F.col("y")).alias("e")).collect()} == {2017: 0, 2018: 1, 2019: 0}


def test_best_member_of_tied_scores_is_the_least_number(spark):
    df = spark.createDataFrame([("c", "10", "ten", 0.5, 1.0, "T"), ("c", "9", "nine", 0.5, 2.0, "U"), ("c", "8", "eight", 0.1, 0.0, "T")], "company_id string, npi string, org_legal_name string, score double, net_paid double, primary_taxonomy string")
    assert leads.best_members(df).first().asDict() == {"company_id": "c", "best_npi": "9", "best_name": "nine", "npi_list": "10|9|8", "specialty_code": "U"}
