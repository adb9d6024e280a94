import pytest
from pyspark.sql import functions as F

from claimscope.functions import dates, ids, names, numbers, screening


def one(spark, column, **values):
    row = spark.range(1).select(*[(F.lit(v).cast("string") if v is None else F.lit(v)).alias(k) for k, v in values.items()] or [F.lit(1).alias("x")])
    return row.select(column.alias("r")).first()["r"]


@pytest.mark.parametrize("raw, want", [("1234567893", "1234567893"), (" '1234567893", "1234567893"), ("1234567890", None), ("A12345", None), (None, None), ("", None), ("0000000000", None), ("12345678930", None)])
def test_npi(spark, raw, want):
    assert one(spark, ids.canonical_npi(F.col("r0")), r0=raw) == want


@pytest.mark.parametrize("raw, want", [(None, "blank"), ("A1", "alpha_prefixed"), ("1234567893", "valid_not_registered"), ("1234567890", "failed_luhn"), ("20", "malformed")])
def test_buckets(spark, raw, want):
    assert one(spark, ids.identifier_bucket(F.col("r0")), r0=raw) == want


def test_names(spark):
    assert one(spark, names.name_key(F.col("a")), a="  Smith, John MD. ") == "SMITH JOHN"
    assert one(spark, names.company_key(F.col("a")), a="The New-Life Center, Inc.") == "NEW LIFE CENTER"
    assert one(spark, names.name_root(F.col("a")), a="New Life Wellness Flagstaff LLC") == "NEW LIFE WELLNESS"
    assert one(spark, names.display_name(F.col("a"), F.col("b"), F.col("c")), a="", b="DOE", c=None) == "DOE"
    assert one(spark, names.name_match(F.col("a"), F.col("b")), a="A B", b="B C") == "partial"
    assert one(spark, names.state_codes(F.col("a")), a="tx; California/NY") == ["TX", "NY"]
    assert one(spark, names.address_key(F.col("a"), F.col("b"), F.col("c"), F.col("d")), a="1 Main St.", b="Ames", c="ia", d="50010-1234") == "1 MAIN ST AMES IA 50010"


def test_dates(spark):
    assert one(spark, dates.ymd_date(F.col("a")), a="00000000") is None
    assert str(one(spark, dates.ymd_date(F.col("a")), a="20200229")) == "2020-02-29"
    assert one(spark, dates.ymd_month(F.col("a")), a="20200229") == "2020-02"
    assert one(spark, dates.month_start(F.col("a")), a="2021-13") is None
    assert one(spark, dates.timing_bucket(F.col("a"), 2018, 2024), a="20250101") == "after_2024"


def test_nan_and_zero(spark):
    assert one(spark, numbers.ratio(F.lit(1), F.lit(0))) is None
    assert one(spark, numbers.not_nan(F.lit(float("nan")))) is None
    assert one(spark, numbers.log1p_positive(F.lit(-1.0))) is None


def test_mean_tie_percentile_skips_nulls(spark):
    df = spark.createDataFrame([(1, 1.0), (2, 1.0), (3, 2.0), (4, None)], "id int, x double")
    got = {r["id"]: r["p"] for r in df.select("id", numbers.mean_tie_percentile(F.col("x"), F.lit(1)).alias("p")).collect()}
    assert got == {1: 0.5, 2: 0.5, 3: 1.0, 4: None}


@pytest.mark.parametrize("name, spec, want", [("County of Kern", "", "government"), ("Kern County", "", "government"), ("Mercy Hospital", "", "hospital_name"), ("Any", "x 282N00000X", "hospital_taxonomy"), ("Any", "261QF0400X", "fqhc_taxonomy"), ("Nationwide Care", "", None), (None, None, None)])
def test_lead_class(spark, name, spec, want):
    assert one(spark, screening.lead_class(F.col("a"), F.col("b")), a=name, b=spec) == want


@pytest.mark.parametrize("name, want", [("Smith, John A.", "individual"), ("Smith, John L L C", None), ("LabCorp of X", "labs")])
def test_advert_class(spark, name, want):
    assert one(spark, screening.advert_class(F.col("a")), a=name) == want
