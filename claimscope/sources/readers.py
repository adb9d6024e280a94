"""Readers: formats by extension, alias-resolved schemas, unions of files with differing columns."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BAD = "_bad"


def normal_header(name: str) -> str:
    return re.sub(r"[\s_]", "", name.strip().strip("\"'")).lower()


def resolve_columns(columns: list[str], aliases: dict[str, list[str]], required: tuple[str, ...] = ()) -> dict[str, str | None]:
    """For each canonical name the first column that one of its aliases names, else None."""
    by_norm = {normal_header(c): c for c in reversed(columns)}
    found = {k: next((by_norm[normal_header(a)] for a in names if normal_header(a) in by_norm), None) for k, names in aliases.items()}
    missing = [k for k in required if found.get(k) is None]
    if missing:
        raise ValueError(f"no column for {missing} among {columns}")
    return found


def _is_parquet(path: str) -> bool:
    return bool(re.search(r"\.parquet/?$|\.pq$", path.lower()))


def _csv_with_bad(spark: SparkSession, path: str) -> DataFrame:
    """All columns as strings, and the line itself in ``_bad`` where it doesn't fit the header."""
    options = {"header": True, "quote": '"', "escape": '"'}
    header = spark.read.csv(path, inferSchema=False, **options).schema
    wide = T.StructType([*[T.StructField(f.name, T.StringType()) for f in header], T.StructField(BAD, T.StringType())])
    return spark.read.schema(wide).options(columnNameOfCorruptRecord=BAD, columnPruning=False, mode="PERMISSIVE").csv(path, **options)


def read_any(spark: SparkSession, path: str) -> DataFrame:
    """Parquet by extension, else CSV with all columns as strings. Lines that don't fit are in malformed(), not here."""
    if _is_parquet(path):
        return spark.read.parquet(path)
    return _csv_with_bad(spark, path).where(F.col(BAD).isNull()).drop(BAD)


def malformed(spark: SparkSession, path: str) -> DataFrame:
    """source, first field and line of the CSV lines that read_any() leaves out; empty for Parquet."""
    if _is_parquet(path):
        return spark.createDataFrame([], "source string, first_field string, line string")
    both = _csv_with_bad(spark, path)
    return both.where(F.col(BAD).isNotNull()).select(F.lit(path).alias("source"), F.col(f"`{both.columns[0]}`").alias("first_field"), F.col(BAD).alias("line"))


def find_input(spark: SparkSession, name: str, folders: list[str], deep: bool = False) -> str:
    """The path of ``name`` in the first of ``folders`` that has it; with ``deep`` also below them, by least path."""
    for deeper in (False, True) if deep else (False,):
        for folder in folders:
            fs, root = file_system(spark, folder)
            direct = root.suffix(f"/{name}")
            if not deeper and fs.exists(direct):
                return direct.toString()
            if deeper and fs.exists(root):
                found, files = [], fs.listFiles(root, True)
                while files.hasNext():
                    p = files.next().getPath()
                    while p is not None and p.toString() != root.toString():
                        if p.getName() == name:
                            found.append(p.toString())
                        p = p.getParent()
                if found:
                    return min(found)
    raise FileNotFoundError(f"{name} is in none of {folders}")


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the qualified path."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs, fs.makeQualified(p)


def read_table(spark: SparkSession, path: str, aliases: dict[str, list[str]], required: tuple[str, ...] = ()) -> DataFrame:
    """Canonical columns as strings; absent optional ones are null."""
    df = read_any(spark, path)
    found = resolve_columns(df.columns, aliases, required)
    return df.select(*[(F.col(f"`{c}`").cast("string") if c else F.lit(None).cast("string")).alias(k) for k, c in found.items()])


def file_stem() -> Column:
    return F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)(\.[^.]*)?$", 1)


def facility_type(stem: Column) -> Column:
    """The kind of facility that an owners file is about, from its name."""
    label = F.regexp_replace(F.regexp_replace(stem, r"(?i)[_\s-]*all[_\s-]*owners.*$", ""), r"(?i)owners.*$", "")
    short = F.lower(F.btrim(label, F.lit("_- .")))
    return F.when(short == "", F.lower(stem)).otherwise(short)


def union_files(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def typed_spending(df: DataFrame, suppressed: str | None = None, tokens: tuple[str, ...] = ("*", "Y", "YES", "TRUE", "1", "SUPPRESSED")) -> DataFrame:
    """Numbers of a spending table; suppressed measures are null."""
    flag = F.upper(F.trim(F.coalesce(F.col(suppressed), F.lit("")))).isin(*tokens) if suppressed else F.lit(False)
    cast = {c: F.when(~flag, F.col(c).try_cast("double")) for c in ("total_patients", "total_claim_lines", "total_paid")}
    return df.withColumns(cast).withColumn("is_suppressed", flag)


# The two headers of each column of the yearly track's spending file.
YEARLY_SPENDING = {
    "npi": ["BILLING_PROVIDER_NPI_NUM", "billing_provider_npi"], "hcpcs_code": ["HCPCS_CODE", "hcpcs_code"], "service_month": ["CLAIM_FROM_MONTH", "service_month"],
    "total_patients": ["TOTAL_PATIENTS", "total_beneficiaries"], "total_claim_lines": ["TOTAL_CLAIM_LINES", "total_claims"], "total_paid": ["TOTAL_PAID", "total_paid_amount"],
}


def yearly_spending(spark: SparkSession, path: str) -> DataFrame:
    """Spending of the yearly track: rows with an npi; texts default to empty, what isn't a number to 0."""
    df = read_table(spark, path, YEARLY_SPENDING, ("npi",)).where("npi is not null")
    numbers = ("total_patients", "total_claim_lines", "total_paid")
    return df.withColumns({**{c: F.coalesce(F.col(c).try_cast("double"), F.lit(0.0)) for c in numbers}, **{c: F.coalesce(c, F.lit("")) for c in ("hcpcs_code", "service_month")}})


def constant(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)
