"""Writers: Parquet, quoted CSV, lead files and reports."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimscope.sources.readers import file_system, read_any


def write_parquet(df: DataFrame, path: str, by: tuple[str, ...] = (), drop: tuple[str, ...] = ()) -> None:
    writer = df.drop(*drop).write.mode("overwrite")
    (writer.partitionBy(*by) if by else writer).parquet(path)


def csv_to_parquet(df: DataFrame, path: str) -> DataFrame:
    write_parquet(df, path)
    return df.sparkSession.read.parquet(path)


def cached_parquet(spark: SparkSession, source: str, folder: str) -> str:
    """The Parquet copy of a CSV file below ``folder``, converted again only if the file is newer than the copy."""
    stem = source.rstrip("/").rsplit("/", 1)[-1].rsplit(".", 1)[0]
    copy = f"{folder.rstrip('/')}/{stem}.parquet"
    fs, done = file_system(spark, f"{copy}/_SUCCESS")
    from_fs, origin = file_system(spark, source)
    if not fs.exists(done) or fs.getFileStatus(done).getModificationTime() < from_fs.getFileStatus(origin).getModificationTime():
        write_parquet(read_any(spark, source), copy)
    return copy


def flat(df: DataFrame, sep: str = "; ") -> DataFrame:
    """List columns as joined strings, for CSV."""
    return df.select(*[F.array_join(F.col(f"`{c}`").cast("array<string>"), sep).alias(c) if t.startswith("array") else F.col(f"`{c}`") for c, t in df.dtypes])


def write_csv(df: DataFrame, path: str, drop: tuple[str, ...] = (), force_quote: tuple[str, ...] | None = None) -> None:
    """CSV with a header. All fields are quoted, so ids keep leading zeros in spreadsheets; with ``force_quote``
    those columns always, others only where a field needs it."""
    ready = flat(df.drop(*drop))
    if force_quote is None:
        ready.write.mode("overwrite").csv(path, header=True, quoteAll=True)
        return
    quoted = [F.concat_ws(",", *[_field(F.col(f"`{c}`"), c in force_quote) for c in ready.columns]).alias(",".join(_header(c) for c in ready.columns))]
    ready.select(*quoted).write.mode("overwrite").option("header", True).option("quote", "\u0000").option("emptyValue", "").csv(path, sep="\u0001", escape="\u0000")


def _header(name: str) -> str:
    return '"' + name.replace('"', '""') + '"' if any(x in name for x in ',"\n\r') else name


def _field(c: Column, always: bool) -> Column:
    """A CSV field; null is empty."""
    text = F.coalesce(c.cast("string"), F.lit(""))
    needs = F.lit(True) if always else text.rlike('[,"\n\r]')
    return F.when(needs, F.concat(F.lit('"'), F.regexp_replace(text, '"', '""'), F.lit('"'))).otherwise(text)


def write_lead_files(df: DataFrame, path: str, kinds: dict[str, Column], force_quote: tuple[str, ...] | None = None) -> None:
    """One projection, a CSV for each predicate."""
    for name, keep in kinds.items():
        write_csv(df.where(keep), f"{path}/{name}", force_quote=force_quote)


def markdown(title: str, sections: dict[str, DataFrame], limit: int = 50) -> str:
    """A report of small aggregates; at most ``limit`` rows of each."""
    out = [f"# {title}"]
    for name, df in sections.items():
        out += [f"\n## {name}\n", "| " + " | ".join(df.columns) + " |", "|" + "-|" * len(df.columns)]
        out += ["| " + " | ".join("" if v is None else str(v) for v in r) + " |" for r in df.limit(limit).collect()]
    return "\n".join(out) + "\n"


def as_json(df: DataFrame, limit: int = 50) -> str:
    return json.dumps([r.asDict() for r in df.limit(limit).collect()], default=str)
