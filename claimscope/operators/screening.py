"""Screening of leads: kept and removed rows with reasons, duplicates with an audit."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimscope.functions.screening import lead_class
from claimscope.operators.quality import partitioned


def screen(leads: DataFrame, name: str, specialty: str, check: bool = False) -> tuple[DataFrame, DataFrame]:
    """(kept, removed with reason); with ``check``, their counts are reconciled."""
    judged = leads.withColumn("removed_reason", lead_class(F.col(name), F.col(specialty)))
    kept, removed = judged.where("removed_reason is null").drop("removed_reason"), judged.where("removed_reason is not null")
    if check:
        partitioned(leads, kept, removed)
    return kept, removed


def dedupe_with_audit(df: DataFrame, keys: list[str], order: list[str], name: str) -> DataFrame:
    """Adds occurrence (1 for the row that stays) and first_name, the name of the row it repeats."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("occurrence", F.row_number().over(w)).withColumn("first_name", F.first(name).over(w))
