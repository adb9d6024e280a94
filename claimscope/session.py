"""The engine's Spark session."""

from __future__ import annotations

from pyspark.sql import SparkSession


def get_session(master: str | None = None, **conf: str) -> SparkSession:
    """ANSI mode, adaptive execution and UTC; cluster sizes are left to the deployment."""
    builder = SparkSession.builder.appName("claimscope")
    if master:
        builder = builder.master(master)
    defaults = {"spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true", "spark.sql.ansi.enabled": "true"}
    for k, v in (defaults | conf).items():
        builder = builder.config(k, v)
    return builder.getOrCreate()
