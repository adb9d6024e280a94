"""An extension beyond batch parity: windowed totals of an event stream, with late data bounded by a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def windowed_totals(events: DataFrame, time: str = "ts", key: str = "event_type", value: str = "value", width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """n and total of each key in tumbling windows; works on streams and tables alike."""
    grouped = events.withWatermark(time, late).groupBy(F.window(time, width), key)
    return grouped.agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total")).select(F.col("window.start").alias("window_start"), key, "n", "total")
