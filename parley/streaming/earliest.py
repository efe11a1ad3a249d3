"""An extension: the earliest filing of each key, kept as filings arrive.

The result equals operators.dedup.earliest over all rows that came within the
watermark; state is one row for each key and window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def earliest_stream(filings: DataFrame, key: str, when: str, order: str, late: str = "60 days", window: str = "3650 days") -> DataFrame:
    """(key, window, news_dt, order) of a stream; rows later than the watermark are left out."""
    rows = filings.withWatermark(when, late)
    first = F.min(F.struct(F.col(when), F.col(order))).alias("f")
    return rows.groupBy(F.col(key), F.window(when, window)).agg(first).select(key, "window", F.col(f"f.{when}").alias(when), F.col(f"f.{order}").alias(order))
