"""Event time on streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def event_time(df: DataFrame, ts: str, delay: str = "10 seconds") -> DataFrame:
    """Bounded out-of-order event time. Zone-less timestamps are read as UTC, which the session is set to."""
    return df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)


def ascending_time(df: DataFrame, ts: str) -> DataFrame:
    """Event time that never goes back."""
    return event_time(df, ts, "0 seconds")


def processing_time(df: DataFrame, out: str = "proc_time") -> DataFrame:
    """Stamp rows with processing time, one value per micro-batch, usable as a window's time column."""
    return df.withColumn(out, F.current_timestamp()).withWatermark(out, "0 seconds")
