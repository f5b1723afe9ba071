"""The supplied Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with ``ts`` as a zoned timestamp, which watermarks need (the session zone is UTC)."""
    return table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
