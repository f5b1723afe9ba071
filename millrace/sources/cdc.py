"""Change feeds: landed change rows, key-value table change streams, and an initial snapshot over JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.changes import decode_change
from millrace.sources.files import read_dir


def change_schema(row: T.StructType) -> T.StructType:
    """Envelope of landed changes: operation, time, sequence, the row before and after, and where it came from."""
    return T.StructType(
        [
            T.StructField("op", T.StringType()),
            T.StructField("op_ts", T.TimestampType()),
            T.StructField("seq", T.LongType()),
            T.StructField("before", row),
            T.StructField("after", row),
            T.StructField("table_name", T.StringType()),
            T.StructField("schema_name", T.StringType()),
            T.StructField("database_name", T.StringType()),
        ]
    )


def read_cdc_table(spark: SparkSession, path: str, row: T.StructType, fmt: str = "parquet", **kwargs) -> DataFrame:
    """Landed change rows of a table with their metadata columns."""
    return read_dir(spark, path, change_schema(row), fmt, **kwargs)


def cdc_rows(changes: DataFrame) -> DataFrame:
    """Source columns of each change plus operation, change time, processing time and origin."""
    row = F.when(F.col("op").isin("DELETE", "REMOVE"), F.col("before")).otherwise(F.col("after"))
    return changes.select(
        "op", "seq", row.alias("_row"),
        F.current_timestamp().alias("_change_processed_at"), F.col("op_ts").alias("_source_updated_at"),
        F.col("table_name").alias("_table_name"), F.col("schema_name").alias("_schema_name"),
        F.col("database_name").alias("_db_name"),
    ).select("op", "seq", "_row.*", "_change_processed_at", "_source_updated_at", "_table_name", "_schema_name", "_db_name")


def read_change_stream(records: DataFrame, item: T.StructType) -> DataFrame:
    """Change rows from the records of a change log; timestamps ascend, so the watermark has no delay."""
    image = T.StructType([T.StructField("eventName", T.StringType()), T.StructField("created", T.TimestampType()),
                          T.StructField("oldImage", item), T.StructField("newImage", item)])
    rows = records.select(F.from_json(F.col("data").cast("string"), image, {"mode": "FAILFAST"}).alias("r")).select("r.*")
    changes = decode_change(rows, "eventName", "created", "oldImage", "newImage")
    return changes.withWatermark("timestamp", "0 seconds") if changes.isStreaming else changes


def snapshot_jdbc(
    spark: SparkSession, url: str, table: str, key: str, lower: int, upper: int, partitions: int, **properties: str
) -> DataFrame:
    """The table as it stands, read in key ranges so that no single connection carries all of it."""
    return spark.read.jdbc(url, table, key, lower, upper, partitions, properties=properties)
