"""Files as batch tables and as streams of newly found files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_dir(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    fmt: str = "parquet",
    streaming: bool = True,
    max_files: int | None = None,
    **options: str,
) -> DataFrame:
    """A folder of files with a declared schema; as a stream, files that appear later are picked up by the trigger."""
    reader = (spark.readStream if streaming else spark.read).schema(schema).format(fmt).options(**options)
    if streaming and max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def read_parquet_dir(spark: SparkSession, path: str, schema: T.StructType, **kwargs) -> DataFrame:
    return read_dir(spark, path, schema, "parquet", **kwargs)


def read_avro_dir(spark: SparkSession, path: str, schema: T.StructType, avro_schema: str, **kwargs) -> DataFrame:
    """Avro container files read with a fixed reader schema (needs spark-avro on the class path)."""
    return read_dir(spark, path, schema, "avro", avroSchema=avro_schema, **kwargs)


def read_table_increments(spark: SparkSession, path: str, schema: T.StructType, **kwargs) -> DataFrame:
    """Rows appended to a table folder, as they appear."""
    return read_dir(spark, path, schema, "parquet", **kwargs)


def with_file_metadata(df: DataFrame) -> DataFrame:
    """Add the source file and its modification time."""
    return df.select(
        "*", F.col("_metadata.file_name").alias("_file_name"),
        F.col("_metadata.file_modification_time").alias("_file_modified_at"),
    )
