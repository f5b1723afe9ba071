"""Kafka in and out. The connector is Spark's own ``spark-sql-kafka`` package, which must be on the class path to load
or start anything; options and the decoding of the value column need no package."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import scalar

EARLIEST, LATEST = "earliest", "latest"


def source_options(
    servers: str,
    topic: str,
    start: str = EARLIEST,
    start_timestamp: int | None = None,
    group: str | None = None,
    max_offsets: int | None = None,
    max_records_per_task: int | None = None,
    **client: str,
) -> dict[str, str]:
    """Reader options. A start timestamp (epoch ms) wins over ``start``; ``client`` goes to the consumer unchanged.

    ``max_offsets`` bounds a micro-batch; ``max_records_per_task`` splits a topic partition that holds much of the data.
    """
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic}
    if start_timestamp is not None:
        options["startingTimestamp"] = str(start_timestamp)
    elif start in (EARLIEST, LATEST):
        options["startingOffsets"] = start
    else:
        raise ValueError(f"unknown start {start!r}")
    if group:
        options["kafka.group.id"] = group
    if max_offsets:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    if max_records_per_task:
        options["maxRecordsPerPartition"] = str(max_records_per_task)
    options.update({f"kafka.{name.replace('_', '.')}": value for name, value in client.items()})
    return options


def read_kafka(spark: SparkSession, **settings) -> DataFrame:
    """Raw records. A query's checkpoint holds the committed offsets; the start applies to its first run only."""
    return spark.readStream.format("kafka").options(**source_options(**settings)).load()


def text_rows(records: DataFrame) -> DataFrame:
    return records.select(F.col("value").cast("string").alias("value"))


def json_rows(records: DataFrame, schema: T.StructType, iso: bool = False) -> DataFrame:
    """Typed rows; a record that does not decode fails the job."""
    return records.select(scalar.json_decode("value", schema, iso).alias("row")).select("row.*")


def lenient_json_rows(records: DataFrame, schema: T.StructType, iso: bool = False) -> DataFrame:
    """Typed rows; records that do not decode are left out."""
    return scalar.json_decode_lenient(records, "value", schema, iso=iso).select("row.*")


def sql_rows(records: DataFrame, view: str, schema: T.StructType, query: str, iso: bool = True) -> DataFrame:
    """Decoded records as a temporary view, queried with SQL; records that do not decode are left out."""
    lenient_json_rows(records, schema, iso).createOrReplaceTempView(view)
    return records.sparkSession.sql(query)


def kafka_records(df: DataFrame, value: Column | None = None, key: Column | None = None, partition: Column | None = None) -> DataFrame:
    """Rows in the shape the Kafka sink takes: value, and key and partition when given."""
    payload = scalar.json_encode(*df.columns) if value is None else value
    columns = [payload.alias("value")]
    if key is not None:
        columns.append(key.cast("string").alias("key"))
    if partition is not None:
        columns.append(partition.cast("int").alias("partition"))
    return df.select(*columns)


def sink_options(servers: str, topic: str, **client: str) -> dict[str, str]:
    options = {"kafka.bootstrap.servers": servers, "topic": topic}
    options.update({f"kafka.{name.replace('_', '.')}": value for name, value in client.items()})
    return options


def write_kafka(records: DataFrame, servers: str, topic: str, checkpoint: str | None = None, **client: str):
    """At-least-once delivery, batch or stream."""
    options = sink_options(servers, topic, **client)
    if records.isStreaming:
        return records.writeStream.format("kafka").options(checkpointLocation=checkpoint, **options)
    return records.write.format("kafka").options(**options).save()


def avro_rows(records: DataFrame, reader_schema: str, skip_bytes: int = 0) -> DataFrame:
    """Avro values read with a fixed reader schema (needs spark-avro). ``skip_bytes`` drops a registry header."""
    from pyspark.sql.avro.functions import from_avro

    value = F.expr(f"substring(value, {skip_bytes + 1})") if skip_bytes else F.col("value")
    return records.select(from_avro(value, reader_schema).alias("row")).select("row.*")


def avro_records(df: DataFrame, writer_schema: str, key: Column | None = None, partition: Column | None = None) -> DataFrame:
    """Rows as Avro values (needs spark-avro), optionally keyed and placed on a partition."""
    from pyspark.sql.avro.functions import to_avro

    return kafka_records(df, to_avro(F.struct("*"), writer_schema), key, partition)
