"""Partitioned files, batch and stream."""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import scalar
from millrace.sinks.storage import SUCCESS_FILE, Folder, partition_folder

PENDING = "_pending"


def save(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    checkpoint: str | None = None,
    mode: str = "append",
    **options: str,
):
    """Write a batch, or return the writer of a stream for ``streaming.run`` to start.

    A partitioned batch is rebalanced by its partition columns: adaptive execution merges small outputs and splits a
    partition that holds much of the data over several files.
    """
    if df.isStreaming:
        writer = df.writeStream.format(fmt).outputMode("append").options(path=path, checkpointLocation=checkpoint, **options)
        return writer.partitionBy(*partition_by) if partition_by else writer
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.format(fmt).mode(mode).options(**options)
    return (writer.partitionBy(*partition_by) if partition_by else writer).save(path)


def streamed(spark: SparkSession, path: str) -> bool:
    """Whether a stream into a folder has committed anything yet."""
    return any(name[:1].isdigit() for name in Folder(spark, path).children("_spark_metadata"))


def write_json_lines(df: DataFrame, path: str, timestamps: Sequence[str] = (), bucket_ts: str | None = None, **kwargs):
    """One JSON object per line; ``timestamps`` become epoch milliseconds; folders per hour of ``bucket_ts`` if given."""
    buckets = []
    if bucket_ts:
        df, buckets = df.withColumn("bucket", F.date_format(bucket_ts, "yyyy-MM-dd--HH")), ["bucket"]
    for column in timestamps:
        df = df.withColumn(column, F.unix_millis(column))
    return save(df, path, "json", buckets, ignoreNullFields="false", **kwargs)


HOURLY = ["year", "month", "day", "hour"]


def with_hour_folders(df: DataFrame, ts: str | None = None) -> DataFrame:
    """Folder columns from ``ts``, or from processing time."""
    moment = F.col(ts) if ts else F.current_timestamp()
    for name, pattern in zip(HOURLY, ["yyyy", "MM", "dd", "HH"]):
        df = df.withColumn(name, F.date_format(moment, pattern))
    return df


def write_parquet_hourly(df: DataFrame, path: str, ts: str | None = None, **kwargs):
    return save(with_hour_folders(df, ts), path, "parquet", HOURLY, **kwargs)


def write_avro_hourly(df: DataFrame, path: str, ts: str | None = None, **kwargs):
    """Needs spark-avro on the class path."""
    return save(with_hour_folders(df, ts), path, "avro", HOURLY, **kwargs)


def write_partitioned_sql(df: DataFrame, path: str, ts: str, **kwargs):
    """JSON files under ``dt=/hr=``; the folder columns are not repeated in the files."""
    parted = df.withColumn("dt", scalar.date_part(ts)).withColumn("hr", scalar.hour_part(ts))
    return save(parted, path, "json", ["dt", "hr"], **kwargs)


class PartitionCommit:
    """``foreachBatch`` function: write a batch under its partitions and mark each with ``_SUCCESS`` once it is old enough.

    A touched partition is first noted under ``_pending``; every batch then marks the noted ones that have waited for
    ``delay`` seconds. Each batch replaces its own ``batch_id=`` subfolder, so a replay does not double rows.
    """

    def __init__(self, path: str, partition_by: Sequence[str], fmt: str = "json", delay: float = 60.0):
        self.path, self.partition_by, self.fmt, self.delay = path, list(partition_by), fmt, delay

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        tagged = batch.withColumn("batch_id", F.lit(batch_id))
        layout = [*self.partition_by, "batch_id"]
        tagged.hint("rebalance", *layout).write.format(self.fmt).mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy(*layout).save(self.path)
        folder = Folder(batch.sparkSession, self.path)
        for row in batch.select(*self.partition_by).distinct().toLocalIterator():
            note = f"{PENDING}/{partition_folder(self.partition_by, row)}/note"
            if not folder.exists(note):
                folder.touch(note)
        batch.unpersist()
        self.commit_due(batch.sparkSession)

    def finish(self, spark) -> None:
        """Mark everything noted, waiting for the delay of the youngest note: for the end of a bounded run, and for the start
        of a new one, whose first batch may be long in coming."""
        folder = Folder(spark, self.path)
        while ages := [folder.age_seconds(f"{PENDING}/{note}") for note in folder.files_below(PENDING)]:
            time.sleep(max(0.05, self.delay - min(ages)))
            self.commit_due(spark)

    def commit_due(self, spark) -> None:
        folder = Folder(spark, self.path)
        for note in folder.files_below(PENDING):
            if folder.age_seconds(f"{PENDING}/{note}") >= self.delay:
                folder.touch(f"{note.rsplit('/', 1)[0]}/{SUCCESS_FILE}")
                folder.remove(f"{PENDING}/{note}")
