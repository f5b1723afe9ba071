"""Partitioned message logs, batch and stream, read and written.

Where the records of a log are landed as Parquet files, Spark's own file source reads them and its checkpoint says which files
are done; a stream into the log is a file sink with its own record of what was committed.

Spark ships no connector for shard-based log services, so one is defined on the Python data source API for when a ``client``
is named as ``module:Class``. A client offers ``shards()``, ``bounds(shard)``, ``at_timestamp(shard, micros)``,
``pieces(shard, start, end)`` and ``read(piece)``; to be written to as well, ``stage(batches)`` and ``publish(staged,
batch_id)``. Offsets are the next sequence number per shard. A shard's range is read in pieces, so one shard that holds a
third of all records is still read by many tasks.
"""

from __future__ import annotations

import hashlib
import importlib
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    DataSourceStreamArrowWriter,
    DataSourceStreamReader,
    InputPartition,
    WriterCommitMessage,
)

from millrace.functions import scalar
from millrace.sinks.files import save
from millrace.sources.files import read_dir
from millrace.streaming.tables import append_stream

FORMAT = "millrace_log"
SCHEMA = "shard string, sequence bigint, arrival timestamp, key string, data binary"
ARROW = pa.schema(
    [
        ("shard", pa.string()),
        ("sequence", pa.int64()),
        ("arrival", pa.timestamp("us", tz="UTC")),
        ("key", pa.string()),
        ("data", pa.binary()),
    ]
)
LATEST, TRIM_HORIZON, AT_TIMESTAMP = "LATEST", "TRIM_HORIZON", "AT_TIMESTAMP"


def load_client(options):
    """The client named by the ``client`` option, whose module must be installed on the workers."""
    module, _, attribute = options["client"].partition(":")
    return getattr(importlib.import_module(module), attribute)(dict(options))


def _start_of(client, options) -> dict[str, int]:
    position = options.get("position", LATEST).upper()
    if position == LATEST:
        return {s: client.bounds(s)[1] for s in client.shards()}
    if position == TRIM_HORIZON:
        return {s: client.bounds(s)[0] for s in client.shards()}
    if position == AT_TIMESTAMP:
        if not options.get("timestamp"):
            raise ValueError("position AT_TIMESTAMP needs the timestamp option (epoch milliseconds)")
        micros = int(options["timestamp"]) * 1000
        return {s: client.at_timestamp(s, micros) for s in client.shards()}
    raise ValueError(f"unknown position {position}")


def _pieces(client, start: dict[str, int], end: dict[str, int]) -> list[InputPartition]:
    found = []
    for shard, upto in end.items():
        since = start.get(shard, 0)
        if upto > since:
            found.extend(InputPartition(piece) for piece in client.pieces(shard, since, upto))
    return found


class LogReader(DataSourceReader):
    def __init__(self, options):
        self.options = dict(options)

    def partitions(self):
        client = load_client(self.options)
        end = {s: client.bounds(s)[1] for s in client.shards()}
        return _pieces(client, _start_of(client, {"position": TRIM_HORIZON, **self.options}), end)

    def read(self, partition):
        return load_client(self.options).read(partition.value) if partition is not None else iter(())


class LogStreamReader(DataSourceStreamReader):
    def __init__(self, options):
        self.options = dict(options)

    def initialOffset(self):
        return _start_of(load_client(self.options), self.options)

    def latestOffset(self):
        client = load_client(self.options)
        return {s: client.bounds(s)[1] for s in client.shards()}

    def partitions(self, start, end):
        return _pieces(load_client(self.options), start, end)

    def read(self, partition):
        return load_client(self.options).read(partition.value)


def _message(staged: list) -> WriterCommitMessage:
    message = WriterCommitMessage()
    message.staged = staged
    return message


class LogWriter(DataSourceArrowWriter):
    def __init__(self, options):
        self.options = dict(options)
        self.token = uuid.uuid4().hex

    def write(self, iterator):
        return _message(load_client(self.options).stage(iterator))

    def commit(self, messages):
        load_client(self.options).publish([f for m in messages if m for f in m.staged], self.token)


class LogStreamWriter(DataSourceStreamArrowWriter):
    def __init__(self, options):
        self.options = dict(options)

    def write(self, iterator):
        return _message(load_client(self.options).stage(iterator))

    def commit(self, messages, batchId):
        if not self.options.get("query"):
            raise ValueError("a stream into a log needs the query option: a name that no other query into it has")
        run = hashlib.blake2b(self.options["query"].encode(), digest_size=12).hexdigest()
        load_client(self.options).publish([f for m in messages if m for f in m.staged], f"{run}-{batchId}")

    def abort(self, messages, batchId):
        return None


class LogSource(DataSource):
    @classmethod
    def name(cls):
        return FORMAT

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return LogReader(self.options)

    def streamReader(self, schema):
        return LogStreamReader(self.options)

    def writer(self, schema, overwrite):
        return LogWriter(self.options)

    def streamWriter(self, schema, overwrite):
        return LogStreamWriter(self.options)


def register(spark: SparkSession) -> None:
    """Make the format known to the session of the rows and to the active one; Spark looks it up in both.

    Whether a name is taken is looked up in the active session too, so each is the active one while it registers.
    """
    sessions = SparkSession._get_j_spark_session_class(spark._jvm)
    for session in (spark, SparkSession.getActiveSession() or spark):
        sessions.setActiveSession(session._jsparkSession)
        session.dataSource.register(LogSource)


def read_stream_log(
    spark: SparkSession, stream: str, position: str = LATEST, timestamp: int | None = None, streaming: bool = True, **options
) -> DataFrame:
    """Records of a log from LATEST, TRIM_HORIZON or AT_TIMESTAMP (epoch milliseconds, then mandatory).

    Without a ``client`` the log is a folder of landed records. A stream from its LATEST needs the time of its first start as
    ``timestamp``, the same at every restart.
    """
    if "client" not in options:
        return _landed(spark, stream, position, timestamp, streaming)
    register(spark)
    reader = (spark.readStream if streaming else spark.read).format(FORMAT)
    given = {"stream": stream, "position": position, **options}
    if timestamp is not None:
        given["timestamp"] = str(timestamp)
    return reader.options(**given).load()


def _landed(spark: SparkSession, folder: str, position: str, timestamp: int | None, streaming: bool) -> DataFrame:
    position = position.upper()
    if position not in (LATEST, TRIM_HORIZON, AT_TIMESTAMP):
        raise ValueError(f"unknown position {position}")
    rows = read_dir(spark, folder, T.StructType.fromDDL(SCHEMA), streaming=streaming)
    if position == TRIM_HORIZON:
        return rows
    if position == LATEST and not streaming:
        return rows.filter(F.lit(False))
    if timestamp is None:
        raise ValueError(f"position {position} needs the timestamp option (epoch milliseconds)")
    return rows.filter(F.col("arrival") >= F.timestamp_millis(F.lit(timestamp)))


def log_records(df: DataFrame, key, data=None, arrival=None) -> DataFrame:
    """Rows in the shape the log takes; the payload is the whole row as JSON unless given."""
    payload = scalar.json_encode(*df.columns) if data is None else data
    return df.select(
        F.lit(None).cast("string").alias("shard"),
        F.lit(None).cast("bigint").alias("sequence"),
        (F.current_timestamp() if arrival is None else arrival).alias("arrival"),
        key.cast("string").alias("key"),
        payload.cast("binary").alias("data"),
    )


def write_stream_log(records: DataFrame, stream: str, checkpoint: str | None = None, **options):
    """Append records to a log; a streaming frame gives the writer to start, with its checkpoint set.

    A replayed batch of a stream adds nothing, while another query into the same log, or the same one begun anew with another
    checkpoint, adds all its batches.
    """
    if records.isStreaming and not checkpoint:
        raise ValueError("a stream into a log needs a checkpoint")
    if "client" not in options:
        return append_stream(records, stream, [], checkpoint) if records.isStreaming else save(records, stream)
    register(records.sparkSession)
    if records.isStreaming:
        named = {"query": checkpoint, **options}
        return records.writeStream.format(FORMAT).options(stream=stream, checkpointLocation=checkpoint, **named)
    return records.write.format(FORMAT).mode("append").options(stream=stream, **options).save()


def decoded(df: DataFrame, schema: T.StructType, lenient: bool = False) -> DataFrame:
    """JSON payloads of log records as typed rows."""
    if lenient:
        return scalar.json_decode_lenient(df, "data", schema).select("row.*")
    return df.select(scalar.json_decode("data", schema).alias("row")).select("row.*")
