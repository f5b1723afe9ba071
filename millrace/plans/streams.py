"""Streaming runs over the event table: the stream works off the files there are, and its output is read back.

Windows come out in append mode, as the watermark closes them. A bounded run ends with a marker row far in the future, which
closes every window but its own, so the answer has all windows of the data. Runs in steps land the table in parts and start
the query again for each, so that state, watermark and checkpoint are carried from one micro-batch to the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import schemas
from millrace.functions import scalar
from millrace.operators import windows
from millrace.plans.registry import plain_bounds, query
from millrace.plans.windows import SLIDE_MIN, TUMBLE_MIN, VEHICLES, readings_text, vehicles
from millrace.session import shared_dir
from millrace.sinks import files as sink_files
from millrace.sinks import lake
from millrace.sinks.storage import Folder
from millrace.sources import files, log
from millrace.streaming import run, state
from millrace.streaming.time import event_time
from millrace.tables import events, table


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event table as a stream of its files, be it one file or a folder of them."""
    if Folder(spark, sf_dir).is_folder("events.parquet"):
        return files.read_parquet_dir(spark, f"{sf_dir.rstrip('/')}/events.parquet", schemas.EVENTS)
    return files.read_parquet_dir(spark, sf_dir, schemas.EVENTS, pathGlobFilter="events.parquet")


def _parts(spark: SparkSession, sf_dir: str, by: str, n: int) -> list[DataFrame]:
    """The events in n parts of equal spans of a column, in its order; rows without it are in the first."""
    rows = spark.read.schema(schemas.EVENTS).parquet(f"{sf_dir.rstrip('/')}/events.parquet")
    place = F.col(by) if by == "event_id" else F.unix_micros(F.col(by).cast("timestamp"))
    low, high = (x or 0 for x in rows.agg(F.min(place), F.max(place)).first())
    part = F.coalesce(F.least(F.floor((place - low) * n / max(1, high - low)), F.lit(n - 1)), F.lit(0))
    return [rows.filter(part == i) for i in range(n)]


# Later than any event; its own window stays open.
END_OF_TIME = "2999-01-01 00:00:00"


def _with_marker(rows: DataFrame) -> DataFrame:
    last = rows.sparkSession.range(1).select(F.lit(END_OF_TIME).cast("timestamp_ntz").alias("ts"))
    return rows.unionByName(last, allowMissingColumns=True)


def _in_steps(parts: list[DataFrame], transform, purpose: str) -> DataFrame:
    """Land one part after the other; each time run the query on what is new, from its checkpoint."""
    spark = parts[0].sparkSession
    base = shared_dir(spark, purpose)
    for part in parts:
        part.write.mode("append").parquet(f"{base}/landed")
        out = transform(files.read_parquet_dir(spark, f"{base}/landed", schemas.EVENTS))
        run.run_to_end(sink_files.save(out, f"{base}/rows", checkpoint=f"{base}/checkpoint"))
    return spark.read.schema(out.schema).parquet(f"{base}/rows")


def _flushed(spark: SparkSession, sf_dir: str, transform, purpose: str, steps: int = 2) -> DataFrame:
    """A query over the events in time order, with all windows closed at the end."""
    parts = _parts(spark, sf_dir, "ts", steps)
    return _in_steps([*parts[:-1], _with_marker(parts[-1])], transform, purpose)


def _through_files(df: DataFrame, purpose: str) -> DataFrame:
    """Run a stream into a Parquet folder and read that."""
    base = shared_dir(df.sparkSession, purpose)
    run.run_to_end(sink_files.save(df, f"{base}/rows", checkpoint=f"{base}/checkpoint"))
    return df.sparkSession.read.schema(df.schema).parquet(f"{base}/rows")


@query("SELECT event_type, count(*) AS n, round(sum(value), 2) AS total, max(ts) AS last_ts FROM events GROUP BY event_type")
def stream_parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events streamed into hourly folders and summed up from there."""
    base = shared_dir(spark, "hourly")
    run.run_to_end(
        sink_files.write_parquet_hourly(event_stream(spark, sf_dir), f"{base}/rows", "ts", checkpoint=f"{base}/checkpoint")
    )
    back = spark.read.parquet(f"{base}/rows")
    return back.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("total"), F.max("ts").alias("last_ts")
    )


@query(TUMBLE_MIN)
def stream_tumble_min(spark: SparkSession, sf_dir: str) -> DataFrame:
    def tumbled(stream: DataFrame) -> DataFrame:
        return plain_bounds(windows.window_min(event_time(stream, "ts"), "ts", "user_id", "value", "30 minutes"))

    return _flushed(spark, sf_dir, tumbled, "tumble")


def _slid(stream: DataFrame) -> DataFrame:
    return plain_bounds(windows.window_min(event_time(stream, "ts"), "ts", "event_type", "value", "1 hour", "10 minutes"))


@query(SLIDE_MIN)
def stream_slide_min(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flushed(spark, sf_dir, _slid, "slide")


@query(VEHICLES)
def stream_vehicle_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    def aggregated(stream: DataFrame) -> DataFrame:
        return readings_text(windows.vehicle_window_agg(vehicles(event_time(stream, "ts")), "ts", size="1 day"))

    return _flushed(spark, sf_dir, aggregated, "vehicles")


@query("""
    WITH spans AS (
        SELECT *, coalesce(least(floor((epoch_us(ts) - min(epoch_us(ts)) OVER ()) * 3.0
                                       / greatest(1, max(epoch_us(ts)) OVER () - min(epoch_us(ts)) OVER ())), 2), 0) AS part FROM events
    ), seen AS (SELECT max(ts) - INTERVAL 10 SECONDS AS mark FROM spans WHERE part <> 1)
    SELECT user_id, min(value) AS min_value, time_bucket(INTERVAL 30 MINUTES, ts) AS window_start,
           time_bucket(INTERVAL 30 MINUTES, ts) + INTERVAL 30 MINUTES AS window_end
    FROM spans, seen WHERE part <> 1 OR time_bucket(INTERVAL 30 MINUTES, ts) + INTERVAL 30 MINUTES > mark
    GROUP BY ALL
""")
def stream_late_min(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The middle third of the events comes last: what belongs to windows that were closed by then is dropped."""
    first, middle, last = _parts(spark, sf_dir, "ts", 3)

    def tumbled(stream: DataFrame) -> DataFrame:
        return plain_bounds(windows.window_min(event_time(stream, "ts"), "ts", "user_id", "value", "30 minutes"))

    return _in_steps([first, last, _with_marker(middle)], tumbled, "late")


@query("SELECT event_type, row_number() OVER (PARTITION BY event_type) AS total_count FROM events")
def stream_keyed_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A running number per key from keyed state, which is carried over two runs."""
    parts = _parts(spark, sf_dir, "event_id", 2)
    return _in_steps(parts, lambda stream: state.keyed_count(stream, "event_type"), "keyed-count")


@query("""
    SELECT event_id, event_type, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS total_count FROM events
""")
def stream_running_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from two micro-batches, with hot keys split over tasks."""
    base = shared_dir(spark, "running-count")

    def sink(rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{base}/rows/batch={batch_id}")

    counter = state.RunningCountBatches(["event_type"], ["event_id"], f"{base}/totals", sink)
    for part in _parts(spark, sf_dir, "event_id", 2):
        part.write.mode("append").parquet(f"{base}/landed")
        stream = files.read_parquet_dir(spark, f"{base}/landed", schemas.EVENTS).select("event_id", "event_type")
        run.run_to_end(run.each_batch(stream, counter, f"{base}/checkpoint"))
    return spark.read.parquet(f"{base}/rows").drop("batch")


@query("""
    SELECT 'lines' AS sink, event_type, count(*) AS n FROM events GROUP BY event_type
    UNION ALL SELECT 'rows', event_type, count(*) FROM events WHERE value > 50 GROUP BY event_type
""")
def multi_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One stream into two sinks, read once."""
    base = shared_dir(spark, "multi-sink")

    def rows(batch: DataFrame, batch_id: int) -> None:
        batch.filter("value > 50").write.mode("overwrite").parquet(f"{base}/rows/batch={batch_id}")

    def lines(batch: DataFrame, batch_id: int) -> None:
        batch.select(scalar.json_encode("event_type").alias("value")).write.mode("overwrite").text(f"{base}/lines/batch={batch_id}")

    run.run_to_end(run.multi_sink(event_stream(spark, sf_dir), {"rows": rows, "lines": lines}, f"{base}/checkpoint"))
    kinds = {
        "rows": spark.read.parquet(f"{base}/rows").select("event_type"),
        "lines": spark.read.schema("event_type string").json(f"{base}/lines").select("event_type"),
    }
    counts = [df.groupBy("event_type").count().select(F.lit(k).alias("sink"), "event_type", F.col("count").alias("n"))
              for k, df in kinds.items()]
    return counts[0].unionByName(counts[1])


@query("SELECT event_id, epoch_us(ts) // 1000 AS ts, event_type, strftime(ts, '%Y-%m-%d--%H') AS bucket FROM events")
def json_lines_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON lines in hourly folders, timestamps as epoch milliseconds."""
    path = shared_dir(spark, "json-lines")
    rows = events(spark, sf_dir).select("event_id", "ts", "event_type")
    sink_files.write_json_lines(rows, path, timestamps=["ts"], bucket_ts="ts")
    return spark.read.schema("event_id bigint, ts bigint, event_type string, bucket string").json(path)


@query("""
    SELECT event_id, event_type, value, strftime(ts, '%Y-%m-%d') AS dt, strftime(ts, '%H') AS hr FROM events WHERE value > 50
""")
def partitioned_sql_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values above fifty as JSON under date and hour folders."""
    path = shared_dir(spark, "dt-hr")
    rows = events(spark, sf_dir).filter("value > 50").select("event_id", "ts", "event_type", "value")
    sink_files.write_partitioned_sql(rows, path, "ts")
    schema = "event_id bigint, ts string, event_type string, value double, dt string, hr string"
    return spark.read.schema(schema).json(path).drop("ts")


@query("SELECT event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY event_type")
def partition_commit_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream into folders per event type, each marked as complete."""
    base = shared_dir(spark, "commit")
    commit = sink_files.PartitionCommit(f"{base}/rows", ["event_type"], delay=1)
    stream = event_stream(spark, sf_dir).select("event_id", "event_type", "value")
    run.run_to_end(run.each_batch(stream, commit, f"{base}/checkpoint"))
    commit.finish(spark)
    marked = [name for name in Folder(spark, f"{base}/rows").children() if Folder(spark, f"{base}/rows/{name}").exists("_SUCCESS")]
    back = spark.read.schema("event_id bigint, value double, event_type string, batch_id bigint").json(f"{base}/rows")
    back = back.filter(F.concat(F.lit("event_type="), "event_type").isin(marked))
    return back.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("total"))


@query("SELECT event_id, event_type, value FROM events")
def stream_log_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events written to a message log, streamed back from its beginning and decoded."""
    rows = events(spark, sf_dir).select("event_id", "event_type", "value")
    stream = shared_dir(spark, "log")
    log.write_stream_log(log.log_records(rows, F.col("event_id")), stream)
    records = log.read_stream_log(spark, stream, log.TRIM_HORIZON)
    return _through_files(log.decoded(records, rows.schema), "log-rows")


@query("SELECT event_type, min_value AS value, window_end FROM (" + SLIDE_MIN + ")")
def stream_log_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of a stream written to a message log by a streaming query, then read from the log."""
    target, base = shared_dir(spark, "window-log"), shared_dir(spark, "window-log-run")
    first, last = _parts(spark, sf_dir, "ts", 2)
    for part in (first, _with_marker(last)):
        part.write.mode("append").parquet(f"{base}/landed")
        stream = files.read_parquet_dir(spark, f"{base}/landed", schemas.EVENTS)
        rows = _slid(stream).select("event_type", F.col("min_value").alias("value"), "window_end")
        run.run_to_end(log.write_stream_log(log.log_records(rows, F.col("event_type")), target, f"{base}/checkpoint"))
    return log.decoded(log.read_stream_log(spark, target, log.TRIM_HORIZON, streaming=False), rows.schema)


@query("""
    SELECT c_mktsegment, c_custkey, false AS is_second FROM customer
    UNION ALL SELECT c_mktsegment, -c_custkey, true FROM customer WHERE c_acctbal < 0
""")
def table_increments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table read as it grows: the second run of the stream sees only what was appended after the first."""
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    base = shared_dir(spark, "increments")
    schema = rows.schema
    for step, part in enumerate([rows, rows.filter("c_acctbal < 0").withColumn("c_custkey", -F.col("c_custkey"))]):
        lake.lake_append(part, f"{base}/table", ["c_mktsegment"])
        stream = files.read_table_increments(spark, f"{base}/table", schema)
        marked = stream.select("c_mktsegment", "c_custkey", F.lit(step == 1).alias("is_second"))
        run.run_to_end(sink_files.save(marked, f"{base}/rows", checkpoint=f"{base}/checkpoint"))
    return spark.read.parquet(f"{base}/rows")
