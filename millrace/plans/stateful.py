"""Streaming runs with state and timers, each over several micro-batches that land one after the other."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.project import observed_counts
from millrace.plans.changes import _COLUMNS, _CURRENT, _DECODED, _key_value_changes, order_changes
from millrace.plans.ordered import _arrivals, _late_sql
from millrace.plans.registry import plain_bounds, query
from millrace.plans.streams import END_OF_TIME, _flushed, _parts
from millrace.plans.windows import VEHICLES, readings_text, vehicles
from millrace.session import shared_dir
from millrace.sinks import files as sink_files
from millrace.sinks import lake
from millrace.sources import cdc, files, log
from millrace.streaming import registry, run, state, tables, totals, windows
from millrace.tables import table


def landed(base: str, parts: list[DataFrame], each: Callable[[DataFrame], None]) -> None:
    """Land one part after the other, and let ``each`` run a query over the stream of the landed files to its end."""
    for part in parts:
        part.write.mode("append").parquet(f"{base}/landed")
        each(files.read_parquet_dir(part.sparkSession, f"{base}/landed", part.schema))


# --- tables kept by streams ---------------------------------------------------------------------------------------------


@query(_CURRENT)
def stream_current_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The current orders from a stream of changes that come late, in the wrong order and twice.

    First come the last changes of half the orders, then their inserts (for removed orders: after the removal) with the changes
    of the others, and at the end all changes once more.
    """
    bucket = F.pmod(F.hash("o_orderkey"), F.lit(8)).alias("bucket")
    changes = order_changes(spark, sf_dir).select(*_COLUMNS, "op", "op_ts", "seq", bucket)
    early = (F.pmod("o_orderkey", F.lit(2)) == 0) == (F.col("seq") > 0)
    base, keys = shared_dir(spark, "current-orders"), ["o_orderkey", "bucket"]

    def keep(stream: DataFrame) -> None:
        run.run_to_end(tables.current_table(stream, f"{base}/table", keys, ["bucket"], ["op_ts", "seq"], f"{base}/checkpoint"))

    landed(base, [changes.filter(early), changes.filter(~early), changes], keep)
    return lake.lake_table(spark, f"{base}/table", ["bucket"]).select(*_COLUMNS)


@query("""
    SELECT c_custkey, CASE WHEN c_nationkey < 10 THEN c_acctbal + 2 WHEN c_nationkey < 20 THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal,
           c_mktsegment FROM customer
""")
def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers upserted by three micro-batches; within one the higher step wins."""
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_mktsegment", "c_nationkey")
    step = lambda n, some: some.withColumn("c_acctbal", F.col("c_acctbal") + n).select(
        "c_custkey", "c_acctbal", "c_mktsegment", F.lit(n).alias("step")
    )
    some, few = rows.filter("c_nationkey < 20"), rows.filter("c_nationkey < 10")
    base, keys = shared_dir(spark, "stream-upsert"), ["c_custkey", "c_mktsegment"]

    def keep(stream: DataFrame) -> None:
        run.run_to_end(tables.upsert_stream(stream, f"{base}/table", keys, ["c_mktsegment"], ["step"], f"{base}/checkpoint"))

    landed(base, [step(0, rows), step(1, some).unionByName(step(0, some)), step(2, few)], keep)
    return lake.lake_table(spark, f"{base}/table", ["c_mktsegment"]).drop("step")


@query("SELECT event_id, event_type, value FROM events")
def stream_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events appended to a table by three micro-batches."""
    base = shared_dir(spark, "stream-append")

    def keep(stream: DataFrame) -> None:
        rows = stream.select("event_id", "event_type", "value")
        run.run_to_end(tables.append_stream(rows, f"{base}/table", ["event_type"], f"{base}/checkpoint"))

    landed(base, _parts(spark, sf_dir, "event_id", 3), keep)
    return lake.lake_table(spark, f"{base}/table", ["event_type"])


# --- windows by the clock, whole windows, series, late rows -----------------------------------------------------------------


@query("""
    SELECT 'tumbling' AS kind, event_type, count(*) AS n, min(value) AS low, max(value) AS high FROM events GROUP BY event_type
    UNION ALL SELECT 'sliding', event_type, 2 * count(*), min(value), max(value) FROM events GROUP BY event_type
""")
def stream_proc_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of processing time, closed by the clock: each event is in one tumbling and in two sliding windows."""
    base = shared_dir(spark, "proc-windows")
    parts = [windows.Part("n", "count"), windows.Part("low", "min", "value"), windows.Part("high", "max", "value")]
    kinds = {"tumbling": (None, 1), "sliding": ("1 second", 2)}
    found = []
    rows = table(spark, sf_dir, "events").select("event_type", "value")
    rows.write.parquet(f"{base}/landed")
    expected = rows.count()
    for kind, (slide, times) in kinds.items():
        stream = files.read_parquet_dir(spark, f"{base}/landed", rows.schema)
        closed = windows.proc_time_windows(stream, ["event_type"], "2 seconds", parts, slide)
        writer = sink_files.save(closed, f"{base}/{kind}", checkpoint=f"{base}/{kind}-checkpoint")
        out = spark.read.schema(closed.schema)

        def done(path: str = f"{base}/{kind}", wanted: int = times * expected, out=out) -> bool:
            return sink_files.streamed(spark, path) and out.parquet(path).agg(F.sum("n")).first()[0] == wanted

        run.run_until(writer, done)
        found.append(out.parquet(f"{base}/{kind}").withColumn("kind", F.lit(kind)))
    every = found[0].unionByName(found[1])
    return every.groupBy("kind", "event_type").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))


@query(VEHICLES)
def stream_vehicle_process(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vehicle aggregate as a function of whole windows, called as the watermark closes them."""

    def processed(stream: DataFrame) -> DataFrame:
        rows = stream.withColumn("ts", F.col("ts").cast("timestamp"))
        return readings_text(windows.vehicle_window_process(vehicles(rows), "ts", size="1 day"))

    return _flushed(spark, sf_dir, processed, "vehicle-process", steps=3)


@query("""
    SELECT event_type, user_id::VARCHAR AS user_id, count(*) AS n,
           string_agg(printf('%d:%.2f', epoch_us(ts) // 1000, value), ' ' ORDER BY ts, event_id) AS samples
    FROM events GROUP BY event_type, user_id
""")
def stream_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Series of samples in event-time order from three micro-batches; chunks in the order of their numbers."""

    def ordered(stream: DataFrame) -> DataFrame:
        rows = stream.withColumn("ts", F.col("ts").cast("timestamp"))
        return windows.series_in_order(
            rows, "value", ["event_type", "user_id"], "ts", "value", "10 minutes", ["event_id"], stretch="30 days", size=5
        )

    chunks = _flushed(spark, sf_dir, ordered, "series", steps=3).filter(~F.col("late"))
    text = F.transform("samples", lambda s: F.format_string("%d:%.2f", F.unix_millis(s["ts"]), s["value"]))
    some = chunks.select(
        F.col("labels")["event_type"].alias("event_type"), F.col("labels")["user_id"].alias("user_id"), "chunk",
        F.size("samples").cast("long").alias("n"), F.array_join(text, " ").alias("text"),
    )
    in_order = F.transform(F.array_sort(F.collect_list(F.struct("chunk", "text"))), lambda c: c["text"])
    return some.groupBy("event_type", "user_id").agg(F.sum("n").alias("n"), F.array_join(in_order, " ").alias("samples"))


@query(_late_sql("PARTITION BY user_id"))
def stream_late_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which events come after their day has closed, with a watermark per user over three micro-batches, as two outputs."""
    rows = _arrivals(spark, sf_dir)
    low, high = rows.agg(F.min("arrival"), F.max("arrival")).first()
    part = F.least(F.floor((F.col("arrival") - (low or 0)) * 3 / max(1, (high or 0) - (low or 0))), F.lit(2))
    base = shared_dir(spark, "late-split")

    def split(stream: DataFrame) -> None:
        marked = windows.late_rows(stream, "ts", ["arrival", "event_id"], "1 day", "10 minutes", ["user_id"])
        sinks = {
            kind: lambda some, n, kind=kind, late=late: some.filter(F.col("is_late") == late)
            .select("event_id", "user_id", "is_late").write.mode("overwrite").parquet(f"{base}/{kind}/batch={n}")
            for kind, late in (("on-time", False), ("late", True))
        }
        run.run_to_end(run.multi_sink(marked, sinks, f"{base}/checkpoint"))

    landed(base, [rows.filter(part == i) for i in range(3)], split)
    return spark.read.parquet(f"{base}/on-time").unionByName(spark.read.parquet(f"{base}/late")).drop("batch")


@query("""
    SELECT event_type, round(sum(0.1::DOUBLE * value * pow(0.9::DOUBLE, rn - 1)), 6) AS ema
    FROM (SELECT event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY event_id DESC) AS rn FROM events)
    GROUP BY event_type
""")
def stream_gauge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The decaying average per event type after each of two micro-batches; the files of one hold ranges of ids."""
    base = shared_dir(spark, "gauge")
    parts = [p.repartitionByRange("event_id").sortWithinPartitions("event_id") for p in _parts(spark, sf_dir, "event_id", 2)]

    def gauge(stream: DataFrame) -> None:
        rows = stream.select("event_id", "event_type", "value", F.col("_metadata.file_name").alias("file"))
        averages = state.keyed_average(rows, "event_type", "value", order="event_id", run="file")

        def write(some: DataFrame, n: int) -> None:
            some.withColumn("at", F.monotonically_increasing_id()).write.mode("overwrite").parquet(f"{base}/rows/batch={n}")

        run.run_to_end(run.each_batch(averages, write, f"{base}/checkpoint"))

    landed(base, parts, gauge)
    last = F.max_by("ema", F.struct("batch", "at")).alias("ema")
    return spark.read.parquet(f"{base}/rows").groupBy("event_type").agg(last).withColumn("ema", F.round("ema", 6))


# --- change records, registered schemas, totals -----------------------------------------------------------------------------


@query(f"""
    SELECT "eventType", time_bucket(INTERVAL 7 DAYS, timestamp) AS window_start,
           time_bucket(INTERVAL 7 DAYS, timestamp) + INTERVAL 7 DAYS AS window_end, count(*) AS n, count(new_price) AS n_new
    FROM ({_DECODED}) GROUP BY ALL
""")
def stream_change_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change records landed in the order of their time, decoded and counted per week under the ascending watermark."""
    base = shared_dir(spark, "change-windows")
    raw = _key_value_changes(spark, sf_dir)
    day = F.unix_date(F.col("created").cast("date"))
    low, high = (x or 0 for x in raw.agg(F.min(day), F.max(day)).first())
    part = F.coalesce(F.least(F.floor((day - low) * 2 / max(1, high - low)), F.lit(1)), F.lit(0))
    end = raw.limit(1).select(
        F.lit("REMOVE").alias("eventName"), F.lit(END_OF_TIME).cast("timestamp").alias("created"), "oldImage", "newImage"
    )
    found = []
    for some in (raw.filter(part == 0), raw.filter(part == 1).unionByName(end)):
        log.write_stream_log(log.log_records(some, F.col("newImage")["partition-key"]), f"{base}/landed")
        changes = cdc.read_change_stream(log.read_stream_log(spark, f"{base}/landed", log.TRIM_HORIZON), raw.schema["newImage"].dataType)
        week = F.window("timestamp", "7 days", startTime="4 days")
        counted = changes.groupBy(week.alias("w"), "eventType").agg(F.count(F.lit(1)).alias("n"), F.count("newItem").alias("n_new"))
        out = plain_bounds(counted.select("eventType", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "n", "n_new"))
        run.run_to_end(sink_files.save(out, f"{base}/rows", checkpoint=f"{base}/checkpoint"))
        found = out.schema
    return spark.read.schema(found).parquet(f"{base}/rows")


@query("""
    SELECT c_custkey, c_name, c_acctbal, CASE WHEN c_nationkey < 12 THEN 'none' ELSE c_mktsegment END AS segment FROM customer
""")
def stream_registry_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers under two registered schemas, the second registered while the query is stopped between two micro-batches."""
    base = shared_dir(spark, "registry")
    known = registry.Registry(spark, f"{base}/schemas")
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal", F.col("c_mktsegment").alias("segment"), "c_nationkey")
    reader = rows.drop("c_nationkey").schema
    first, defaults = T.StructType(reader.fields[:3]), {"segment": "none"}
    steps = [(first, rows.filter("c_nationkey < 12").select("c_custkey", "c_name", "c_acctbal")),
             (reader, rows.filter("c_nationkey >= 12").drop("c_nationkey"))]

    def sink(some: DataFrame, n: int) -> None:
        some.write.mode("overwrite").parquet(f"{base}/rows/batch={n}")

    for schema, some in steps:
        version = known.register("customer", schema, defaults)
        registry.encoded(some, version).write.mode("append").parquet(f"{base}/landed")
        stream = files.read_parquet_dir(spark, f"{base}/landed", T.StructType().add("value", "binary"))
        run.run_to_end(registry.decoded_stream(stream, known, "customer", reader, sink, f"{base}/checkpoint", defaults=defaults))
    return spark.read.parquet(f"{base}/rows").drop("batch")


@query("""
    SELECT 'received' AS metric, count(*) AS total FROM events UNION ALL SELECT 'filtered', count(*) FROM events WHERE value > 50
""")
def stream_row_counter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows before and after a filter, added up over two runs of a query by two listeners."""
    base = shared_dir(spark, "row-counter")
    found = {}

    def count(stream: DataFrame) -> None:
        listener = totals.RunningTotals(spark, f"{base}/totals")
        spark.streams.addListener(listener)
        try:
            kept = observed_counts(stream, F.col("value") > 50)
            done = run.run_to_end(sink_files.save(kept, f"{base}/rows", checkpoint=f"{base}/checkpoint"))
            listener.settle()
            found.update(listener.totals(done))
        finally:
            spark.streams.removeListener(listener)

    landed(base, _parts(spark, sf_dir, "event_id", 2), count)
    return spark.createDataFrame([(name, sums["total"]) for name, sums in found.items()], "metric string, total bigint")


