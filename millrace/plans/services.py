"""Work that goes through a client. The clients here are stand-ins with fixed answers; the work grows with the table."""

from __future__ import annotations

import json
import uuid

import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.udfs import service_column
from millrace.operators import enrich, ordered
from millrace.functions import scalar
from millrace.plans.registry import query
from millrace.plans.streams import event_stream
from millrace.session import shared_dir
from millrace.sinks import service
from millrace.streaming import run
from millrace.tables import events


class Answers:
    """Answers by event type: a click fails once, a view times out in the client once, an error always fails, and a sign-up
    gives up after the client's own time-out each time."""

    def __init__(self):
        self.seen: set[int] = set()

    def __call__(self, row: dict, remaining: float) -> int:
        kind = row["event_type"]
        if kind == "signup":
            raise TimeoutError
        if kind == "view" and row["event_id"] not in self.seen:
            self.seen.add(row["event_id"])
            raise TimeoutError
        if kind == "error":
            return 500
        if kind == "click" and row["event_id"] not in self.seen:
            self.seen.add(row["event_id"])
            return 500
        self.seen.discard(row["event_id"])
        return 200


@query("""
    SELECT event_id, event_type, CASE WHEN event_type IN ('error', 'signup') THEN 'FAILED' ELSE 'OK' END AS status,
           CASE event_type WHEN 'error' THEN 500 WHEN 'signup' THEN -1 ELSE 200 END::INTEGER AS code,
           CASE WHEN event_type IN ('click', 'view') THEN 2 WHEN event_type IN ('error', 'signup') THEN 3 ELSE 1 END::INTEGER AS attempts
    FROM events
""")
def async_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event asked for at a service, with retries; failures and timeouts are kept as dead letters."""
    rows = events(spark, sf_dir).select("event_id", "event_type")
    return enrich.enrich(
        rows, Answers, capacity=16, timeout=60.0, pause=0.0, on_error=enrich.DEAD_LETTER, on_timeout=enrich.DEAD_LETTER
    )


@query("SELECT event_type AS message, count(*) AS n FROM events WHERE event_type NOT IN ('error', 'signup') GROUP BY event_type")
def enrich_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only rows that got an answer go on."""
    rows = events(spark, sf_dir).select("event_id", "event_type", F.col("event_type").alias("message"))
    answers = enrich.enrich(rows, Answers, capacity=16, timeout=60.0, pause=0.0, on_error=enrich.DROP)
    return enrich.enriched_messages(answers).groupBy("message").agg(F.count(F.lit(1)).alias("n"))


class Facts:
    def __call__(self, number: int) -> str:
        if number > 90:
            raise ValueError("too large")
        return f"fact about {number}"


@query("""
    SELECT event_id, CASE WHEN floor(value) > 90 THEN 'ERROR: Can''t invoke facts  Reason: too large'
                          ELSE 'fact about ' || floor(value)::INTEGER END AS fun_fact FROM events
""")
def service_udf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A text column from a service; errors become text."""
    rows = events(spark, sf_dir).select("event_id", F.floor("value").cast("int").alias("a_number"))
    return service_column(rows, "a_number", "fun_fact", Facts, "facts").drop("a_number")


class Recording:
    """Takes every record it does not refuse and notes it in a shared folder as a line of JSON."""

    def __init__(self, folder: str, refused: str | None = None):
        self.store, base = pyarrow.fs.FileSystem.from_uri(folder)
        self.refused, self.path = refused, f"{base}/{uuid.uuid4().hex}.json"
        self.store.create_dir(base, recursive=True)

    def put(self, records: list[dict]) -> list[int]:
        failed = [i for i, r in enumerate(records) if self.refused and dict(r["labels"])["event_type"] == self.refused]
        taken = [json.dumps(r, default=_plain) for i, r in enumerate(records) if i not in failed]
        with self.store.open_append_stream(self.path) as out:
            out.write("".join(f"{line}\n" for line in taken).encode())
        return failed


def _plain(value) -> str:
    return value.isoformat()


_PAYLOAD = T.StructType().add("event_id", "long").add("event_type", "string").add("value", "double")


def _noted(spark: SparkSession, folder: str) -> DataFrame:
    """What the service was sent, decoded from the payloads."""
    sent = spark.read.schema("key string, data string").json(folder)
    return sent.select(scalar.json_decode("data", _PAYLOAD).alias("row")).select("row.*")


@query("SELECT event_id, event_type, value FROM events")
def delivery_stream_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events through a stream into a delivery service; the rows are read from what it was sent."""
    folder, base = shared_dir(spark, "delivered"), shared_dir(spark, "delivery")
    rows = event_stream(spark, sf_dir).select("event_id", "event_type", "value")
    run.run_to_end(run.to_service(rows, service.write_delivery_stream, lambda: Recording(folder), f"{base}/checkpoint"))
    return _noted(spark, folder)


@query("SELECT event_id, event_type, value FROM events WHERE value > 50")
def queue_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same into a queue, from a batch."""
    folder = shared_dir(spark, "queued")
    rows = events(spark, sf_dir).filter("value > 50").select("event_id", "event_type", "value")
    service.write_queue(rows, lambda: Recording(folder))
    return _noted(spark, folder)


@query("""
    SELECT event_type, user_id::VARCHAR AS user_id, (n - 1) // 500 AS chunk, count(*) AS n, round(sum(value), 4) AS total
    FROM (SELECT *, row_number() OVER (PARTITION BY event_type, user_id ORDER BY ts, event_id) AS n FROM events)
    WHERE event_type <> 'error' GROUP BY ALL
""")
def metric_samples_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Series of samples sent in order; what the endpoint keeps refusing is discarded. The rest is read from what it took."""
    folder = shared_dir(spark, "samples")
    series = ordered.group_samples(
        events(spark, sf_dir), "value", ["event_type", "user_id"], "ts", "value", ["event_id"], size=500
    )
    labelled = series.withColumn("event_type", F.col("labels")["event_type"]).withColumn("user_id", F.col("labels")["user_id"])
    service.write_metric_samples(labelled, lambda: Recording(folder, "error"), attempts=2)
    sent = spark.read.schema("event_type string, user_id string, chunk bigint, samples array<struct<value:double>>").json(folder)
    total = F.aggregate("samples", F.lit(0.0), lambda a, s: a + s["value"])
    return sent.select("event_type", "user_id", "chunk", F.size("samples").cast("long").alias("n"), F.round(total, 4).alias("total"))
