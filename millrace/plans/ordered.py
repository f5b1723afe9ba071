"""Results that depend on the order of rows within a key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import ordered
from millrace.plans.registry import query
from millrace.tables import events


@query("""
    SELECT event_id, event_type, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS total_count FROM events
""")
def running_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event with its number within its type."""
    rows = events(spark, sf_dir).select("event_id", "event_type")
    return ordered.running_count(rows, ["event_type"], ["event_id"])


@query("""
    SELECT event_type, round(sum(0.1::DOUBLE * value * pow(0.9::DOUBLE, rn - 1)), 6) AS ema
    FROM (SELECT event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY event_id DESC) AS rn FROM events)
    GROUP BY event_type
""")
def ema_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decaying average per event type after its last event."""
    rows = ordered.ema_last(events(spark, sf_dir), ["event_type"], ["event_id"], "value")
    return rows.withColumn("ema", F.round("ema", 6))


def _arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in a shuffled order of arrival."""
    arrival = F.col("event_id") + F.col("event_id") * 7919 % 800
    return events(spark, sf_dir).select("event_id", "user_id", "ts", arrival.alias("arrival"))


def _late_sql(partition: str) -> str:
    return f"""
        SELECT event_id, user_id,
               coalesce(time_bucket(INTERVAL 1 DAY, ts) + INTERVAL 1 DAY <= seen - INTERVAL 10 MINUTES, false) AS is_late
        FROM (SELECT *, max(ts) OVER ({partition} ORDER BY event_id + event_id * 7919 % 800, event_id
                                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM events)
    """


@query(_late_sql("PARTITION BY user_id"))
def late_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which events arrive after their day has closed, with a watermark per user."""
    marked = ordered.late_split(_arrivals(spark, sf_dir), "ts", ["arrival", "event_id"], "1 day", "10 minutes", ["user_id"])
    return marked.select("event_id", "user_id", "is_late")


@query(_late_sql(""))
def late_split_single_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with one watermark for all events."""
    marked = ordered.late_split(_arrivals(spark, sf_dir), "ts", ["arrival", "event_id"], "1 day", "10 minutes")
    return marked.select("event_id", "user_id", "is_late")


@query("""
    SELECT event_type, user_id::VARCHAR AS user_id, chunk, count(*) AS n,
           string_agg(printf('%d:%.2f', epoch_us(ts) // 1000, value), ' ' ORDER BY ts, event_id) AS samples
    FROM (SELECT *, (row_number() OVER (PARTITION BY event_type, user_id ORDER BY ts, event_id) - 1) // 5 AS chunk FROM events)
    GROUP BY event_type, user_id, chunk
""")
def group_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One time series per event type and user, in chunks of five samples."""
    series = ordered.group_samples(
        events(spark, sf_dir), "value", ["event_type", "user_id"], "ts", "value", ["event_id"], size=5
    )
    text = F.transform("samples", lambda s: F.format_string("%d:%.2f", F.unix_millis(s["ts"]), s["value"]))
    return series.select(
        F.col("labels")["event_type"].alias("event_type"), F.col("labels")["user_id"].alias("user_id"), "chunk",
        F.size("samples").cast("long").alias("n"), F.array_join(text, " ").alias("samples"),
    )
