"""Keyed windows over the event table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import scalar
from millrace.operators import windows
from millrace.operators.custom import custom_aggregate
from millrace.plans.registry import plain_bounds, query
from millrace.sources import synth
from millrace.tables import events, table

SLIDE_MIN = """
    SELECT event_type, ws AS window_start, ws + INTERVAL 1 HOUR AS window_end, min(value) AS min_value
    FROM (SELECT event_type, value, time_bucket(INTERVAL 10 MINUTES, ts) - to_minutes(10 * k::BIGINT) AS ws
          FROM events, range(6) t(k))
    GROUP BY ALL
"""


@query(SLIDE_MIN)
def slide_event_min(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Smallest value per event type in one-hour windows every ten minutes."""
    return plain_bounds(windows.window_min(events(spark, sf_dir), "ts", "event_type", "value", "1 hour", "10 minutes"))


TUMBLE_MIN = """
    SELECT user_id, time_bucket(INTERVAL 30 MINUTES, ts) AS window_start,
           time_bucket(INTERVAL 30 MINUTES, ts) + INTERVAL 30 MINUTES AS window_end, min(value) AS min_value
    FROM events GROUP BY ALL
"""


@query(TUMBLE_MIN)
def tumble_event_min(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain_bounds(windows.window_min(events(spark, sf_dir), "ts", "user_id", "value", "30 minutes"))


@query(f"""
    SELECT event_type || ',' || printf('%.2f', min_value) || ',TimeWindow{{start=' || epoch_ms(window_start)
           || ', end=' || epoch_ms(window_end) || '}}' AS line
    FROM ({SLIDE_MIN})
""")
def window_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sliding minimum as text lines."""
    rows = windows.window_min(events(spark, sf_dir), "ts", "event_type", "value", "1 hour", "10 minutes")
    return rows.select(scalar.csv_window("event_type", "min_value", "window_start", "window_end").alias("line"))


def _cents(df: DataFrame) -> DataFrame:
    return df.withColumn("value", F.col("value").cast("decimal(8,2)"))


# Half-up average in whole cents; the values are never negative.
_AVG = """cast(((2 * sum(cents) + count(*)) // (2 * count(*))) / 100 AS DECIMAL(8,2))"""


@query(f"""
    SELECT user_id, time_bucket(INTERVAL 1 DAY, ts) AS window_start,
           time_bucket(INTERVAL 1 DAY, ts) + INTERVAL 1 DAY AS window_end, {_AVG} AS avg_value
    FROM (SELECT user_id, ts, round(value * 100)::BIGINT AS cents FROM events) GROUP BY ALL
""")
def tumble_avg_decimal(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _cents(events(spark, sf_dir))
    return plain_bounds(windows.window_avg_decimal(rows, "ts", "user_id", "value", "1 day", precision=8))


@query(f"""
    SELECT event_type, ws AS window_start, ws + INTERVAL 1 HOUR AS window_end, {_AVG} AS avg_value
    FROM (SELECT event_type, round(value * 100)::BIGINT AS cents,
                 time_bucket(INTERVAL 12 MINUTES, ts) - to_minutes(12 * k::BIGINT) AS ws
          FROM events, range(5) t(k))
    GROUP BY ALL
""")
def slide_avg_decimal(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _cents(events(spark, sf_dir))
    return plain_bounds(
        windows.window_avg_decimal(rows, "ts", "event_type", "value", "1 hour", "12 minutes", precision=8)
    )


def _processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with a stored processing time, so that processing-time windows can be replayed."""
    return events(spark, sf_dir).withColumn(
        "proc_time", F.expr("ts + make_dt_interval(0, 0, cast(event_id % 7 AS int), 0)")
    )


@query("""
    SELECT event_type, time_bucket(INTERVAL 10 MINUTES, p) AS window_start,
           time_bucket(INTERVAL 10 MINUTES, p) + INTERVAL 10 MINUTES AS window_end, min(value) AS min_value
    FROM (SELECT *, ts + to_minutes(event_id % 7) AS p FROM events) GROUP BY ALL
""")
def tumble_proc_min(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain_bounds(
        windows.window_min(_processed(spark, sf_dir), "proc_time", "event_type", "value", "10 minutes")
    )


@query(f"""
    SELECT user_id, ws AS window_start, ws + INTERVAL 1 DAY AS window_end, {_AVG} AS avg_value
    FROM (SELECT user_id, round(value * 100)::BIGINT AS cents,
                 time_bucket(INTERVAL 6 HOURS, ts + to_minutes(event_id % 7)) - to_hours(6 * k::BIGINT) AS ws
          FROM events, range(4) t(k))
    GROUP BY ALL
""")
def slide_proc_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _cents(_processed(spark, sf_dir))
    return plain_bounds(
        windows.window_avg_decimal(rows, "proc_time", "user_id", "value", "1 day", "6 hours", precision=8)
    )


def vehicles(rows: DataFrame) -> DataFrame:
    """Events as vehicle events; sign-ups lack the second reading."""
    k = F.from_json("props", "k bigint")["k"]
    both = F.create_map(F.lit("value"), F.floor("value"), F.lit("k"), k)
    one = F.create_map(F.lit("value"), F.floor("value"))
    return rows.select(
        F.col("user_id").cast("string").alias("vin"),
        "ts",
        F.when(F.col("event_type") == "signup", one).otherwise(both).alias("sensorData"),
        F.array("event_type").alias("warningLights"),
    )


def readings_text(df: DataFrame) -> DataFrame:
    entries = F.array_sort(F.map_entries("averageSensorData"))
    text = F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ",")
    return df.select("vin", "timestamp", text.alias("readings"), "countDistinctWarnings")


VEHICLES = """
    SELECT user_id::VARCHAR AS vin, epoch_ms(time_bucket(INTERVAL 1 DAY, ts)) + 86400000 - 1 AS timestamp,
           CASE WHEN count(*) FILTER (event_type <> 'signup') > 0
                THEN 'k=' || (sum((props->>'$.k')::BIGINT) FILTER (event_type <> 'signup') // count(*)) || ',' ELSE '' END
           || 'value=' || (sum(floor(value)::BIGINT) // count(*)) AS readings,
           count(DISTINCT event_type)::INTEGER AS "countDistinctWarnings"
    FROM events GROUP BY user_id, time_bucket(INTERVAL 1 DAY, ts)
"""


@query(VEHICLES)
def vehicle_window_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Average readings and distinct warnings per vehicle and day."""
    return readings_text(windows.vehicle_window_agg(vehicles(events(spark, sf_dir)), "ts", size="1 day"))


@query("""
    SELECT l_suppkey, min(l_extendedprice) AS cheapest,
           cast(((2 * sum(cents) + count(*)) // (2 * count(*))) / 100 AS DECIMAL(12,2)) AS avg_price
    FROM (SELECT *, round(l_extendedprice * 100)::BIGINT AS cents FROM lineitem) GROUP BY ALL
""")
def mergeable_aggregates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two aggregates built from parts that merge, per supplier."""
    rows = table(spark, sf_dir, "lineitem").select(
        "l_suppkey", "l_extendedprice", F.col("l_extendedprice").cast("decimal(12,2)").alias("price")
    )
    return windows.aggregate_by(
        rows, ["l_suppkey"], [windows.min_of("l_extendedprice", "cheapest"), windows.avg_decimal_of("price", "avg_price", 12)]
    )


@query("SELECT event_type, max(value) - min(value) AS spread, count(*) AS n FROM events GROUP BY ALL")
def custom_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An aggregate given as Python functions: create and add, merge, result."""
    rows = events(spark, sf_dir).select("event_type", "value")
    parts = T.StructType().add("low", "double").add("high", "double").add("n", "long")
    output = T.StructType().add("event_type", "string").add("spread", "double").add("n", "long")

    def add(frame):
        return {"low": frame["value"].min(), "high": frame["value"].max(), "n": len(frame)}

    def merge(frame):
        return {"low": frame["low"].min(), "high": frame["high"].max(), "n": int(frame["n"].sum())}

    def result(frame):
        return frame.assign(spread=frame["high"] - frame["low"])

    return custom_aggregate(rows, ["event_type"], parts, add, merge, result, output)


# The generator's integer steps, written once more in SQL.
def _mixed(salt: int) -> str:
    seeded = f"((event_id % 2147483647 + {salt * 7919 + 1}) % 2147483647 * 48271 % 2147483647)"
    return f"(xor({seeded}, {seeded} >> 15) % 2147483647 * 69621 % 2147483647)"


@query(f"""
    SELECT ticker, time_bucket(INTERVAL 1 HOUR, ts) AS window_start,
           time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end, min(price) AS min_value
    FROM (SELECT ts, ['AAPL', 'AMZN', 'MSFT', 'INTC', 'TBV'][{_mixed(1)} % 5 + 1] AS ticker,
                 ({_mixed(2)} % 9000 + 1000) / 100.0::DOUBLE AS price FROM events)
    GROUP BY ALL
""")
def synth_stock_min(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly minimum over generated stock prices, one per event."""
    prices = synth.stock_rows(events(spark, sf_dir), "event_id", F.col("ts"))
    return plain_bounds(windows.window_min(prices, "event_time", "ticker", "price", "1 hour"))


@query(f"""
    SELECT event_id, printf('V%08d', {_mixed(3)} % 100) AS vin, {_mixed(4)} % 120 AS speed, {_mixed(5)} % 9000 + 1000 AS rpm,
           {_mixed(6)} % 100 AS fuel, ['fuelPressure', 'oilPressure', 'tirePressure'][{_mixed(7)} % 3 + 1] AS light
    FROM events
""")
def synth_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Generated vehicle events, one per event id."""
    rows = synth.vehicle_rows(events(spark, sf_dir), "event_id", F.col("ts"))
    return rows.select(
        "event_id", "vin", *[F.col("sensorData")[k].alias(a) for k, a in [("speed", "speed"), ("rpm", "rpm"), ("fuelLevel", "fuel")]],
        F.col("warningLights")[0].alias("light"),
    )
