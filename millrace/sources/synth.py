"""Deterministic synthetic records: one per input row, computed from its id, so a table of any size gives as many."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The vocabularies and ranges of the record kinds.
TICKERS = ["AAPL", "AMZN", "MSFT", "INTC", "TBV"]
LIGHTS = ["fuelPressure", "oilPressure", "tirePressure"]
ROOMS = ["room1", "room2", "room3", "room4", "room5"]
_PRIME = 2147483647


def mixed(id: Column, salt: int) -> Column:
    """A number in [0, 2**31 - 1) from an id and a salt, by two multiplicative steps with a shift between."""
    seeded = F.pmod(F.pmod(id.cast("long"), F.lit(_PRIME)) + F.lit(salt * 7919 + 1), F.lit(_PRIME))
    first = F.pmod(seeded * F.lit(48271), F.lit(_PRIME))
    shifted = first.bitwiseXOR(F.shiftright(first, 15))
    return F.pmod(F.pmod(shifted, F.lit(_PRIME)) * F.lit(69621), F.lit(_PRIME))


def below(id: Column, salt: int, bound: int) -> Column:
    return F.pmod(mixed(id, salt), F.lit(bound))


def pick(id: Column, salt: int, values: Sequence[str]) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (below(id, salt, len(values)) + 1).cast("int"))


def stock_rows(df: DataFrame, id: str, ts: Column) -> DataFrame:
    """event_time, ticker, price in [10, 100) with two decimals."""
    key = F.col(id)
    return df.select(
        key, ts.alias("event_time"), pick(key, 1, TICKERS).alias("ticker"),
        ((below(key, 2, 9000) + 1000) / 100.0).alias("price"),
    )


def vehicle_rows(df: DataFrame, id: str, ts: Column) -> DataFrame:
    """vin, event time, three sensor readings, one warning light."""
    key = F.col(id)
    return df.select(
        key,
        F.format_string("V%08d", below(key, 3, 100)).alias("vin"),
        ts.alias("event_time"),
        F.create_map(
            F.lit("speed"), below(key, 4, 120), F.lit("rpm"), below(key, 5, 9000) + 1000, F.lit("fuelLevel"), below(key, 6, 100)
        ).alias("sensorData"),
        F.array(pick(key, 7, LIGHTS)).alias("warningLights"),
    )


def sensor_rows(df: DataFrame, id: str, ts: Column) -> DataFrame:
    """sensor_id in 10..20, temperature in [0, 100] with two decimals, measurement time."""
    key = F.col(id)
    return df.select(
        key, (below(key, 8, 11) + 10).cast("int").alias("sensor_id"),
        (below(key, 9, 10001) / 100.0).cast("decimal(6,2)").alias("temperature"), ts.alias("measurement_time"),
    )


def temperature_rows(df: DataFrame, id: str, ts: Column) -> DataFrame:
    """roomId, sensorId (ten per room), epoch milliseconds, temperature in [20, 30)."""
    key = F.col(id)
    room = below(key, 10, 100)
    return df.select(
        key, F.format_string("R%05d", room).alias("roomId"),
        F.format_string("S%09d", below(key, 11, 10) + room * 100).alias("sensorId"),
        F.unix_millis(ts).alias("timestamp"), (below(key, 12, 1000) / 100.0 + 20).alias("temperature"),
    )


def room_rows(df: DataFrame, id: str, ts: Column) -> DataFrame:
    """sensorId in 0..99, room, temperature in [18, 30), sample time."""
    key = F.col(id)
    return df.select(
        key, below(key, 19, 100).cast("int").alias("sensorId"), pick(key, 20, ROOMS).alias("room"),
        (below(key, 21, 1200) / 100.0 + 18).cast("float").alias("temperature"), ts.alias("sampleTime"),
    )


def matrix_rows(df: DataFrame, id: str, ts: Column) -> DataFrame:
    """Four matrix elements in [0, 100)."""
    key = F.col(id)
    elements = [(below(key, 21 + i, 10000) / 100.0).cast("float").alias(f"element{i}") for i in range(1, 5)]
    return df.select(key, ts.alias("seed_time"), *elements)


def trade_rows(df: DataFrame, id: str, ts: Column) -> DataFrame:
    """Trades with side, symbol, price and number of shares."""
    key = F.col(id)
    return df.select(
        key, F.format_string("T%012d", key).alias("tradeId"), F.format_string("A%06d", below(key, 13, 1000)).alias("accountNr"),
        ts.alias("executionTime"), pick(key, 14, ["BUY", "SELL"]).alias("buySell"), pick(key, 15, TICKERS).alias("symbol"),
        (below(key, 16, 50000) / 100.0).cast("decimal(8,2)").alias("price"), (below(key, 17, 100) + 1).cast("int").alias("shares"),
    )


def message_rows(df: DataFrame, id: str, poison_one_in: int = 10) -> DataFrame:
    key = F.col(id)
    return df.select(key, F.when(below(key, 18, poison_one_in) == 0, "Poison").otherwise("Hello World").alias("message"))


def ids(spark: SparkSession, rows: int, partitions: int | None = None) -> DataFrame:
    """Ids 0..rows-1 to generate from, spread over partitions."""
    return spark.range(0, rows, 1, partitions)


def rate_stream(spark: SparkSession, rows_per_second: int) -> DataFrame:
    """An endless stream of ids with a timestamp, to generate from."""
    stream = spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()
    return stream.select(F.col("value").alias("id"), "timestamp")
