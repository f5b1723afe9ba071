import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import durations
from millrace.operators import windows
from millrace.operators.custom import custom_aggregate
from tests.conftest import rows

START = dt.datetime(2024, 1, 1)


def at(seconds):
    return START + dt.timedelta(seconds=seconds)


def frame(spark, data, value="double"):
    df = spark.createDataFrame([(at(s), k, v) for s, k, v in data], f"ts timestamp_ntz, key string, value {value}")
    return df.withColumn("ts", F.col("ts").cast("timestamp"))


def test_min_ignores_nan_unless_alone(spark):
    nan = float("nan")
    df = frame(spark, [(0, "a", nan), (1, "a", 2.0), (2, "a", 1.0), (3, "b", nan), (4, "c", None), (5, "c", 7.0)])
    got = {r.key: r.min_value for r in windows.window_min(df, "ts", "key", "value", "30 seconds").collect()}
    assert got["a"] == 1.0 and got["c"] == 7.0 and math.isnan(got["b"])
    slid = windows.window_min(df, "ts", "key", "value", "30 seconds", "5 seconds").collect()
    assert len(slid) == 6 + 6 + 7  # only c crosses a pane border, at 5 s
    assert all(math.isnan(r.min_value) for r in slid if r.key == "b")


def test_window_edges_are_half_open(spark):
    df = frame(spark, [(0, "a", 1.0), (29.999, "a", 2.0), (30, "a", 3.0)])
    got = rows(windows.window_min(df, "ts", "key", "value", "30 seconds"), F.unix_seconds("window_start") % 60, "min_value")
    assert got == [(0, 1.0), (30, 3.0)]


@pytest.mark.parametrize("size,slide", [(30, 5), (10, 2), (12, 5), (7, 7)])
def test_sliding_min_matches_brute_force(spark, size, slide):
    rng = random.Random(size * 100 + slide)
    data = [(rng.randrange(200_000) / 1000, rng.choice("aab"), float(rng.randrange(100))) for _ in range(300)]
    df = frame(spark, data)
    got = windows.window_min(df, "ts", "key", "value", f"{size} seconds", f"{slide} seconds")
    base = int(START.replace(tzinfo=dt.timezone.utc).timestamp())
    wanted = {}
    for s, k, v in data:
        last = math.floor((base + s) / slide) * slide
        for start in range(last, last - size, -slide):
            if start <= base + s < start + size:
                wanted[k, start] = min(v, wanted.get((k, start), v))
    assert {(r.key, int(r.start)): r.min_value for r in got.select("key", "min_value", F.unix_seconds("window_start").alias("start")).collect()} == wanted


def test_decimal_average_rounds_half_up(spark):
    df = frame(spark, [(0, "a", "1.00"), (1, "a", "1.01"), (2, "b", "-1.00"), (3, "b", "-1.01")], "string")
    df = df.withColumn("value", F.col("value").cast("decimal(6,2)"))
    out = windows.window_avg_decimal(df, "ts", "key", "value", "10 seconds")
    assert dict(out.dtypes)["avg_value"] == "decimal(6,2)"
    assert {r.key: str(r.avg_value) for r in out.collect()} == {"a": "1.01", "b": "-1.01"}


@pytest.mark.parametrize("precision", [8, 12])
def test_decimal_average_of_nulls_and_wide_columns(spark, precision):
    df = frame(spark, [(0, "a", None), (1, "b", None), (2, "b", "3.33"), (3, "b", "3.34")], "string")
    df = df.withColumn("value", F.col("value").cast(f"decimal({precision},2)"))
    out = windows.window_avg_decimal(df, "ts", "key", "value", "10 seconds", "5 seconds", precision=precision)
    assert {(r.key, str(r.avg_value)) for r in out.collect()} == {("a", "None"), ("b", "3.34")}


def test_vehicle_average_divides_by_events(spark):
    schema = "vin string, ts timestamp_ntz, sensorData map<string,bigint>, warningLights array<string>"
    data = [
        ("v", at(0), {"speed": 10, "rpm": 1000}, ["oil", "oil"]),
        ("v", at(1), {"speed": 11}, ["tire"]),
        ("v", at(2), {"speed": 12, "rpm": -1001}, []),
        ("v", at(11), None, None),
        ("v", at(21), {}, [None, "oil", None]),
        ("w", at(3), {}, ["oil"]),
    ]
    df = spark.createDataFrame(data, schema).withColumn("ts", F.col("ts").cast("timestamp"))
    got = {(r.vin, r.timestamp % 60000): (r.averageSensorData, r.countDistinctWarnings)
           for r in windows.vehicle_window_agg(df, "ts").collect()}
    assert got == {
        ("v", 9999): ({"speed": 11, "rpm": 0}, 2),  # -1 div 3 drops towards zero
        ("v", 19999): ({}, 0),
        ("v", 29999): ({}, 2),
        ("w", 9999): ({}, 1),
    }


def test_custom_aggregate_merges_parts(spark):
    df = spark.range(0, 10_000, 1, 7).select(F.when(F.col("id") < 9000, "hot").otherwise("cold").alias("k"), F.col("id").alias("v"))
    state = T.StructType().add("s", "long").add("n", "long")
    out = T.StructType().add("k", "string").add("mean", "double")
    got = custom_aggregate(
        df, ["k"], state,
        lambda f: {"s": int(f.v.sum()), "n": len(f)},
        lambda f: {"s": int(f.s.sum()), "n": int(f.n.sum())},
        lambda f: f.assign(mean=f.s / f.n), out,
    )
    assert rows(got) == [("cold", 9499.5), ("hot", 4499.5)]


def test_durations():
    assert durations.micros("1 hour 30 minutes") == 5_400_000_000
    for bad in ("", "5", "1 month"):
        with pytest.raises(ValueError):
            durations.micros(bad)
