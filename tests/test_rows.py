import datetime as dt

import pytest
import xxhash
from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import schemas
from millrace.functions import scalar, udfs
from millrace.operators import project, windows
from millrace.sources import kafka, synth
from tests.conftest import JOB_ERRORS, rows


def _hash(key: bytes) -> int:
    h = 1
    for b in key:
        h = (h * 31 + (b - 256 if b > 127 else b)) & 0xFFFFFFFF
    return h - 2**32 if h >= 2**31 else h


def test_keys_of_the_output(spark):
    """The hashed key is XXH64 with seed 42 of the number's eight bytes; random keys are all different."""
    ids = spark.range(2000).select((F.col("id") - 3).alias("id"))
    got = ids.select("id", scalar.key_of_hash("id").alias("hashed"), scalar.key_random().alias("random")).collect()
    for r in got:
        value = xxhash.xxh64_intdigest(r.id.to_bytes(8, "little", signed=True), 42)
        assert int(r.hashed) == value - (value >> 63 << 64)
    assert len({r.random for r in got}) == 2000


def test_hash_partition(spark):
    keys = ["", "room1", "Zürich", "日本", "a" * 100]
    df = spark.createDataFrame([(k,) for k in keys] + [(None,)], "key string")
    got = {r.key: (r.h, r.p) for r in df.select("key", scalar.byte_hash("key").alias("h"), scalar.hash_partition("key", 7).alias("p")).collect()}
    for k in keys:
        assert got[k] == (_hash(k.encode()), abs(_hash(k.encode())) % 7)
    assert got[None][1] == 0


def test_smallest_hash_has_a_partition(spark):
    # 31**n of the seed plus the bytes as digits of base 31, for the shortest length that fits.
    target = 2**31
    want = None
    for n in range(1, 9):
        rest = (target - pow(31, n, 2**32)) % 2**32
        out, r = [], rest
        for _ in range(n):
            out.append(r % 31)
            r //= 31
        if r == 0:
            want = bytes(reversed(out))
            break
    assert want is not None and _hash(want) == -(2**31)
    df = spark.createDataFrame([(bytearray(want),)], "key binary")
    assert df.select(scalar.hash_partition("key", 7)).first()[0] == 2**31 % 7


def test_outcome_and_split(spark):
    df = spark.createDataFrame([("Poison",), ("poison",), (None,), ("",)], "message string")
    main, dead = project.split_streams(df, "message")
    assert rows(dead) == [("Poison", "ERROR")]
    assert rows(main) == sorted([("poison", "SUCCESS"), (None, "SUCCESS"), ("", "SUCCESS")], key=repr)


def test_lenient_and_strict_json(spark):
    text = ['{"user":"a","message":"m","ts":"2024-01-01T00:00:00.000"}', "not json", '{"user":1}', '{"user":"b","extra":1}', "", None, '{"ts":"x"}']
    df = spark.createDataFrame([(t,) for t in text], "value string")
    got = rows(kafka.lenient_json_rows(df, schemas.USER_MESSAGE, iso=True))
    assert ("a", "m", dt.datetime(2024, 1, 1)) in got and ("b", None, None) in got
    assert all(r[0] in ("a", "b", "1") for r in got)
    with pytest.raises(JOB_ERRORS):
        kafka.json_rows(df, schemas.USER_MESSAGE).collect()


def test_json_keeps_nulls(spark):
    df = spark.createDataFrame([(1, None)], "a int, b string")
    assert df.select(scalar.json_encode()).first()[0] == '{"a":1,"b":null}'


def test_price_is_rounded_half_up_once(spark):
    df = spark.createDataFrame([(1.005, 0.0), (2.675, 0.0), (0.001, 0.0), (100.0, -5.0)], "base double, pct double")
    got = [str(r[0]) for r in df.select(scalar.price_after_change("base", "pct")).collect()]
    assert got == ["1.01", "2.68", "0.01", "95.00"]


def test_enum_value(spark):
    df = spark.createDataFrame([("BUY",), (None,)], "side string")
    assert rows(df.select(scalar.enum_value("side", ["BUY", "SELL"]))) == [("BUY",), (None,)]
    with pytest.raises(JOB_ERRORS):
        spark.createDataFrame([("HOLD",)], "side string").select(scalar.enum_value("side", ["BUY", "SELL"])).collect()


def test_schema_evolution_rules(spark):
    df = spark.createDataFrame([(1, "x", 9)], "id int, name string, gone int")
    reader = T.StructType().add("id", "long").add("name", "string").add("note", "string")
    assert rows(project.evolve_to(df, reader)) == [(1, "x", None)]
    with pytest.raises(ValueError):
        project.evolve_to(df, T.StructType().add("id", "long").add("must", "string", False))
    with pytest.raises(ValueError):
        project.evolve_to(df, T.StructType().add("name", "integer"))


def test_versions_of_a_value(spark):
    old, new = T.StructType().add("id", "integer"), T.StructType().add("id", "long").add("tag", "string").add("gone", "long")
    reader = T.StructType().add("id", "long").add("tag", "string", False)
    data = [(1, '{"id":1}'), (2, '{"id":2,"tag":"b","gone":0}')]
    df = spark.createDataFrame(data, "v int, value string")
    read = lambda d: project.decode_versions(d, "value", "v", {1: old, 2: new}, reader, {"tag": "none"})
    assert rows(read(df)) == [(1, "none"), (2, "b")]
    for bad in [(3, "{}"), (None, "{}"), (1, '{"id":"x"}')]:
        with pytest.raises(JOB_ERRORS):
            read(spark.createDataFrame([bad], "v int, value string")).collect()
    assert project.compatibility(new, T.StructType().add("id", "integer").add("must", "long", False)) == [
        "id: bigint cannot be read as int", "must: required, but neither written nor given a default"
    ]


def test_insert_by_position_needs_equal_width(spark):
    with pytest.raises(ValueError):
        project.insert_by_position(spark.range(1), T.StructType().add("a", "long").add("b", "long"))


def test_unpack_fails_on_bad_record(spark):
    schema = T.StructType().add("n", "long")
    good = spark.createDataFrame([(1, '{"n":1}\n{"n":2}\n')], "id int, text string")
    assert rows(project.unpack_batches(good, project.ndjson("text"), schema, ["id"])) == [(1, 1), (1, 2)]
    bad = spark.createDataFrame([(1, '{"n":1}\n{"n"')], "id int, text string")
    with pytest.raises(JOB_ERRORS):
        project.unpack_batches(bad, project.ndjson("text"), schema).collect()


def test_counts_before_and_after_filter(spark):
    before, after = Observation("before"), Observation("after")
    df = spark.range(100).observe(before, F.count(F.lit(1)).alias("total")).filter("id > 89").observe(after, F.count(F.lit(1)).alias("total"))
    assert df.collect() and before.get["total"] == 100 and after.get["total"] == 10
    assert project.observed_counts(spark.range(100), F.col("id") > 89).count() == 10


def test_service_errors_become_text(spark):
    class Client:
        def __call__(self, n):
            if n == 2:
                raise RuntimeError("busy")
            return f"got {n}"

    df = spark.createDataFrame([(1,), (2,)], "n int")
    assert rows(udfs.service_column(df, "n", "fact", Client, "m")) == [(1, "got 1"), (2, "ERROR: Can't invoke m  Reason: busy")]

    def broken():
        raise OSError("no route")

    assert rows(udfs.service_column(df, "n", "fact", broken, "m"), "fact")[0][0].startswith("ERROR: Can't invoke m  Reason: no route")


def test_kafka_options():
    got = kafka.source_options("h:9092", "t", start_timestamp=5, group="g", security_protocol="SSL")
    assert got == {
        "kafka.bootstrap.servers": "h:9092", "subscribe": "t", "startingTimestamp": "5", "kafka.group.id": "g",
        "kafka.security.protocol": "SSL",
    }
    assert kafka.source_options("h", "t")["startingOffsets"] == "earliest"
    with pytest.raises(ValueError):
        kafka.source_options("h", "t", start="yesterday")
    assert kafka.sink_options("h", "t", acks="all")["kafka.acks"] == "all"


def test_generated_rows_stay_in_range(spark):
    ids, ts = synth.ids(spark, 5000, 4), F.lit(dt.datetime(2024, 1, 1))
    stock = synth.stock_rows(ids, "id", ts).agg(F.min("price"), F.max("price"), F.count_distinct("ticker")).first()
    assert 10 <= stock[0] and stock[1] < 100 and stock[2] == 5
    sensor = synth.sensor_rows(ids, "id", ts).agg(F.min("sensor_id"), F.max("sensor_id"), F.max("temperature")).first()
    assert (sensor[0], sensor[1]) == (10, 20) and sensor[2] <= 100
    room = synth.room_rows(ids, "id", ts).agg(F.min("temperature"), F.max("temperature"), F.count_distinct("room")).first()
    assert 18 <= room[0] and room[1] < 30 and room[2] == 5
    series = synth.temperature_rows(ids, "id", ts)
    assert series.filter("roomId rlike '^R[0-9]{5}$' and sensorId rlike '^S[0-9]{9}$' and temperature >= 20 and temperature < 30").count() == 5000
    trade = synth.trade_rows(ids, "id", ts).agg(F.count_distinct("buySell"), F.min("shares")).first()
    assert tuple(trade) == (2, 1)
    assert synth.matrix_rows(ids, "id", ts).columns[-1] == "element4"
    assert 300 < synth.message_rows(ids, "id").filter("message = 'Poison'").count() < 700
    again = synth.stock_rows(synth.ids(spark, 5000, 9), "id", ts)
    assert again.exceptAll(synth.stock_rows(ids, "id", ts)).count() == 0


def test_record_schemas_round_trip(spark, tmp_path):
    event = [("V123456X", 42, {"speed": 100, "rpm": 2000, "fuelLevel": 12345}, ["OIL_TEMPERATURE", "TIRE_PRESSURE"])]
    aggregate = [("V123456X", 42, {"speed": 100, "rpm": 2000, "fuelLevel": 12345}, 42)]
    for name, data, schema in [("e", event, schemas.VEHICLE_EVENT), ("a", aggregate, schemas.VEHICLE_AGG)]:
        spark.createDataFrame(data, schema).write.parquet(f"{tmp_path}/{name}")
        assert [tuple(r) for r in spark.read.schema(schema).parquet(f"{tmp_path}/{name}").collect()] == data


@pytest.mark.parametrize("blank", ["", "   "])
def test_strict_decoding_refuses_blank_text(spark, blank):
    df = spark.createDataFrame([(blank,), (None,)], "value string")
    decoded = df.select(scalar.json_decode("value", T.StructType().add("id", "long")).alias("row"))
    with pytest.raises(JOB_ERRORS):
        decoded.collect()
    assert decoded.filter("row is null").limit(0).count() == 0


@pytest.mark.parametrize("precision", [6, 9, 12])
def test_decimal_average_is_rounded_once(spark, precision):
    df = spark.createDataFrame([("a", "0.004"), ("a", "0.004"), ("a", "0.007")], "k string, v string").withColumn("v", F.col("v").cast("decimal(8,4)"))
    (row,) = windows.aggregate_by(df, ["k"], [windows.avg_decimal_of("v", "avg", precision, 2)]).collect()
    assert str(row.avg) == "0.01"
