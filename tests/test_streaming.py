import datetime as dt
import os
import shutil
import time

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators import windows
from millrace.sinks import files as sink_files
from millrace.sources import files, log, synth
from millrace.streaming import run, state
from millrace.streaming.time import ascending_time, event_time, processing_time
from tests import filelog
from tests.conftest import rows

SCHEMA = "key string, n bigint, ts timestamp_ntz, v double"
START = dt.datetime(2024, 1, 1)


def feed(spark, folder, data):
    """Append one file of (key, n, seconds, value)."""
    made = [(k, n, START + dt.timedelta(seconds=s), v) for k, n, s, v in data]
    spark.createDataFrame(made, SCHEMA).coalesce(1).write.mode("append").parquet(str(folder))


def stream(spark, folder, **kwargs):
    return files.read_parquet_dir(spark, str(folder), spark.createDataFrame([], SCHEMA).schema, **kwargs)


def test_restart_goes_on_from_the_checkpoint(spark, tmp_path):
    for n in range(2):
        feed(spark, tmp_path / "in", [("a", n, n, 1.0)])
        query = run.run_to_end(sink_files.save(stream(spark, tmp_path / "in"), f"{tmp_path}/out", checkpoint=f"{tmp_path}/cp"))
        assert run.rates(query)["rows"] == 1
    assert rows(spark.read.parquet(f"{tmp_path}/out"), "n") == [(0,), (1,)]


def test_rows_behind_the_watermark_are_dropped(spark, tmp_path):
    dropped = []
    for batch in ([("a", 0, 1, 5.0)], [("a", 1, 100, 7.0)], [("a", 2, 2, 1.0)], [("a", 3, 200, 9.0)]):
        feed(spark, tmp_path / "in", batch)
        timed = event_time(stream(spark, tmp_path / "in"), "ts")
        out = windows.window_min(timed, "ts", "key", "v", "30 seconds")
        query = run.run_to_end(sink_files.save(out, f"{tmp_path}/out", checkpoint=f"{tmp_path}/cp"))
        dropped.append(run.dropped_late(query))
    got = spark.read.parquet(f"{tmp_path}/out")
    assert dropped == [0, 0, 1, 0]
    assert rows(got, "min_value") == [(5.0,), (7.0,)]  # 1.0 came too late, 9.0 is still open


def test_late_row_still_counts_in_open_sliding_windows(spark, tmp_path):
    for batch in ([("a", 0, 20, 5.0)], [("a", 1, 35, 7.0)], [("a", 2, 12, 1.0)], [("a", 3, 300, 9.0)]):
        feed(spark, tmp_path / "in", batch)
        timed = event_time(stream(spark, tmp_path / "in"), "ts")
        out = windows.window_min(timed, "ts", "key", "v", "30 seconds", "5 seconds")
        run.run_to_end(sink_files.save(out, f"{tmp_path}/out", checkpoint=f"{tmp_path}/cp"))
    got = spark.read.parquet(f"{tmp_path}/out").filter(F.col("window_end") == F.lit(START + dt.timedelta(seconds=40)))
    assert rows(got, "min_value") == [(1.0,)]


def test_processing_time_windows_close_while_running(spark, tmp_path):
    rate = processing_time(synth.rate_stream(spark, 50))
    out = windows.windowed(rate, "proc_time", [], "2 seconds", [windows.rows_in("n")])
    query = run.start(sink_files.save(out, f"{tmp_path}/out", checkpoint=f"{tmp_path}/cp"), "1 second")
    try:
        deadline = time.time() + 60
        while time.time() < deadline:
            try:
                if spark.read.parquet(f"{tmp_path}/out").count():
                    break
            except Exception:
                pass
            time.sleep(1)
    finally:
        query.stop()
    assert spark.read.parquet(f"{tmp_path}/out").agg(F.sum("n")).first()[0] > 0


@pytest.mark.parametrize("replay", [False, True])
def test_running_count_over_batches(spark, tmp_path, replay):
    sunk = {}
    counter = state.RunningCountBatches(["key"], ["n"], f"{tmp_path}/totals", lambda df, i: sunk.__setitem__(i, rows(df, "n", "total_count")))
    batches = [[("hot", i, i, 0.0) for i in range(b * 50, b * 50 + 50)] + [("cold", 1000 + b, 0, 0.0)] for b in range(4)]
    for i, batch in enumerate(batches):
        df = spark.createDataFrame([(k, n) for k, n, _, _ in batch], "key string, n bigint")
        counter(df, i)
        if replay:
            counter(df, i)
    got = dict(pair for i in sunk for pair in sunk[i])
    assert {n: c for n, c in got.items() if n < 1000} == {n: n + 1 for n in range(200)}
    assert {n: c for n, c in got.items() if n >= 1000} == {1000 + b: b + 1 for b in range(4)}


def test_keyed_state_survives_a_restart(spark, tmp_path):
    feed(spark, tmp_path / "in", [("a", 0, 0, 10.0), ("b", 1, 0, 1.0)])
    for step in range(2):
        if step:
            feed(spark, tmp_path / "in", [("a", 2, 0, 20.0)])
        counted = state.keyed_count(stream(spark, tmp_path / "in"), "key")
        run.run_to_end(sink_files.save(counted, f"{tmp_path}/count", checkpoint=f"{tmp_path}/cp1"))
        averaged = state.keyed_average(stream(spark, tmp_path / "in"), "key", "v")
        run.run_to_end(sink_files.save(averaged, f"{tmp_path}/avg", checkpoint=f"{tmp_path}/cp2"))
    assert rows(spark.read.parquet(f"{tmp_path}/count")) == [("a", 1), ("a", 2), ("b", 1)]
    assert [(k, round(v, 9)) for k, v in rows(spark.read.parquet(f"{tmp_path}/avg"))] == [("a", 1.0), ("a", 2.9), ("b", 0.1)]


def test_several_sinks_or_none(spark, tmp_path):
    feed(spark, tmp_path / "in", [("a", 0, 0, 1.0)])
    got = []
    sinks = {"one": lambda df, i: got.append(("one", df.count())), "two": lambda df, i: got.append(("two", df.count()))}
    run.run_to_end(run.multi_sink(stream(spark, tmp_path / "in"), sinks, f"{tmp_path}/cp"))
    assert got == [("one", 1), ("two", 1)]
    with pytest.raises(ValueError):
        run.multi_sink(stream(spark, tmp_path / "in"), {}, f"{tmp_path}/cp2")


def test_console(spark, tmp_path):
    feed(spark, tmp_path / "in", [("a", 0, 0, 1.0)])
    run.to_console(spark.range(1))
    run.run_to_end(run.to_console(stream(spark, tmp_path / "in"), f"{tmp_path}/cp"))


# --- message log ------------------------------------------------------------------------------------------------------


CLIENT = {"client": "tests.filelog:FileLog"}


def put(spark, target, low, high, second=0, **options):
    df = spark.range(low, high, 1, 3)
    arrival = F.timestamp_seconds(F.lit(1_700_000_000 + second))
    log.write_stream_log(log.log_records(df, F.col("id"), arrival=arrival), target, **options)


@pytest.mark.parametrize("options", [{}, CLIENT])
def test_log_from_a_position(spark, tmp_path, options):
    target = f"{tmp_path}/log"
    put(spark, target, 0, 100, **options)
    put(spark, target, 100, 150, second=60, **options)
    read = lambda **k: log.read_stream_log(spark, target, streaming=False, **k, **options)
    assert ids(read(position=log.TRIM_HORIZON)) == list(range(150))
    assert ids(read(position=log.LATEST)) == []
    assert ids(read(position=log.AT_TIMESTAMP, timestamp=1_700_000_030_000)) == list(range(100, 150))
    for bad in ({"position": log.AT_TIMESTAMP}, {"position": "YESTERDAY"}):
        with pytest.raises(Exception):
            read(**bad).collect()


def test_landed_log_streams_on_from_its_checkpoint(spark, tmp_path):
    target = f"{tmp_path}/log"
    for low in (0, 40):
        put(spark, target, low, low + 40)
        records = log.read_stream_log(spark, target, log.LATEST, timestamp=1_700_000_000_000)
        run.run_to_end(log.write_stream_log(records, f"{tmp_path}/copy", f"{tmp_path}/cp"))
    assert ids(log.read_stream_log(spark, f"{tmp_path}/copy", log.TRIM_HORIZON, streaming=False)) == list(range(80))
    with pytest.raises(ValueError, match="timestamp"):
        log.read_stream_log(spark, target, log.LATEST)


def test_landed_log_takes_two_queries(spark, tmp_path):
    feed(spark, tmp_path / "in", [("a", n, n, 1.0) for n in range(100)])
    for name in ("one", "two"):
        records = log.log_records(stream(spark, tmp_path / "in").select(F.col("n").alias("id")), F.col("id"))
        for _ in range(2):  # nothing new for the second run
            run.run_to_end(log.write_stream_log(records, f"{tmp_path}/log", f"{tmp_path}/{name}"))
    assert ids(log.read_stream_log(spark, f"{tmp_path}/log", log.TRIM_HORIZON, streaming=False)) == sorted([*range(100)] * 2)


def test_log_client_from_a_session_with_other_settings(spark, tmp_path):
    """The format is registered where Spark looks it up, which is the session that is active."""
    put(spark.newSession(), f"{tmp_path}/log", 0, 10, **CLIENT)
    assert ids(log.read_stream_log(spark.newSession(), f"{tmp_path}/log", log.TRIM_HORIZON, streaming=False, **CLIENT)) == list(range(10))


ID = T.StructType().add("id", "long")


def ids(df):
    return sorted(r.id for r in log.decoded(df, ID).collect())


def test_log_numbers_its_records(spark, tmp_path):
    target = f"{tmp_path}/log"
    put(spark, target, 0, 100, **CLIENT)
    put(spark, target, 100, 150, second=60, **CLIENT)
    records = log.read_stream_log(spark, target, log.TRIM_HORIZON, streaming=False, **CLIENT)
    numbered = records.groupBy("shard").agg(F.count("*").alias("n"), F.max("sequence").alias("last"), F.count_distinct("sequence").alias("d"))
    assert all(r.n == r.last + 1 == r.d for r in numbered.collect())


def test_log_stream_goes_on_and_replays_add_nothing(spark, tmp_path):
    target = f"{tmp_path}/log"
    for low in (0, 40):
        put(spark, target, low, low + 40, shards="2", **CLIENT)
        records = log.read_stream_log(spark, target, log.TRIM_HORIZON, **CLIENT)
        run.run_to_end(sink_files.save(log.decoded(records, ID), f"{tmp_path}/out", checkpoint=f"{tmp_path}/cp"))
    assert sorted(r.id for r in spark.read.parquet(f"{tmp_path}/out").collect()) == list(range(80))
    client = filelog.FileLog({"stream": target, "shards": "2"})
    before = {s: client.bounds(s) for s in client.shards()}
    done = os.listdir(f"{target}/_published")[0]
    client.publish([("shard-000000", "/nowhere", 5)], done)
    assert {s: client.bounds(s) for s in client.shards()} == before


def test_log_pieces_split_a_shard(spark, tmp_path):
    target = f"{tmp_path}/log"
    for low in range(0, 30, 10):
        put(spark, target, low, low + 10, shards="1", **CLIENT)
    client = filelog.FileLog({"stream": target, "shards": "1", "rowsPerPiece": "2"})
    pieces = client.pieces("shard-000000", 5, 25)
    read = [b["sequence"].to_pylist() for p in pieces for b in client.read(p)]
    assert max(map(len, read)) == 2 and [n for batch in read for n in batch] == list(range(5, 25))


def test_log_row_groups(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(filelog, "GROUP_BYTES", 1)  # a row group per batch
    client = filelog.FileLog({"stream": f"{tmp_path}/log", "shards": "1"})
    fields = [log.ARROW.field(n) for n in ("arrival", "key", "data")]
    batches = [
        pa.record_batch([pa.array([i * 10_000_000 + j for j in range(4)], fields[0].type), ["k"] * 4, [b"x"] * 4], schema=pa.schema(fields))
        for i in range(5)
    ]
    client.publish(client.stage(iter(batches)), "b")
    assert client.bounds("shard-000000") == (0, 20)
    assert [client.at_timestamp("shard-000000", t) for t in (0, 2, 4, 20_000_001, 99_000_000)] == [0, 2, 4, 9, 20]
    (piece,) = client.pieces("shard-000000", 6, 13)
    assert [n for b in client.read(piece) for n in b["sequence"].to_pylist()] == list(range(6, 13))


def test_log_keeps_its_number_of_shards(spark, tmp_path):
    target = f"{tmp_path}/log"
    put(spark, target, 0, 1000, shards="8", **CLIENT)
    assert ids(log.read_stream_log(spark, target, log.TRIM_HORIZON, streaming=False, **CLIENT)) == list(range(1000))
    with pytest.raises(Exception, match="8 shards"):
        log.read_stream_log(spark, target, log.TRIM_HORIZON, streaming=False, shards="3", **CLIENT).collect()


def test_two_queries_into_one_log_keep_all_rows(spark, tmp_path):
    feed(spark, tmp_path / "in", [("a", n, n, 1.0) for n in range(100)])
    for name in ("one", "two"):
        records = log.log_records(stream(spark, tmp_path / "in").select(F.col("n").alias("id")), F.col("id"))
        for _ in range(2):  # nothing new for the second run
            run.run_to_end(log.write_stream_log(records, f"{tmp_path}/log", f"{tmp_path}/{name}", **CLIENT))
    got = ids(log.read_stream_log(spark, f"{tmp_path}/log", log.TRIM_HORIZON, streaming=False, **CLIENT))
    assert got == sorted([*range(100)] * 2)


def test_state_with_a_time_to_live(spark, tmp_path):
    feed(spark, tmp_path / "in", [("a", 0, 0, 1.0), ("a", 1, 0, 1.0)])
    counted = state.keyed_count(stream(spark, tmp_path / "in"), "key", ttl_ms=3_600_000)
    run.run_to_end(sink_files.save(counted, f"{tmp_path}/out", checkpoint=f"{tmp_path}/cp"))
    assert rows(spark.read.parquet(f"{tmp_path}/out")) == [("a", 1), ("a", 2)]


def test_counting_stops_when_its_totals_are_gone(spark, tmp_path):
    counter = state.RunningCountBatches(["key"], ["n"], f"{tmp_path}/totals", lambda df, i: df.collect())
    df = spark.createDataFrame([("a", 1)], "key string, n bigint")
    with pytest.raises(ValueError, match="missing"):
        counter(df, 3)


def test_a_sibling_of_the_table_is_not_read(spark, tmp_path):
    from millrace.plans.streams import event_stream

    source = "/root/testdata/sf0.001/events.parquet"
    for name in ("events.parquet", "events.parquet_old"):
        spark.read.parquet(source).write.parquet(f"{tmp_path}/folder/{name}")
    os.makedirs(f"{tmp_path}/file")
    for name in ("events.parquet", "events.parquet_old"):
        shutil.copy(source, f"{tmp_path}/file/{name}")
    for kind in ("folder", "file"):
        rows_in = event_stream(spark, f"{tmp_path}/{kind}").select("event_id")
        run.run_to_end(sink_files.save(rows_in, f"{tmp_path}/{kind}-out", checkpoint=f"{tmp_path}/{kind}-cp"))
        assert spark.read.parquet(f"{tmp_path}/{kind}-out").count() == spark.read.parquet(source).count()


def test_ascending_time_closes_windows_at_once(spark, tmp_path):
    feed(spark, tmp_path / "in", [("a", 0, 1, 5.0), ("a", 1, 30, 7.0)])
    out = windows.window_min(ascending_time(stream(spark, tmp_path / "in"), "ts"), "ts", "key", "v", "30 seconds")
    run.run_to_end(sink_files.save(out, f"{tmp_path}/out", checkpoint=f"{tmp_path}/cp"))
    assert rows(spark.read.parquet(f"{tmp_path}/out"), "min_value") == [(5.0,)]
