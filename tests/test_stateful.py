import datetime as dt
import random
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators import ordered
from millrace.operators.project import observed_counts
from millrace.sinks import files as sink_files
from millrace.sinks import lake
from millrace.sinks.storage import Folder
from millrace.sources import files
from millrace.streaming import registry, run, state, tables, totals, windows
from tests.conftest import JOB_ERRORS, rows

START = dt.datetime(2024, 1, 1)


def at(seconds):
    return START + dt.timedelta(seconds=seconds)


def land(spark, folder, data, schema):
    spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(f"{folder}/landed")
    return files.read_parquet_dir(spark, f"{folder}/landed", T.StructType.fromDDL(schema))


# --- tables -------------------------------------------------------------------------------------------------------------

CHANGE = "id long, part string, op string, op_ts timestamp, seq long, v string"


def keep(spark, folder, batches):
    seen = []
    for batch in batches:
        stream = land(spark, folder, batch, CHANGE)
        run.run_to_end(tables.current_table(stream, f"{folder}/table", ["id", "part"], ["part"], ["op_ts", "seq"], f"{folder}/cp"))
        seen.append(rows(lake.lake_table(spark, f"{folder}/table", ["part"]), "id", "v"))
    return seen


def test_a_late_change_of_a_removed_key_brings_nothing_back(spark, tmp_path):
    first = [(1, "a", "INSERT", at(0), 0, "one"), (2, "a", "INSERT", at(0), 0, "two"), (3, "b", "INSERT", at(5), 0, "three")]
    second = [(1, "a", "DELETE", at(9), 0, None), (2, "a", "UPDATE", at(9), 1, "two!"), (2, "a", "UPDATE", at(9), 0, "older"), (4, "b", "REMOVE", at(9), 0, None)]
    third = [(1, "a", "UPDATE", at(8), 0, "late"), (4, "b", "INSERT", at(8), 0, "late"), (2, "a", "UPDATE", at(9), 0, "late"), *second, *first]
    fourth = [(1, "a", "INSERT", at(10), 0, "again"), (None, "c", "INSERT", at(0), 0, "no id"), (5, "c", "INSERT", None, 0, "no time")]
    fifth = [(5, "c", "UPDATE", at(-100), 0, "a time"), (None, "c", "DELETE", None, 9, None)]
    assert keep(spark, tmp_path, [first, second, third, fourth, fifth]) == [
        [(1, "one"), (2, "two"), (3, "three")],
        [(2, "two!"), (3, "three")],
        [(2, "two!"), (3, "three")],
        sorted([(1, "again"), (2, "two!"), (3, "three"), (None, "no id"), (5, "no time")], key=repr),
        sorted([(1, "again"), (2, "two!"), (3, "three"), (None, "no id"), (5, "a time")], key=repr),
    ]


def test_the_current_table_does_not_depend_on_order_or_batches(spark, tmp_path):
    rng = random.Random(4)
    changes = [(k, f"p{k % 3}", rng.choice(["INSERT", "UPDATE", "DELETE"]), at(rng.randrange(5)), s, f"{k}.{s}") for k in range(12) for s in range(8)]
    newest = {}
    for c in changes:
        if c[0] not in newest or (c[3], c[4]) > (newest[c[0]][3], newest[c[0]][4]):
            newest[c[0]] = c
    rng.shuffle(changes)
    batches = [changes[i : i + 40] + rng.sample(changes, 10) for i in range(0, len(changes), 40)]
    assert keep(spark, tmp_path, batches)[-1] == sorted(((c[0], c[5]) for c in newest.values() if c[2] != "DELETE"), key=repr)


def test_changes_are_compared_by_an_aggregate_and_replays_do_not_pass(spark, tmp_path):
    """Python's keyed state, a call for each key, does not carry many keys."""
    first = [(k, "a", "INSERT", at(k), 0, f"{k}") for k in range(50)]
    second = [(k, "a", "UPDATE", at(k + k % 2), 1 - k % 2, f"{k}!") for k in range(10)] + [(10, "a", "UPDATE", at(9), 7, "older")]
    passed = []
    for batch in [first, second, [*second, *first], [(3, "a", "DELETE", at(90), 0, None), (4, "a", "UPDATE", at(4), 0, "late")]]:
        newer = tables.newer_changes(land(spark, tmp_path, batch, CHANGE), ["id", "part"], ["op_ts", "seq"])
        query = run.run_to_end(run.each_batch(newer, lambda some, n: passed.append(rows(some)), f"{tmp_path}/cp", "update"))
        assert {op["operatorName"] for p in query.recentProgress for op in p["stateOperators"]} == {"stateStoreSave"}
    assert [len(p) for p in passed] == [50, 10, 0, 1]
    assert passed[0] == sorted(first, key=repr) and passed[1] == sorted(second[:10], key=repr)


class Crash(Exception):
    pass


@pytest.mark.parametrize("after", range(6))
def test_no_partition_is_missing_after_a_crash(spark, tmp_path, monkeypatch, after):
    """A write that stops after any number of moves: readers see it whole, and its replay finishes it."""
    path, schema = f"{tmp_path}/t", "id long, v long, p string"
    lake.lake_append(spark.createDataFrame([(i, 0, f"p{i % 3}") for i in range(9)], schema), path, ["p"])
    new = spark.createDataFrame([(i, 1, f"p{i % 3}") for i in range(6)], schema)
    moves, rename = [], Folder.rename

    def stopping(self, name, to):
        if len(moves) == after:
            raise Crash
        moves.append(to)
        rename(self, name, to)

    monkeypatch.setattr(Folder, "rename", stopping)
    with pytest.raises(Crash):
        lake.lake_upsert(new, path, ["id", "p"], ["p"], commit_id="c")
        raise Crash
    want = sorted(((i, int(i < 6), f"p{i % 3}") for i in range(9)), key=repr)
    assert rows(lake.lake_table(spark, path, ["p"]), "id", "v", "p") == want
    monkeypatch.setattr(Folder, "rename", rename)
    for _ in range(2):
        lake.lake_upsert(new, path, ["id", "p"], ["p"], commit_id="c")
        assert rows(spark.read.parquet(path), "id", "v", "p") == rows(lake.lake_table(spark, path, ["p"]), "id", "v", "p") == want


def test_a_batch_that_crashes_after_its_write_is_written_once(spark, tmp_path):
    """The query dies when the table is written and the batch is not yet noted as done."""
    crashes = []

    def append(stream):
        def write(batch, n):
            lake.lake_append(batch, f"{tmp_path}/table", ["part"], tables.commit_of(batch, n))
            if n == 1 and not crashes:
                crashes.append(n)
                raise Crash

        return run.each_batch(stream, write, f"{tmp_path}/cp")

    schema = "id long, part string"
    run.run_to_end(append(land(spark, tmp_path, [(1, "a"), (2, "b")], schema)))
    stream = land(spark, tmp_path, [(3, "a"), (4, None)], schema)
    with pytest.raises(JOB_ERRORS):
        run.run_to_end(append(stream))
    run.run_to_end(append(stream))
    assert crashes and rows(spark.read.parquet(f"{tmp_path}/table"), "id") == [(1,), (2,), (3,), (4,)]
    with pytest.raises(ValueError):
        tables.commit_of(spark.range(1), 0)


def test_an_upsert_stream_begun_anew_writes_its_batches(spark, tmp_path):
    schema = "id long, part string, n long"
    stream = land(spark, tmp_path, [(1, "a", 1), (1, "a", 2)], schema)
    for name in ("cp1", "cp2"):
        run.run_to_end(tables.upsert_stream(stream, f"{tmp_path}/table", ["id"], ["part"], ["n"], f"{tmp_path}/{name}"))
    assert len([n for n in Folder(spark, f"{tmp_path}/table").children("_commits") if n.endswith(".done")]) == 2
    assert rows(lake.lake_table(spark, f"{tmp_path}/table", ["part"]), "id", "n") == [(1, 2)]
    with pytest.raises(ValueError):
        lake.lake_table(spark, f"{tmp_path}/none", ["part"])


# --- windows ------------------------------------------------------------------------------------------------------------

EVENT = "key string, n long, ts timestamp, v double"


@pytest.mark.parametrize("slide", [None, "1 second"])
def test_a_window_closes_by_the_clock_alone(spark, tmp_path, slide):
    """All rows are there before the start; windows come out although nothing comes after them."""
    stream = land(spark, tmp_path, [("a", 1, at(0), 2.5), ("a", 2, at(0), None), (None, 3, at(0), 1.0)], EVENT)
    parts = [windows.Part("rows", "count"), windows.Part("n", "sum", "n"), windows.Part("low", "min", "v"), windows.Part("high", "max", "v"), windows.Part("k", "count", "v")]
    out = windows.proc_time_windows(stream, ["key"], "2 seconds", parts, slide)
    path, before, times = f"{tmp_path}/out", time.time(), 2 if slide else 1
    counted = lambda: spark.read.schema(out.schema).parquet(path).agg(F.sum("rows")).first()[0]
    done = lambda: sink_files.streamed(spark, path) and counted() == 3 * times
    run.run_until(sink_files.save(out, path, checkpoint=f"{tmp_path}/cp"), done, patience=120)
    got = spark.read.schema(out.schema).parquet(path)
    assert rows(got, "key", "rows", "n", "low", "high", "k") == sorted([("a", 2, 3, 2.5, 2.5, 1), (None, 1, 3, 1.0, 1.0, 1)] * times, key=repr)
    for r in got.collect():
        assert r.window_end - r.window_start == dt.timedelta(seconds=2)
        assert before - 2 <= r.window_end.replace(tzinfo=dt.timezone.utc).timestamp() <= time.time() + 1
    assert got.select("window_start").distinct().count() >= times


def test_run_until_gives_up_and_raises_errors(spark, tmp_path):
    stream = land(spark, tmp_path, [("a", 1, at(0), 2.5)], EVENT)
    with pytest.raises(TimeoutError):
        run.run_until(sink_files.save(stream, f"{tmp_path}/out", checkpoint=f"{tmp_path}/cp"), lambda: False, patience=2)
    failing = stream.select(F.raise_error(F.lit("no")).cast("string").alias("x"))
    with pytest.raises(JOB_ERRORS):
        run.run_until(sink_files.save(failing, f"{tmp_path}/out2", checkpoint=f"{tmp_path}/cp2"), lambda: False, patience=60)


def processed(spark, folder, batches, size="10 seconds", delay="5 seconds"):
    output = T.StructType().add("items", "string")
    items = F.array(F.struct(F.col("key").alias("item"), F.col("n").alias("n")))
    for batch in batches:
        stream = land(spark, folder, batch, EVENT)
        grouped = stream.withColumn("g", F.lit("g"))
        finish = lambda totals: (" ".join(f"{k}={n}" for k, n in sorted(totals.items())),)
        out = windows.window_process(grouped, "ts", delay, ["g"], size, items, finish, output)
        run.run_to_end(sink_files.save(out, f"{folder}/out", checkpoint=f"{folder}/cp"))
    return [(int((r.window_start - START).total_seconds()), r.items) for r in spark.read.parquet(f"{folder}/out").orderBy("window_start").collect()]


def test_whole_windows_merge_over_batches_and_drop_what_is_late(spark, tmp_path):
    batches = [
        [("a", 1, at(1), None), ("b", 2, at(2), None), ("a", 4, at(12), None)],
        [("a", 8, at(3), None), ("c", None, at(9), None)],  # old, but their window is open
        [("z", 1, at(100), None), ("none", 1, None, None)],
        [("a", 100, at(4), None), ("a", 16, at(101), None)],  # the window of the first is gone
        [("z", 1, at(500), None)],
    ]
    assert processed(spark, tmp_path, batches) == [(0, "a=9 b=2 c=None"), (10, "a=4"), (100, "a=16 z=1")]


def test_open_windows_are_kept_by_aggregates(spark, tmp_path):
    """Python is called when a window closes and not for each key and micro-batch."""
    output = T.StructType().add("n", "long").add("items", "integer")
    batches = [[(f"k{i % 40}", i, at(i % 20), None) for i in range(400)], [("k0", None, at(3), None), ("z", 1, at(100), None)]]
    for batch in batches:
        stream = land(spark, tmp_path, batch, EVENT)
        item = lambda name, n: F.struct(name.alias("item"), n.cast("long").alias("n"))
        items = F.array(item(F.lit("all"), F.col("n")), item(F.col("ts").cast("string"), F.lit(1)))
        out = windows.window_process(stream, "ts", "30 seconds", ["key"], "10 seconds", items, lambda t: (t["all"], len(t)), output)
        query = run.run_to_end(sink_files.save(out, f"{tmp_path}/out", checkpoint=f"{tmp_path}/cp"))
        assert {op["operatorName"] for p in query.recentProgress for op in p["stateOperators"]} == {"stateStoreSave"}
    want = {}
    for key, n, ts, _ in batches[0]:
        start = at(0 if ts < at(10) else 10)
        total, times = want.get((key, start), (0, set()))
        want[key, start] = total + n, times | {ts}
    want["k0", START] = want["k0", START][0], want["k0", START][1] | {at(3)}
    got = spark.read.parquet(f"{tmp_path}/out")
    assert rows(got, "key", "window_start", "n", "items") == sorted(((*k, n, len(t) + 1) for k, (n, t) in want.items()), key=repr)


def test_many_series_share_calls_of_the_state(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(state, "SHARES", 2, raising=False)
    batches = [[(f"k{i % 30}" if i % 30 else None, i, at(i // 30), float(-i)) for i in range(j, 300, 2)] for j in range(2)]
    for batch in [*batches, [("k1", 999, at(500), 0.0)], [("k2", 1000, at(1), 1.5), ("k3", 1001, at(2), 2.5)]]:
        stream = land(spark, tmp_path, batch, EVENT)
        out = windows.series_in_order(stream, "m", ["key"], "ts", "v", "10 seconds", ["n"], stretch="1 minute", size=4)
        query = run.run_to_end(sink_files.save(out, f"{tmp_path}/out", checkpoint=f"{tmp_path}/cp"))
        assert max(op["numRowsTotal"] for p in query.recentProgress for op in p["stateOperators"]) <= 20
    got = spark.read.parquet(f"{tmp_path}/out").select(F.col("labels")["key"].alias("key"), "chunk", "late", F.col("samples.value").alias("v"))
    values = {k: [float(-i) for i in range(300) if (f"k{i % 30}" if i % 30 else None) == k] for k in [None, *(f"k{i}" for i in range(1, 30))]}
    want = [(k, n, False, v[4 * n : 4 * n + 4]) for k, v in values.items() for n in range(3)]
    assert rows(got) == sorted([*want, ("k2", 3, True, [1.5]), ("k3", 3, True, [2.5])], key=repr)


def samples(spark, folder):
    got = spark.read.parquet(f"{folder}/out").orderBy("chunk").collect()
    return [(r.late, [int((s.ts - START).total_seconds()) for s in r.samples], [s.value for s in r.samples]) for r in got]


def test_series_come_in_order_over_batches(spark, tmp_path):
    batches = [
        [("k", 1, at(50), 5.0), ("k", 2, at(5), 0.5), ("k", 3, at(30), 3.0)],
        [("k", 4, at(45), 4.5), ("k", 5, at(45), 4.4), ("k", 6, at(300), 30.0), ("k", 9, None, 1.0)],
        [("k", 7, at(6), 0.6), ("k", 8, at(310), None), ("k", 10, at(2000), 200.0)],
        [("k", 11, at(4000), 400.0)],
    ]
    for batch in batches:
        stream = land(spark, tmp_path, batch, EVENT)
        out = windows.series_in_order(stream, "m", ["key"], "ts", "v", "10 seconds", ["n"], stretch="1 minute", size=2)
        run.run_to_end(sink_files.save(out, f"{tmp_path}/out", checkpoint=f"{tmp_path}/cp"))
    assert samples(spark, tmp_path) == [
        (False, [5, 30], [0.5, 3.0]), (False, [45, 45], [4.5, 4.4]), (False, [50], [5.0]),
        (True, [6], [0.6]), (False, [300, 310], [30.0, None]), (False, [2000], [200.0]),
    ]


def test_late_rows_are_those_of_the_batch_operator(spark, tmp_path):
    rng = random.Random(9)
    arrivals = [(rng.choice(["s1", "s2", None]), i, at(i * 7 + rng.randrange(-200, 200)) if rng.random() < 0.95 else None, 0.0) for i in range(120)]
    for i in range(0, 120, 40):
        stream = land(spark, tmp_path, rng.sample(arrivals[i : i + 40], 40), EVENT)
        marked = windows.late_rows(stream, "ts", ["n"], "60 seconds", "20 seconds", ["key"], "30 seconds")
        run.run_to_end(sink_files.save(marked, f"{tmp_path}/out", checkpoint=f"{tmp_path}/cp"))
    whole = ordered.late_split(spark.createDataFrame(arrivals, EVENT), "ts", ["n"], "60 seconds", "20 seconds", ["key"], "30 seconds")
    got = rows(spark.read.parquet(f"{tmp_path}/out"), "n", "is_late")
    assert got == rows(whole, "n", "is_late")
    assert {late for _, late in got} == {True, False}


def test_many_sources_share_calls_of_the_state(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(state, "SHARES", 2, raising=False)
    schema = "key double, n long, ts timestamp"
    rng = random.Random(3)
    keys = [None, float("nan"), 0.0, *(float(i) for i in range(1, 40))]
    arrivals = [(rng.choice(keys), i, at(i * 7 + rng.randrange(-2000, 2000)) if rng.random() < 0.95 else None) for i in range(600)]
    for i in range(0, 600, 300):
        marked = windows.late_rows(land(spark, tmp_path, arrivals[i : i + 300], schema), "ts", ["n"], "60 seconds", "20 seconds", ["key"])
        query = run.run_to_end(sink_files.save(marked, f"{tmp_path}/out", checkpoint=f"{tmp_path}/cp"))
        assert max(op["numRowsTotal"] for p in query.recentProgress for op in p["stateOperators"]) <= 2
    whole = ordered.late_split(spark.createDataFrame(arrivals, schema), "ts", ["n"], "60 seconds", "20 seconds", ["key"])
    got = spark.read.parquet(f"{tmp_path}/out")
    assert got.columns == ["key", "n", "ts", "is_late"]
    assert rows(got, "n", "is_late") == rows(whole, "n", "is_late")
    assert {r.is_late for r in got.collect()} == {True, False}


# --- schemas and totals ---------------------------------------------------------------------------------------------------


def test_registry_takes_compatible_versions_only(spark, tmp_path):
    known = registry.Registry(spark, f"{tmp_path}/schemas")
    one = T.StructType().add("id", "integer").add("name", "string")
    wider = T.StructType().add("id", "long").add("name", "string").add("size", T.IntegerType(), False)
    assert known.writers("x") == {}
    assert [known.register("x", one), known.register("x", one), known.register("y", wider)] == [1, 1, 1]
    for bad, why in ((wider, "size: required"), (T.StructType().add("id", "string"), "id: int cannot be read as string")):
        with pytest.raises(ValueError, match=why):
            known.register("x", bad)
    assert known.register("x", wider, {"size": 0}) == 2
    assert known.writers("x") == {1: one, 2: wider}
    with pytest.raises(ValueError, match="bigint cannot be read as int"):
        known.register("x", T.StructType().add("id", "integer"))


def test_a_version_registered_between_two_batches_is_read(spark, tmp_path):
    known = registry.Registry(spark, f"{tmp_path}/schemas")
    reader = T.StructType().add("id", "long").add("name", "string").add("size", "integer")
    one, two, got = T.StructType(reader.fields[:2]), reader, []
    stream = None

    def read():
        sink = lambda batch, n: got.append(rows(batch))
        run.run_to_end(registry.decoded_stream(stream, known, "x", reader, sink, f"{tmp_path}/cp", defaults={"size": -1}))

    def write(schema, data, version):
        nonlocal stream
        registry.encoded(spark.createDataFrame(data, schema), version).write.mode("append").parquet(f"{tmp_path}/landed")
        stream = files.read_parquet_dir(spark, f"{tmp_path}/landed", T.StructType().add("value", "binary"))

    write(one, [(1, "a"), (2, None)], known.register("x", one))
    read()
    write(two, [(3, "ü", 5)], known.register("x", two))
    write(one, [(4, "old")], 1)
    read()
    assert got == [sorted([(1, "a", -1), (2, None, -1)], key=repr), [(3, "ü", 5), (4, "old", -1)]]
    write(one, [(5, "?")], 7)
    with pytest.raises(JOB_ERRORS, match="unregistered schema version 7"):
        read()


def test_header_is_a_zero_and_the_version(spark):
    value = registry.encoded(spark.createDataFrame([(1,)], "id int"), 258).first().value
    assert bytes(value) == b"\x00\x00\x00\x01\x02" + b'{"id":1}'


def test_totals_go_on_after_a_restart_and_count_no_batch_twice(spark, tmp_path):
    batches = [[("a", n, at(0), float(n)) for n in range(10)], [("a", n, at(0), float(n)) for n in range(4)], [("a", 1, at(0), 0.0)]]
    found, events = [], []
    for batch in batches:
        listener = totals.RunningTotals(spark, f"{tmp_path}/totals")
        keep_event = listener.onQueryProgress
        listener.onQueryProgress = lambda event, keep_event=keep_event: (events.append(event), keep_event(event))
        spark.streams.addListener(listener)
        try:
            kept = observed_counts(land(spark, tmp_path, batch, EVENT), F.col("v") > 2)
            query = run.run_to_end(sink_files.save(kept, f"{tmp_path}/out", checkpoint=f"{tmp_path}/cp"))
            listener.settle()
        finally:
            spark.streams.removeListener(listener)
        sums = listener.totals(query)
        found.append((sums["received"]["total"], sums["filtered"]["total"], listener.gaps(query)))
    assert found == [(10, 7, 0), (14, 8, 0), (15, 8, 0)]
    again = totals.RunningTotals(spark, f"{tmp_path}/totals")
    for event in events:
        again.onQueryProgress(event)
    assert again.totals(query)["received"]["total"] == 15
