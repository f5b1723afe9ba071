import datetime as dt
import glob
import json
import os
import time

import pytest
from pyspark.sql import functions as F

from millrace.operators import enrich
from millrace.operators.asking import ask_all
from millrace.sinks import files, jdbc, lake, service
from millrace.sinks.storage import partition_folder
from tests.conftest import JOB_ERRORS, rows

SCHEMA = "symbol string, price double, id int"


def prices(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def stored(spark, path):
    return rows(spark.read.schema(SCHEMA).parquet(path), "symbol", "price", "id")


def test_default_operation_is_upsert_by_symbol(spark, tmp_path):
    path = f"{tmp_path}/t"
    lake.lake_write(prices(spark, [("A", 1.0, 1), ("B", 2.0, 2)]), path)
    lake.lake_write(prices(spark, [("A", 5.0, 3)]), path)
    assert stored(spark, path) == [("A", 5.0, 3), ("B", 2.0, 2)]
    with pytest.raises(ValueError):
        lake.lake_write(prices(spark, []), path, "merge")
    assert lake.parse_fields("a, b c") == ["a", "b", "c"]


def test_upsert_moves_between_partitions_and_empties_one(spark, tmp_path):
    path = f"{tmp_path}/t"
    lake.lake_upsert(prices(spark, [("A", 1.0, 1), ("B", 2.0, 2), ("it's/odd=1", 3.0, 3), (None, 4.0, 4)]), path, ["id"], ["symbol"])
    lake.lake_upsert(prices(spark, [("B", 9.0, 1), ("B", 8.0, 3), ("B", 7.0, 4), ("B", 6.0, 4)]), path, ["id"], ["symbol"], order=["price"])
    assert stored(spark, path) == [("B", 2.0, 2), ("B", 7.0, 4), ("B", 8.0, 3), ("B", 9.0, 1)]
    assert [d for d in os.listdir(path) if d.startswith("symbol=")] == ["symbol=B"]


def test_upsert_with_two_partition_columns(spark, tmp_path):
    path, schema = f"{tmp_path}/t", "id int, v string, a string, b int"
    first = [(1, "x", "p", 1), (2, "x", "p", None), (3, "x", None, 1), (4, "x", "q", 2)]
    second = [(1, "y", "p", 2), (2, "y", "p", None), (3, "y", "q", 2)]
    for batch in (first, second):
        lake.lake_upsert(spark.createDataFrame(batch, schema), path, ["id"], ["a", "b"])
    got = spark.read.schema("id int, v string, a string, b int").parquet(path)
    assert rows(got) == sorted([(1, "y", "p", 2), (2, "y", "p", None), (3, "y", "q", 2), (4, "x", "q", 2)], key=repr)


def test_commit_is_applied_once(spark, tmp_path):
    path = f"{tmp_path}/t"
    lake.lake_upsert(prices(spark, [("A", 1.0, 1)]), path, ["id"], ["symbol"], commit_id="1")
    lake.lake_upsert(prices(spark, [("A", 2.0, 1)]), path, ["id"], ["symbol"], commit_id="2")
    lake.lake_upsert(prices(spark, [("A", 1.0, 1)]), path, ["id"], ["symbol"], commit_id="1")
    assert stored(spark, path) == [("A", 2.0, 1)]


def test_upsert_recovers_from_a_crash_during_the_swap(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/t"
    lake.lake_upsert(prices(spark, [("A", 1.0, 1), ("A", 2.0, 2), ("B", 3.0, 3)]), path, ["id"], ["symbol"], commit_id="1")

    def crash(folder, name, to):
        # The old files of a partition are gone, and then the job is.
        raise RuntimeError("lost")

    batch = prices(spark, [("A", 9.0, 1)])
    with monkeypatch.context() as patched:
        patched.setattr(lake.Folder, "rename", crash)
        with pytest.raises(RuntimeError):
            lake.lake_upsert(batch, path, ["id"], ["symbol"], commit_id="2")
    lake.lake_upsert(batch, path, ["id"], ["symbol"], commit_id="2")
    assert stored(spark, path) == [("A", 2.0, 2), ("A", 9.0, 1), ("B", 3.0, 3)]


def test_changes_may_come_late_or_twice(spark, tmp_path):
    path, schema = f"{tmp_path}/t", "id int, v string, part string, op string, n bigint"
    first = spark.createDataFrame([(1, "a", "p", "INSERT", 1), (2, "a", "q", "INSERT", 1)], schema)
    second = spark.createDataFrame([(1, "b", "q", "UPDATE", 3), (2, "a", "q", "DELETE", 2)], schema)
    late = spark.createDataFrame([(1, "old", "p", "UPDATE", 2)], schema)
    for batch in (first, second, late, second):
        lake.apply_changes(batch, path, ["id"], ["part"], ["n"], version="n")
    assert rows(spark.read.schema("id int, v string, n bigint, part string").parquet(path), "id", "v", "part") == [(1, "b", "q")]


def test_overwrite_touches_only_its_partitions(spark, tmp_path):
    path = f"{tmp_path}/t"
    lake.lake_append(prices(spark, [("A", 1.0, 1), ("B", 2.0, 2)]), path, ["symbol"])
    lake.lake_overwrite(prices(spark, [("A", 5.0, 5)]), path, ["symbol"])
    assert stored(spark, path) == [("A", 5.0, 5), ("B", 2.0, 2)]


def test_partition_folders_are_escaped_as_spark_does(spark, tmp_path):
    odd = ["a b", "a/b", "50%", "x=y", "it's", "ä", None, ""]
    path = f"{tmp_path}/t"
    spark.createDataFrame([(v, i) for i, v in enumerate(odd)], "p string, i int").write.partitionBy("p").parquet(path)
    assert {d for d in os.listdir(path) if d.startswith("p=")} == {partition_folder(["p"], [v]) for v in odd}


def test_partition_commit_waits_for_its_delay(spark, tmp_path):
    path = f"{tmp_path}/t"
    batch = spark.createDataFrame([(1, 2.0), (2, 3.0)], "sensor_id int, temperature double")
    waiting = files.PartitionCommit(path, ["sensor_id"], delay=3600)
    waiting(batch, 0)
    assert not glob.glob(f"{path}/sensor_id=*/_SUCCESS")
    due = files.PartitionCommit(path, ["sensor_id"], delay=0)
    due(batch.filter("sensor_id = 1"), 1)
    due(batch.filter("sensor_id = 1"), 1)  # a replay replaces the batch
    assert len(glob.glob(f"{path}/sensor_id=*/_SUCCESS")) == 2
    assert spark.read.schema("temperature double, sensor_id int").json(path).count() == 3


def test_json_lines_and_partition_columns(spark, tmp_path):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 5), "A", None)], "ts timestamp, t string, n int")
    files.write_json_lines(df, f"{tmp_path}/l", timestamps=["ts"], bucket_ts="ts")
    (name,) = glob.glob(f"{tmp_path}/l/bucket=*/part-*")
    assert json.loads(open(name).read()) == {"ts": 1704085200000, "t": "A", "n": None}
    files.write_partitioned_sql(df, f"{tmp_path}/p", "ts")
    (name,) = glob.glob(f"{tmp_path}/p/dt=2024-01-01/hr=05/part-*")
    assert "dt" not in open(name).read()


# --- JDBC: the connection is a stand-in that notes what it is sent ---------------------------------------------------


class Connection:
    def __init__(self, folder, fail_first=0):
        self.folder, self.fail_first = folder, fail_first

    def cursor(self):
        return self

    def executemany(self, statement, chunk):
        tries = len(os.listdir(self.folder))
        name = os.path.join(self.folder, f"{tries:04d}-{os.urandom(4).hex()}")
        failed = tries < self.fail_first
        with open(name, "w") as out:
            json.dump({"statement": statement, "rows": chunk, "failed": failed}, out)
        if failed:
            raise ConnectionError("gone")

    def commit(self):
        pass

    def close(self):
        pass


def calls(folder):
    return [json.load(open(f"{folder}/{n}")) for n in sorted(os.listdir(folder))]


def test_upsert_statements():
    got = jdbc.upsert_statement("prices", ["symbol", "price", "timestamp"], ["symbol"])
    assert got == (
        "INSERT INTO prices (symbol, price, timestamp) VALUES (%s, %s, %s) "
        "ON CONFLICT(symbol) DO UPDATE SET price = EXCLUDED.price, timestamp = EXCLUDED.timestamp"
    )
    assert "ON DUPLICATE KEY UPDATE price = VALUES(price)" in jdbc.upsert_statement("t", ["k", "price"], ["k"], jdbc.MYSQL)
    assert jdbc.upsert_statement("t", ["k", "v"], ["k"], jdbc.ANSI, "?").startswith("MERGE INTO t t USING (SELECT ? AS k, ? AS v)")
    with pytest.raises(ValueError):
        jdbc.upsert_statement("t", ["k"], ["k"], "dbase")


def test_jdbc_upsert_sends_last_row_per_key_in_batches(spark, tmp_path):
    folder = str(tmp_path)
    df = spark.createDataFrame([(f"s{i % 25}", float(i), i) for i in range(100)], "symbol string, price double, n int")
    jdbc.upsert_jdbc(df, lambda: Connection(folder, 2), "prices", ["symbol"], ["n"], batch=10, wait=0.0, connections=1)
    made = calls(folder)
    good = [c for c in made if not c["failed"]]
    assert sum(c["failed"] for c in made) == 2 and max(len(c["rows"]) for c in good) <= 10
    assert sorted(r[2] for c in good for r in c["rows"]) == list(range(75, 100))


def test_jdbc_gives_up_after_its_retries(spark, tmp_path):
    folder = str(tmp_path)
    df = spark.createDataFrame([("a", 1)], "symbol string, n int")
    with pytest.raises(JOB_ERRORS):
        jdbc.upsert_jdbc(df, lambda: Connection(folder, 99), "t", ["symbol"], ["n"], retries=2, wait=0.0)
    assert len(calls(folder)) == 3


def test_jdbc_changelog_deletes(spark, tmp_path):
    folder = str(tmp_path)
    df = spark.createDataFrame([(1, "a", "INSERT", 1), (2, "b", "INSERT", 1), (2, "b", "DELETE", 2)], "id int, v string, op string, n int")
    jdbc.upsert_jdbc_changelog(df, lambda: Connection(folder), "t", ["id"], ["n"], ["id", "v"])
    sent = {c["statement"].split()[0]: c["rows"] for c in calls(folder)}
    assert sent == {"INSERT": [[1, "a"]], "DELETE": [[2]]}


# --- services ---------------------------------------------------------------------------------------------------------


class Flaky:
    """Refuses each record the first time."""

    def __init__(self):
        self.seen = set()

    def put(self, records):
        assert len(records) <= 7
        failed = [i for i, r in enumerate(records) if r["data"] not in self.seen]
        self.seen.update(r["data"] for r in records)
        return failed


class Never:
    def put(self, records):
        return list(range(len(records)))


def test_refused_records_are_sent_again(spark):
    df = spark.range(50).repartition(3)
    assert service.write_queue(df, Flaky, batch=7, wait=0.0) == (50, 0)
    with pytest.raises(JOB_ERRORS):
        service.write_delivery_stream(df, Never, attempts=2, wait=0.0)


class Ordered:
    """Checks that the chunks of a series come in order."""

    def __init__(self):
        self.last = {}

    def put(self, records):
        for r in records:
            series = str(r["labels"])
            assert r["chunk"] == self.last.get(series, -1) + 1
            self.last[series] = r["chunk"]
        return []


def test_samples_leave_in_order_and_are_discarded_when_refused(spark):
    df = spark.range(300).select(F.array(F.lit("a")).alias("x"), F.create_map(F.lit("room"), (F.col("id") % 3).cast("string")).alias("labels"),
                                 F.lit("t").alias("metric"), F.floor(F.col("id") / 3).alias("chunk")).drop("x").orderBy(F.rand(1))
    assert service.write_metric_samples(df, Ordered, batch=7) == (300, 0)
    assert service.write_metric_samples(df, Never, attempts=3) == (0, 300)


def test_fan_out_needs_a_sink(spark):
    with pytest.raises(ValueError):
        service.fan_out(spark.range(1), {})
    assert service.fan_out(spark.range(3), {"a": lambda d: d.count(), "b": lambda d: d.count() + 1}) == {"a": 3, "b": 4}


# --- enrichment -------------------------------------------------------------------------------------------------------


class Scripted:
    """Answers by row: a list of codes, the last one repeated; a slow row ends in the client's own time-out, a late one in its deadline."""

    script = {"ok": [200], "late": [200], "retry": [500, 200], "fail": [500], "missing": [404], "crash": [None]}

    def __init__(self):
        self.calls = {}

    def __call__(self, row, remaining):
        kind = row["kind"]
        if kind == "slow":
            raise TimeoutError
        if kind == "late":
            time.sleep(1.0)
        n = self.calls[kind] = self.calls.get(kind, 0) + 1
        codes = self.script[kind]
        code = codes[min(n, len(codes)) - 1]
        if code is None:
            raise OSError("reset")
        return code


def kinds(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "kind string").coalesce(1)


def test_enrich_outcomes(spark):
    df = kinds(spark, "ok", "retry", "fail", "missing", "crash", "slow")
    kept = enrich.enrich(df, Scripted, capacity=1, pause=0.0, on_error="dead_letter", on_timeout="dead_letter")
    assert rows(kept) == [
        ("crash", "FAILED", -1, 3), ("fail", "FAILED", 500, 3), ("missing", "FAILED", 404, 3), ("ok", "OK", 200, 1),
        ("retry", "OK", 200, 2), ("slow", "FAILED", -1, 3),
    ]
    assert rows(enrich.enrich(df, Scripted, pause=0.0, on_error="drop"), "kind") == [("ok",), ("retry",)]
    assert rows(enrich.enrich(kinds(spark, "ok", "late"), Scripted, timeout=0.3, pause=0.0), "kind") == [("ok",)]
    told = enrich.enrich(kinds(spark, "ok", "late"), Scripted, timeout=0.3, pause=0.0, on_timeout="dead_letter")
    assert rows(told, "kind", "status") == [("late", "TIMEOUT"), ("ok", "OK")]
    for bad in ("fail", "slow"):  # the client's own time-out is an error like others
        with pytest.raises(JOB_ERRORS):
            enrich.enrich(kinds(spark, "ok", bad), Scripted, pause=0.0).collect()
    with pytest.raises(ValueError):
        enrich.enrich(df, Scripted, on_error="ignore")


def statuses(client, rows_in, **options):
    return {a.row: (a.status, a.attempts) for a in ask_all(rows_in, client, **options)}


def test_deadline_covers_all_attempts():
    got = statuses(lambda row, left: 500, [1], capacity=2, timeout=0.05, attempts=3, pause=1.0, accept=lambda v: v == 200)
    assert got == {1: ("TIMEOUT", 1)}


def test_deadline_holds_for_clients_that_ignore_it():
    def client(row, left):
        time.sleep({"late": 0.4, "stuck": 30.0}.get(row, 0.0))
        return 200

    began = time.monotonic()
    got = statuses(client, ["late", "stuck", *range(20)], capacity=2, timeout=0.15, attempts=1)
    assert time.monotonic() - began < 5
    assert got["late"][0] == got["stuck"][0] == "TIMEOUT" and all(got[i] == ("OK", 1) for i in range(20))


def test_rows_do_not_wait_for_a_slower_one():
    order = [a.row for a in ask_all(range(50), lambda row, left: time.sleep(0.3 if row == 0 else 0.0), capacity=4, timeout=5.0)]
    assert order[-1] == 0 and sorted(order) == list(range(50))


def test_blank_partition_is_the_null_partition(spark, tmp_path):
    path, schema = f"{tmp_path}/t", "id int, part string"
    lake.lake_upsert(spark.createDataFrame([(1, None), (2, "x")], schema), path, ["id"], ["part"])
    lake.lake_upsert(spark.createDataFrame([(3, "")], schema), path, ["id"], ["part"])
    assert rows(spark.read.schema(schema).parquet(path)) == sorted([(1, None), (2, "x"), (3, None)], key=repr)


def test_narrower_and_wider_rows_keep_the_columns_of_the_table(spark, tmp_path):
    path = f"{tmp_path}/t"
    lake.lake_upsert(spark.createDataFrame([(1, "a", "p"), (2, "b", "p")], "id int, extra string, part string"), path, ["id"], ["part"])
    lake.lake_upsert(spark.createDataFrame([(2, "p"), (3, "p")], "id int, part string"), path, ["id"], ["part"])
    lake.lake_upsert(spark.createDataFrame([(4, 9, "p")], "id int, more int, part string"), path, ["id"], ["part"])
    got = spark.read.schema("id int, extra string, more int, part string").parquet(path)
    assert rows(got) == sorted([(1, "a", None, "p"), (2, None, None, "p"), (3, None, None, "p"), (4, None, 9, "p")], key=repr)


def test_repeated_keys_need_an_order(spark, tmp_path):
    with pytest.raises(ValueError, match="repeat a key"):
        lake.lake_upsert(prices(spark, [("A", 9.0, 1), ("A", 1.0, 1)]), f"{tmp_path}/t", ["id"], ["symbol"])
    with pytest.raises(ValueError, match="commit id"):
        lake.lake_write(prices(spark, []), f"{tmp_path}/t", "overwrite", commit_id="c")


def test_append_with_a_commit_id_is_added_once_and_goes_on_after_a_crash(spark, tmp_path, monkeypatch):
    path, batch = f"{tmp_path}/t", prices(spark, [("A", 1.0, 1), ("B", 2.0, 2), ("C", 3.0, 3)])
    lake.lake_append(prices(spark, [("A", 0.0, 0)]), path, ["symbol"], "first")
    moved = []

    def crash_after_one(folder, name, to, real=lake.Folder.rename):
        if moved:
            raise RuntimeError("lost")
        moved.append(real(folder, name, to))

    with monkeypatch.context() as patched:
        patched.setattr(lake.Folder, "rename", crash_after_one)
        with pytest.raises(RuntimeError):
            lake.lake_append(batch, path, ["symbol"], "second")
    for _ in range(2):
        lake.lake_append(batch, path, ["symbol"], "second")
    assert stored(spark, path) == [("A", 0.0, 0), ("A", 1.0, 1), ("B", 2.0, 2), ("C", 3.0, 3)]


def test_noted_partitions_are_marked_without_another_batch(spark, tmp_path):
    batch = spark.createDataFrame([(1, 2.0), (2, 3.0)], "sensor_id int, temperature double")
    files.PartitionCommit(f"{tmp_path}/t", ["sensor_id"], delay=1)(batch, 0)
    assert not glob.glob(f"{tmp_path}/t/sensor_id=*/_SUCCESS")
    files.PartitionCommit(f"{tmp_path}/t", ["sensor_id"], delay=1).finish(spark)
    assert len(glob.glob(f"{tmp_path}/t/sensor_id=*/_SUCCESS")) == 2
