"""What the physical plans must and must not contain."""

import pytest
from pyspark.sql import functions as F

from millrace.operators import ordered
from millrace.plans.catalogue import QUERIES
from millrace.sinks import lake

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_pairwise_joins(spark, name):
    text = plan(QUERIES[name].run(spark, SF_DIR))
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text


@pytest.mark.parametrize(
    "name,pushed",
    [
        ("filter_project_dt_hr", "GreaterThan(value,50.0)"),
        ("filter_enum", "EqualTo(l_returnflag,R)"),
        ("format_rows", "GreaterThan(value,106.0)"),
    ],
)
def test_filters_reach_the_scan(spark, name, pushed):
    assert pushed in plan(QUERIES[name].run(spark, SF_DIR))


@pytest.mark.parametrize(
    "name,columns",
    [
        ("slide_event_min", "ReadSchema: struct<ts:timestamp_ntz,event_type:string,value:double>"),
        ("temperature_f", "ReadSchema: struct<event_id:bigint,value:double>"),
    ],
)
def test_scans_read_only_what_is_used(spark, name, columns):
    assert columns in plan(QUERIES[name].run(spark, SF_DIR))


def test_ordered_operators_write_only_what_is_used(spark, monkeypatch):
    """The plan that is written out for the slices; what is returned starts at the written rows."""
    seen, keep = [], ordered.keep
    monkeypatch.setattr(ordered, "keep", lambda df, purpose: (seen.append(plan(df)), keep(df, purpose))[1])
    QUERIES["running_count"].run(spark, SF_DIR)
    assert "ReadSchema: struct<event_id:bigint,event_type:string>" in seen[0]


@pytest.mark.parametrize("name", ["slide_event_min", "tumble_avg_decimal", "vehicle_window_agg", "latest_by_key"])
def test_aggregates_are_partial_before_the_shuffle(spark, name):
    assert "partial_" in plan(QUERIES[name].run(spark, SF_DIR))


def test_ordered_rows_are_joined_only_with_the_short_list_of_carries(spark):
    df = spark.range(1000).select("id", F.when(F.col("id") < 900, "a").otherwise("b").alias("k"))
    text = plan(ordered.running_count(df, ["k"], ["id"], slices=4))
    assert "SortMergeJoin" not in text and "ShuffledHashJoin" not in text and "BroadcastHashJoin" in text


@pytest.mark.parametrize("name", ["running_count", "late_split", "late_split_single_source", "ema_last", "group_samples"])
def test_no_key_and_no_table_meets_in_one_task(spark, name):
    assert "SinglePartition" not in plan(QUERIES[name].run(spark, SF_DIR))


def test_upserts_read_only_their_partitions(spark, tmp_path):
    df = spark.range(100).select("id", (F.col("id") % 10).cast("int").alias("p"))
    lake.lake_append(df, f"{tmp_path}/t", ["p"])
    stored = lake._stored(spark, f"{tmp_path}/t", lake.Folder(spark, f"{tmp_path}/t"), ["p"], df.schema)
    labels = [r[0] for r in df.filter("p in (3, 4)").select(lake._label(["p"])).distinct().collect()]
    kept = lake._only(stored, labels, ["p"])
    assert "PartitionFilters: []" not in plan(kept) and sorted(f.rsplit("/", 2)[1] for f in kept.inputFiles()) and kept.count() == 20
