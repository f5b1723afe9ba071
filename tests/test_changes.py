import datetime as dt

import pytest

from millrace.operators import changes
from tests.conftest import JOB_ERRORS, rows

T0 = dt.datetime(2024, 1, 1)
LOG = "id int, v string, op string, op_ts timestamp, seq bigint"
CHANGES = [
    (1, "a", "INSERT", T0, 1), (1, "b", "UPDATE", T0, 2), (1, "c", "UPDATE", T0, 3),  # equal times, later number wins
    (2, "a", "INSERT", T0, 1), (2, "a", "DELETE", T0, 2),
    (3, "a", "INSERT", T0, 1), (3, "a", "REMOVE", T0, 2), (3, "d", "INSERT", T0, 3),  # back after a removal
]


def test_latest_by_key(spark):
    df = spark.createDataFrame(CHANGES, LOG)
    assert rows(changes.latest_by_key(df, ["id"], ["op_ts", "seq"], "op"), "id", "v") == [(1, "c"), (3, "d")]
    replayed = df.unionByName(df)
    assert rows(changes.latest_by_key(replayed, ["id"], ["op_ts", "seq"], "op"), "id", "v") == [(1, "c"), (3, "d")]
    assert rows(changes.latest_by_key(df, ["id"], ["op_ts", "seq"], "op", drop_removed=False), "id") == [(1,), (2,), (3,)]


IMAGE = "struct<`partition-key`:string,`sort-key`:string,fieldOne:string,fieldTwo:string>"


def _raw(spark, *names):
    old, new = ("p", "s", "1", None), ("p", "s", "2", "x")
    return spark.createDataFrame([(n, T0, old, new) for n in names], f"name string, at timestamp, old {IMAGE}, new {IMAGE}")


def test_decode_change(spark):
    got = {r.eventType: (r.oldItem and r.oldItem.fieldOne, r.newItem and r.newItem.fieldOne)
           for r in changes.decode_change(_raw(spark, "INSERT", "MODIFY", "REMOVE"), "name", "at", "old", "new").collect()}
    assert got == {"INSERT": (None, "2"), "MODIFY": ("1", "2"), "REMOVE": ("1", None)}


@pytest.mark.parametrize("name", ["TRUNCATE", None])
def test_unknown_change_fails(spark, name):
    with pytest.raises(JOB_ERRORS):
        changes.decode_change(_raw(spark, "INSERT", name), "name", "at", "old", "new").collect()


def test_change_as_text(spark):
    decoded = changes.decode_change(_raw(spark, "INSERT"), "name", "at", "old", "new")
    assert decoded.select(changes.change_to_string()).first()[0] == (
        "ChangeEvent{timestamp=2024-01-01T00:00:00Z, eventType=INSERT, oldItem=null, "
        "newItem=DdbTableSchema{partitionKey='p', sortKey='s', fieldOne='2', fieldTwo='x'}}"
    )


def test_envelope(spark):
    row = "struct<id:int,v:string>"
    df = spark.createDataFrame(
        [("INSERT", T0, 1, None, (1, "a")), ("DELETE", T0, 2, (1, "a"), None)],
        f"op string, op_ts timestamp, seq bigint, before {row}, after {row}",
    )
    assert rows(changes.flatten_envelope(df), "op", "id", "v") == [("DELETE", 1, "a"), ("INSERT", 1, "a")]


def test_unknown_event_names_fail_whatever_is_read(spark):
    item = "struct<`partition-key`:string,`sort-key`:string,fieldOne:string,fieldTwo:string>"
    df = spark.createDataFrame([("BOGUS", None, None, None), (None, None, None, None)], f"name string, at timestamp, old {item}, new {item}")
    for bad in (df.filter("name is not null"), df.filter("name is null")):
        decoded = changes.decode_change(bad, "name", "at", "old", "new")
        for read in (decoded.select("newItem").collect, decoded.count, decoded.select("eventType").collect):
            with pytest.raises(JOB_ERRORS):
                read()
