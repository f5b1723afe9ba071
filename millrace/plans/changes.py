"""Change data and tables kept current by it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import changes
from millrace.plans.registry import ntz, query
from millrace.session import shared_dir
from millrace.sinks import lake
from millrace.sources import cdc, log
from millrace.tables import table


def order_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A change log from orders: all are inserted, open ones then raised and moved to urgent, pending ones deleted."""
    status = F.col("o_orderstatus")
    row = lambda op, seq, price, priority: F.struct(
        F.lit(op).alias("op"), F.lit(seq).cast("long").alias("seq"), price.alias("o_totalprice"), priority.alias("o_orderpriority")
    )
    price, priority = F.col("o_totalprice"), F.col("o_orderpriority")
    steps = F.array(
        row("INSERT", 0, price, priority),
        F.when(status == "O", row("UPDATE", 1, price * 2, F.lit("1-URGENT"))),
        F.when(status == "P", row("DELETE", 1, price, priority)),
    )
    exploded = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", F.col("o_orderdate").cast("timestamp").alias("op_ts"), F.explode(steps).alias("change")
    )
    return exploded.filter("change is not null").select("o_orderkey", "o_orderstatus", "op_ts", "change.*")


_CURRENT = """
    SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus = 'O' THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice,
           CASE WHEN o_orderstatus = 'O' THEN '1-URGENT' ELSE o_orderpriority END AS o_orderpriority
    FROM orders WHERE o_orderstatus <> 'P'
"""
_COLUMNS = ["o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]


@query(_CURRENT)
def latest_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The current orders from their change log."""
    return changes.latest_by_key(order_changes(spark, sf_dir), ["o_orderkey"], ["op_ts", "seq"], "op").select(*_COLUMNS)


@query(_CURRENT)
def apply_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The current orders from a stored table: inserts first, then the other changes. The table is partitioned by a hash of
    the key, so the key fixes the partition and a batch reads no others."""
    bucket = F.pmod(F.hash("o_orderkey"), F.lit(8)).alias("bucket")
    log_rows = order_changes(spark, sf_dir).select(*_COLUMNS, "op", "op_ts", "seq", bucket)
    path, keys = shared_dir(spark, "apply-changes"), ["o_orderkey", "bucket"]
    later = F.col("seq") > 0
    for step, batch in enumerate([log_rows.filter(~later), log_rows.filter(later)]):
        lake.apply_changes(batch, path, keys, ["bucket"], ["op_ts", "seq"], version="op_ts", commit_id=f"step-{step}")
    return spark.read.parquet(path).select(*_COLUMNS)


def _key_value_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as raw change records of a key-value table."""
    image = lambda price: F.struct(
        F.col("o_orderkey").cast("string").alias("partition-key"),
        F.col("o_orderpriority").alias("sort-key"),
        price.cast("decimal(20,2)").cast("string").alias("fieldOne"),
        F.lit(None).cast("string").alias("fieldTwo"),
    )
    name = F.when(F.col("o_orderstatus") == "F", "INSERT").when(F.col("o_orderstatus") == "O", "MODIFY").otherwise("REMOVE")
    return table(spark, sf_dir, "orders").select(
        name.alias("eventName"), F.col("o_orderdate").cast("timestamp").alias("created"),
        image(F.col("o_totalprice")).alias("oldImage"), image(F.col("o_totalprice") * 2).alias("newImage"),
    )


_DECODED = """
    SELECT CASE o_orderstatus WHEN 'F' THEN 'INSERT' WHEN 'O' THEN 'MODIFY' ELSE 'REMOVE' END AS "eventType",
           o_orderdate AS timestamp, o_orderkey::VARCHAR AS key, o_orderpriority AS sort_key,
           CASE WHEN o_orderstatus <> 'F' THEN o_totalprice::DECIMAL(20,2)::VARCHAR END AS old_price,
           CASE WHEN o_orderstatus <> 'P' THEN (o_totalprice * 2)::DECIMAL(20,2)::VARCHAR END AS new_price
    FROM orders
"""


def _flat(decoded: DataFrame) -> DataFrame:
    either = lambda name: F.coalesce(F.col(f"newItem.{name}"), F.col(f"oldItem.{name}"))
    return decoded.select(
        "eventType", ntz("timestamp").alias("timestamp"), either("partitionKey").alias("key"), either("sortKey").alias("sort_key"),
        F.col("oldItem.fieldOne").alias("old_price"), F.col("newItem.fieldOne").alias("new_price"),
    )


@query(_DECODED)
def decode_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Old and new items by kind of change."""
    raw = _key_value_changes(spark, sf_dir)
    return _flat(changes.decode_change(raw, "eventName", "created", "oldImage", "newImage"))


@query("""
    SELECT 'ChangeEvent{timestamp=' || strftime(timestamp, '%Y-%m-%dT%H:%M:%SZ') || ', eventType=' || "eventType"
           || ', oldItem=' || CASE WHEN old_price IS NULL THEN 'null' ELSE printf('DdbTableSchema{partitionKey=''%s'', sortKey=''%s'', fieldOne=''%s'', fieldTwo=''null''}', key, sort_key, old_price) END
           || ', newItem=' || CASE WHEN new_price IS NULL THEN 'null' ELSE printf('DdbTableSchema{partitionKey=''%s'', sortKey=''%s'', fieldOne=''%s'', fieldTwo=''null''}', key, sort_key, new_price) END
           || '}' AS line
    FROM (""" + _DECODED + ")")
def change_to_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _key_value_changes(spark, sf_dir)
    decoded = changes.decode_change(raw, "eventName", "created", "oldImage", "newImage")
    return decoded.select(changes.change_to_string().alias("line"))


@query(_DECODED)
def change_log_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same changes written to a message log as JSON and read back from it."""
    raw = _key_value_changes(spark, sf_dir)
    stream = shared_dir(spark, "change-log")
    log.write_stream_log(log.log_records(raw, F.col("newImage")["partition-key"]), stream)
    records = log.read_stream_log(spark, stream, log.TRIM_HORIZON, streaming=False)
    return _flat(cdc.read_change_stream(records, raw.schema["newImage"].dataType))


CUSTOMER_COPY = {"c_custkey": "customer_id", "c_name": "first_name", "c_mktsegment": "email"}


@query("""
    SELECT c_custkey AS customer_id, c_name AS first_name, c_mktsegment AS email,
           TIMESTAMP '2024-01-01' + to_seconds(c_custkey) AS _source_updated_at, true AS is_processed FROM customer
""")
def change_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source rows under the target's names with the time of the change and of its processing."""
    rows = table(spark, sf_dir, "customer").withColumn(
        "op_ts", F.timestamp_seconds(F.unix_timestamp(F.lit("2024-01-01 00:00:00")) + F.col("c_custkey"))
    )
    copied = changes.change_copy(changes.with_change_metadata(rows, "op_ts", "customer"), CUSTOMER_COPY)
    return copied.select(
        "customer_id", "first_name", "email", ntz("_source_updated_at").alias("_source_updated_at"),
        F.col("_change_processed_at").isNotNull().alias("is_processed"),
    )


@query("""
    SELECT 'U' AS op, c_custkey, c_acctbal + 1 AS c_acctbal, 'customer' AS _table_name, 'dbo' AS _schema_name, 'db' AS _db_name
    FROM customer WHERE c_acctbal >= 0
    UNION ALL SELECT 'DELETE', c_custkey, c_acctbal, 'customer', 'dbo', 'db' FROM customer WHERE c_acctbal < 0
""")
def cdc_table_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed change envelopes (written as files, read back with the declared schema) as rows with their origin."""
    before = F.struct("c_custkey", "c_acctbal")
    after = F.struct(F.col("c_custkey"), (F.col("c_acctbal") + 1).alias("c_acctbal"))
    removed = F.col("c_acctbal") < 0
    envelope = table(spark, sf_dir, "customer").select(
        F.when(removed, "DELETE").otherwise("U").alias("op"), F.current_timestamp().alias("op_ts"),
        F.col("c_custkey").alias("seq"), before.alias("before"), F.when(~removed, after).alias("after"),
        F.lit("customer").alias("table_name"), F.lit("dbo").alias("schema_name"), F.lit("db").alias("database_name"),
    )
    path = shared_dir(spark, "cdc-feed")
    envelope.write.parquet(path)
    rows = cdc.cdc_rows(cdc.read_cdc_table(spark, path, envelope.schema["before"].dataType, streaming=False))
    return rows.select("op", "c_custkey", "c_acctbal", "_table_name", "_schema_name", "_db_name")


# --- table writes -----------------------------------------------------------------------------------------------------

_SEGMENTS = ["c_mktsegment"]


@query("""
    SELECT c_custkey, c_acctbal, c_mktsegment FROM customer
    UNION ALL SELECT c_custkey, -c_acctbal, c_mktsegment FROM customer WHERE c_mktsegment = 'BUILDING'
""")
def lake_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, path = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_mktsegment"), shared_dir(spark, "append")
    lake.lake_write(rows, path, lake.APPEND, "c_mktsegment")
    more = rows.filter("c_mktsegment = 'BUILDING'").withColumn("c_acctbal", -F.col("c_acctbal"))
    for commit in ("more", "more"):  # sent twice, added once
        lake.lake_write(more, path, lake.APPEND, "c_mktsegment", commit_id=commit)
    return spark.read.parquet(path)


@query("""
    SELECT c_custkey, c_acctbal, c_mktsegment FROM customer WHERE c_mktsegment <> 'BUILDING'
    UNION ALL SELECT c_custkey, c_acctbal * 2, c_mktsegment FROM customer WHERE c_mktsegment = 'BUILDING' AND c_acctbal > 0
""")
def lake_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One partition replaced, the others untouched."""
    rows, path = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_mktsegment"), shared_dir(spark, "overwrite")
    lake.lake_write(rows, path, lake.APPEND, "c_mktsegment")
    fresh = rows.filter("c_mktsegment = 'BUILDING' and c_acctbal > 0").withColumn("c_acctbal", F.col("c_acctbal") * 2)
    lake.lake_write(fresh, path, lake.OVERWRITE, "c_mktsegment")
    return spark.read.parquet(path)


@query("""
    SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 0.0 ELSE c_acctbal END AS c_acctbal,
           CASE WHEN c_acctbal < 0 OR c_mktsegment = 'MACHINERY' THEN 'HOUSEHOLD' ELSE c_mktsegment END AS c_mktsegment FROM customer
    UNION ALL SELECT c_custkey + 1000000000, c_acctbal, 'AUTOMOBILE' FROM customer WHERE c_nationkey = 3
""")
def lake_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows replaced by key, moved between partitions (one of which empties), and added."""
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_mktsegment", "c_nationkey")
    stored, path = rows.drop("c_nationkey"), shared_dir(spark, "upsert")
    lake.lake_write(stored, path, lake.APPEND, "c_mktsegment")
    moved = stored.filter("c_acctbal < 0 or c_mktsegment = 'MACHINERY'").select(
        "c_custkey", F.greatest("c_acctbal", F.lit(0.0)).alias("c_acctbal"), F.lit("HOUSEHOLD").alias("c_mktsegment")
    )
    added = rows.filter("c_nationkey = 3").select(
        (F.col("c_custkey") + 1000000000).alias("c_custkey"), "c_acctbal", F.lit("AUTOMOBILE").alias("c_mktsegment")
    )
    for step in ("first", "first"):  # the second run of a commit changes nothing; keys lie in several partitions
        lake.lake_write(moved.unionByName(added), path, lake.UPSERT, "c_mktsegment", "c_custkey", commit_id=step)
    return spark.read.parquet(path)
