"""Projections, filters, formats, routing and user-defined functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import schemas
from millrace.functions import scalar, udfs
from millrace.operators import project
from millrace.plans.registry import query
from millrace.sources import files, kafka
from millrace.tables import events, table


# --- projections and filters -----------------------------------------------------------------------------------------


@query("SELECT event_id, ts, user_id, event_type, value, props FROM events")
def identity_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


CUSTOMER_NAMES = {"c_custkey": "customer_id", "c_name": "customer_name", "c_acctbal": "balance"}


@query("SELECT c_custkey AS customer_id, c_name AS customer_name, c_acctbal AS balance FROM customer")
def project_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project.project_rename(table(spark, sf_dir, "customer"), CUSTOMER_NAMES)


@query("""
    SELECT event_id, event_type, value, strftime(ts, '%Y-%m-%d') AS dt, strftime(ts, '%H') AS hr FROM events WHERE value > 50
""")
def filter_project_dt_hr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values above fifty with the date and hour they belong to."""
    rows = project.with_date_parts(events(spark, sf_dir), "ts").select("event_id", "event_type", "value", "dt", "hr")
    return project.above(rows, "value", 50)


@query("SELECT l_orderkey, l_linenumber, l_extendedprice, l_returnflag FROM lineitem WHERE l_returnflag = 'R'")
def filter_enum(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").filter(F.col("l_returnflag") == "R")
    flag = scalar.enum_value("l_returnflag", ["A", "N", "R"]).alias("l_returnflag")
    return rows.select("l_orderkey", "l_linenumber", "l_extendedprice", flag)


@query("""
    SELECT event_type, count(*) AS n, count(*) FILTER (value > 106) AS above_limit FROM events GROUP BY event_type
""")
def sql_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A temporary view queried with SQL."""
    return project.sql_view(
        events(spark, sf_dir), "all_events",
        "SELECT event_type, count(*) AS n, count_if(value > 106) AS above_limit FROM all_events GROUP BY event_type",
    )


@query("SELECT s_suppkey::INTEGER AS sensor_id, s_acctbal AS temperature_f, s_name AS label FROM supplier")
def insert_by_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows fitted to a target whose column names differ."""
    target = T.StructType().add("sensor_id", "integer").add("temperature_f", "double").add("label", "string")
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", "s_acctbal", "s_name")
    return project.insert_by_position(rows, target)


@query("SELECT 'events.parquet' AS _file_name, count(*) AS n, true AS is_dated FROM events")
def metadata_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per source file, from the metadata columns of the file reader."""
    rows = files.with_file_metadata(table(spark, sf_dir, "events"))
    return rows.groupBy("_file_name").agg(
        F.count(F.lit(1)).alias("n"), F.min("_file_modified_at").isNotNull().alias("is_dated")
    )


@query("SELECT event_type || ',' || printf('%.2f', value) AS line FROM events WHERE value > 106")
def format_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = project.above(events(spark, sf_dir), "value", 106)
    return rows.select(scalar.csv_pair("event_type", "value").alias("line"))


@query("SELECT count(*) AS received, count(*) FILTER (value > 106) AS filtered FROM events")
def row_counter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows before and after the filter, in one pass."""
    kept = F.col("value") > 106
    return events(spark, sf_dir).agg(F.count(F.lit(1)).alias("received"), F.count_if(kept).alias("filtered"))


# --- routing ---------------------------------------------------------------------------------------------------------


@query("""
    SELECT event_id, CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'SUCCESS' END AS outcome,
           CASE WHEN event_type = 'error' THEN 'dead letters' ELSE 'main' END AS output,
           nullif(event_type, 'view') AS message
    FROM events
""")
def validate_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors go to the dead letters, everything else (null messages too) to the main output."""
    rows = events(spark, sf_dir).select("event_id", F.nullif("event_type", F.lit("view")).alias("message"))
    tagged = project.with_outcome(rows, "message", poison="error")
    return tagged.withColumn("output", F.when(F.col("outcome") == scalar.ERROR, "dead letters").otherwise("main"))


@query("""
    SELECT o_orderkey, o_orderstatus || ';' || o_custkey AS joined, o_orderpriority AS plain, true AS is_hashed, 36 AS random_length
    FROM orders
""")
def partition_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Output keys by each strategy."""
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        scalar.key_of_columns(["o_orderstatus", "o_custkey"]).alias("joined"),
        F.col("o_orderpriority").alias("plain"),
        scalar.key_of_hash("o_orderkey").isNotNull().alias("is_hashed"),
        F.length(scalar.key_random()).alias("random_length"),
    )


@query("""
    WITH keys AS (SELECT event_id, CASE WHEN event_type <> 'signup' THEN event_type || '-' || user_id END AS key FROM events),
    hashed AS (SELECT event_id, key, list_reduce(list_transform(range(1, coalesce(length(key), 0) + 1), lambda i: ord(substr(key, i, 1))::BIGINT),
                   lambda h, b: (h * 31 + b) % 4294967296, 1::BIGINT) AS h FROM keys)
    SELECT event_id, coalesce(abs(CASE WHEN h >= 2147483648 THEN h - 4294967296 ELSE h END) % 12, 0)::INTEGER AS partition FROM hashed
    WHERE key IS NOT NULL
    UNION ALL SELECT event_id, 0 FROM hashed WHERE key IS NULL
""")
def hash_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partition of a keyed message among twelve; sign-ups have no key."""
    key = F.concat_ws("-", "event_type", F.col("user_id").cast("string"))
    keyed = events(spark, sf_dir).select("event_id", F.when(F.col("event_type") != "signup", key).alias("key"))
    return keyed.select("event_id", scalar.hash_partition("key", 12).alias("partition"))


# --- JSON and schema conversion --------------------------------------------------------------------------------------


@query("SELECT event_id, (props->>'$.k')::BIGINT AS k FROM events")
def json_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).select("event_id", scalar.json_decode("props", schemas.PROPS).alias("row"))
    return rows.select("event_id", "row.k")


@query("""
    SELECT event_id, CASE WHEN event_type = 'view' THEN NULL ELSE (props->>'$.k')::BIGINT END AS k
    FROM events WHERE event_type IN ('view', 'purchase')
""")
def json_lenient(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text damaged in different ways: not JSON, wrong type, empty; a missing field is no damage."""
    kind = F.col("event_type")
    damaged = (
        F.when(kind == "error", "not json")
        .when(kind == "signup", '{"k": "x"}')
        .when(kind == "click", "")
        .when(kind == "view", '{"other": 1}')
        .otherwise(F.col("props"))
    )
    rows = events(spark, sf_dir).select("event_id", damaged.alias("text"))
    return scalar.json_decode_lenient(rows, "text", schemas.PROPS).select("event_id", "row.k")


@query("""
    SELECT '{"event_id":' || event_id || ',"event_type":"' || event_type || '","value":' || value::DECIMAL(12,2)
           || ',"note":null}' AS line FROM events
""")
def json_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    note = F.lit(None).cast("string").alias("note")
    rows = events(spark, sf_dir).select("event_id", "event_type", F.col("value").cast("decimal(12,2)").alias("value"), note)
    return rows.select(scalar.json_encode("event_id", "event_type", "value", "note").alias("line"))


@query("""
    SELECT event_id, '{"ts":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.') || lpad((epoch_us(ts) // 1000 % 1000)::VARCHAR, 3, '0')
           || '"}' AS line, time_bucket(INTERVAL 1 MILLISECOND, ts) AS read_back FROM events
""")
def json_iso_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Timestamps as ISO text with milliseconds, written and read back."""
    rows = table(spark, sf_dir, "events").select("event_id", scalar.json_encode("ts", iso=True).alias("line"))
    schema = T.StructType().add("ts", T.TimestampNTZType())
    return rows.select("event_id", "line", scalar.json_decode("line", schema, iso=True)["ts"].alias("read_back"))


@query("""
    SELECT '{"c_custkey":' || c_custkey || ',"c_name":"' || c_name || '","c_nationkey":' || c_nationkey || ',"balance":'
           || c_acctbal::DECIMAL(12,2) || ',"c_mktsegment":"' || c_mktsegment || '"}' AS line FROM customer
""")
def record_to_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole records of a columnar file as JSON text."""
    rows = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_nationkey", F.col("c_acctbal").cast("decimal(12,2)").alias("balance"), "c_mktsegment"
    )
    return rows.select(scalar.json_encode(*rows.columns).alias("line"))


@query("""
    SELECT c_custkey, c_name, c_acctbal, CASE WHEN c_nationkey < 12 THEN 'UNKNOWN' ELSE c_mktsegment END AS c_mktsegment
    FROM customer
""")
def schema_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows written under two schema versions, read as the newer one."""
    rows = table(spark, sf_dir, "customer")
    is_old = F.coalesce(F.col("c_nationkey") < 12, F.lit(False))
    old = rows.filter(is_old).select(F.col("c_custkey").cast("int"), "c_name", "c_acctbal", "c_nationkey")
    new = rows.filter(~is_old)
    reader = T.StructType().add("c_custkey", "long").add("c_name", "string").add("c_acctbal", "double").add(
        "c_mktsegment", "string", False
    )
    return project.union_versions([old, new], reader, {"c_mktsegment": "UNKNOWN"})


@query("""
    SELECT event_id, event_type, CASE WHEN event_type = 'signup' THEN -1.0 ELSE value END AS value FROM events
""")
def registry_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages written under two registered schemas (sign-ups under the older), read as one."""
    older = T.StructType().add("event_id", "integer").add("event_type", "string")
    newer = T.StructType().add("event_id", "long").add("event_type", "string").add("value", "double").add("props", "string")
    is_older = F.col("event_type") == "signup"
    text = F.when(is_older, scalar.json_encode("event_id", "event_type")).otherwise(
        scalar.json_encode("event_id", "event_type", "value", "props")
    )
    messages = table(spark, sf_dir, "events").select(F.when(is_older, 1).otherwise(2).alias("version"), text.alias("message"))
    reader = T.StructType().add("event_id", "long").add("event_type", "string").add("value", "double")
    return project.decode_versions(messages, "message", "version", {1: older, 2: newer}, reader, {"value": -1.0})


@query("""
    SELECT doc_id, line FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents) WHERE line <> ''
""")
def unpack_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Containers of many JSON records (here the lines of a document), unpacked into one row per record."""
    lines = F.filter(F.split("text", "\n"), lambda line: line != "")
    records = F.transform(lines, lambda line: F.to_json(F.struct(line.alias("line"))))
    containers = table(spark, sf_dir, "documents").select("doc_id", records.alias("payloads"))
    return project.unpack_batches(containers, F.col("payloads"), T.StructType().add("line", "string"), keep=["doc_id"])


# --- Kafka-shaped records ---------------------------------------------------------------------------------------------


def _kafka_shaped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as the Kafka source would deliver them."""
    rows = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    return kafka.kafka_records(rows, key=F.col("event_type")).withColumn("value", F.col("value").cast("binary"))


_EVENT = T.StructType().add("event_id", "long").add("event_type", "string").add("value", "double")


@query("SELECT event_id, event_type, value FROM events")
def kafka_json_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kafka.json_rows(_kafka_shaped(spark, sf_dir), _EVENT)


@query("SELECT event_type || '/' || event_id AS value FROM events")
def kafka_text_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat_ws("/", "event_type", F.col("event_id").cast("string")).cast("binary")
    return kafka.text_rows(events(spark, sf_dir).select(text.alias("value")))


@query("SELECT event_id, event_type, value FROM events WHERE event_type <> 'error'")
def kafka_lenient_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records that do not decode are left out."""
    damaged = F.when(F.col("key") == "error", F.lit("{").cast("binary")).otherwise(F.col("value"))
    return kafka.lenient_json_rows(_kafka_shaped(spark, sf_dir).withColumn("value", damaged), _EVENT)


@query("SELECT event_type AS kind, count(*) AS n FROM events GROUP BY event_type")
def kafka_sql_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kafka.sql_rows(
        _kafka_shaped(spark, sf_dir), "kafka_events", _EVENT,
        "SELECT event_type AS kind, count(*) AS n FROM kafka_events GROUP BY event_type",
    )


@query("""
    SELECT '{"event_id":' || event_id || ',"event_type":"' || event_type || '"}' AS value, event_type AS key,
           (event_id % 4)::INTEGER AS partition FROM events
""")
def kafka_sink_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows in the shape the Kafka sink takes, keyed and placed."""
    rows = events(spark, sf_dir)
    return kafka.kafka_records(
        rows, scalar.json_encode("event_id", "event_type"), F.col("event_type"), F.col("event_id") % 4
    )


# --- numbers and user-defined functions -------------------------------------------------------------------------------

_FAHRENHEIT = "SELECT event_id, round(value * 9 / 5 + 32, 6) AS temperature_f FROM events"


@query(_FAHRENHEIT)
def temperature_f(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select("event_id", F.round(scalar.fahrenheit("value"), 6).alias("temperature_f"))


@query(_FAHRENHEIT)
def scalar_udf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same through a function registered for SQL."""
    udfs.register_udfs(spark)
    return project.sql_view(
        events(spark, sf_dir).select("event_id", "value"), "sensor_readings",
        "SELECT event_id, round(celsius_to_fahrenheit(value), 6) AS temperature_f FROM sensor_readings",
    )


_DETERMINANT = """
    SELECT l_orderkey, l_linenumber, cast(l_quantity::FLOAT::DOUBLE * l_extendedprice::FLOAT::DOUBLE
           - l_discount::FLOAT::DOUBLE * l_tax::FLOAT::DOUBLE AS FLOAT) AS det FROM lineitem
"""


def _matrices(spark: SparkSession, sf_dir: str) -> DataFrame:
    elements = zip("abcd", ["l_quantity", "l_discount", "l_tax", "l_extendedprice"])
    floats = [F.col(column).cast("float").alias(name) for name, column in elements]
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", *floats)


@query(_DETERMINANT)
def det2x2(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _matrices(spark, sf_dir)
    return rows.select("l_orderkey", "l_linenumber", scalar.determinant("a", "b", "c", "d").alias("det"))


@query(_DETERMINANT)
def multi_arg_udf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same through a function on Arrow batches that uses a numeric library."""
    udfs.register_udfs(spark)
    return project.sql_view(
        _matrices(spark, sf_dir), "matrices", "SELECT l_orderkey, l_linenumber, determinant(a, b, c, d) AS det FROM matrices"
    )


@query("""
    SELECT l_orderkey, l_linenumber,
           round(cast(cast(greatest(0.01::DOUBLE, l_extendedprice * (1 + (l_discount * 100 - 5) / 100.0::DOUBLE)) AS VARCHAR)
                      AS DECIMAL(38,20)), 2)::DECIMAL(10,2) AS price
    FROM lineitem
""")
def decimal_round(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices moved by a percentage, rounded half up."""
    price = scalar.price_after_change("l_extendedprice", F.col("l_discount") * 100 - 5)
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", price.alias("price"))
