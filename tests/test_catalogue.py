"""Every registered query against its SQL on the smallest tables."""

import math

import duckdb
import pytest

from millrace.plans.catalogue import QUERIES
from millrace.session import RUNTIME_CONF

SF_DIR = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    return value


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, oracle, name):
    query = QUERIES[name]
    got = query.run(spark, SF_DIR)
    assert query.sql, "every query has SQL"
    wanted = oracle.sql(query.sql)
    columns = sorted(got.columns)
    assert columns == sorted(wanted.columns)
    at = [wanted.columns.index(c) for c in columns]
    left = sorted((tuple(_plain(r[c]) for c in columns) for r in got.collect()), key=repr)
    right = sorted((tuple(_plain(r[i]) for i in at) for r in wanted.fetchall()), key=repr)
    assert left == right
    assert left


@pytest.mark.parametrize("name", ["stream_log_rows", "stream_log_sink", "change_log_rows", "stream_keyed_count", "slide_event_min", "stream_proc_windows"])
def test_queries_from_a_session_with_other_settings(spark, oracle, name):
    """The driver's session is a plain one; what a query needs it sets beside it."""
    plain = spark.newSession()
    for key in RUNTIME_CONF:
        plain.conf.unset(key)
    plain.conf.set("spark.sql.session.timeZone", "America/New_York")
    before = {key: plain.conf.get(key, None) for key in RUNTIME_CONF}
    assert QUERIES[name].run(plain, SF_DIR).count() == oracle.sql(f"SELECT count(*) FROM ({QUERIES[name].sql})").fetchall()[0][0]
    assert {key: plain.conf.get(key, None) for key in RUNTIME_CONF} == before
