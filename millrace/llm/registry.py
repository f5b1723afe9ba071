"""Where the training-data queries register themselves; kept apart from the other queries."""

from __future__ import annotations

from pyspark.sql import SparkSession

from millrace.plans.registry import Query
from millrace.session import prepare

LLM_QUERIES: dict[str, Query] = {}


def query(sql: str | None = None):
    """Register a function ``(spark, sf_dir) -> DataFrame`` under its own name, with SQL that gives the same rows."""

    def register(function):
        def run(spark: SparkSession, sf_dir: str):
            return function(prepare(spark), sf_dir)

        LLM_QUERIES[function.__name__] = Query(run, sql)
        return function

    return register
