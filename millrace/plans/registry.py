"""Where the queries register themselves."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import prepare


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(sql: str | None = None):
    """Register a function ``(spark, sf_dir) -> DataFrame`` under its own name, with the SQL that gives the same rows."""

    def register(function):
        if function.__name__ in QUERIES:
            raise ValueError(f"two queries named {function.__name__}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return function(prepare(spark), sf_dir)

        QUERIES[function.__name__] = Query(run, sql)
        return function

    return register


def ntz(column: str | Column) -> Column:
    """A timestamp as the zone-less value the tables use."""
    return (F.col(column) if isinstance(column, str) else column).cast("timestamp_ntz")


def plain_bounds(df: DataFrame) -> DataFrame:
    return df.withColumn("window_start", ntz("window_start")).withColumn("window_end", ntz("window_end"))
