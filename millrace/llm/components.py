"""Connected components of a table of links, and the tables that steps hand to one another."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import shared_dir


class Steps:
    """Writes intermediate results as Parquet to a fresh shared folder, so that a lost executor costs no more than a step."""

    def __init__(self, spark: SparkSession, purpose: str):
        self.spark, self.folder, self.written = spark, shared_dir(spark, purpose), 0

    def keep(self, df: DataFrame) -> DataFrame:
        self.written += 1
        path = f"{self.folder}/{self.written}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


def connected(links: DataFrame, steps: Steps) -> DataFrame:
    """(id, component) of every id in ``links`` (a, b): component is the smallest id that can be reached.

    Alternating stars: every id links its larger neighbours to its smallest one, then its smaller ones, until nothing
    changes. Rounds grow with the logarithm of the longest chain; no step needs the neighbours of an id in one place.
    """
    edges = steps.keep(links.filter("a <> b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("m")).distinct())
    seen = None
    while (now := _digest(edges)) != seen:
        seen = now
        both = edges.select(F.col("v").alias("u"), F.col("m").alias("n")).union(edges.select(F.col("m"), F.col("v")))
        least = both.groupBy("u").agg(F.min("n").alias("n")).select("u", F.least("u", "n").alias("to"))
        large = both.join(least, "u").filter("n > u").select(F.col("n").alias("v"), F.col("to").alias("m")).distinct()
        least = large.groupBy("v").agg(F.min("m").alias("to"))
        small = large.join(least, "v").filter("m <> to").select(F.col("m").alias("v"), F.col("to").alias("m"))
        edges = steps.keep(small.union(least).distinct())
    roots = edges.select(F.col("m").alias("id")).distinct().withColumn("component", F.col("id"))
    return edges.select(F.col("v").alias("id"), F.col("m").alias("component")).union(roots)


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("v", "m"))).first())
