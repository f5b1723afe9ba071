"""Aggregates that no built-in function expresses: create and add, merge, result, as functions on pandas frames.

Prefer ``windows.Mergeable``, which stays inside the JVM. Here every task first folds its Arrow batches into one small
accumulator row per key, accumulators are merged in salted groups, and only then per key: no group ever holds raw rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.session import shuffle_partitions


def custom_aggregate(
    df: DataFrame,
    keys: Sequence[str],
    accumulator: T.StructType,
    add: Callable[[pd.DataFrame], dict],
    merge: Callable[[pd.DataFrame], dict],
    result: Callable[[pd.DataFrame], pd.DataFrame],
    output: T.StructType,
) -> DataFrame:
    """One row per key.

    ``add(rows of a key)`` and ``merge(accumulators of a key)`` return one accumulator as a dict of ``accumulator``'s
    fields; ``result(frame of keys and accumulators)`` returns a frame of ``output``'s fields. ``merge`` must be associative and
    commutative.
    """
    spark, keys = df.sparkSession, list(keys)
    partial = T.StructType([df.schema[k] for k in keys] + accumulator.fields)

    def fold(frame: pd.DataFrame, step) -> pd.DataFrame:
        groups = frame.groupby(keys, sort=False, dropna=False)
        rows = [{**dict(zip(keys, key)), **step(rows)} for key, rows in groups]
        return pd.DataFrame(rows, columns=partial.names)

    def fold_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            if len(batch):
                new = fold(batch, add)
                held = new if held is None else fold(pd.concat([held, new]), merge)
                if len(held) > 50_000:
                    yield held
                    held = None
        if held is not None:
            yield held

    def merge_group(frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([{**{k: frame[k].iloc[0] for k in keys}, **merge(frame)}], columns=partial.names)

    def finish(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield result(batch)[output.names]

    partials = df.mapInPandas(fold_batches, partial)
    salted = partials.withColumn("_salt", F.spark_partition_id() % shuffle_partitions(spark))
    merged = salted.groupBy(*keys, "_salt").applyInPandas(merge_group, partial)
    final = merged.groupBy(*keys).applyInPandas(merge_group, partial)
    return final.mapInPandas(finish, output)
