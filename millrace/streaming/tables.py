"""Tables kept by streams: appended to, upserted and kept current by changes, each micro-batch exactly once.

A micro-batch is written under the id of its query and its own number, which a replay after a crash repeats, so the write
finishes what was begun or finds that it was done. The id of a query lives in its checkpoint: a query that is begun anew with
another checkpoint writes all its batches.

Changes may come late, twice and in any order. ``newer_changes`` holds the last change of each key in state, that of a
removal too, and lets only those changes pass that are newer than all before; so nothing that was removed comes back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.readwriter import DataStreamWriter

from millrace.sinks import lake
from millrace.streaming.run import each_batch


def commit_of(batch: DataFrame, batch_id: int) -> str:
    """The name of a micro-batch, the same in every replay."""
    query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not query:
        raise ValueError("a micro-batch is written by the streaming query it belongs to")
    return f"{query}-{batch_id}"


def append_stream(df: DataFrame, path: str, partition_by: Sequence[str], checkpoint: str) -> DataStreamWriter:
    """Add each micro-batch to a table once."""
    return each_batch(df, lambda rows, n: lake.lake_append(rows, path, partition_by, commit_of(rows, n)), checkpoint)


def upsert_stream(
    df: DataFrame, path: str, keys: Sequence[str], partition_by: Sequence[str], order: Sequence[str], checkpoint: str
) -> DataStreamWriter:
    """Upsert each micro-batch once; of several rows of a key in it the last by ``order`` stays."""
    return each_batch(df, lambda rows, n: lake.lake_upsert(rows, path, keys, partition_by, order, commit_of(rows, n)), checkpoint)


def newer_changes(changes: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Of a stream of changes those that are newer, by ``order``, than all changes of their key before; in a micro-batch the last one.

    ``order`` is the version of a change and tells any two of a key apart; a change with a version that was seen is a replay.
    Keys and versions can be of any type that has an order; a null version is older than all others. State is the newest change
    of each key, of removed keys as well, and for ever: a change that comes a year late is still late. It is that of a streaming
    aggregate, so the result is to be written in update mode.
    """
    # The time of a micro-batch is one value, which a replay repeats. Of equal versions the first to come stays, so a key whose
    # newest change came in an earlier micro-batch is known by its time.
    timed = changes.withColumn("_at", F.current_timestamp())
    version = F.struct(*[F.col(c).alias(f"_{i}") for i, c in enumerate(order)], (-F.unix_micros("_at")).alias("_first"))
    newest = timed.groupBy(*keys).agg(F.max_by(F.struct(*timed.columns), version).alias("_newest"))
    return newest.filter(F.col("_newest._at") == F.current_timestamp()).select(*[F.col("_newest")[c].alias(c) for c in changes.columns])


def current_table(
    changes: DataFrame, path: str, keys: Sequence[str], partition_by: Sequence[str], order: Sequence[str], checkpoint: str, op: str = "op"
) -> DataStreamWriter:
    """Keep a table at the current rows of a stream of changes, whatever order they come in.

    The table is that of the newest change of each key, without the keys whose newest change is a removal. Partition columns
    should follow from the key; then a micro-batch reads and rewrites only the partitions of its keys.
    """

    def write(rows: DataFrame, batch_id: int) -> None:
        lake.apply_changes(rows, path, keys, partition_by, order, op, commit_id=commit_of(rows, batch_id))

    return each_batch(newer_changes(changes, keys, order), write, checkpoint, "update")
