"""Tables kept as partitioned Parquet folders: append, replace touched partitions, upsert, apply changes.

On a catalog whose tables support ``MERGE`` use ``merge_table``. The folder form is copy-on-write: only partitions that a
batch touches are read and rewritten. A batch first writes the full new content of those partitions beside the table and
then moves the old content aside and it in; if the job dies in between, a rerun with the same commit id finds the finished copy
and goes on with the moves, and ``lake_table`` reads the new content from where it is. A commit id that was applied before is skipped, so replayed micro-batches change nothing, appended ones neither.

Where the key fixes the partition (partition columns are among the keys, like a hash of the key), an upsert reads no other
partitions than those of its rows. Otherwise it has to look for its keys in the whole table, in the key columns only.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.changes import REMOVALS, latest_by_key
from millrace.sinks.storage import SUCCESS_FILE, Folder, partition_folder

APPEND, OVERWRITE, UPSERT = "append", "overwrite", "upsert"
_COMMITS = "_commits"
_PLAN = "folder string, filled boolean, label string"


def parse_fields(text: str) -> list[str]:
    """Column list separated by commas and/or spaces."""
    return [name for name in re.split(r"[, ]+", text) if name]


def lake_write(
    df: DataFrame,
    path: str,
    operation: str = UPSERT,
    partition_by: str = "symbol",
    keys: str = "symbol",
    order: Sequence[str] = (),
    commit_id: str | None = None,
) -> None:
    """Write by the named operation; the defaults are an upsert on ``symbol`` partitioned by ``symbol``."""
    parts = parse_fields(partition_by)
    if operation == APPEND:
        lake_append(df, path, parts, commit_id)
    elif operation == OVERWRITE:
        if commit_id is not None:
            raise ValueError("an overwrite gives the same table when it is repeated and takes no commit id")
        lake_overwrite(df, path, parts)
    elif operation == UPSERT:
        lake_upsert(df, path, parse_fields(keys), parts, order, commit_id)
    else:
        raise ValueError(f"unknown operation {operation!r}")


def lake_append(df: DataFrame, path: str, partition_by: Sequence[str], commit_id: str | None = None) -> None:
    """Add rows. With a commit id the batch is written beside the table and moved in, and is added once however often sent."""
    if commit_id is None:
        _write(df, path, partition_by, "append")
        return
    folder, commit = Folder(df.sparkSession, path), f"{_COMMITS}/{commit_id}"
    if folder.exists(f"{commit}.done"):
        return
    if not folder.exists(f"{commit}/rows/{SUCCESS_FILE}"):
        _write(df, f"{path}/{commit}/rows", partition_by, "overwrite")
    for name in folder.files_below(f"{commit}/rows"):
        if not name.rsplit("/", 1)[-1].startswith(("_", ".")):
            folder.rename(f"{commit}/rows/{name}", name)
    folder.touch(f"{commit}.done")
    folder.remove(commit)


def _write(df: DataFrame, path: str, partition_by: Sequence[str], mode: str) -> None:
    df.hint("rebalance", *partition_by).write.mode(mode).partitionBy(*partition_by).parquet(path)


def lake_overwrite(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Replace the partitions that occur in ``df``, leave the others."""
    df.hint("rebalance", *partition_by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        *partition_by
    ).parquet(path)


def lake_upsert(
    df: DataFrame,
    path: str,
    keys: Sequence[str],
    partition_by: Sequence[str],
    order: Sequence[str] = (),
    commit_id: str | None = None,
) -> None:
    """Rows replace stored rows with equal keys. Of several incoming rows of a key the last by ``order`` wins; without an
    order a repeated key is an error. Columns that only the table or only the rows have are null in the others."""
    if order:
        df = latest_by_key(df, keys, order)
    elif df.groupBy(*keys).count().filter("count > 1").limit(1).count():
        raise ValueError(f"rows repeat a key of {list(keys)}; name the columns that order them")
    _merge(df.sparkSession, path, df, None, keys, partition_by, commit_id)


def apply_changes(
    changes: DataFrame,
    path: str,
    keys: Sequence[str],
    partition_by: Sequence[str],
    order: Sequence[str],
    op: str = "op",
    version: str | None = None,
    commit_id: str | None = None,
) -> None:
    """Apply a batch of changes: the last change of a key wins, a removal deletes its row.

    With ``version`` (a stored column that grows with every change of a key) a change older than the stored row is
    ignored, so batches may come late or twice. A removed row leaves no version behind: a change of it that comes after a
    later removal was applied brings it back.
    """
    incoming = latest_by_key(changes, keys, order, op, drop_removed=False)
    _merge(changes.sparkSession, path, incoming, op, keys, partition_by, commit_id, version)


def _same(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[c]) for c in columns])


def _label(columns: Sequence[str]) -> Column:
    """One text for a combination of partition values; only partition columns are in it, so filters on it prune folders."""
    return F.concat_ws("\u0001", *[F.coalesce(F.concat(F.lit("v"), F.col(c).cast("string")), F.lit("n")) for c in columns])


def _only(stored: DataFrame, labels: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Stored rows of the given partitions. The list is no longer than the table's own list of folders."""
    return stored.filter(_label(columns).isin(list(labels)))


def _stored(spark: SparkSession, path: str, folder: Folder, parts: Sequence[str], like: T.StructType) -> DataFrame:
    """The table with its own columns; partition columns have the types of the incoming rows. Empty if there is none yet."""
    if not any(name.startswith(f"{parts[0]}=") for name in folder.children()):
        return spark.createDataFrame([], like)
    return _read(spark, path, [path], parts, like)


def _merge(
    spark: SparkSession,
    path: str,
    incoming: DataFrame,
    op: str | None,
    keys: Sequence[str],
    partition_by: Sequence[str],
    commit_id: str | None,
    version: str | None = None,
) -> None:
    folder = Folder(spark, path)
    commit = f"{_COMMITS}/{commit_id or uuid.uuid4().hex}"
    if folder.exists(f"{commit}.done"):
        return
    parts, keys = list(partition_by), list(keys)
    if not folder.exists(f"{commit}/plan/{SUCCESS_FILE}"):
        _stage(spark, path, folder, commit, incoming, op, keys, parts, version)
    # Every touched partition with whether it has new content; a partition whose content was moved in before is passed over.
    for row in spark.read.schema(_PLAN).parquet(f"{path}/{commit}/plan").toLocalIterator():
        staged, aside = f"{commit}/rows/{row.folder}", f"{commit}/old/{row.folder}"
        if folder.exists(staged):
            if folder.exists(row.folder):
                folder.remove(aside)
                folder.rename(row.folder, aside)
            folder.rename(staged, row.folder)
        elif not row.filled:
            folder.remove(row.folder)
    folder.touch(f"{commit}.done")
    folder.remove(commit)


def _stage(spark, path, folder, commit, incoming, op, keys, parts, version) -> None:
    """Write the new content of the touched partitions, and the list of them, beside the table."""
    for p in parts:
        if incoming.schema[p].dataType == T.StringType():
            incoming = incoming.withColumn(p, F.nullif(F.col(p), F.lit("")))  # a folder cannot tell them apart
    # Used several times below, so it is written down once.
    incoming.write.mode("overwrite").parquet(f"{path}/{commit}/incoming")
    incoming = spark.read.schema(incoming.schema).parquet(f"{path}/{commit}/incoming")
    stored = _stored(spark, path, folder, parts, (incoming.drop(op) if op else incoming).schema)
    touched = incoming.select(*parts)
    if not set(parts) <= set(keys):
        # The key does not fix the partition: a replaced row may lie anywhere.
        there = stored.select(*dict.fromkeys([*keys, *parts]))
        touched = touched.union(there.join(incoming, _same(there, incoming, keys), "left_semi").select(*parts))
    named = [(row["_label"], partition_folder(parts, row)) for row in touched.select(*parts, _label(parts).alias("_label")).distinct().toLocalIterator()]
    there = _only(stored, [label for label, _ in named], parts)
    if version:
        newer = there.select(*dict.fromkeys([*keys, version])).filter(F.col(version).isNotNull())
        stale = _same(incoming, newer, keys) & (newer[version] > incoming[version])
        incoming = incoming.join(newer, stale, "left_anti")
    kept = there.join(incoming, _same(there, incoming, keys), "left_anti")
    if op:
        incoming = incoming.filter(~F.col(op).isin(REMOVALS) | F.col(op).isNull()).drop(op)
    _write(kept.unionByName(incoming, allowMissingColumns=True), f"{path}/{commit}/rows", parts, "overwrite")
    filled = {name.rsplit("/", 1)[0] for name in folder.files_below(f"{commit}/rows") if "/" in name}
    plan = [(name, name in filled, label) for label, name in named]
    spark.createDataFrame(plan, _PLAN).coalesce(1).write.mode("overwrite").parquet(f"{path}/{commit}/plan")


def lake_table(spark: SparkSession, path: str, partition_by: Sequence[str]) -> DataFrame:
    """The table as of its last write whose new content is complete, moved in or not.

    A plain read of the folder can meet a write between two moves, when a partition is away for a moment, or after a crash.
    This one takes what is not yet in its place from where it was written. A write that moves on meanwhile makes the read
    fail for a file that is gone; reading again then sees the new place.
    """
    folder, parts = Folder(spark, path), list(partition_by)
    found = _read(spark, path, [path], parts) if any(name.startswith(f"{parts[0]}=") for name in folder.children()) else None
    for name in sorted(folder.children(_COMMITS)):
        commit = f"{_COMMITS}/{name}"
        if name.endswith(".done") or folder.exists(f"{commit}.done") or not folder.exists(f"{commit}/plan/{SUCCESS_FILE}"):
            continue
        plan = [(row, folder.exists(f"{commit}/rows/{row.folder}")) for row in spark.read.schema(_PLAN).parquet(f"{path}/{commit}/plan").toLocalIterator()]
        if found is not None:
            found = found.filter(~_label(parts).isin([row.label for row, staged in plan if staged or not row.filled]))
        staged = [f"{path}/{commit}/rows/{row.folder}" for row, staged in plan if staged]
        if staged:
            new = _read(spark, f"{path}/{commit}/rows", staged, parts, found and found.schema)
            found = new if found is None else found.unionByName(new, allowMissingColumns=True)
    if found is None:
        raise ValueError(f"there is no table in {path}")
    return found


def _read(spark: SparkSession, base: str, paths: list[str], parts: list[str], like: T.StructType | None = None) -> DataFrame:
    """Rows of some folders; partition columns have the types they have in ``like``."""
    reader = spark.read.option("basePath", base)
    own = reader.option("mergeSchema", "true").parquet(*paths).schema
    fields = [f for f in own.fields if f.name not in parts] + [(like or own)[p] for p in parts]
    return reader.schema(T.StructType(fields)).parquet(*paths)


def merge_table(df: DataFrame, table: str, keys: Sequence[str], op: str | None = None) -> None:
    """The same through ``MERGE INTO`` on a catalog table whose format supports it."""
    match = reduce(lambda a, b: a & b, [F.col(f"{table}.{k}").eqNullSafe(F.col(f"_source.{k}")) for k in keys])
    merge = df.alias("_source").mergeInto(table, match)
    if op:
        gone = F.col(f"_source.{op}").isin(REMOVALS)
        values = {c: F.col(f"_source.{c}") for c in df.columns if c != op}
        merge = merge.whenMatched(gone).delete().whenMatched().update(values).whenNotMatched(~gone).insert(values)
    else:
        merge = merge.whenMatched().updateAll().whenNotMatched().insertAll()
    merge.merge()
