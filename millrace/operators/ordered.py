"""Per-key results that depend on the order of rows: running counts, running maxima, decaying averages, fixed-size chunks.

A window function sorts all rows of one key in one task. Here the rows are dealt by ranges of (key, order) instead, so that a
slice is as large as any other however the keys are distributed, and written once with their slice number. Windows then run
per (key, slice). What a slice needs from earlier slices of the same key (a count, a maximum) comes from a small aggregate;
only keys that cross from one slice to the next need it, fewer than there are slices, so that list can be sent to all
tasks. There is one algorithm for every size and every type that Spark can sort; nulls sort first. Rows that are equal in
the order columns are put in the order of a hash of the row, so they are spread too; only rows equal in every column are not.

These are batch operators; ``streaming.state`` has the forms for streams.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.durations import micros
from millrace.session import keep, shuffle_partitions

_SLICE, _TIE, _ALL, _CARRY = "_slice", "_tie", "_all", "_carry"


def _tie(df: DataFrame) -> Column:
    plain = [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.ArrayType, T.StructType, T.VariantType))]
    return F.xxhash64(*plain)


def with_slices(df: DataFrame, keys: Sequence[str], order: Sequence[str], slices: int | None = None) -> DataFrame:
    """The rows as a written table with their slice number: every row of a slice comes before every row of the next."""
    n = slices or shuffle_partitions(df.sparkSession)
    ranged = df.withColumn(_TIE, _tie(df)).repartitionByRange(n, *keys, *order, _TIE)
    return keep(ranged.withColumn(_SLICE, F.spark_partition_id()).withColumn(_ALL, F.lit(0)), "slices")


def _across(keys: Sequence[str]) -> W:
    return W.partitionBy(*(keys or [_ALL]))


def _with_carry(sliced: DataFrame, keys: Sequence[str], per_slice: Column, over: Column) -> DataFrame:
    """Rows with ``_carry``: ``over`` combines ``_part`` of the earlier slices of the key; null if there are none.

    A slice continues at most one key of the slice before it, so there are fewer carries than slices.
    """
    parts = sliced.groupBy(*(keys or [_ALL]), _SLICE).agg(per_slice.alias("_part"))
    earlier = _across(keys).orderBy(_SLICE).rowsBetween(W.unboundedPreceding, -1)
    placed = parts.withColumn("_first", F.row_number().over(_across(keys).orderBy(_SLICE)) == 1)
    carried = placed.withColumn(_CARRY, over.over(earlier)).filter(~F.col("_first"))
    small = carried.select(*[F.col(k).alias(f"_of_{k}") for k in keys], F.col(_SLICE).alias("_of_slice"), _CARRY)
    match = sliced[_SLICE] == small["_of_slice"]
    for k in keys:
        match = match & sliced[k].eqNullSafe(small[f"_of_{k}"])
    return sliced.join(F.broadcast(small), match, "left").select(*[sliced[c] for c in sliced.columns], _CARRY)


def _within(keys: Sequence[str], order: Sequence[str]) -> W:
    return W.partitionBy(*keys, _SLICE).orderBy(*order, _TIE)


def running_count(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str = "total_count", slices: int | None = None
) -> DataFrame:
    """Every row with its number (1, 2, 3, ...) within its key, in the given order."""
    placed = _with_carry(with_slices(df, keys, order, slices), keys, F.count(F.lit(1)), F.sum("_part"))
    number = F.row_number().over(_within(keys, order)) + F.coalesce(_CARRY, F.lit(0))
    return placed.withColumn(out, number.cast("long")).drop(_SLICE, _TIE, _ALL, _CARRY)


def running_max(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, out: str, slices: int | None = None
) -> DataFrame:
    """Every row with the largest ``value`` among the rows before it in its key (null for the first)."""
    placed = _with_carry(with_slices(df, keys, order, slices), keys, F.max(value), F.max("_part"))
    before = F.max(value).over(_within(keys, order).rowsBetween(W.unboundedPreceding, -1))
    return placed.withColumn(out, F.greatest(before, _CARRY)).drop(_SLICE, _TIE, _ALL, _CARRY)


def late_split(
    df: DataFrame,
    ts: str,
    arrival: Sequence[str],
    size: str,
    delay: str,
    source: Sequence[str] = (),
    slide: str | None = None,
    slices: int | None = None,
) -> DataFrame:
    """Mark the rows all of whose windows the watermark had closed when they arrived.

    The watermark is the largest timestamp among the rows that arrived before, less ``delay``, less one millisecond; a
    window closes when the watermark reaches its last millisecond. Windows tumble unless ``slide`` is given. ``source``
    names the source partition, each of which has its own watermark; without it there is a single one.
    """
    tracked = running_max(df, source, arrival, ts, "_seen", slices)
    at = F.unix_micros(ts)
    last_end = at - F.pmod(at, F.lit(micros(slide or size))) + micros(size)
    closed = last_end <= F.unix_micros("_seen") - micros(delay)
    return tracked.withColumn("is_late", F.coalesce(closed, F.lit(False))).drop("_seen")


def ema_last(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    out: str = "ema",
    decay: float = 0.1,
    slices: int | None = None,
) -> DataFrame:
    """Last value per key of ``avg = avg * (1 - decay) + x * decay``, starting at 0.

    A row's weight is ``decay * (1 - decay) ** (number of later rows)``. Each slice sums its rows with the count of later
    rows inside the slice; the slice sums are then weighted by the number of rows in later slices.
    """
    keep_share = 1 - decay
    sliced = with_slices(df.select(*dict.fromkeys([*keys, *order, value])), keys, order, slices)
    backwards = W.partitionBy(*keys, _SLICE).orderBy(*[F.col(c).desc() for c in [*order, _TIE]])
    weighted = sliced.withColumn("_later", F.row_number().over(backwards) - 1)
    parts = weighted.groupBy(*(keys or [_ALL]), _SLICE).agg(
        F.sum(F.col(value) * F.lit(decay) * F.pow(F.lit(keep_share), F.col("_later"))).alias("_part"),
        F.count(F.lit(1)).alias("_n"),
    )
    after = _across(keys).orderBy(F.col(_SLICE).desc()).rowsBetween(W.unboundedPreceding, -1)
    placed = parts.withColumn("_after", F.coalesce(F.sum("_n").over(after), F.lit(0)))
    return placed.groupBy(*keys).agg(F.sum(F.col("_part") * F.pow(F.lit(keep_share), F.col("_after"))).alias(out))


def chunked(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], size: int, out: str = "chunk", slices: int | None = None
) -> DataFrame:
    """Number the rows of each key into chunks of ``size`` consecutive rows (0, 1, 2, ...)."""
    numbered = running_count(df, keys, order, "_position", slices)
    return numbered.withColumn(out, F.floor((F.col("_position") - 1) / size).cast("long")).drop("_position")


def group_samples(
    df: DataFrame,
    metric: str,
    labels: Sequence[str],
    ts: str,
    value: str,
    order: Sequence[str] = (),
    size: int = 500,
    slices: int | None = None,
) -> DataFrame:
    """Time series for a metrics endpoint: metric name, label map, and samples in time order.

    A series is cut into chunks of at most ``size`` samples, so the longest series is many rows, never one list.
    """
    order = [ts, *order]
    rows = chunked(df.select(*dict.fromkeys([*labels, *order, value])), labels, order, size, slices=slices)
    series = rows.groupBy(*labels, "chunk").agg(
        F.array_sort(F.collect_list(F.struct(*order, F.col(value).alias("_value")))).alias("_rows")
    )
    pairs = [part for name in labels for part in (F.lit(name), F.col(name).cast("string"))]
    return series.select(
        F.lit(metric).alias("metric"),
        F.create_map(*pairs).alias("labels"),
        "chunk",
        F.transform("_rows", lambda r: F.struct(r["_value"].alias("value"), r[ts].alias("ts"))).alias("samples"),
    )
