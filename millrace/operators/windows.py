"""Keyed time windows.

In a batch, sliding windows are computed from panes: rows are first aggregated into tumbling panes as wide as the common
divisor of size and slide, and only the panes are copied into the windows that cover them. A 30 s / 5 s window then
copies one partial row per pane and key six times instead of copying every input row six times. Both steps are ordinary
hash aggregates with map-side partials, so a key that holds a third of the rows leaves each map task as one partial row.

A stream uses the direct form: with panes a late row would be dropped once its pane is closed, although some of the
windows that cover it are still open.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.durations import interval, micros


@dataclass(frozen=True)
class Mergeable:
    """An aggregate that can be computed in parts and then merged.

    ``create`` maps part names to aggregates over input rows, ``merge`` maps the same names to aggregates over parts, and
    ``result`` turns merged parts into the column ``out``.
    """

    out: str
    create: Mapping[str, Column]
    merge: Mapping[str, Column]
    result: Column


def min_of(column: str, out: str) -> Mergeable:
    """Smallest value. NaN sorts last, so it is returned only when a window holds nothing else."""
    part = f"{out}_min"
    return Mergeable(out, {part: F.min(column)}, {part: F.min(part)}, F.col(part))


def avg_decimal_of(column: str, out: str, precision: int = 6, scale: int = 2) -> Mergeable:
    """Average of a decimal column, rounded half up and stored back as ``decimal(precision, scale)``.

    Values are summed as they are and the average is rounded once, whatever the precision asked for.
    """
    total, rows = f"{out}_sum", f"{out}_n"
    result = (F.col(total) / F.col(rows)).cast(f"decimal({precision},{scale})")
    created = F.sum(column)
    return Mergeable(
        out,
        {total: created, rows: F.count(column)},
        {total: F.sum(total), rows: F.sum(rows)},
        F.when(F.col(rows) > 0, result),
    )


def rows_in(out: str) -> Mergeable:
    part = f"{out}_rows"
    return Mergeable(out, {part: F.count(F.lit(1))}, {part: F.sum(part)}, F.col(part))


def windowed(
    df: DataFrame, ts: str, keys: Sequence[str], size: str, aggregates: Sequence[Mergeable], slide: str | None = None
) -> DataFrame:
    """Keys, ``window_start``, ``window_end`` and one column per aggregate; tumbling unless ``slide`` is given."""
    create = [column.alias(name) for agg in aggregates for name, column in agg.create.items()]
    if slide is None or slide == size or df.isStreaming:
        window = F.window(ts, size, slide) if slide else F.window(ts, size)
        merged = df.groupBy(window.alias("_window"), *keys).agg(*create)
    else:
        pane = interval(math.gcd(micros(size), micros(slide)))
        panes = df.groupBy(F.window(ts, pane).alias("_pane"), *keys).agg(*create)
        merge = [column.alias(name) for agg in aggregates for name, column in agg.merge.items()]
        merged = panes.groupBy(F.window("_pane.start", size, slide).alias("_window"), *keys).agg(*merge)
    return merged.select(
        *keys,
        F.col("_window.start").alias("window_start"),
        F.col("_window.end").alias("window_end"),
        *[agg.result.alias(agg.out) for agg in aggregates],
    )


def window_min(df: DataFrame, ts: str, key: str, value: str, size: str, slide: str | None = None) -> DataFrame:
    """Smallest ``value`` per key and window, with the window's bounds."""
    return windowed(df, ts, [key], size, [min_of(value, "min_value")], slide)


def window_avg_decimal(
    df: DataFrame, ts: str, key: str, value: str, size: str, slide: str | None = None, precision: int = 6, scale: int = 2
) -> DataFrame:
    """Decimal average of ``value`` per key and window."""
    return windowed(df, ts, [key], size, [avg_decimal_of(value, "avg_value", precision, scale)], slide)


def aggregate_by(df: DataFrame, keys: Sequence[str], aggregates: Sequence[Mergeable]) -> DataFrame:
    """The same aggregates without a window: one row per key."""
    create = [column.alias(name) for agg in aggregates for name, column in agg.create.items()]
    return df.groupBy(*keys).agg(*create).select(*keys, *[agg.result.alias(agg.out) for agg in aggregates])


_EVENT, _READING, _LIGHT = 0, 1, 2


def vehicle_window_agg(
    df: DataFrame,
    ts: str,
    key: str = "vin",
    readings: str = "sensorData",
    lights: str = "warningLights",
    size: str = "10 seconds",
) -> DataFrame:
    """Per key and window: the sum of each reading divided by the number of *events*, and the count of distinct lights.

    Every event becomes rows of a kind, a name and a number: one per reading, one per light, and one for the event itself that
    carries no name. They are summed per (window, key, kind, name), so no window is ever held as a list of rows. The division
    is on whole numbers and drops the remainder. The timestamp is the last millisecond of the window. A null map or list
    contributes nothing, its event still counts; a null light counts as one more light.
    """
    item = lambda kind, name, n: F.struct(F.lit(kind).cast("byte").alias("kind"), name.alias("name"), n.alias("n"))
    one, unnamed = F.lit(1).cast("long"), F.lit(None).cast("string")
    none = F.array().cast("array<struct<kind:tinyint,name:string,n:bigint>>")
    measured = F.transform(F.map_entries(readings), lambda e: item(_READING, e["key"], e["value"]))
    lit_up = F.transform(lights, lambda w: item(_LIGHT, w, one))
    items = F.concat(F.array(item(_EVENT, unnamed, one)), F.coalesce(measured, none), F.coalesce(lit_up, none))
    exploded = df.select(F.col(ts).alias("_ts"), F.col(key).alias("_key"), F.inline(items))
    if df.isStreaming:  # append mode needs the window itself in both groupings
        window, again, end = F.window("_ts", size), F.window(F.window_time("_w"), size), F.col("_of.end")
    else:
        window, again, end = F.window("_ts", size)["end"], F.col("_w"), F.col("_of")
    summed = exploded.groupBy(window.alias("_w"), "_key", "kind", "name").agg(F.sum("n").alias("_n"))
    per_window = summed.groupBy(again.alias("_of"), "_key").agg(
        F.max(F.when(F.col("kind") == _EVENT, F.col("_n"))).alias("_events"),
        F.count(F.when(F.col("kind") == _LIGHT, F.lit(1))).cast("int").alias("countDistinctWarnings"),
        F.collect_list(F.when(F.col("kind") == _READING, F.struct(F.col("name").alias("_name"), "_n"))).alias("_sums"),
    )
    averages = F.expr("map_from_entries(transform(array_sort(_sums), s -> struct(s._name, s._n div _events)))")
    return per_window.select(
        F.col("_key").alias(key), (F.unix_millis(end) - 1).alias("timestamp"), averages.alias("averageSensorData"),
        "countDistinctWarnings",
    )
