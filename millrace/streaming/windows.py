"""Windows, series and late rows from keyed state with timers, for what a streaming aggregate cannot express.

* ``proc_time_windows``: windows by the clock. They close when their time is over, whether or not more rows come.
* ``window_process``: a function of a whole event-time window, over items that merge and not over a list of its rows. Its state
  is that of streaming aggregates; only the function is Python.
* ``series_in_order``: samples of a series in event-time order over micro-batches, as the watermark passes them.
* ``late_rows``: rows that come after their window has closed, by a watermark of each source partition.

A key's rows are reduced in each task before they go to its state, where the result allows it.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from millrace.functions.durations import interval, micros
from millrace.streaming.state import nulls_first, share


@dataclass(frozen=True)
class Part:
    """A value of a window that is made of others of its kind: ``how`` is min, max, sum or count; without a column, rows are counted."""

    out: str
    how: str
    column: str | None = None

    def field(self, schema: T.StructType) -> T.StructField:
        if self.how == "count":
            return T.StructField(self.out, T.LongType())
        kind = schema[self.column].dataType
        if self.how == "sum":
            whole = isinstance(kind, T.IntegralType)
            kind = T.DecimalType(38, kind.scale) if isinstance(kind, T.DecimalType) else T.LongType() if whole else T.DoubleType()
        return T.StructField(self.out, kind)

    def merge(self, one, two):
        if one is None or two is None:
            return two if one is None else one
        return {"min": min, "max": max}[self.how](one, two) if self.how in ("min", "max") else one + two


def _reduced(keys: Sequence[str], parts: Sequence[Part], arrow: pa.Schema):
    """One row for each key of an Arrow batch."""

    def batches(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in incoming:
            asked = [([], "count_all") if p.column is None else (p.column, p.how) for p in parts]
            made = pa.Table.from_batches([batch]).group_by(list(keys), use_threads=False).aggregate(asked)
            names = ["count_all" if p.column is None else f"{p.column}_{p.how}" for p in parts]
            yield from made.select([*keys, *names]).rename_columns(arrow.names).cast(arrow).to_batches()

    return batches


class ProcessingTimeWindows(StatefulProcessor):
    """State is one merged row for each pane of a key; a timer at the end of each window merges its panes."""

    def __init__(self, keys: Sequence[str], parts: Sequence[Part], merged: T.StructType, size: int, slide: int):
        self.keys, self.parts, self.merged, self.size, self.slide = list(keys), list(parts), merged, size, slide
        self.pane = math.gcd(size, slide)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.panes = handle, handle.getMapState("panes", "start bigint", self.merged)

    def _join(self, one, two):
        return tuple(p.merge(a, b) for p, a, b in zip(self.parts, one, two, strict=True))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        now = timerValues.getCurrentProcessingTimeInMs()
        at = (now - now % self.pane,)
        known = self.panes.getValue(at)
        held = None if known is None else tuple(known)
        if held is None:
            last = now - now % self.slide
            for start in range(last, at[0] - self.size, -self.slide):
                self.handle.registerTimer(start + self.size)
        for row in rows:
            part = tuple(row[p.out] for p in self.parts)
            held = part if held is None else self._join(held, part)
        self.panes.updateValue(at, held)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        end = expiredTimerInfo.getExpiryTimeInMs()
        merged, over = None, []
        for (pane,), held in self.panes.iterator():
            if end - self.size <= pane < end:
                merged = tuple(held) if merged is None else self._join(merged, tuple(held))
            if pane - pane % self.slide + self.size <= end:
                over.append(pane)
        for pane in over:
            self.panes.removeKey((pane,))
        if merged is not None:
            yield Row(*self.keys, "_start", "_end", *(p.out for p in self.parts))(*key, end - self.size, end, *merged)

    def close(self) -> None:
        pass


def _fields(df: DataFrame, names: Sequence[str]) -> list[T.StructField]:
    return [T.StructField(n, df.schema[n].dataType) for n in names]


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


_BOUNDS = [T.StructField("_start", T.LongType()), T.StructField("_end", T.LongType())]


def _with_bounds(df: DataFrame, keys: Sequence[str], rest: Sequence[str]) -> DataFrame:
    bounds = [F.timestamp_millis("_start").alias("window_start"), F.timestamp_millis("_end").alias("window_end")]
    return df.select(*keys, *bounds, *rest)


def proc_time_windows(df: DataFrame, keys: Sequence[str], size: str, parts: Sequence[Part], slide: str | None = None) -> DataFrame:
    """Keys, ``window_start``, ``window_end`` and the parts of each window of processing time, on a stream.

    A row's processing time is that of its micro-batch. A window comes out once, in the first micro-batch after its end; such
    a batch is made by the clock and needs no new rows, so the query has to be run by a trigger and not only to the end of the
    input (see ``run.run_until``).
    """
    merged = T.StructType([p.field(df.schema) for p in parts])
    reduced = T.StructType([*_fields(df, keys), *merged.fields])
    wanted = dict.fromkeys([*keys, *(p.column for p in parts if p.column)])
    few = df.select(*wanted).mapInArrow(_reduced(keys, parts, _arrow(reduced)), reduced)
    millis = [micros(t) // 1000 for t in (size, slide or size)]
    processor = ProcessingTimeWindows(keys, parts, merged, *millis)
    schema = T.StructType([*_fields(df, keys), *_BOUNDS, *merged.fields])
    closed = few.groupBy(*keys).transformWithState(processor, schema, "append", "processingTime")
    return _with_bounds(closed, keys, [p.out for p in parts])


def window_process(
    df: DataFrame, ts: str, delay: str, keys: Sequence[str], size: str, items: Column,
    finish: Callable[[Mapping[str, int | None]], tuple], output: T.StructType,
) -> DataFrame:
    """A function of each whole event-time window of a stream: keys, ``window_start``, ``window_end`` and what it returns.

    A row gives ``items``, an array of (item, n); the function gets the total of each item of the window (None if there are but
    nulls) and never its rows.
    Totals merge in the tasks, in state and over micro-batches, so a window costs as much as it has different items. Spark's own
    aggregates keep them, and Python is called with the closed windows of a micro-batch only, many at a time. A row whose window
    the watermark (``delay`` behind the newest row of the micro-batches before) has closed comes too late and counts nowhere.
    """
    width = interval(micros(size))
    rows = df.filter(F.col(ts).isNotNull()).select(*keys, F.col(ts).alias("_ts"), F.inline(items).alias("_item", "_n"))
    totals = rows.withWatermark("_ts", delay).groupBy(F.window("_ts", width).alias("_w"), *keys, "_item").agg(F.sum("_n").alias("_n"))
    # Append mode needs the window itself in both groupings.
    again = F.window(F.window_time("_w"), width).alias("_of")
    whole = totals.groupBy(again, *keys).agg(F.collect_list(F.struct("_item", "_n")).alias("_items"))
    finished = F.udf(lambda found: finish({row["_item"]: row["_n"] for row in found}), output)("_items")
    out = whole.select(*keys, F.col("_of.start").alias("window_start"), F.col("_of.end").alias("window_end"), finished.alias("_out"))
    return out.select(*keys, "window_start", "window_end", "_out.*")


def vehicle_window_process(
    df: DataFrame, ts: str, delay: str = "10 seconds", key: str = "vin", readings: str = "sensorData", lights: str = "warningLights",
    size: str = "10 seconds",
) -> DataFrame:
    """The vehicle aggregate of ``operators.windows`` as a function of whole windows, with the same result."""
    one, none = F.lit(1).cast("long"), F.array().cast("array<struct<item:string,n:bigint>>")
    item = lambda name, n: F.struct(name.alias("item"), n.cast("long").alias("n"))
    measured = F.transform(F.map_entries(readings), lambda e: item(F.concat(F.lit("r:"), e["key"]), e["value"]))
    lit_up = F.transform(lights, lambda w: item(F.concat(F.lit("l"), F.coalesce(F.concat(F.lit(":"), w), F.lit(""))), one))
    items = F.concat(F.array(item(F.lit("e"), one)), F.coalesce(measured, none), F.coalesce(lit_up, none))
    output = T.StructType().add("averageSensorData", T.MapType(T.StringType(), T.LongType())).add("countDistinctWarnings", T.IntegerType())

    def finish(totals: Mapping[str, int]) -> tuple:
        events = totals["e"]
        # Division of whole numbers that drops the remainder, also below zero.
        averages = {i[2:]: None if n is None else int(math.copysign(abs(n) // events, n)) for i, n in sorted(totals.items()) if i[:2] == "r:"}
        return averages, sum(i[0] == "l" for i in totals)

    done = window_process(df, ts, delay, [key], size, items, finish, output)
    return done.select(key, (F.unix_millis("window_end") - 1).alias("timestamp"), "averageSensorData", "countDistinctWarnings")


class SamplesInOrder(StatefulProcessor):
    """Waiting samples of a share of the series by stretch of time, in pieces; a timer at the end of a stretch gives it out in order.

    An item is the labels of a series and then a sample of it; state also has the number of chunks each series has given.
    """

    PIECE = 1000

    def __init__(self, labels: Sequence[str], item: T.StructType, stretch: int, size: int):
        self.labels, self.item, self.stretch, self.size = list(labels), item, stretch, size

    def init(self, handle: StatefulProcessorHandle) -> None:
        held = T.StructType().add("items", T.ArrayType(self.item))
        self.handle = handle
        self.waiting = handle.getMapState("waiting", "stretch bigint, piece int", held)
        self.pieces = handle.getMapState("pieces", "stretch bigint", "n int")
        self.given = handle.getValueState("given", "n map<string,bigint>")

    def _out(self, items: list, late: bool) -> Iterator[Row]:
        out, given, series = Row(*self.labels, "chunk", "late", "_samples"), dict((self.given.get() or ({},))[0]), {}
        for item in items:
            series.setdefault(item[: len(self.labels)], []).append(item[len(self.labels) :])
        for labels, samples in series.items():
            name, samples = repr(labels), sorted(samples, key=nulls_first)
            n = given.get(name, 0)
            for at in range(0, len(samples), self.size):
                yield out(*labels, n, late, samples[at : at + self.size])
                n += 1
            given[name] = n
        self.given.update((given,))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        mark, fresh, late = timerValues.getCurrentWatermarkInMs(), {}, []
        for row in rows:
            *item, stretch, _ = row
            (late if stretch + self.stretch <= mark else fresh.setdefault(stretch, [])).append(tuple(item))
        for stretch, items in fresh.items():
            n = (self.pieces.getValue((stretch,)) or (0,))[0]
            for at in range(0, len(items), self.PIECE):
                self.waiting.updateValue((stretch, n), (items[at : at + self.PIECE],))
                n += 1
            self.pieces.updateValue((stretch,), (n,))
            self.handle.registerTimer(stretch + self.stretch)
        if late:
            yield from self._out(late, True)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        stretch = expiredTimerInfo.getExpiryTimeInMs() - self.stretch
        items = []
        for piece in range((self.pieces.getValue((stretch,)) or (0,))[0]):
            items += [tuple(i) for i in self.waiting.getValue((stretch, piece))[0]]
            self.waiting.removeKey((stretch, piece))
        self.pieces.removeKey((stretch,))
        yield from self._out(items, False)

    def close(self) -> None:
        pass


def series_in_order(
    df: DataFrame, metric: str, labels: Sequence[str], ts: str, value: str, delay: str, order: Sequence[str] = (),
    stretch: str = "1 minute", size: int = 500,
) -> DataFrame:
    """Samples of each series of a stream in time order, in numbered chunks of at most ``size``: metric, labels, chunk, late, samples.

    Time is cut into stretches. A stretch comes out when the watermark (``delay`` behind the newest sample) has passed its end, in
    the order of ``ts`` and ``order``, so over micro-batches the chunks of a series ascend in number and in time. A sample that
    comes after its stretch was given out cannot be put in order any more: it comes at once, in a chunk that is marked late.
    Samples without a time are left out. State holds the open stretches in pieces and a task one stretch of a share of the series
    (see ``state.share``) at a time.
    """
    timed = df.filter(F.col(ts).isNotNull()).withWatermark(ts, delay)
    place = F.unix_micros(ts) - F.pmod(F.unix_micros(ts), F.lit(micros(stretch)))
    names = [*dict.fromkeys([ts, *order])]
    texts = [f"_label_{i}" for i in range(len(labels))]
    named = timed.withColumns({text: F.col(name).cast("string") for text, name in zip(texts, labels, strict=True)})
    picked = named.select(
        *texts, F.unix_micros(ts).alias("_at"), *names[1:], F.col(value).alias("_value"), F.floor(place / 1000).alias("_stretch"),
        share(texts).alias("_share"),
    )
    item = T.StructType(picked.schema.fields[:-2])
    schema = T.StructType([
        *_fields(picked, texts), T.StructField("chunk", T.LongType()), T.StructField("late", T.BooleanType()),
        T.StructField("_samples", T.ArrayType(T.StructType(item.fields[len(texts) :]))),
    ])
    processor = SamplesInOrder(texts, item, micros(stretch) // 1000, size)
    out = picked.groupBy("_share").transformWithState(processor, schema, "append", "eventTime")
    pairs = [part for text, name in zip(texts, labels, strict=True) for part in (F.lit(name), F.col(text))]
    samples = F.transform("_samples", lambda s: F.struct(s["_value"].alias("value"), F.timestamp_micros(s["_at"]).alias("ts")))
    return out.select(F.lit(metric).alias("metric"), F.create_map(*pairs).alias("labels"), "chunk", "late", samples.alias("samples"))


class WatermarkOfSource(StatefulProcessor):
    """Each row with whether all its windows were closed when it came; state is the newest time of each source partition of a share."""

    def __init__(self, source: Sequence[str], arrival: Sequence[str], columns: Sequence[str], size: int, slide: int, delay: int):
        self.source, self.arrival, self.columns = list(source), list(arrival), list(columns)
        self.size, self.slide, self.delay = size, slide, delay

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.newest = handle.getValueState("newest", "at map<string,bigint>")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        newest, out = dict((self.newest.get() or ({},))[0]), Row(*self.columns, "is_late")
        source, arrival, time = ([self.columns.index(c) for c in some] for some in (self.source, self.arrival, ["_at"]))
        for row in sorted(rows, key=lambda r: nulls_first([r[c] for c in arrival])):
            name, at = _name([row[c] for c in source]), row[time[0]]
            seen = newest.get(name)
            late = at is not None and seen is not None and at - at % self.slide + self.size <= seen - self.delay
            if at is not None and (seen is None or at > seen):
                newest[name] = at
            yield out(*row, late)
        self.newest.update((newest,))

    def close(self) -> None:
        pass


def _name(values: Sequence) -> str:
    """A text that is the same for values that Spark groups together."""
    return repr([v + 0.0 if isinstance(v, float) else v for v in values])


def late_rows(
    df: DataFrame, ts: str, arrival: Sequence[str], size: str, delay: str, source: Sequence[str], slide: str | None = None
) -> DataFrame:
    """The rows of a stream with ``is_late``, by the rule of ``operators.ordered.late_split``, over all micro-batches.

    The watermark of each source partition is kept in state, so a row is judged by all that came before it from there. One
    task goes through the rows of a source partition in a micro-batch in their order of arrival, as its reader would; it holds
    those of a share of the source partitions (see ``state.share``) at a time.
    """
    rows = df.withColumns({"_at": F.unix_micros(ts), "_share": share(source)})
    schema = T.StructType([*rows.schema.fields, T.StructField("is_late", T.BooleanType())])
    processor = WatermarkOfSource(source, arrival, rows.columns, micros(size), micros(slide or size), micros(delay))
    return rows.groupBy("_share").transformWithState(processor, schema, "append", "none").drop("_at", "_share")
