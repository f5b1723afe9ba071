"""Running per-key results on streams."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from millrace.operators.ordered import running_count
from millrace.session import shuffle_partitions
from millrace.sinks.storage import Folder


def nulls_first(values: Sequence) -> tuple:
    """A key that sorts values as Spark does."""
    return tuple((v is not None, v) if v is not None else (False,) for v in values)


SHARES = 1024


def share(columns: Sequence[str]) -> Column:
    """The share of the keys that a key falls into.

    A call of Python's keyed state costs milliseconds whatever it holds, so many small keys are better kept together, in a number
    of groups that does not grow with them. The number is fixed because stored state goes by it.
    """
    return F.pmod(F.xxhash64(F.lit(0), *columns), F.lit(SHARES)).cast("int")


class CountingProcessor(StatefulProcessor):
    """Turns (key, rows seen in a piece) into (key, rows before the piece, rows in it).

    State is one number per key, kept for ever unless a time to live is given.
    """

    def __init__(self, names: Sequence[str], ttl_ms: int | None = None):
        self.names, self.ttl_ms = list(names), ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.count = handle.getValueState("count", "n bigint", self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        out = Row(*self.names)
        n = (self.count.get() or (0,))[0]
        for row in rows:
            yield out(*key, n, row["_rows"])
            n += row["_rows"]
        self.count.update((n,))

    def close(self) -> None:
        pass


class DecayingAverage(StatefulProcessor):
    """Turns (key, where a piece begins, its rows, their weighted sum) into (key, average after the piece), starting at 0."""

    def __init__(self, names: Sequence[str], decay: float = 0.1):
        self.names, self.keep = list(names), 1 - decay

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.average = handle.getValueState("average", "a double")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        out = Row(*self.names)
        a = (self.average.get() or (0.0,))[0]
        for row in sorted(rows, key=lambda r: nulls_first([r["_begins"]])):
            a = a * self.keep ** row["_rows"] + row["_part"]
            yield out(*key, a)
        self.average.update((a,))

    def close(self) -> None:
        pass


def _stateful(df: DataFrame, key: str, processor: StatefulProcessor, columns: str, ttl: bool = False) -> DataFrame:
    # A time to live is counted in processing time.
    mode = "processingTime" if ttl else "none"
    return df.groupBy(key).transformWithState(processor, _schema_of(df, key, columns), "append", mode)


def _rows_per_piece(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        (key,) = batch.schema.names
        counted = pa.Table.from_batches([batch]).group_by(key).aggregate([([], "count_all")])
        yield from counted.select([key, "count_all"]).rename_columns([key, "_rows"]).to_batches()


def keyed_count(df: DataFrame, key: str, out: str = "total_count", ttl_ms: int | None = None) -> DataFrame:
    """(key, n) for every row of a stream, n = 1, 2, 3, ...

    Rows of a key are alike to a running count, so each task first counts its rows per key and Arrow batch. Only those
    counts are shuffled to the keyed state, which gives each its place; the places are spread again and unfolded into one
    row per input row. A key that holds much of the stream therefore costs its task a row per batch, not per record.
    """
    pieces = df.select(key).mapInArrow(_rows_per_piece, _schema_of(df, key, "_rows bigint"))
    places = _stateful(pieces, key, CountingProcessor([key, "_before", "_rows"], ttl_ms), "_before bigint, _rows bigint", ttl_ms is not None)
    spread = places.repartition(shuffle_partitions(df.sparkSession))
    return spread.select(key, F.explode(F.sequence(F.col("_before") + 1, F.col("_before") + F.col("_rows"))).alias(out))


def _schema_of(df: DataFrame, key: str, more: str) -> str:
    return f"`{key}` {df.schema[key].dataType.simpleString()}, {more}"


def keyed_average(
    df: DataFrame, key: str, value: str, out: str = "ema", decay: float = 0.1, order: str | None = None, run: str | None = None
) -> DataFrame:
    """The gauge of ``avg = avg * (1 - decay) + x * decay`` per key, once per piece of rows that arrive together.

    Like the count, a task folds its rows into one weighted sum per key and batch before anything is shuffled. Without an
    ``order`` rows count as they arrive. With one, pieces are put in the order of their first rows; ``run`` names a column that
    is the same for rows between which no others come (say, the file they were landed in), and a piece never holds two runs.
    """
    kind = df.schema[order].dataType.simpleString() if order else "int"
    wanted = dict.fromkeys([key, value, *([order] if order else []), *([run] if run else [])])

    def fold(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if order:
                frame = frame.sort_values(order, kind="stable", na_position="first")
            by = [key, run] if run else [key]
            later = frame.groupby(by, dropna=False, sort=False).cumcount(ascending=False)
            weighted = frame.assign(
                _part=decay * frame[value] * (1 - decay) ** later, _rows=1, _begins=frame[order] if order else 0
            )
            sums = {"_begins": "first", "_rows": "sum", "_part": "sum"}
            yield weighted.groupby(by, dropna=False, sort=False, as_index=False).agg(sums)[[key, *sums]]

    pieces = df.select(*wanted).mapInPandas(fold, _schema_of(df, key, f"_begins {kind}, _rows bigint, _part double"))
    return _stateful(pieces, key, DecayingAverage([key, out], decay), f"{out} double")


class RunningCountBatches:
    """``foreachBatch`` function for a running count that splits hot keys.

    Rows of a micro-batch are numbered with the sliced batch operator and raised by the totals of the batches before.
    Totals are one small row per key, written per batch under ``totals`` and read back by the next one, so a replayed
    batch starts from the same totals and gives the same rows.
    """

    def __init__(self, keys: Sequence[str], order: Sequence[str], totals: str, sink, out: str = "total_count"):
        self.keys, self.order, self.totals, self.sink, self.out = list(keys), list(order), totals, sink, out

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist()
        seen = batch.groupBy(*self.keys).agg(F.count(F.lit(1)).alias("_seen"))
        folder = Folder(spark, self.totals)
        if batch_id > 0:
            if not folder.exists(f"batch={batch_id - 1}"):
                raise ValueError(f"the totals of batch {batch_id - 1} are missing in {self.totals}; counting cannot go on")
            before = spark.read.parquet(f"{self.totals}/batch={batch_id - 1}")
        else:
            before = seen.limit(0)
        summed = before.unionByName(seen).groupBy(*self.keys).agg(F.sum("_seen").alias("_seen"))
        summed.write.mode("overwrite").parquet(f"{self.totals}/batch={batch_id}")
        numbered = running_count(batch, self.keys, self.order, "_n")
        known = before.join(seen, [before[k].eqNullSafe(seen[k]) for k in self.keys], "left_semi")
        match = [numbered[k].eqNullSafe(known[k]) for k in self.keys]
        raised = numbered.join(known, match, "left").select(
            *[numbered[c] for c in batch.columns], (F.col("_n") + F.coalesce("_seen", F.lit(0))).alias(self.out)
        )
        self.sink(raised, batch_id)
        batch.unpersist()
        if batch_id > 1:
            folder.remove(f"batch={batch_id - 2}")
