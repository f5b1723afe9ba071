"""Starting streaming queries with checkpoints and triggers."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter

from millrace.sinks.service import fan_out

AVAILABLE_NOW = "available now"


def triggered(writer: DataStreamWriter, trigger: str = "60 seconds") -> DataStreamWriter:
    """Checkpoint every ``trigger``; AVAILABLE_NOW works off what is there and ends."""
    return writer.trigger(availableNow=True) if trigger == AVAILABLE_NOW else writer.trigger(processingTime=trigger)


def start(writer: DataStreamWriter, trigger: str = "60 seconds") -> StreamingQuery:
    return triggered(writer, trigger).start()


NO_DATA = "spark.sql.streaming.noDataMicroBatches.enabled"


def run_to_end(writer: DataStreamWriter) -> StreamingQuery:
    """Work off what is available and wait for the end; an error in the query is raised here.

    State that goes by the clock (a time to live, timers in processing time) asks for another micro-batch for ever, so such a
    query ends with the last batch of rows. What its timers would give later comes out in a later run.
    """
    df = writer._df
    by_clock = "ProcessingTime" in df._jdf.queryExecution().logical().toString()
    spark, before = df.sparkSession, df.sparkSession.conf.get(NO_DATA)
    if by_clock:
        spark.conf.set(NO_DATA, "false")
    try:
        query = start(writer, AVAILABLE_NOW)  # takes its own copy of the settings
    finally:
        if by_clock:
            spark.conf.set(NO_DATA, before)
    query.awaitTermination()
    return query


def run_until(writer: DataStreamWriter, done: Callable[[], bool], trigger: str = "1 second", patience: float = 600.0) -> StreamingQuery:
    """Run by the clock until ``done`` says so, which is asked after every trigger; an error in the query is raised here."""
    query, limit = start(writer, trigger), time.monotonic() + patience
    try:
        while query.isActive and not done():
            if time.monotonic() > limit:
                raise TimeoutError(f"the query was not done after {patience:g} s")
            query.awaitTermination(1)
    finally:
        query.stop()
    if query.exception():
        raise query.exception()
    return query


def each_batch(
    df: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append"
) -> DataStreamWriter:
    return df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(sink)


def multi_sink(df: DataFrame, sinks: dict[str, Callable[[DataFrame, int], None]], checkpoint: str) -> DataStreamWriter:
    """Several sinks of one stream in one query, so the source is read once. At least one sink is required."""
    if not sinks:
        raise ValueError("no sink is configured")

    def write(batch: DataFrame, batch_id: int) -> None:
        fan_out(batch, {name: (lambda rows, sink=sink: sink(rows, batch_id)) for name, sink in sinks.items()})

    return each_batch(df, write, checkpoint)


def to_service(df: DataFrame, write: Callable, make_client: Callable[[], object], checkpoint: str, **options) -> DataStreamWriter:
    """A stream into a service: each micro-batch goes through one of the writers of ``sinks.service``, at least once."""
    return each_batch(df, lambda batch, batch_id: write(batch, make_client, **options), checkpoint)


def to_console(df: DataFrame, checkpoint: str | None = None, mode: str = "append"):
    """Print rows: a batch at once, a stream as its batches complete (returns the writer)."""
    if not df.isStreaming:
        return df.write.format("console").option("truncate", "false").mode("append").save()
    writer = df.writeStream.format("console").option("truncate", "false").outputMode(mode)
    return writer.option("checkpointLocation", checkpoint) if checkpoint else writer


def rates(query: StreamingQuery) -> dict[str, float]:
    """Rows and rows per second of the last micro-batch."""
    last = query.lastProgress
    if last is None:
        return {"rows": 0, "rows_per_second": 0.0}
    return {"rows": last["numInputRows"], "rows_per_second": last["processedRowsPerSecond"]}


def dropped_late(query: StreamingQuery) -> int:
    """Rows the watermark has dropped over the micro-batches that are still known."""
    return sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])
