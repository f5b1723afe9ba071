"""Writers for message services and metric endpoints reached through a client.

``make_client`` is called once per task and returns an object with ``put(records) -> list of positions that failed``.
Records go out in calls of at most ``batch`` rows; positions that failed are sent again. Delivery is at least once.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import scalar

FAIL, DISCARD = "fail", "discard"
# The largest number of records one call may carry.
DELIVERY_BATCH, QUEUE_BATCH, SAMPLES_BATCH = 500, 10, 500


def send(client, rows: Iterator, batch: int, attempts: int, wait: float, exhausted: str) -> tuple[int, int]:
    """(records sent, records discarded)"""
    sent = dropped = 0
    while left := list(islice(rows, batch)):
        for attempt in range(attempts):
            failed = client.put(left)
            sent += len(left) - len(failed)
            left = [left[i] for i in failed]
            if not left:
                break
            if attempt + 1 < attempts:
                time.sleep(wait)
        if left:
            if exhausted == FAIL:
                raise RuntimeError(f"{len(left)} records were refused {attempts} times")
            dropped += len(left)
    return sent, dropped


def put_rows(
    df: DataFrame,
    make_client: Callable[[], object],
    batch: int,
    attempts: int = 3,
    wait: float = 0.2,
    exhausted: str = FAIL,
) -> tuple[int, int]:
    """Send every row of a batch (as a dict) from its task; (sent, discarded) over all tasks."""

    def run(batches):
        rows = (row for arrow in batches for row in arrow.to_pylist())
        sent, dropped = send(make_client(), rows, batch, attempts, wait, exhausted)
        yield pa.RecordBatch.from_pydict({"sent": [sent], "dropped": [dropped]})

    totals = df.mapInArrow(run, "sent bigint, dropped bigint")
    row = totals.agg(F.sum("sent"), F.sum("dropped")).first()
    return row[0] or 0, row[1] or 0


def messages(df: DataFrame, key: Column | None = None, payload: Column | None = None) -> DataFrame:
    """``key`` and ``data`` (the row as JSON unless given)."""
    data = scalar.json_encode(*df.columns) if payload is None else payload
    return df.select((F.lit(None).cast("string") if key is None else key.cast("string")).alias("key"), data.alias("data"))


def write_delivery_stream(df: DataFrame, make_client, batch: int = DELIVERY_BATCH, **kwargs) -> tuple[int, int]:
    return put_rows(messages(df), make_client, batch, **kwargs)


def write_queue(df: DataFrame, make_client, batch: int = QUEUE_BATCH, **kwargs) -> tuple[int, int]:
    return put_rows(messages(df), make_client, batch, **kwargs)


def write_metric_samples(
    series: DataFrame, make_client, batch: int = SAMPLES_BATCH, attempts: int = 100, wait: float = 0.0, in_order: bool = True
) -> tuple[int, int]:
    """Send grouped samples (``metric``, ``labels``, ``chunk``, ``samples``); what is refused too often is discarded.

    An endpoint that wants the samples of a series in time order takes them from one sender: the chunks of a series go to
    one task, sorted, and stream through it a chunk at a time. Give ``in_order=False`` for an endpoint that accepts
    samples in any order; then a long series is sent by all tasks.
    """
    if in_order:
        by_series = series.withColumn("_series", F.concat_ws("\u0001", "metric", F.to_json("labels")))
        series = by_series.repartition("_series").sortWithinPartitions("_series", "chunk").drop("_series")
    return put_rows(series, make_client, batch, attempts, wait, DISCARD)


def fan_out(df: DataFrame, sinks: dict[str, Callable[[DataFrame], object]]) -> dict[str, object]:
    """Give one batch to several sinks, computing it once. At least one sink is required."""
    if not sinks:
        raise ValueError("no sink is configured")
    if len(sinks) == 1:
        ((name, sink),) = sinks.items()
        return {name: sink(df)}
    kept = df.persist()
    try:
        return {name: sink(kept) for name, sink in sinks.items()}
    finally:
        kept.unpersist()
