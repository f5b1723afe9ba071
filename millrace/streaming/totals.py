"""Totals of observed metrics over the life of a streaming query, restarts included."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from millrace.sinks.storage import Folder


class RunningTotals(StreamingQueryListener):
    """Adds up the ``observe`` metrics of every micro-batch of the queries of a session.

    After each micro-batch the totals of its query are written to the folder under the number of the batch. A listener that is
    made after a restart goes on from there; a batch that is reported again adds nothing. Progress is reported after a batch is
    committed: if the driver dies in between, that batch is missing from the totals, and ``gaps`` says so.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.folder, self.known = spark, Folder(spark, path), {}

    def _last(self, query: str) -> tuple[int, dict]:
        if query not in self.known:
            batches = [int(name) for name in self.folder.children(query) if name.isdigit()]
            last = max(batches, default=-1)
            kept = json.loads(self.folder.read_text(f"{query}/{last}")) if batches else {"totals": {}, "gaps": 0}
            self.known[query] = last, kept
        return self.known[query]

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        query, batch = str(progress.id), progress.batchId
        last, kept = self._last(query)
        if batch <= last or not progress.observedMetrics:
            return
        totals = {name: dict(values) for name, values in kept["totals"].items()}
        for name, row in progress.observedMetrics.items():
            sums = totals.setdefault(name, {})
            for column, n in row.asDict().items():
                sums[column] = sums.get(column, 0) + (n or 0)
        now = {"totals": totals, "gaps": kept["gaps"] + batch - last - 1}
        self.folder.write_text(f"{query}/{batch}", json.dumps(now))
        self.known[query] = batch, now
        if last >= 0:
            self.folder.remove(f"{query}/{last}")

    def onQueryTerminated(self, event) -> None:
        pass

    def settle(self) -> None:
        """Wait until all progress so far has been reported."""
        self.spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()

    def totals(self, query: StreamingQuery | str) -> Mapping[str, Mapping[str, int]]:
        """The sums of each metric's columns, by its name."""
        return self._last(query if isinstance(query, str) else str(query.id))[1]["totals"]

    def gaps(self, query: StreamingQuery | str) -> int:
        """Micro-batches that were not reported."""
        return self._last(query if isinstance(query, str) else str(query.id))[1]["gaps"]
