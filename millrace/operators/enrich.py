"""Enrichment of rows from an external service, with bounded concurrency, retries and a deadline per row."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.asking import FAILED, OK, TIMEOUT, Answer, ask_all

FAIL, DROP, DEAD_LETTER = "fail", "drop", "dead_letter"
ANSWERS_PER_BATCH = 1000


def enrich(
    df: DataFrame,
    make_client: Callable[[], Callable],
    capacity: int = 100,
    timeout: float = 2.0,
    attempts: int = 3,
    pause: float = 1.0,
    on_error: str = FAIL,
    on_timeout: str = DROP,
    tasks: int | None = None,
) -> DataFrame:
    """Ask the service about every row; answers come out in the order they arrive, and no row waits for a slower one.

    ``client(row, remaining seconds)`` returns a status code. 200 is an answer; any other code and any exception is tried
    again until the attempts are used up (FAILED). The timeout covers all attempts of a row; when it runs out, the row has no
    answer (TIMEOUT), even if the client is still busy or answers later.

    ``capacity`` bounds the rows in flight per task (divide the service's limit by the number of tasks). Output is the
    input columns with ``status``, ``code`` and ``attempts``. A row that failed fails the job, is dropped or is kept as a
    dead letter, as ``on_error`` says; a row that timed out is dropped or kept. ``tasks`` spreads the rows evenly first,
    for when waiting for answers and not reading sets the pace.
    """
    if on_error not in (FAIL, DROP, DEAD_LETTER) or on_timeout not in (DROP, DEAD_LETTER):
        raise ValueError(f"unknown policy {on_error!r} / {on_timeout!r}")
    added = [("status", T.StringType()), ("code", T.IntegerType()), ("attempts", T.IntegerType())]
    schema = T.StructType(df.schema.fields + [T.StructField(name, kind) for name, kind in added])

    def keep(answer: Answer) -> bool:
        if answer.status == FAILED:
            if on_error == FAIL:
                raise RuntimeError(f"the service answered {_code(answer)} in {answer.attempts} attempts")
            return on_error == DEAD_LETTER
        return answer.status == OK or on_timeout == DEAD_LETTER

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                for i, row in enumerate(batch.to_pylist()):
                    yield batch, i, row

        client = make_client()
        answers = ask_all(rows(), lambda row, left: client(row[2], left), capacity, timeout, attempts, pause, lambda code: code == 200)
        kept = (answer for answer in answers if keep(answer))
        while some := list(islice(kept, ANSWERS_PER_BATCH)):
            of: dict[int, list[Answer]] = {}
            for answer in some:
                of.setdefault(id(answer.row[0]), []).append(answer)
            for few in of.values():
                given = few[0].row[0].take(pa.array([a.row[1] for a in few], pa.int64()))
                columns = [pa.array([a.status for a in few]), pa.array([_code(a) for a in few], pa.int32()), pa.array([a.attempts for a in few], pa.int32())]
                yield pa.RecordBatch.from_arrays([*given.columns, *columns], schema.names)

    spread = df.repartition(tasks) if tasks else df
    return spread.mapInArrow(run, schema)


def _code(answer: Answer) -> int:
    """The last code; -1 if the last call raised or none has come back."""
    return -1 if answer.value is None or answer.error is not None else answer.value


def enriched_messages(answers: DataFrame, message: str = "message") -> DataFrame:
    """The messages of the rows that got an answer."""
    return answers.filter(F.col("status") == OK).select(message)
