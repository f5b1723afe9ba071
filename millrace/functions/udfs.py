"""User-defined functions. Each has a built-in counterpart in ``scalar`` that stays inside the JVM; these are for
functions that need a Python library, and run on Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.asking import ask_all


def _celsius_to_fahrenheit(celsius: pd.Series) -> pd.Series:
    return celsius * 9 / 5 + 32


def _determinant(a: pd.Series, b: pd.Series, c: pd.Series, d: pd.Series) -> pd.Series:
    rows = np.stack([a, b, c, d], axis=-1).astype("float64")
    return pd.Series((rows[:, 0] * rows[:, 3] - rows[:, 1] * rows[:, 2]).astype("float32"))


celsius_to_fahrenheit = F.pandas_udf(_celsius_to_fahrenheit, T.DoubleType())
determinant = F.pandas_udf(_determinant, T.FloatType())


def register_udfs(spark: SparkSession) -> None:
    """Make the functions available to SQL."""
    spark.udf.register("celsius_to_fahrenheit", celsius_to_fahrenheit)
    spark.udf.register("determinant", determinant)


# Fixed value: the text of a failed call.
ERROR_TEXT = "ERROR: Can't invoke {name}  Reason: {reason}"


def service_column(
    df: DataFrame,
    argument: str,
    out: str,
    make_client: Callable[[], Callable[[object], str]],
    name: str = "service",
    capacity: int = 16,
) -> DataFrame:
    """Ask a service once per row and add its answer as text. An exception becomes ``ERROR: ...``, never a failure.

    The client is made once per task and called from up to ``capacity`` threads; if making it fails, every row of the task
    gets the error text. Rows come out in the order of their answers.
    """
    schema = T.StructType(df.schema.fields + [T.StructField(out, T.StringType())])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        problem = None
        try:
            made = make_client()
        except Exception as e:
            problem = e

        def client(row, _):
            if problem is not None:
                raise problem
            return made(row[1])

        for batch in batches:
            numbered = enumerate(batch.column(argument).to_pylist())
            answers = list(ask_all(numbered, client, capacity))
            text = [a.value if a.error is None else ERROR_TEXT.format(name=name, reason=a.error) for a in answers]
            rows = batch.take(pa.array([a.row[0] for a in answers], pa.int64()))
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(text, pa.string())], [*batch.schema.names, out])

    return df.mapInArrow(ask, schema)
