"""Schemas that writers register, and values that name theirs in a header.

The registry is a table with a row for each version of a subject. A version is registered only if rows of the one before can
be read as the new one (backward compatible). A value is five bytes, a zero and the version, and then JSON; the schemas are
looked up for each micro-batch, so a query reads versions that were registered after it was started.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.readwriter import DataStreamWriter

from millrace.functions import scalar
from millrace.operators.project import compatibility, decode_versions
from millrace.sinks.storage import Folder
from millrace.streaming.run import each_batch

# The header is one zero byte and the version as four bytes, the highest first.
HEADER_BYTES = 5
_TABLE = "subject string, version int, schema string"


class Registry:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def writers(self, subject: str) -> dict[int, T.StructType]:
        """The schema of each version of a subject."""
        if not Folder(self.spark, self.path).exists():
            return {}
        rows = self.spark.read.schema(_TABLE).parquet(self.path).filter(F.col("subject") == subject)
        return {r.version: T.StructType.fromJson(json.loads(r.schema)) for r in rows.orderBy("version").collect()}

    def register(self, subject: str, schema: T.StructType, defaults: Mapping[str, object] | None = None) -> int:
        """The version of a schema, a new one if it has none. One writer registers at a time."""
        known = self.writers(subject)
        for version, other in known.items():
            if other == schema:
                return version
        latest = max(known, default=0)
        if known and (problems := compatibility(known[latest], schema, defaults)):
            raise ValueError(f"{subject} {latest} cannot be read as the new schema: " + "; ".join(problems))
        row = [(subject, latest + 1, schema.json())]
        self.spark.createDataFrame(row, _TABLE).coalesce(1).write.mode("append").parquet(self.path)
        return latest + 1


def with_header(version: int, payload: Column) -> Column:
    """A value of a version: the header, then the payload."""
    return F.concat(F.lit(bytearray(version.to_bytes(HEADER_BYTES, "big"))), payload.cast("binary"))


def encoded(df: DataFrame, version: int, out: str = "value") -> DataFrame:
    return df.select(with_header(version, scalar.json_encode(*df.columns)).alias(out))


def decoded(
    df: DataFrame, registry: Registry, subject: str, reader: T.StructType, value: str = "value",
    defaults: Mapping[str, object] | None = None,
) -> DataFrame:
    """Values with a header as rows of the reader's schema. A version that is not registered fails the job."""
    number = F.conv(F.hex(F.substring(value, 1, HEADER_BYTES)), 16, 10).cast("int")
    text = F.substring(F.col(value), F.lit(HEADER_BYTES + 1), F.octet_length(value)).cast("string")
    return decode_versions(df.select(number.alias("version"), text.alias("text")), "text", "version", registry.writers(subject), reader, defaults)


def decoded_stream(
    df: DataFrame, registry: Registry, subject: str, reader: T.StructType, sink: Callable[[DataFrame, int], None], checkpoint: str,
    value: str = "value", defaults: Mapping[str, object] | None = None,
) -> DataStreamWriter:
    """Each micro-batch decoded with the versions that are registered by then, into a sink."""
    return each_batch(df, lambda rows, n: sink(decoded(rows, registry, subject, reader, value, defaults), n), checkpoint)
