"""Projections, filters, routing and schema conversion."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import scalar


def project_rename(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Keep ``columns`` (old name -> new name), in that order."""
    return df.select(*[F.col(old).alias(new) for old, new in columns.items()])


def insert_by_position(df: DataFrame, target: T.StructType) -> DataFrame:
    """Fit rows to a target schema by position: names are the target's, types are cast."""
    if len(df.columns) != len(target):
        raise ValueError(f"{len(df.columns)} columns for a target of {len(target)}")
    pairs = zip(df.columns, target.fields)
    return df.select(*[F.col(f"`{name}`").cast(field.dataType).alias(field.name) for name, field in pairs])


def sql_view(df: DataFrame, name: str, query: str) -> DataFrame:
    """Register ``df`` as a temporary view and query it with SQL."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.sql(query)


def with_date_parts(df: DataFrame, ts: str) -> DataFrame:
    return df.withColumn("dt", scalar.date_part(ts)).withColumn("hr", scalar.hour_part(ts))


def above(df: DataFrame, column: str, limit: float) -> DataFrame:
    """Rows strictly above the limit; nulls go."""
    return df.filter(F.col(column) > F.lit(limit))


def with_outcome(df: DataFrame, message: str, poison: str = "Poison") -> DataFrame:
    """All rows with their ``outcome``. To write both kinds in one pass, partition the output by it."""
    return df.withColumn("outcome", scalar.outcome(message, poison))


def split_streams(df: DataFrame, message: str, poison: str = "Poison") -> tuple[DataFrame, DataFrame]:
    """(valid rows, dead letters); both carry the ``outcome`` column. Using both reads the input twice."""
    tagged = with_outcome(df, message, poison)
    return tagged.filter(F.col("outcome") == scalar.SUCCESS), tagged.filter(F.col("outcome") == scalar.ERROR)


def unpack_batches(df: DataFrame, payloads: Column, schema: T.StructType, keep: Sequence[str] = ()) -> DataFrame:
    """One row per record of a container (an array of JSON texts); an undecodable record fails the job."""
    inner = df.select(*keep, F.explode(payloads).alias("_payload"))
    return inner.select(*keep, scalar.json_decode("_payload", schema).alias("_row")).select(*keep, "_row.*")


def ndjson(column: Column | str) -> Column:
    """Newline-delimited JSON text as an array of its non-empty lines."""
    column = F.col(column) if isinstance(column, str) else column
    return F.filter(F.split(column, "\n"), lambda line: F.length(F.trim(line)) > 0)


def compatibility(writer: T.StructType, reader: T.StructType, defaults: Mapping[str, object] | None = None) -> list[str]:
    """Why rows of the writer's schema cannot be read as the reader's; empty when they can (backward compatible)."""
    defaults, written, problems = defaults or {}, {f.name: f.dataType for f in writer.fields}, []
    for field in reader.fields:
        if field.name in written:
            source = written[field.name]
            if not widens(source, field.dataType):
                problems.append(f"{field.name}: {source.simpleString()} cannot be read as {field.dataType.simpleString()}")
        elif field.name not in defaults and not field.nullable:
            problems.append(f"{field.name}: required, but neither written nor given a default")
    return problems


def _as_reader(
    value: Callable[[str], Column], writer: T.StructType, reader: T.StructType, defaults: Mapping[str, object] | None
) -> list[Column]:
    if problems := compatibility(writer, reader, defaults):
        raise ValueError("; ".join(problems))
    written = set(writer.fieldNames())
    given = lambda f: value(f.name) if f.name in written else F.lit((defaults or {}).get(f.name))
    return [given(field).cast(field.dataType).alias(field.name) for field in reader.fields]


def evolve_to(df: DataFrame, schema: T.StructType, defaults: Mapping[str, object] | None = None) -> DataFrame:
    """Read rows of an older or newer version as ``schema``.

    A column the rows lack takes its default, or null where the field is nullable; a column the schema lacks is left
    out; types are widened. A required column without a default, or a narrowing cast, is refused.
    """
    return df.select(*_as_reader(lambda name: F.col(f"`{name}`"), df.schema, schema, defaults))


def decode_versions(
    df: DataFrame,
    value: str,
    version: str,
    writers: Mapping[int, T.StructType],
    reader: T.StructType,
    defaults: Mapping[str, object] | None = None,
) -> DataFrame:
    """JSON values written under registered schemas, read as one reader schema in one pass.

    ``version`` says under which schema a row was written; an unregistered version or an undecodable value fails the job.
    """
    chosen = None
    for number, writer in writers.items():
        row = scalar.json_decode(value, writer)
        struct = F.struct(*_as_reader(lambda name, row=row: row[name], writer, reader, defaults))
        chosen = F.when(F.col(version) == number, struct) if chosen is None else chosen.when(F.col(version) == number, struct)
    if chosen is None:
        raise ValueError("no writer schema is registered")
    unknown = F.concat(F.lit("unregistered schema version "), F.coalesce(F.col(version).cast("string"), F.lit("null")))
    failed = F.raise_error(unknown).cast(reader)
    return df.select(chosen.otherwise(failed).alias("_row")).select("_row.*")


# The types each simple type may be read as.
WIDER = {
    "tinyint": {"smallint", "int", "bigint", "float", "double"},
    "smallint": {"int", "bigint", "float", "double"},
    "int": {"bigint", "float", "double"},
    "bigint": {"float", "double"},
    "float": {"double"},
    "string": {"binary"},
    "binary": {"string"},
}


def widens(source: T.DataType, target: T.DataType) -> bool:
    if source == target:
        return True
    if isinstance(source, T.DecimalType) and isinstance(target, T.DecimalType):
        whole = target.precision - target.scale >= source.precision - source.scale
        return whole and target.scale >= source.scale
    if isinstance(source, T.ArrayType) and isinstance(target, T.ArrayType):
        return widens(source.elementType, target.elementType)
    if isinstance(source, T.MapType) and isinstance(target, T.MapType):
        return widens(source.keyType, target.keyType) and widens(source.valueType, target.valueType)
    return target.simpleString() in WIDER.get(source.simpleString(), set())


def union_versions(versions: Sequence[DataFrame], schema: T.StructType, defaults: Mapping[str, object] | None = None) -> DataFrame:
    """Rows written under several schema versions as one table of the reader's schema."""
    first, *rest = [evolve_to(df, schema, defaults) for df in versions]
    for df in rest:
        first = first.unionByName(df)
    return first


def observed_counts(df: DataFrame, condition: Column, before: str = "received", after: str = "filtered") -> DataFrame:
    """Filter, counting rows before and after as named metrics (``Observation`` or a query listener reads them)."""
    return df.observe(before, F.count(F.lit(1)).alias("total")).filter(condition).observe(
        after, F.count(F.lit(1)).alias("total")
    )
