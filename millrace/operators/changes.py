"""Change data: decoding, collapsing to the current row, copying with metadata."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

INSERT, MODIFY, UPDATE, REMOVE, DELETE = "INSERT", "MODIFY", "UPDATE", "REMOVE", "DELETE"
REMOVALS = [REMOVE, DELETE]


def latest_by_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], op: str | None = None, drop_removed: bool = True
) -> DataFrame:
    """The last row per key by ``order``; with ``op``, keys whose last change is a removal go (unless kept on request).

    Each map task reduces its rows to one candidate per key before the shuffle, so a key with very many changes costs
    no more there than any other. Give an ``order`` that breaks ties (time, then sequence).
    """
    row = F.struct(*df.columns)
    last = df.groupBy(*keys).agg(F.max_by(row, F.struct(*order)).alias("_last")).select("_last.*")
    if op is not None and drop_removed:
        last = last.filter(~F.col(op).isin(REMOVALS) | F.col(op).isNull())
    return last


def decode_change(df: DataFrame, event_name: str, created: str, old_image: str, new_image: str) -> DataFrame:
    """Change rows of a key-value table: an insert has only the new item, a modification both, a removal only the old.

    Any other event name fails the job. Item attributes spelled ``partition-key`` and ``sort-key`` are renamed.
    """
    name = F.col(event_name)
    known = F.coalesce(name.isin(INSERT, MODIFY, REMOVE), F.lit(False))
    unknown = F.raise_error(F.concat(F.lit("unknown event name "), F.coalesce(name, F.lit("null")))).cast("boolean")
    # As a filter the check holds whichever columns are read, and when rows are only counted.
    checked = df.filter(F.when(known, F.lit(True)).otherwise(unknown))
    return checked.select(
        F.col(created).alias("timestamp"),
        name.alias("eventType"),
        F.when(name.isin(MODIFY, REMOVE), _item(df, old_image)).alias("oldItem"),
        F.when(name.isin(INSERT, MODIFY), _item(df, new_image)).alias("newItem"),
    )


# Attribute name in the table -> field name in the row.
ITEM_FIELDS = {"partition-key": "partitionKey", "sort-key": "sortKey", "fieldOne": "fieldOne", "fieldTwo": "fieldTwo"}


def _item(df: DataFrame, image: str) -> Column:
    present = {f.name for f in df.schema[image].dataType.fields}
    fields = []
    for attribute, field in ITEM_FIELDS.items():
        source = attribute if attribute in present else field
        value = F.col(image)[source] if source in present else F.lit(None)
        fields.append(value.cast("string").alias(field))
    return F.when(F.col(image).isNotNull(), F.struct(*fields))


def _or_null(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit("null"))


# The text of a change and of an item, with a place for each field.
CHANGE_TEXT = "ChangeEvent{timestamp=%s, eventType=%s, oldItem=%s, newItem=%s}"
ITEM_TEXT = "DdbTableSchema{partitionKey='%s', sortKey='%s', fieldOne='%s', fieldTwo='%s'}"


def item_to_string(item: Column) -> Column:
    text = F.format_string(ITEM_TEXT, *[_or_null(item[field]) for field in ITEM_FIELDS.values()])
    return F.when(item.isNotNull(), text)


def instant_text(ts: Column | str) -> Column:
    """ISO text in UTC, with no fraction, milliseconds or microseconds as the value needs."""
    micro = F.date_format(ts, "SSSSSS")
    digits = F.when(micro == "000000", "").when(micro.endswith("000"), F.substring(micro, 1, 3)).otherwise(micro)
    dot = F.when(digits == "", "").otherwise(".")
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), dot, digits, F.lit("Z"))


def change_to_string() -> Column:
    """A decoded change as text; a missing part prints as ``null``."""
    parts = [instant_text("timestamp"), F.col("eventType"), item_to_string(F.col("oldItem")), item_to_string(F.col("newItem"))]
    return F.format_string(CHANGE_TEXT, *[_or_null(part) for part in parts])


def with_change_metadata(
    df: DataFrame, op_ts: str, table_name: str, schema_name: str = "dbo", database_name: str = "db"
) -> DataFrame:
    """Add when the change happened, when it is processed, and which table it belongs to."""
    return df.select(
        "*",
        F.col(op_ts).alias("_source_updated_at"),
        F.current_timestamp().alias("_change_processed_at"),
        F.lit(table_name).alias("_table_name"),
        F.lit(schema_name).alias("_schema_name"),
        F.lit(database_name).alias("_db_name"),
    )


def flatten_envelope(df: DataFrame) -> DataFrame:
    """``op, op_ts, seq, before, after`` to the row the change is about plus ``op, op_ts, seq``.

    A removal carries the old row (its key is what matters), everything else the new one.
    """
    row = F.when(F.col("op").isin(REMOVALS), F.col("before")).otherwise(F.col("after"))
    return df.select("op", "op_ts", "seq", row.alias("_row")).select("op", "op_ts", "seq", "_row.*")


def change_copy(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Copy of source columns under the target's names, with both timestamps."""
    renamed = [F.col(old).alias(new) for old, new in columns.items()]
    return df.select(*renamed, "_source_updated_at", "_change_processed_at")
