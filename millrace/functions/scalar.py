"""Column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

JSON_ISO = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSS", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSS"}


def _c(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


# --- text ------------------------------------------------------------------------------------------------------------

# Texts of a pair and of a value with its window.
PAIR_TEXT = "%s,%.2f"
WINDOW_TEXT = "%s,%.2f,TimeWindow{start=%d, end=%d}"


def csv_pair(key: Column | str, number: Column | str) -> Column:
    """``key,1.50``"""
    return F.format_string(PAIR_TEXT, _c(key), _c(number))


def csv_window(key: Column | str, number: Column | str, start: Column | str, end: Column | str) -> Column:
    """``key,1.50,TimeWindow{start=..., end=...}`` with the bounds in epoch milliseconds."""
    return F.format_string(WINDOW_TEXT, _c(key), _c(number), F.unix_millis(_c(start)), F.unix_millis(_c(end)))


def date_part(ts: Column | str) -> Column:
    return F.date_format(_c(ts), "yyyy-MM-dd")


def hour_part(ts: Column | str) -> Column:
    return F.date_format(_c(ts), "HH")


# --- numbers ---------------------------------------------------------------------------------------------------------


def fahrenheit(celsius: Column | str) -> Column:
    return _c(celsius) * 9 / 5 + 32


def determinant(a: Column | str, b: Column | str, c: Column | str, d: Column | str) -> Column:
    """Determinant of [[a, b], [c, d]], computed in double and returned as float."""
    a, b, c, d = (_c(x).cast("double") for x in (a, b, c, d))
    return (a * d - b * c).cast("float")


def price_after_change(base: Column | str, percent: Column | str, precision: int = 10) -> Column:
    """``base`` moved by ``percent``, at least 0.01, rounded half up to two places.

    The number is rounded once, from the shortest decimal text of the double, which 20 places hold in full.
    """
    moved = _c(base).cast("double") * (1 + _c(percent).cast("double") / 100.0)
    return F.round(F.greatest(F.lit(0.01), moved).cast("decimal(38,20)"), 2).cast(f"decimal({precision},2)")


# --- JSON ------------------------------------------------------------------------------------------------------------

CORRUPT = "_corrupt_record"


def json_decode(value: Column | str, schema: T.StructType, iso: bool = False) -> Column:
    """Text to a row; text that does not fit the schema, blank text included, fails the job. A null stays null."""
    options = {"mode": "FAILFAST", **(JSON_ISO if iso else {})}
    text = _c(value).cast("string")
    blank = F.raise_error(F.lit("a blank text is no JSON object")).cast("string")
    return F.from_json(F.when(F.length(F.trim(text)) == 0, blank).otherwise(text), schema, options)


def json_decode_lenient(df: DataFrame, value: str, schema: T.StructType, out: str = "row", iso: bool = False) -> DataFrame:
    """Text to a row; rows whose text is not a fitting JSON object are left out."""
    checked = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, **(JSON_ISO if iso else {})}
    parsed = df.withColumn(out, F.from_json(F.col(value).cast("string"), checked, options))
    kept = parsed.filter(F.col(out).isNotNull() & F.col(f"{out}.{CORRUPT}").isNull())
    return kept.withColumn(out, F.col(out).dropFields(CORRUPT))


def json_encode(*columns: Column | str, iso: bool = False) -> Column:
    """The given columns (all when none are given) as one JSON object; null fields are written as null."""
    options = {"ignoreNullFields": "false", **(JSON_ISO if iso else {})}
    return F.to_json(F.struct(*columns) if columns else F.struct("*"), options)


# --- keys and placement ----------------------------------------------------------------------------------------------


def key_of_hash(*columns: Column | str) -> Column:
    return F.xxhash64(*[_c(c) for c in columns]).cast("string")


def key_random() -> Column:
    return F.uuid()


def key_of_columns(columns: Sequence[Column | str], delimiter: str = ";") -> Column:
    return F.concat_ws(delimiter, *[_c(c).cast("string") for c in columns])


# Factor and start of the byte hash, and the range of its result.
HASH_FACTOR, HASH_START, _TWO32 = 31, 1, 4294967296


def byte_hash(key: Column | str) -> Column:
    """31-polynomial hash over the key's UTF-8 bytes, seeded with 1, as a signed 32-bit number held in a bigint."""
    # Read as Latin-1, every byte is one character whose code point is the byte.
    characters = F.split(F.decode(_c(key).cast("binary"), "ISO-8859-1"), "")
    signed = lambda b: F.when(b > 127, b - 256).otherwise(b)
    step = lambda h, c: F.pmod(h * HASH_FACTOR + signed(F.ascii(c)), F.lit(_TWO32))
    seed = F.lit(HASH_START).cast("long")
    folded = F.when(F.octet_length(_c(key)) == 0, seed).otherwise(F.aggregate(characters, seed, step))
    return F.when(folded >= _TWO32 // 2, folded - _TWO32).otherwise(folded)


def hash_partition(key: Column | str, partitions: int) -> Column:
    """Partition number from the absolute byte hash; a null key goes to partition 0.

    The absolute value is taken on a bigint, so the smallest 32-bit hash has a valid partition too.
    """
    return F.coalesce(F.pmod(F.abs(byte_hash(key)), F.lit(partitions).cast("long")).cast("int"), F.lit(0))


def spread_partition(key: Column | str, partitions: int) -> Column:
    """Cheaper placement for when the exact partition number does not matter."""
    return F.pmod(F.xxhash64(_c(key)), F.lit(partitions).cast("long")).cast("int")


# --- validation ------------------------------------------------------------------------------------------------------

ERROR, SUCCESS = "ERROR", "SUCCESS"


def outcome(message: Column | str, poison: str = "Poison") -> Column:
    """ERROR for the poison message, SUCCESS for anything else including null."""
    return F.when(_c(message).eqNullSafe(F.lit(poison)), ERROR).otherwise(SUCCESS)


def enum_value(column: Column | str, allowed: Sequence[str]) -> Column:
    """The value itself when allowed (or null); anything else fails the job."""
    column = _c(column)
    message = F.concat(F.lit("value not in the enumeration: "), column)
    return F.when(column.isNull() | column.isin(list(allowed)), column).otherwise(F.raise_error(message).cast("string"))
