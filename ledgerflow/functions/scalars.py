"""Text forms, hashing and lenient numbers, all as built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Types whose text form is one-to-one with the value, so they can be grouped or joined natively.
_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_ONE_TO_ONE = _INTEGRAL + (T.DateType, T.BooleanType)


def column(name: str) -> Column:
    """A column by exact name, dots included."""
    return F.col(f"`{name}`")


def type_of(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def is_integral(kind: T.DataType) -> bool:
    return isinstance(kind, _INTEGRAL)


def has_unique_text(kind: T.DataType) -> bool:
    return isinstance(kind, _ONE_TO_ONE)


def to_text(col: Column, kind: T.DataType | None = None) -> Column:
    """Text of a value. A timestamp is an instant in milliseconds, in ISO 8601 and UTC whatever the session's time zone."""
    if isinstance(kind, T.TimestampType):
        millis = F.unix_millis(col)
        zero, seconds = F.lit(0), F.floor(millis / F.lit(1000).cast("decimal(4,0)")).cast("decimal(18,6)")
        utc = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(zero, zero, zero, seconds)
        whole = F.replace(utc.cast("string"), F.lit(" "), F.lit("T"))
        return F.concat(whole, F.lit("."), F.lpad(F.pmod(millis, F.lit(1000)).cast("string"), 3, "0"), F.lit("Z"))
    return col.cast("string")


def text_form(name: str, df: DataFrame | None = None) -> Column:
    """Text of a column, null as the empty string; the frame tells its type."""
    kind = None if df is None or name not in df.columns else type_of(df, name)
    return F.coalesce(to_text(column(name), kind), F.lit(""))


def sha256_hex(col: Column, kind: T.DataType | None = None) -> Column:
    """Lowercase hex SHA-256 of the text; null stays null."""
    return F.sha2(to_text(col, kind), 256)


def parsed_double(text: Column) -> Column:
    """Text to double, null when it is not a number.

    Spark also reads ``inf`` and any casing of ``nan``; only the exact words ``Infinity`` and ``NaN`` are numbers here,
    so special results are checked against the text.
    """
    number = text.try_cast("double")
    special = F.isnan(number) | (F.abs(number) == F.lit(float("inf")))
    spelled = text.rlike(r"^\s*[+-]?(?:Infinity|NaN|\d|\.\d|0[xX])")
    return F.when(special & ~spelled, F.lit(None).cast("double")).otherwise(number)


def plain_number(text: Column) -> Column:
    """Text to double where it is a number as data files write it; null for type suffixes, hex and words."""
    plain = text.rlike(r"^\s*[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?\s*$")
    return F.when(plain, text.try_cast("double"))


def lenient_double(df: DataFrame, name: str) -> Column:
    """Numbers as double; text parsed; null, unparsable text and any other type count as 0.0."""
    kind = type_of(df, name)
    if isinstance(kind, T.NumericType):
        value = column(name).cast("double")
    elif isinstance(kind, (T.StringType, T.CharType, T.VarcharType)):
        value = parsed_double(column(name))
    else:
        return F.lit(0.0)
    return F.coalesce(value, F.lit(0.0))


def row_json(names: list[str]) -> Column:
    """A row as a JSON object with nulls written out."""
    return F.to_json(F.struct(*[column(c) for c in names]), {"ignoreNullFields": "false"})
