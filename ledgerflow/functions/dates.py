"""Dates: text formats, truncation, run dates, period ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Date text formats.
ISO_DATE = "yyyy-MM-dd"
COMPACT_DATE = "yyyyMMdd"
DISPLAY_DATE = "dd MMM yyyy"


def iso_date(day: Column) -> Column:
    return F.date_format(day, ISO_DATE)


def compact_date(day: Column) -> Column:
    return F.date_format(day, COMPACT_DATE)


def display_date(day: Column) -> Column:
    return F.date_format(day, DISPLAY_DATE)


def week_start(day: Column) -> Column:
    """Monday of the ISO week."""
    return F.trunc(day, "week")


def month_start(day: Column) -> Column:
    return F.trunc(day, "month")


def year_start(day: Column) -> Column:
    return F.trunc(day, "year")


def dated_path_column(base: str, day: Column) -> Column:
    """``base/yyyy-MM-dd/`` for each row."""
    return F.concat(F.lit(base.rstrip("/") + "/"), iso_date(day), F.lit("/"))


def shard_column(table: str, day: Column) -> Column:
    """``table$yyyyMMdd`` for each row."""
    return F.concat(F.lit(table + "$"), compact_date(day))


def decode_period(period_id: Column) -> Column:
    """Struct of type code, date, month and quarter read from a period id; null fields for other forms.

    Six digits are a month (dated on its last day), eight a day, ten a day plus a two-digit quarter.
    """
    digits = period_id.rlike(r"^\d+$")
    size = F.length(period_id)
    kind = F.when(digits & (size == 6), "MONTHLY").when(digits & (size == 8), "DAILY")
    kind = kind.when(digits & (size == 10), "QUARTERLY")
    day = _period_date(period_id, size, digits)
    return F.struct(
        kind.alias("PerTypeCd"),
        day.alias("PerDt"),
        F.month(day).cast("bigint").alias("MoNo"),
        F.when(digits & (size == 10), F.substring(period_id, 9, 2).cast("int")).alias("QtrNo"),
    )


def _period_date(period_id: Column, size: Column, digits: Column) -> Column:
    dashed = F.concat_ws(
        "-",
        F.substring(period_id, 1, 4),
        F.substring(period_id, 5, 2),
        F.when(size == 6, F.lit("01")).otherwise(F.substring(period_id, 7, 2)),
    )
    day = F.when(digits & size.isin(6, 8, 10), dashed.try_cast("date"))
    return F.when(size == 6, F.last_day(day)).otherwise(day)


def fiscal_year_label(day: Column, first_month: int = 4) -> Column:
    """``"23-24"`` for dates in the fiscal year that starts in April 2023."""
    start = F.year(day) - F.when(F.month(day) < first_month, 1).otherwise(0)
    return F.concat_ws("-", *[F.lpad((year % 100).cast("string"), 2, "0") for year in (start, start + 1)])
