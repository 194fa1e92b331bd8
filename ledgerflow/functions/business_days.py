"""Business days: pure arithmetic for Monday-to-Friday calendars, a bounded calendar table where holidays count."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerflow.functions.scalars import column
from ledgerflow.session import materialize

# A calendar row is two small columns, so this many rows (about 270 years) stay far below any broadcast limit.
_MONDAY = date(1970, 1, 5)


def is_weekend(day: Column) -> Column:
    return F.dayofweek(day).isin(1, 7)


def _days(day: Column) -> Column:
    return F.datediff(day.cast("date"), F.lit(_MONDAY))


def weekday_index(day: Column) -> Column:
    """Number of the last Monday-to-Friday day at or before ``day``, counted from a fixed Monday."""
    days = _days(day)
    week = F.floor(days / 7)
    return (week * 5 + F.least(days - week * 7, F.lit(4))).cast("int")


def weekday_of_index(index: Column) -> Column:
    """The date with a given weekday number."""
    week = F.floor(index / 5)
    return F.date_add(F.lit(_MONDAY), (week * 7 + (index - week * 5)).cast("int"))


def shift_weekdays(day: Column, offset: int) -> Column:
    """Move by weekdays. 0 is the weekday at or before the date; from a weekend, -1 is the Friday before.

    Arithmetic on the column only, so it costs no join however many rows there are.
    """
    index = weekday_index(day) + F.lit(offset)
    if offset < 0:
        index = index + is_weekend(day).cast("int")
    return weekday_of_index(index)


def next_weekday(day: Column) -> Column:
    """First weekday strictly after the date."""
    return shift_weekdays(day, 1)


def previous_weekday(day: Column) -> Column:
    """Last weekday at or before the date."""
    return shift_weekdays(day, 0)


def count_weekdays(start: Column, end: Column) -> Column:
    """Weekdays in ``[start, end)``, 0 for an empty range."""
    before = lambda day: weekday_index(F.date_sub(day.cast("date"), 1))
    return F.greatest(before(end) - before(start), F.lit(0))


def business_calendar(spark: SparkSession, start: date, end: date, holidays: DataFrame | None = None) -> DataFrame:
    """One row per date: ``cal_date``, ``is_business``, and ``biz_index`` (business days up to and including it).

    ``holidays`` has a ``holiday`` date column. The span is bounded, so the running count over it may use one task.
    """
    days = (end - start).days + 1
    if days <= 0:
        raise ValueError("a calendar ends on or after its start")
    dates = spark.range(days).select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("cal_date"))
    business = ~is_weekend(F.col("cal_date"))
    if holidays is not None:
        closed = holidays.select(F.col("holiday").cast("date").alias("cal_date")).distinct()
        closed = closed.where(F.col("cal_date").between(F.lit(start), F.lit(end)))
        dates = dates.join(closed.withColumn("_closed", F.lit(True)), "cal_date", "left")
        business = business & F.col("_closed").isNull()
    marked = dates.select("cal_date", business.alias("is_business"))
    running = Window.orderBy("cal_date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    calendar = marked.withColumn("biz_index", F.sum(F.col("is_business").cast("int")).over(running).cast("int"))
    # Written once where holidays come from a table, as every use of a calendar reads it more than once.
    return calendar if holidays is None else materialize(calendar, "calendar")


def business_days_in_range(
    spark: SparkSession, start: date, end: date, holidays: DataFrame | None = None
) -> DataFrame:
    """Business days from ``start`` to ``end``, both included, in order."""
    return business_calendar(spark, start, end, holidays).where("is_business").select("cal_date").orderBy("cal_date")


def shift_business_days(df: DataFrame, day: str, offset: int, calendar: DataFrame, out: str) -> DataFrame:
    """Move a date column by business days of a calendar table; null outside the calendar.

    Date-to-date pairs are worked out on the calendar alone and joined as one row per date.
    """
    moved = F.col("biz_index") + F.lit(offset)
    if offset < 0:
        moved = moved + F.when(F.col("is_business"), 0).otherwise(1)
    origins = calendar.select(F.col("cal_date").alias("_from"), moved.alias("_index"))
    targets = calendar.where("is_business").select(F.col("biz_index").alias("_index"), F.col("cal_date").alias(out))
    pairs = origins.join(targets, "_index").select("_from", out)
    joined = df.withColumn("_from", column(day).cast("date")).join(pairs, "_from", "left")
    return joined.select(*[column(c) for c in df.columns], out)


def count_business_days(df: DataFrame, start: str, end: str, calendar: DataFrame, out: str) -> DataFrame:
    """Business days of a calendar table in ``[start, end)`` for each row."""
    before = F.col("biz_index") - F.col("is_business").cast("int")
    at = calendar.select("cal_date", before.alias("_before"))
    low = at.select(F.col("cal_date").alias("_start"), F.col("_before").alias("_low"))
    high = at.select(F.col("cal_date").alias("_end"), F.col("_before").alias("_high"))
    keyed = df.withColumns({"_start": column(start).cast("date"), "_end": column(end).cast("date")})
    joined = keyed.join(low, "_start", "left").join(high, "_end", "left")
    counted = F.greatest(F.col("_high") - F.col("_low"), F.lit(0)).alias(out)
    return joined.select(*[column(c) for c in df.columns], counted)


def calendar_window(run_date: date, reach: int, wider: int = 1) -> tuple[date, date]:
    """A span that usually lets a date move ``reach`` business days either way; ``wider`` multiplies it."""
    margin = (abs(reach) * 2 + 40) * wider
    before, after = (run_date - date.min).days, (date.max - run_date).days
    return run_date - timedelta(days=min(margin, before)), run_date + timedelta(days=min(margin, after))


def effective_date(
    spark: SparkSession, run_date: date, look_back_days: int = 0, holidays: DataFrame | None = None
) -> date:
    """The business date of a run: ``look_back_days`` business days before the run date (1 is yesterday's).

    0 is the run date itself. The calendar is widened until it holds the date, however long closures last; without any
    business day left it is an error.
    """
    if look_back_days == 0:
        return run_date
    day = spark.range(1).select(F.lit(run_date).alias("day"))
    wider, span = 1, None
    while span != (span := calendar_window(run_date, look_back_days, wider)):
        calendar = business_calendar(spark, *span, holidays)
        moved = shift_business_days(day, "day", -look_back_days, calendar, "moved").first()["moved"]
        if moved is not None:
            return moved
        wider *= 4
    raise ValueError(f"no business day lies {look_back_days} days before {run_date}")
