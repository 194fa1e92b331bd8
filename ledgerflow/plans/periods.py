"""The period master."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PERIOD_COLUMNS = ("PerDt", "MoNo", "YrNo", "PerTypeCd")


class UnknownPeriodError(ValueError):
    """A period id is not in the master."""


def with_period(df: DataFrame, periods: DataFrame, strict: bool = True) -> DataFrame:
    """Add date, month, fiscal year label and type of ``PerId``.

    An id the master lacks fails the job when ``strict``, else the row is dropped.
    """
    side = periods.select("PerId", *PERIOD_COLUMNS)
    if not strict:
        return df.join(side, "PerId")
    joined = df.join(side.withColumn("_known", F.lit(True)), "PerId", "left")
    problem = F.concat(F.lit("period is not in the period master: "), F.coalesce("PerId", F.lit("(null)")))
    return joined.where(F.assert_true(F.coalesce("_known", F.lit(False)), problem).isNull()).drop("_known")


def find_period(periods: DataFrame, period_id: str) -> dict:
    """One period of the master; an unknown id is an error."""
    row = periods.where(F.col("PerId") == period_id).select("PerId", *PERIOD_COLUMNS).first()
    if row is None:
        raise UnknownPeriodError(f"period {period_id!r} is not in the period master")
    return row.asDict()
