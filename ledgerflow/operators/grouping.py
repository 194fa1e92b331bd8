"""GROUP_BY with lenient numbers: partial aggregation on the map side, one shuffle on the keys."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.functions.scalars import column, has_unique_text, lenient_double, text_form, type_of

# The exact, case-sensitive function names.
FUNCTIONS = ("SUM", "COUNT", "AVG", "MIN", "MAX")


@dataclass(frozen=True)
class Aggregation:
    field: str
    function: str
    output: str


def aggregate_column(df: DataFrame, agg: Aggregation, strict: bool = False) -> Column:
    """One aggregate. Null and unparsable values count as 0.0; COUNT counts rows whatever the field.

    MIN is guarded because Spark orders NaN last while here any NaN makes the minimum NaN.
    """
    if agg.function == "COUNT":
        return F.count(F.lit(1)).alias(agg.output)
    if agg.function not in FUNCTIONS:
        if strict:
            raise ValueError(f"unknown aggregate function {agg.function!r}; known: {', '.join(FUNCTIONS)}")
        return F.lit(0.0).alias(agg.output)
    value = lenient_double(df, agg.field)
    if agg.function == "SUM":
        result = F.sum(value)
    elif agg.function == "AVG":
        result = F.avg(value)
    elif agg.function == "MAX":
        result = F.max(value)
    else:
        result = F.when(F.max(F.isnan(value)), F.lit(float("nan"))).otherwise(F.min(value))
    return result.alias(agg.output)


def group_by(df: DataFrame, fields: list[str], aggregations: list[Aggregation], strict: bool = False) -> DataFrame:
    """One row per key: keys as strings (null as empty), then the aggregates.

    Keys whose text form is one-to-one are grouped on the native value and formatted once per group.
    """
    keys = {}
    for name in fields:
        native = has_unique_text(type_of(df, name))
        keys[name] = (column(name) if native else text_form(name, df)).alias(name)
    aggregates = [aggregate_column(df, agg, strict) for agg in aggregations]
    if not aggregates:
        return df.select(*keys.values()).distinct().select(*[text_form(name).alias(name) for name in fields])
    if not keys:
        # No key is one group, and no rows means no group.
        counted = df.agg(F.count(F.lit(1)).alias("_rows"), *aggregates)
        return counted.where("_rows > 0").drop("_rows")
    grouped = df.groupBy(*keys.values()).agg(*aggregates)
    outputs = [column(agg.output) for agg in aggregations]
    return grouped.select(*[text_form(name).alias(name) for name in fields], *outputs)
