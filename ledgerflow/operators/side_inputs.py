"""Driver-side values available to every row: a constant, a list, a map.

They travel inside the plan; what grows with the data belongs in a table and a lookup.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.functions.scalars import column

def with_constant(df: DataFrame, name: str, value) -> DataFrame:
    """The same value on every row."""
    return df.withColumn(name, F.lit(value))


def in_list(name: str, values: list) -> Column:
    """Whether a column's value is in a driver-side list."""
    return column(name).isin(values)


def map_value(name: str, mapping: dict) -> Column:
    """A column's value looked up in a driver-side map; null when absent."""
    if not mapping:
        return F.lit(None).cast("string")
    entries = [F.lit(part) for pair in mapping.items() for part in pair]
    return F.try_element_at(F.create_map(*entries), column(name))
