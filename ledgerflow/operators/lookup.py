"""Lookup enrichment: a left join on the text form of both keys."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.functions.scalars import column, has_unique_text, is_integral, text_form, to_text, type_of
from ledgerflow.session import materialize

_KEY = "_lookup_key"


class DuplicateLookupKeyError(ValueError):
    """A lookup table holds more than one row for a key."""


def assert_unique_key(lookup: DataFrame, key: str) -> DataFrame:
    """Fail when a lookup key repeats; reads the key column only."""
    repeated = lookup.groupBy(text_form(key, lookup).alias("key")).count().where("count > 1").limit(5).collect()
    if repeated:
        shown = sorted(row["key"] for row in repeated)
        raise DuplicateLookupKeyError(f"lookup key {key!r} is not unique, for example: {shown}")
    return lookup


_REPEATED = "repeated lookup key: "


def unique_rows(side: DataFrame, key: str, name: str) -> DataFrame:
    """The rows of a join side, written out, with a check in the same pass that no key has two.

    The table is read once; what is stored has a known size to plan with, and a join to it can still split hot keys.
    """
    others = [c for c in side.columns if c != key]
    grouped = side.groupBy(column(key)).agg(F.count(F.lit(1)).alias("_n"), *[F.first(column(c)).alias(c) for c in others])
    text = F.coalesce(column(key).cast("string"), F.lit(""))
    checked = grouped.where(F.assert_true(F.col("_n") == 1, F.concat(F.lit(_REPEATED), text, F.lit("\n"))).isNull())
    try:
        return materialize(checked.select(*[column(c) for c in side.columns]), "lookup")
    except Exception as error:
        found = re.search(f"{_REPEATED}(.*)", str(error))
        if found is None:
            raise
        raise DuplicateLookupKeyError(f"lookup key {name!r} is not unique, for example: {[found.group(1)]}") from error


def first_by(lookup: DataFrame, key: str, order: str) -> DataFrame:
    """One row per key, the one with the smallest ``order`` value, written out.

    As a stored table the reduced lookup has a known size to plan with, and a join to it can still split hot keys.
    """
    picked = lookup.groupBy(text_form(key, lookup).alias(_KEY)).agg(
        F.min_by(F.struct(*[column(c) for c in lookup.columns]), column(order)).alias("_row")
    )
    return materialize(picked.select("_row.*"), "lookup")


def join_keys(data: DataFrame, data_key: str, lookup: DataFrame, lookup_key: str) -> tuple[Column, Column]:
    """Join expressions that agree with comparing text forms.

    Where the text form is one-to-one the native values are compared, which keeps bucketed or partitioned tables
    co-located and avoids formatting every row. A null lookup key equals the empty string; a null data key matches
    nothing.
    """
    left, right = type_of(data, data_key), type_of(lookup, lookup_key)
    if is_integral(left) and is_integral(right):
        wide = "bigint"
        return column(data_key).cast(wide), column(lookup_key).cast(wide)
    if left == right and has_unique_text(left):
        return column(data_key), column(lookup_key)
    return to_text(column(data_key), left), text_form(lookup_key, lookup)


def lookup_enrich(
    data: DataFrame,
    lookup: DataFrame,
    lookup_key: str,
    data_key: str,
    output_fields=(),
    unique: str = "check",
) -> DataFrame:
    """Add lookup columns, as strings, to rows whose key text equals a lookup key text.

    Unmatched rows stay, with nulls. No ``output_fields`` means every lookup column, the key included; listed columns
    the lookup lacks are skipped; a name the data already has gets the prefix ``lookup_``.

    ``unique``: ``check`` stores the needed part of the lookup and fails on repeated keys while it does, ``trust`` joins
    the table as it is.

    The join strategy is the planner's: it broadcasts a lookup under its own size threshold and otherwise runs a
    sort-merge join, where adaptive execution splits hot keys (and the null key) on the data side; for that a large
    lookup should be a stored table, not the result of an aggregation.
    """
    if lookup_key not in lookup.columns:
        raise ValueError(f"lookup has no key column {lookup_key!r}")
    wanted = list(dict.fromkeys(output_fields)) if output_fields else lookup.columns
    taken = {c.lower() for c in data.columns}
    renamed = {f: (f"lookup_{f}" if f.lower() in taken else f) for f in wanted if f in lookup.columns}
    clash = [name for field, name in renamed.items() if name != field and name.lower() in taken]
    if clash:
        raise ValueError(f"lookup columns collide even after prefixing: {clash}")
    if unique not in ("check", "trust"):
        raise ValueError(f"unknown uniqueness mode {unique!r}")

    left_key, right_key = join_keys(data, data_key, lookup, lookup_key)
    values = [column(field).cast("string").alias(name) for field, name in renamed.items()]
    side = lookup.select(right_key.alias(_KEY), *values)
    if unique == "check":
        side = unique_rows(side, _KEY, lookup_key)
    joined = data.withColumn(_KEY, left_key).join(side, _KEY, "left")
    return joined.select(*[column(c) for c in data.columns], *[column(n) for n in renamed.values()])
