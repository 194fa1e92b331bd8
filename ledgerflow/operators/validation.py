"""Row validation: rules yield error texts, rows with errors become dead letters."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.functions.scalars import column, parsed_double, type_of
from ledgerflow.functions.tokens import compose
from ledgerflow.result import ILLEGAL_ARGUMENT, ChainResult, dead_letter, payload_of

# Error texts.
MISSING_FIELD = "missing field: {field}"
NULL_REQUIRED = "null value for required field: {field}"
NULL_VALUE = "null value for field: {field}"
NO_MATCH = "field '{field}' value '{value}' does not match pattern {pattern}"
NOT_NUMERIC = "field '{field}' is not numeric: {value}"
OUT_OF_RANGE = "field '{field}' value {value} is outside range [{low}, {high}]"
NOT_ALLOWED = "field '{field}' value '{value}' is not in allowed set: [{allowed}]"


@dataclass(frozen=True)
class Check:
    """A failure condition, never null, and the error text it leads to.

    Conditions stay apart from texts so that the test of valid rows is a plain predicate the scan can use.
    """

    failed: Column
    message: Column

    @property
    def error(self) -> Column:
        return F.when(self.failed, self.message)


# A rule maps a frame to checks, in order.
Rule = Callable[[DataFrame], list[Check]]


def _missing(name: str) -> Check:
    return Check(F.lit(True), compose(MISSING_FIELD, field=name))


def require_fields(*fields: str) -> Rule:
    """Each field must exist and be non-null."""

    def checks(df: DataFrame) -> list[Check]:
        return [
            Check(column(name).isNull(), compose(NULL_REQUIRED, field=name))
            if name in df.columns
            else _missing(name)
            for name in fields
        ]

    return checks


def _on_value(field: str, check: Callable[[DataFrame], Check]) -> Rule:
    """A rule on the value of one field, which must exist and be non-null."""

    def checks(df: DataFrame) -> list[Check]:
        if field not in df.columns:
            return [_missing(field)]
        inner, absent = check(df), column(field).isNull()
        no_value = compose(NULL_VALUE, field=field)
        return [Check(absent | inner.failed, F.when(absent, no_value).otherwise(inner.message))]

    return checks


def matches_pattern(field: str, pattern: str) -> Rule:
    """The whole text form must match the regular expression."""

    def check(df: DataFrame) -> Check:
        text = column(field).cast("string")
        message = compose(NO_MATCH, field=field, value=text, pattern=pattern)
        return Check(~text.rlike(rf"\A(?:{pattern})\z"), message)

    return _on_value(field, check)


def in_range(field: str, low: float, high: float) -> Rule:
    """Inclusive numeric bounds; text that is not a number is an error, NaN passes (it fails no comparison)."""

    def check(df: DataFrame) -> Check:
        kind, text = type_of(df, field), column(field).cast("string")
        numeric = isinstance(kind, T.NumericType)
        number = column(field).cast("double") if numeric else parsed_double(text)
        above = number > F.lit(float(high))
        if not numeric or isinstance(kind, (T.FloatType, T.DoubleType)):
            above = above & ~F.isnan(number)
        outside = (number < F.lit(float(low))) | above
        bounds = {name: F.lit(float(bound)) for name, bound in (("low", low), ("high", high))}
        message = compose(OUT_OF_RANGE, field=field, value=number, **bounds)
        if numeric:
            return Check(outside, message)
        not_numeric = compose(NOT_NUMERIC, field=field, value=text)
        return Check(number.isNull() | outside, F.when(number.isNull(), not_numeric).otherwise(message))

    return _on_value(field, check)


def one_of(field: str, allowed: Iterable[str]) -> Rule:
    """The text form must be one of the allowed values; null fails."""
    values = list(allowed)

    def checks(df: DataFrame) -> list[Check]:
        if field not in df.columns:
            return [_missing(field)]
        text = column(field).cast("string")
        shown = F.coalesce(text, F.lit("null"))
        message = compose(NOT_ALLOWED, field=field, value=shown, allowed=", ".join(values))
        return [Check(text.isNull() | ~text.isin(values), message)]

    return checks


def schema_contains(*names: str) -> Rule:
    """Columns must exist by name; types are not compared."""
    return lambda df: [_missing(n) for n in names if n not in df.columns]


def row_errors(df: DataFrame, rules: Iterable[Rule]) -> Column:
    """Ordered array of error texts, empty for a valid row."""
    found = [check.error for rule in rules for check in rule(df)]
    return F.array_compact(F.array(*found)) if found else F.array().cast("array<string>")


def validate_rows(rows: DataFrame | ChainResult, rules: Iterable[Rule]) -> ChainResult:
    """Rows with any error become dead letters whose message joins all errors in rule order."""
    result = rows if isinstance(rows, ChainResult) else ChainResult.start(rows)
    checks = [check for rule in rules for check in rule(result.tagged.select(*map(column, result.columns)))]
    if not checks:
        return result
    failed = reduce(lambda a, b: a | b, [check.failed for check in checks])
    message = F.concat_ws("; ", *[check.error for check in checks])
    return result.fail_where(failed, dead_letter(payload_of(result.tagged), message, ILLEGAL_ARGUMENT, 0))
