"""Landed pages of a paged service: stop rules and records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.functions.json import json_array, json_path, json_value
from ledgerflow.functions.scalars import column
from ledgerflow.session import materialize

DEFAULT_PAGE_SIZE = 100


def page_records(body: Column, data_path: str | None, strict: bool = True) -> Column:
    """Records of one page as an array of JSON texts; a value that is not an array holds no records."""
    records = json_array(body, data_path, strict)
    return F.transform(records, lambda record: F.coalesce(F.to_json(record), F.lit("null")))


def explode_pages(
    pages: DataFrame, data_path: str | None = None, body: str = "body", strict: bool = True
) -> DataFrame:
    """One ``raw_json`` row per record; the other page columns are kept. Unreadable bodies fail unless not strict."""
    kept = [column(c) for c in pages.columns if c != body]
    return pages.select(*kept, F.explode(page_records(column(body), data_path, strict)).alias("raw_json"))


def trim_pages(
    pages: DataFrame,
    strategy: str | None,
    source: str = "source",
    page: str = "page",
    body: str = "body",
    data_path: str | None = None,
    page_size: int = DEFAULT_PAGE_SIZE,
    next_path: str | None = None,
) -> DataFrame:
    """Keep the pages a client would have fetched, per source, in page order.

    PAGE_NUMBER stops before the first empty page, OFFSET after the first page shorter than ``page_size``, CURSOR after
    the first page without a next cursor; any other strategy keeps the first page only.

    The stop page of a source is a minimum, so it is pre-aggregated before the shuffle. It is written out and joined
    back as one row per source: broadcast when its real size allows, else by a sort-merge join whose hot sources
    adaptive execution splits. The pages of one source are never gathered in one task.
    """
    size = F.coalesce(F.size(json_array(column(body), data_path)), F.lit(0))
    last_kept = strategy in ("OFFSET", "CURSOR")
    if strategy == "PAGE_NUMBER":
        ends = size == 0
    elif strategy == "OFFSET":
        ends = size < page_size
    elif strategy == "CURSOR":
        cursor = json_value(column(body), json_path(next_path)) if next_path else F.lit(None).cast("string")
        ends = F.trim(F.coalesce(cursor, F.lit(""))) == ""
    else:
        ends, last_kept = F.lit(True), True
    stops = pages.where(ends).groupBy(column(source).alias("_source")).agg(F.min(column(page)).alias("_stop"))
    stops = materialize(stops, "page-stops")
    joined = pages.join(stops, column(source).eqNullSafe(F.col("_source")), "left")
    reached = (column(page) <= F.col("_stop")) if last_kept else (column(page) < F.col("_stop"))
    return joined.where(F.col("_stop").isNull() | reached).select(*pages.columns)
