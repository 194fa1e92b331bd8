"""Source dispatch by configured type, in the two modes of the framework."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.functions.json import register_json_functions
from ledgerflow.functions.sql_forms import to_spark_sql
from ledgerflow.functions.tokens import RunTokens, render_sql
from ledgerflow.sources.csv import read_csv_source
from ledgerflow.sources.pages import DEFAULT_PAGE_SIZE, explode_pages, trim_pages
from ledgerflow.sources.paths import resolve_path
from ledgerflow.sources.tables import read_query, read_table
from ledgerflow.sources.text import read_raw_lines, read_raw_stream
from ledgerflow.sources.workbooks import read_workbooks


@dataclass(frozen=True)
class SourceSpec:
    """One source. Chain mode reads GCS, BQ and PUBSUB; load mode reads API (landed pages), FILE, BQ and GCS."""

    source_type: str
    path: str | None = None
    table: str | None = None
    query: str | None = None
    query_params: dict[str, str] = field(default_factory=dict)
    message_format: str = "kafka"
    options: dict[str, str] = field(default_factory=dict)
    file_type: str = "CSV"
    prefix: str | None = None
    suffix: str | None = None
    delimiter: str = ","
    has_header: bool = True
    sheet_index: int = 0
    pagination_enabled: bool = False
    pagination_strategy: str | None = None
    page_size: int = DEFAULT_PAGE_SIZE
    next_page_field: str | None = None
    data_array_field: str | None = None
    schema: str | None = None


def _raw(spark: SparkSession, spec: SourceSpec, tokens: RunTokens) -> DataFrame:
    return read_raw_lines(spark, spec.path)


def _warehouse(spark: SparkSession, spec: SourceSpec, tokens: RunTokens) -> DataFrame:
    if not spec.query:
        return read_query(spark, None, spec.table)
    register_json_functions(spark)
    return read_query(spark, to_spark_sql(render_sql(spec.query, tokens, spec.query_params)), spec.table)


def _messages(spark: SparkSession, spec: SourceSpec, tokens: RunTokens) -> DataFrame:
    return read_raw_stream(spark, spec.message_format, spec.path, **spec.options)


def _file(spark: SparkSession, spec: SourceSpec, tokens: RunTokens) -> DataFrame:
    run_date = date.fromisoformat(tokens.run_date)
    path = resolve_path(spec.path or "", spec.prefix, spec.suffix, run_date, tokens.period_id)
    kind = spec.file_type.upper()
    if kind == "CSV":
        return read_csv_source(spark, path, spec.delimiter, spec.has_header)
    if kind in ("EXCEL", "XLSX"):
        return read_workbooks(spark, path, spec.sheet_index, spec.has_header).select("raw_json")
    raise ValueError(f"unknown file type {spec.file_type!r}; use CSV or EXCEL")


def _pages(spark: SparkSession, spec: SourceSpec, tokens: RunTokens) -> DataFrame:
    """Landed response bodies: a table or path with ``source``, ``page`` and ``body`` columns."""
    pages = read_table(spark, spec.table or spec.path or "")
    if "source" not in pages.columns:
        pages = pages.withColumn("source", F.lit("api"))
    kept = trim_pages(
        pages,
        spec.pagination_strategy if spec.pagination_enabled else None,
        data_path=spec.data_array_field,
        page_size=spec.page_size,
        next_path=spec.next_page_field,
    )
    return explode_pages(kept, spec.data_array_field).select("raw_json")


CHAIN_SOURCES = {"GCS": _raw, "BQ": _warehouse, "PUBSUB": _messages}
LOAD_SOURCES = {"API": _pages, "FILE": _file, "BQ": _warehouse, "GCS": _raw}


def read_source(spark: SparkSession, spec: SourceSpec, tokens: RunTokens = RunTokens(), mode: str = "chain") -> DataFrame:
    """Open a source by type; a type the mode does not support is an error."""
    readers = {"chain": CHAIN_SOURCES, "load": LOAD_SOURCES}[mode]
    kind = (spec.source_type or "").upper()
    if kind not in readers:
        raise ValueError(f"source type {spec.source_type!r} is not supported in {mode} mode; use {', '.join(readers)}")
    return readers[kind](spark, spec, tokens)
