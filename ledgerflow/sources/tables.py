"""Table and query reads, and facts about tables."""

from __future__ import annotations

import logging
import re
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.operators.rows import as_strings as stringify

log = logging.getLogger(__name__)


def read_table(spark: SparkSession, table: str, as_strings: bool = False) -> DataFrame:
    """A catalog table, or a parquet folder or file when the reference is a path."""
    df = spark.read.parquet(table) if "/" in table else spark.table(table)
    return stringify(df) if as_strings else df


def read_query(
    spark: SparkSession, query: str | None = None, table: str | None = None, args: dict | None = None, **views
) -> DataFrame:
    """SQL text if given, else the table; neither is an error. ``views`` fill ``{name}`` markers with DataFrames."""
    if query and query.strip():
        return spark.sql(query, args=args, **views) if args or views else spark.sql(query)
    if table and table.strip():
        return read_table(spark, table)
    raise ValueError("a source query or table is required")


@dataclass(frozen=True)
class TableFacts:
    exists: bool
    schema: T.StructType | None
    row_count: int


_FOOTERS = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}


@contextmanager
def _settings(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def footer_count(spark: SparkSession, path: str) -> DataFrame:
    """The row count of a Parquet folder or file, from the footers of its files; take it under ``footer_settings``."""
    return spark.read.parquet(path).agg(F.count(F.lit(1)).alias("row_count"))


def footer_settings(spark: SparkSession):
    """Settings under which counts are pushed into the Parquet scan."""
    return _settings(spark, _FOOTERS)


def _known_count(spark: SparkSession, table: str) -> int | None:
    """The row count that the catalog has, if the table was analyzed and not written since."""
    about = {row["col_name"]: row["data_type"] for row in spark.sql(f"DESCRIBE EXTENDED {table}").collect()}
    found = re.search(r"(\d+) rows", about.get("Statistics") or "")
    return int(found[1]) if found else None


def table_facts(spark: SparkSession, table: str) -> TableFacts:
    """Whether a table exists, its schema, and its row count (-1 when unknown).

    Rows are not read for it: the catalog's statistics are taken where it has them, and counts of Parquet paths come
    from the files' footers. Other tables are counted.
    """
    try:
        df = read_table(spark, table)
        if "/" in table:
            with footer_settings(spark):
                return TableFacts(True, df.schema, footer_count(spark, table).first()["row_count"])
        known = _known_count(spark, table) if spark.catalog.getTable(table).tableType != "TEMPORARY" else None
        return TableFacts(True, df.schema, df.count() if known is None else known)
    except PySparkException as error:
        log.warning("no facts for table %s: %s", table, error)
        return TableFacts(False, None, -1)
