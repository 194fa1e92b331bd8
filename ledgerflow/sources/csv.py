"""CSV files with the period-load cell rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.functions.scalars import column

_CORRUPT = "_corrupt"


def _present_cells(record: Column, delimiter: str) -> Column:
    """Number of cells in a raw record, counting delimiters outside quotes."""
    bare = F.regexp_replace(record, '"[^"]*"', "")
    return F.length(bare) - F.length(F.replace(bare, F.lit(delimiter), F.lit(""))) + 1


def read_csv_source(
    spark: SparkSession,
    path: str,
    delimiter: str = ",",
    has_header: bool = True,
    multi_line: bool = True,
) -> DataFrame:
    """All-string columns; an empty cell is ``""``, a cell missing from a short row is null, extra cells are dropped.

    Without a header the columns are ``field_0``, ``field_1``, …, as many as the first record has. Only the first
    character of ``delimiter`` counts. ``multi_line`` allows newlines inside quotes and reads each file in one task;
    sources without them should set it to false, then large files are read in parallel splits. Files of one path must
    have the same header: one with other names, or another order, fails the job instead of swapping columns.
    """
    if not delimiter:
        raise ValueError("a delimiter is required")
    sep = delimiter[0]
    options = {"sep": sep, "escape": '"', "multiLine": multi_line, "maxColumns": 1_000_000}
    found = spark.read.options(header=has_header, inferSchema=False, **options).csv(path).columns
    names = found if has_header else [f"field_{i}" for i in range(len(found))]
    fields = [T.StructField(n, T.StringType()) for n in names]
    schema = T.StructType(fields + [T.StructField(_CORRUPT, T.StringType())])
    parsed = (
        spark.read.schema(schema)
        .options(header=has_header, enforceSchema=False, mode="PERMISSIVE", columnNameOfCorruptRecord=_CORRUPT, **options)
        .csv(path)
    )
    present = F.when(F.col(_CORRUPT).isNull(), F.lit(len(names))).otherwise(_present_cells(F.col(_CORRUPT), sep))
    cells = [
        F.when(column(n).isNull() & (F.lit(i) < present), F.lit("")).otherwise(column(n)).alias(n)
        for i, n in enumerate(names)
    ]
    return parsed.select(*cells)
