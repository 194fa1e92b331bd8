"""Sorting within partitions or globally, and top-k."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.functions.scalars import column, text_form

POSITION = "_position"


def with_input_position(df: DataFrame) -> DataFrame:
    """Rows of files with their place in the input: file, start of the block, place in the block.

    It is taken where the files are read, so ``sort_rows`` and ``number_rows`` keep equal rows in the order of the files
    after any filter, join or repartition in between. Use it on the frame that a reader returns.
    """
    within = F.monotonically_increasing_id()
    place = F.struct(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), within.alias("row"))
    return df.withColumn(POSITION, place)


def positioned(df: DataFrame) -> DataFrame:
    """The frame with a position: the input's, if it has one, else one made from its partitions as they are."""
    return df if POSITION in df.columns else df.withColumn(POSITION, F.monotonically_increasing_id())


def sort_rows(
    df: DataFrame, fields: list[str], descending: bool = False, scope: str = "partition", typed: bool = False
) -> DataFrame:
    """Order rows by the given fields, all in one direction; no fields leaves the frame as it is.

    ``scope='partition'`` sorts each partition without a shuffle; ``'global'`` is a range-partitioned sort.
    The default compares text forms (``"10"`` before ``"9"``, null first as the empty string); ``typed`` compares
    native values. Equal rows stay in input order, see ``with_input_position``. That position is the last sort key, so a
    global sort also splits a value that holds a large share of the rows over several ranges.
    """
    if not fields:
        return df
    keys = []
    for name in fields:
        key = column(name) if typed else text_form(name, df)
        keys.append(key.desc() if descending else key.asc())
    if scope not in ("partition", "global"):
        raise ValueError(f"unknown sort scope {scope!r}; use 'partition' or 'global'")
    placed = positioned(df)
    ordered = placed.sortWithinPartitions(*keys, POSITION) if scope == "partition" else placed.orderBy(*keys, POSITION)
    return ordered.drop(POSITION)


def top_rows(df: DataFrame, fields: list[str], n: int, descending: bool = True) -> DataFrame:
    """``ORDER BY … LIMIT n``: each partition keeps its best n, the driver-side merge sees n rows per partition."""
    return sort_rows(df, fields, descending, scope="global", typed=True).limit(n)
