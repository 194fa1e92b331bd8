"""Table sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_table(df: DataFrame, table: str, disposition: str = "TRUNCATE") -> None:
    """Replace (TRUNCATE) or extend (APPEND) an existing table; columns are matched by name."""
    if disposition not in ("TRUNCATE", "APPEND"):
        raise ValueError(f"unknown write disposition {disposition!r}; use TRUNCATE or APPEND")
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        raise ValueError(f"table {table!r} does not exist, and this sink creates none")
    columns = spark.table(table).columns
    df.select(*[f"`{c}`" for c in columns]).write.insertInto(table, overwrite=disposition == "TRUNCATE")


def copy_table(df: DataFrame, table: str) -> None:
    """Write all columns into a table, replacing it, creating it if needed."""
    df.write.mode("overwrite").saveAsTable(table)
