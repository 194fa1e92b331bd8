"""Raw JSON lines, batch and streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RAW = "raw_json"


def read_raw_lines(spark: SparkSession, path: str | None) -> DataFrame:
    """One row per line of the files a path or glob names; lines are not parsed."""
    if not path or not path.strip():
        raise ValueError("a source path is required")
    return spark.read.text(path).withColumnRenamed("value", RAW)


def read_raw_stream(spark: SparkSession, format: str = "kafka", path: str | None = None, **options: str) -> DataFrame:
    """A message stream as text: the payload decoded as UTF-8, headers and attributes dropped."""
    reader = spark.readStream.format(format).options(**options)
    stream = reader.load(path) if path else reader.load()
    if "value" not in stream.columns:
        raise ValueError(f"format {format!r} has no 'value' column to read messages from")
    return stream.select(F.col("value").cast("string").alias(RAW))


def rows_as_raw_stream(stream: DataFrame) -> DataFrame:
    """Any structured stream as raw JSON messages, for sources that already carry columns."""
    return stream.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias(RAW))
