"""Message sinks: one JSON message per row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming.query import StreamingQuery

from ledgerflow.functions.scalars import row_json


def as_messages(df: DataFrame) -> DataFrame:
    """Rows as a single ``value`` column of JSON text."""
    return df.select(row_json(df.columns).alias("value"))


def write_messages(df: DataFrame, format: str, checkpoint: str | None = None, **options: str) -> StreamingQuery | None:
    """Send one message per row; a streaming frame starts a query, a batch frame is written at once."""
    messages = as_messages(df)
    if not df.isStreaming:
        messages.write.format(format).options(**options).save()
        return None
    if not checkpoint:
        raise ValueError("a streaming message sink needs a checkpoint location")
    writer = messages.writeStream.format(format).option("checkpointLocation", checkpoint).options(**options)
    return writer.outputMode("append").start()
