"""A chain over a stream, with both outputs taken from one read of each micro-batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from ledgerflow.operators.chain import ChainOptions, TransformRegistry, run_chain
from ledgerflow.sinks.files import write_dead_letters
from ledgerflow.sinks.messages import as_messages
from ledgerflow.sinks.outcomes import read_outcomes, tagged_rows
from ledgerflow.sinks.router import SinkSpec
from ledgerflow.streaming.publish import FILE_FORMATS, BatchPublisher, publish_to_table

#: Name of a chain's counters in the progress of its query.
METRICS = "chain"


def _start(writer, available_now: bool) -> StreamingQuery:
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def stream_outcomes(
    stream: DataFrame,
    spec: str,
    path: str,
    checkpoint: str,
    options: ChainOptions = ChainOptions(),
    registry: TransformRegistry | None = None,
    available_now: bool = False,
) -> tuple[StreamingQuery, T.StructType]:
    """Stream both outputs into one file sink partitioned by outcome: one read, exactly once, with counters.

    Returns the query and the schema of accepted rows, for ``read_outcomes``.
    """
    result, _ = run_chain(stream, spec, options, registry).observed(METRICS)
    writer = (
        tagged_rows(result)
        .writeStream.format("parquet")
        .outputMode("append")
        .partitionBy("outcome")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    return _start(writer, available_now), result.tagged.select(*result.columns).schema


def _send(publisher: BatchPublisher, messages: DataFrame, batch_id: int, sink: SinkSpec) -> None:
    options = {k: v for k, v in sink.options.items() if k != "path"}
    if sink.message_format in FILE_FORMATS and "path" in sink.options:
        publisher.publish(messages, batch_id, sink.options["path"], sink.message_format, **options)
    elif not publisher.done(batch_id):
        messages.write.format(sink.message_format).options(**sink.options).save()
        publisher.commit(batch_id, 0)


def stream_chain(
    stream: DataFrame,
    spec: str,
    checkpoint: str,
    sink: SinkSpec,
    dead_letter_path: str | None = None,
    options: ChainOptions = ChainOptions(),
    registry: TransformRegistry | None = None,
    available_now: bool = False,
) -> StreamingQuery:
    """Stream accepted rows to a file, table or message sink and dead letters to files.

    Each micro-batch is computed once and cached for its two writes, and its counters are in the query's progress under
    ``METRICS``. File writes go to a folder per batch that a retry replaces; tables of files, and messages written as
    files, take each batch once by ``BatchPublisher``. So a repeated batch leaves no duplicates. Messages to a broker
    are at least once: a batch in the log is not sent again, but one that was stopped while it was sent is.
    """
    result, _ = run_chain(stream, spec, options, registry).observed(METRICS)
    kind = sink.sink_type.upper()
    if kind not in ("GCS", "BQ", "PUBSUB"):
        raise ValueError(f"unknown sink type {sink.sink_type!r}")
    publisher = BatchPublisher(stream.sparkSession, f"{checkpoint.rstrip('/')}/published")

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        tagged = batch.persist()
        try:
            ok = tagged.where(F.col("outcome") == "ok").select("row.*")
            if kind == "GCS":
                ok.write.mode("overwrite").option("ignoreNullFields", "false").json(f"{sink.path}/batch_id={batch_id}")
            elif kind == "BQ":
                publish_to_table(publisher, ok, batch_id, sink.table)
            else:
                _send(publisher, as_messages(ok), batch_id, sink)
            if dead_letter_path:
                dead = tagged.where(F.col("outcome") == "dead").select("dead.*")
                write_dead_letters(dead, f"{dead_letter_path}/batch_id={batch_id}", mode="overwrite")
        finally:
            tagged.unpersist()

    writer = tagged_rows(result).writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    return _start(writer, available_now)


def read_stream_outcomes(spark: SparkSession, path: str, row_schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """The outputs that ``stream_outcomes`` wrote."""
    return read_outcomes(spark, path, row_schema)
