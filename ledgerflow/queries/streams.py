"""Streaming chains over whole tables, run until the available input is used up."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerflow.metrics import StreamTotals, distribution, observed
from ledgerflow.operators.chain import ChainOptions
from ledgerflow.queries.registry import query, table
from ledgerflow.session import scratch_path
from ledgerflow.sinks.outcomes import read_outcomes
from ledgerflow.sinks.router import SinkSpec
from ledgerflow.sources.text import read_raw_stream
from ledgerflow.streaming.chain import METRICS, stream_chain, stream_outcomes

_OPTIONS = ChainOptions(pii_fields=("user_id",))


def _stream(spark, sf_dir):
    """Events as a stream of rows with some nulls."""
    schema = table(spark, sf_dir, "events").schema
    stream = spark.readStream.schema(schema).parquet(f"{sf_dir}/events*.parquet")
    rows = stream.select("event_id", "user_id", "event_type", "value")
    return rows.withColumn("event_type", F.nullif("event_type", F.lit("error")))


def _outcomes(spark, sf_dir):
    path = scratch_path(spark, "stream")
    query_, schema = stream_outcomes(
        _stream(spark, sf_dir), "filter-nulls,mask-pii", f"{path}/out", f"{path}/state", _OPTIONS, available_now=True
    )
    query_.awaitTermination()
    return read_outcomes(spark, f"{path}/out", schema)


@query(
    "SELECT event_id, sha256(CAST(user_id AS VARCHAR)) AS user_id, event_type, value FROM events WHERE event_type <> 'error'"
)
def stream_chain_ok(spark, sf_dir):
    return _outcomes(spark, sf_dir)[0]


@query("SELECT event_id FROM events WHERE event_type = 'error'")
def stream_chain_dead(spark, sf_dir):
    dead = _outcomes(spark, sf_dir)[1]
    return dead.select(F.get_json_object("payload", "$.event_id").cast("bigint").alias("event_id"))


@query(
    """
SELECT event_id, value, 'ok' AS outcome FROM events WHERE event_type <> 'error'
UNION ALL SELECT event_id, NULL, 'dead' FROM events WHERE event_type = 'error'
"""
)
def stream_chain_sinks(spark, sf_dir):
    """Accepted rows to JSON files and dead letters to their own files, from one read of each batch."""
    path = scratch_path(spark, "stream")
    sink = SinkSpec("GCS", path=f"{path}/ok")
    stream_chain(
        _stream(spark, sf_dir), "filter-nulls,mask-pii", f"{path}/state", sink, f"{path}/dead", _OPTIONS, available_now=True
    ).awaitTermination()
    ok = spark.read.schema("event_id bigint, value double").json(f"{path}/ok").select("event_id", "value")
    dead = spark.read.schema("payload string").json(f"{path}/dead")
    failed = dead.select(F.get_json_object("payload", "$.event_id").cast("bigint").alias("event_id"))
    return ok.withColumn("outcome", F.lit("ok")).unionByName(
        failed.withColumn("outcome", F.lit("dead")), allowMissingColumns=True
    )


def _messages(spark, sf_dir, path):
    """Events as raw messages, a JSON text each, landed in three files; some are broken."""
    events = table(spark, sf_dir, "events")
    kept = F.to_json(F.struct("event_id", F.nullif("event_type", F.lit("error")).alias("event_type"), "value"), {"ignoreNullFields": "false"})
    text = F.when(F.col("event_type") == "view", F.concat(F.lit("broken "), F.col("event_id"))).otherwise(kept)
    events.select(text.alias("value")).repartition(3).write.text(path)
    return read_raw_stream(spark, "text", path, maxFilesPerTrigger="1")


_FLATTEN = ChainOptions(json_schema="event_id bigint, event_type string, value double")


@query("SELECT event_id, event_type, value FROM events WHERE event_type NOT IN ('error', 'view')")
def stream_raw_messages(spark, sf_dir):
    """Raw messages in, flattened and filtered, messages out, over several micro-batches; the messages are read back."""
    path = scratch_path(spark, "messages")
    sink = SinkSpec("PUBSUB", message_format="text", options={"path": f"{path}/sent"})
    stream_chain(
        _messages(spark, sf_dir, f"{path}/landed"), "flatten-json,filter-nulls", f"{path}/state", sink, None, _FLATTEN,
        available_now=True,
    ).awaitTermination()
    sent = spark.read.text(f"{path}/sent")
    return sent.select(F.from_json("value", _FLATTEN.json_schema).alias("m")).select("m.*")


@query("SELECT event_type, count(*) AS n, sum(event_id)::BIGINT AS ids FROM events WHERE event_type NOT IN ('error', 'view') GROUP BY 1")
def stream_table_sink(spark, sf_dir):
    """A stream into a partitioned table that loses its last commit and runs the batch again."""
    path = scratch_path(spark, "stream-table")
    name = "events_" + path[-32:]
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS ledgerflow_streams LOCATION '{path}-tables'")
    spark.sql(
        f"CREATE TABLE ledgerflow_streams.{name} (event_id BIGINT, value DOUBLE, event_type STRING) USING parquet "
        f"PARTITIONED BY (event_type) LOCATION '{path}/table'"
    )
    sink = SinkSpec("BQ", table=f"ledgerflow_streams.{name}")
    stream = _messages(spark, sf_dir, f"{path}/landed")
    run = lambda: stream_chain(
        stream, "flatten-json,filter-nulls", f"{path}/state", sink, None, _FLATTEN, available_now=True
    )
    run().awaitTermination()
    last = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/state/commits/2")
    last.getFileSystem(spark._jsc.hadoopConfiguration()).delete(last, False)
    run().awaitTermination()
    return spark.table(f"ledgerflow_streams.{name}").groupBy("event_type").agg(F.count("*").alias("n"), F.sum("event_id").alias("ids"))


@query(
    """
SELECT count(*) AS rows_in, count(*) FILTER (event_type NOT IN ('error', 'view')) AS rows_out,
       count(*) FILTER (event_type = 'error') AS rows_dropped, count(*) FILTER (event_type IN ('error', 'view')) AS dead,
       count(value) AS value_count, min(value) AS value_min, max(value) AS value_max, round(avg(value), 6) AS value_mean
FROM events
"""
)
def stream_counters(spark, sf_dir):
    """Counters of a stream's chain and a distribution of its values, added up over its micro-batches by a listener."""
    path = scratch_path(spark, "stream-counters")
    totals = StreamTotals.listening(spark)
    try:
        chain, _ = stream_outcomes(
            _messages(spark, sf_dir, f"{path}/landed"), "flatten-json,filter-nulls", f"{path}/out", f"{path}/state", _FLATTEN,
            available_now=True,
        )
        chain.awaitTermination()
        found = totals.of(chain, METRICS)
        table(spark, sf_dir, "events").repartition(2).write.parquet(f"{path}/rows")
        rows = spark.readStream.schema("value double").option("maxFilesPerTrigger", 1).parquet(f"{path}/rows")
        counted, _ = observed(rows, "values", distribution("value", F.col("value")))
        writer = counted.writeStream.format("noop").option("checkpointLocation", f"{path}/values")
        values = writer.trigger(availableNow=True).start()
        values.awaitTermination()
        spread = totals.of(values, "values")
    finally:
        spark.streams.removeListener(totals)
    row = (
        found["rows_in"], found["rows_out"], found["rows_dropped_null_field"], found["dlq_total"], spread["value_count"],
        spread["value_min"], spread["value_max"], round(spread["value_mean"], 6),
    )
    schema = (
        "rows_in bigint, rows_out bigint, rows_dropped bigint, dead bigint, value_count bigint, value_min double, "
        "value_max double, value_mean double"
    )
    return spark.createDataFrame([row], schema)
