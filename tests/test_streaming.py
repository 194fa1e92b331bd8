import json

import pytest
from conftest import rows

from ledgerflow.operators.chain import ChainOptions
from ledgerflow.operators.steps import GroupByStep, LookupStep, SortByStep, apply_steps
from ledgerflow.plans.chains import run_chain_job
from ledgerflow.sinks.outcomes import read_outcomes
from ledgerflow.sinks.router import SinkSpec
from ledgerflow.sources.router import SourceSpec
from ledgerflow.sources.text import read_raw_stream, rows_as_raw_stream
from ledgerflow.streaming.chain import stream_chain, stream_outcomes

OPTIONS = ChainOptions(json_schema="id int, name string", pii_fields=("name",))


@pytest.fixture
def messages(tmp_path):
    folder = tmp_path / "messages"
    folder.mkdir()
    (folder / "1.txt").write_text('{"id": 1, "name": "é"}\n{"id": 2, "name": null}\nbroken\n')
    return folder


def test_outcomes_over_restarts(spark, tmp_path, messages):
    """New input is added exactly once when the stream is started again from its checkpoint."""

    def run():
        stream = read_raw_stream(spark, "text", str(messages))
        query, schema = stream_outcomes(
            stream, "flatten-json,filter-nulls,mask-pii", str(tmp_path / "out"), str(tmp_path / "state"), OPTIONS,
            available_now=True,
        )
        query.awaitTermination()
        return read_outcomes(spark, str(tmp_path / "out"), schema)

    ok, dead = run()
    assert [r["id"] for r in ok.collect()] == [1] and dead.count() == 2
    (messages / "2.txt").write_text('{"id": 3, "name": "x"}\n')
    ok, dead = run()
    assert sorted(r["id"] for r in ok.collect()) == [1, 3] and dead.count() == 2
    assert all(len(r["name"]) == 64 for r in ok.collect())


def test_file_sinks_per_batch(spark, tmp_path, messages):
    sink = SinkSpec("GCS", path=str(tmp_path / "ok"))
    stream = read_raw_stream(spark, "text", str(messages))
    stream_chain(
        stream, "flatten-json,filter-nulls", str(tmp_path / "state"), sink, str(tmp_path / "dead"), OPTIONS, available_now=True
    ).awaitTermination()
    assert rows(spark.read.schema("id int").json(str(tmp_path / "ok" / "batch_id=0"))) == [(1,)]
    messages_ = sorted(r["errorMessage"] for r in spark.read.json(str(tmp_path / "dead")).collect())
    assert messages_ == ["Malformed JSON", "Row contains null field(s)"]


def test_table_and_message_sinks(spark, tmp_path, messages):
    spark.sql("CREATE TABLE stream_t (name STRING, id INT) USING parquet")
    stream = read_raw_stream(spark, "text", str(messages))
    stream_chain(
        stream, "flatten-json,filter-nulls", str(tmp_path / "s1"), SinkSpec("BQ", table="stream_t"), None, OPTIONS,
        available_now=True,
    ).awaitTermination()
    assert rows(spark.table("stream_t")) == [("é", 1)]
    sink = SinkSpec("PUBSUB", message_format="text", options={"path": str(tmp_path / "sent")})
    stream_chain(
        stream, "flatten-json,filter-nulls", str(tmp_path / "s2"), sink, None, OPTIONS, available_now=True
    ).awaitTermination()
    sent = [json.loads(r[0]) for r in spark.read.text(str(tmp_path / "sent")).collect()]
    assert sent == [{"id": 1, "name": "é"}]


def test_chain_job_starts_a_query(spark, tmp_path, messages):
    source = SourceSpec("PUBSUB", path=str(messages), message_format="text")
    sink = SinkSpec("GCS", path=str(tmp_path / "ok"))
    with pytest.raises(ValueError, match="checkpoint"):
        run_chain_job(spark, source, "flatten-json", sink, OPTIONS)
    run = run_chain_job(spark, source, "flatten-json", sink, OPTIONS, checkpoint=str(tmp_path / "state"))
    try:
        run.query.processAllAvailable()
        assert sorted(r["id"] for r in spark.read.json(f"{tmp_path}/ok").collect()) == [1, 2]
    finally:
        run.query.stop()


def test_streams_take_lookups_but_no_grouping_or_sorting(spark, tmp_path, messages):
    stream = spark.readStream.schema("id int, name string").json(str(messages))
    names = spark.createDataFrame([("1", "one")], "k string, label string")
    looked_up = apply_steps(stream, [LookupStep("names", "k", "id", ("label",))], {"names": names}.get)
    state = str(tmp_path / "state")
    query = (
        looked_up.writeStream.format("parquet").option("checkpointLocation", state).trigger(availableNow=True)
        .start(str(tmp_path / "out"))
    )
    query.awaitTermination()
    found = {(r["id"], r["label"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert {(1, "one"), (2, None)} <= found
    for step in (GroupByStep(("id",), ()), SortByStep(("id",))):
        with pytest.raises(ValueError, match="cannot run on a stream"):
            apply_steps(stream, [step])


def test_streaming_metrics_are_in_the_progress(spark, tmp_path, messages):
    from ledgerflow.operators.chain import run_chain

    stream = read_raw_stream(spark, "text", str(messages))
    result, observation = run_chain(stream, "flatten-json,filter-nulls", OPTIONS).observed("numbers")
    assert observation is None
    query = (
        result.ok.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    metrics = next(p.observedMetrics["numbers"] for p in query.recentProgress if "numbers" in p.observedMetrics)
    assert (metrics["rows_in"], metrics["rows_out"], metrics["dlq_total"]) == (3, 1, 2)


def test_raw_stream_forms(spark, messages):
    stream = spark.readStream.schema("id int").json(str(messages))
    assert rows_as_raw_stream(stream).columns == ["raw_json"]
