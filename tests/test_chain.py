import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from ledgerflow.operators.chain import ChainOptions, TransformRegistry, run_chain
from ledgerflow.operators.grouping import Aggregation
from ledgerflow.operators.retry import MAX_DELAY_MS, RetryPolicy, map_rows_with_retry
from ledgerflow.operators.rows import filter_nulls
from ledgerflow.operators.steps import GroupByStep, LookupStep, SortByStep, apply_steps, parse_steps
from ledgerflow.plans.chains import run_chain_job
from ledgerflow.sinks.outcomes import write_outcomes
from ledgerflow.sinks.router import SinkSpec, write_sink
from ledgerflow.sources.router import SourceSpec, read_source


def test_specs_are_trimmed_ordered_and_may_repeat(spark):
    seen = []
    registry = TransformRegistry({})
    registry.register("a", lambda result, options: seen.append("a") or result)
    registry.register("b", lambda result, options: seen.append("b") or result)
    df = spark.range(2)
    run_chain(df, " b, a ,, b ", registry=registry)
    assert seen == ["b", "a", "b"]
    assert rows(run_chain(df, "  ", registry=registry).ok) == [(0,), (1,)]
    assert run_chain(df, None, registry=registry).dead.count() == 0


def test_unknown_and_duplicate_names(spark):
    registry = TransformRegistry()
    with pytest.raises(ValueError, match="enrich-from-api, filter-nulls, flatten-json, mask-pii"):
        registry.resolve("filter-nulls,nope")
    with pytest.raises(ValueError, match="already registered"):
        registry.register("mask-pii", lambda result, options: result)


def test_dead_letters_of_all_steps_add_up(spark):
    raw = ['{"id": 1, "name": "x"}', '{"id": null, "name": "y"}', "oops", '{"id": 3, "name": "z"}']
    df = spark.createDataFrame([(r,) for r in raw], "raw_json string")
    responses = spark.createDataFrame([("1", 200, '{"risk_score": 5}')], "id string, status int, body string")
    options = ChainOptions(
        pii_fields=("name",), responses=responses, response_key="id", enrichment_fields=("risk_score",),
        json_schema="id bigint, name string",
    )
    result = run_chain(df, "flatten-json,filter-nulls,mask-pii,enrich-from-api", options)
    ok = result.ok.collect()
    assert len(ok) == 1 and ok[0]["risk_score"] == "5" and len(ok[0]["name"]) == 64
    messages = sorted(r["errorMessage"] for r in result.dead.collect())
    assert messages == [
        "API returned HTTP (no response) for key=3", "Malformed JSON", "Row contains null field(s)"
    ]


def test_enrichment_needs_responses(spark):
    with pytest.raises(ValueError, match="responses"):
        run_chain(spark.range(1), "enrich-from-api")


def test_both_outputs_from_one_write(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None)], "id int, name string")
    ok, dead = write_outcomes(filter_nulls(df), str(tmp_path / "out"))
    assert rows(ok) == [(1, "a")]
    assert json.loads(dead.first()["payload"])["id"] == 2
    assert "outcome=ok" in str(list((tmp_path / "out").iterdir()))


def test_chain_job_writes_sink_and_dead_letters(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "a.json").write_text('{"id": 1}\n{"id": 2}\nbroken\n')
    run = run_chain_job(
        spark, SourceSpec("GCS", path=f"{source}/*.json"), "flatten-json", SinkSpec("GCS", path=str(tmp_path / "ok")),
        ChainOptions(json_schema="id int"), dead_letter_path=str(tmp_path / "dead"),
    )
    assert run.counts["rows_in"] == 3 and run.counts["dlq_total"] == 1
    assert rows(spark.read.schema("id int").json(str(tmp_path / "ok"))) == [(1,), (2,)]
    dead = spark.read.json(str(tmp_path / "dead"))
    assert set(dead.columns) == {"payload", "errorMessage", "errorClass", "attemptCount", "failedAtUtc"}
    assert dead.first()["payload"] == "broken"


def test_chain_job_without_dead_letter_path_drops_them(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "a.json").write_text('{"id": 1}\nbroken\n')
    run_chain_job(
        spark, SourceSpec("GCS", path=str(source)), "flatten-json", SinkSpec("GCS", path=str(tmp_path / "ok")),
        ChainOptions(json_schema="id int"),
    )
    assert rows(spark.read.schema("id int").json(str(tmp_path / "ok"))) == [(1,)]


def test_source_and_sink_dispatch_errors(spark):
    with pytest.raises(ValueError, match="not supported in chain mode"):
        read_source(spark, SourceSpec("FILE", path="/x"))
    with pytest.raises(ValueError, match="not supported in load mode"):
        read_source(spark, SourceSpec("PUBSUB"), mode="load")
    with pytest.raises(ValueError, match="unknown sink"):
        write_sink(spark.range(1), SinkSpec("API"))
    with pytest.raises(ValueError, match="source path"):
        read_source(spark, SourceSpec("GCS", path=" "))
    with pytest.raises(ValueError, match="query or table"):
        read_source(spark, SourceSpec("BQ"))


def test_steps_from_json():
    steps = parse_steps(
        '[{"type": "LOOKUP", "lookupBqTableRef": "p:d.t", "lookupKeyField": "k", "dataKeyField": "j"},'
        ' {"type": "NOPE"}, {"type": "sort_by", "sortByFields": ["a"]},'
        ' {"type": "GROUP_BY", "groupByFields": ["g"], "aggregations": [{"field": "v", "function": "SUM", "outputField": "s"}]}]'
    )
    assert steps == [
        LookupStep("p:d.t", "k", "j"), SortByStep(("a",)), GroupByStep(("g",), (Aggregation("v", "SUM", "s"),))
    ]
    for text in (None, " ", "{bad", '{"type": "SORT_BY"}', "[1]"):
        assert parse_steps(text) == []


def test_steps_run_left_to_right(spark):
    df = spark.createDataFrame([("u", 2), ("e", 3), ("u", 5)], "ccy string, amount int")
    lookup = spark.createDataFrame([("u", "2"), ("e", "1")], "code string, rate string")
    steps = [
        LookupStep("rates", "code", "ccy", ("rate",)),
        GroupByStep(("ccy", "rate"), (Aggregation("amount", "SUM", "total"),)),
        SortByStep(("ccy",), descending=True),
    ]
    got = apply_steps(df, steps, {"rates": lookup}.get)
    assert rows(got) == [("e", "1", 3.0), ("u", "2", 7.0)]
    assert apply_steps(df, []) is df


def test_retry_counts_tries_and_keeps_types(spark):
    df = spark.range(6).select("id", F.when(F.col("id") < 3, F.col("id")).alias("maybe"))

    def fn(row):
        if row["id"] == 4:
            raise RuntimeError()
        return {"id": row["id"], "maybe": row["maybe"]}

    policy = RetryPolicy(max_retries=2, delay_ms=1, exponential=True)
    result = map_rows_with_retry(df, fn, "id bigint, maybe bigint", policy)
    assert rows(result.ok) == [(0, 0), (1, 1), (2, 2), (3, None), (5, None)]
    dead = result.dead.first()
    assert (dead["errorMessage"], dead["errorClass"], dead["attemptCount"]) == ("(no message)", "builtins.RuntimeError", 3)
    assert json.loads(dead["payload"]) == {"id": 4, "maybe": None}


def test_retry_delays():
    fixed = RetryPolicy(3, 500, exponential=False)
    assert [fixed.wait_ms(n) for n in (1, 2, 3)] == [MAX_DELAY_MS] * 3
    doubling = RetryPolicy(3, 50)
    for attempt, base in ((1, 50), (2, 100), (3, 200), (4, 200)):
        assert base <= doubling.wait_ms(attempt) <= base * 1.1
    assert [fixed.should_retry(n) for n in (3, 4)] == [True, False]
