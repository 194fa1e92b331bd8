import hashlib
import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from ledgerflow.operators.rows import (
    as_strings,
    check_headers,
    conform_schema,
    filter_nulls,
    flatten_json,
    flatten_strict,
    infer_json_schema,
    mask_pii,
)
from ledgerflow.result import ChainResult


def test_filter_nulls_splits_on_any_null(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (None, None)], "id int, name string")
    result = filter_nulls(df)
    assert rows(result.ok) == [(1, "a")]
    dead = result.dead.orderBy("payload").collect()
    assert [json.loads(r["payload"]) for r in dead] == [{"id": 2, "name": None}, {"id": None, "name": None}]
    assert {r["errorMessage"] for r in dead} == {"Row contains null field(s)"}
    assert {(r["errorClass"], r["attemptCount"]) for r in dead} == {("java.lang.IllegalArgumentException", 0)}
    assert all(r["failedAtUtc"].endswith("Z") for r in dead)


def test_filter_nulls_without_columns_keeps_rows(spark):
    assert filter_nulls(spark.range(3).select()).ok.count() == 3


def test_mask_pii_hashes_text_and_leaves_the_rest(spark):
    df = spark.createDataFrame([(7, "Zoë", None, "x")], "ssn int, name string, email string, Name2 string")
    masked = mask_pii(df, ["ssn", "name", "email", "NAME2", "absent"]).ok.first()
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert masked == (digest("7"), digest("Zoë"), None, "x")


def test_step_counters_are_observed(spark):
    df = spark.createDataFrame([("a", "e"), ("b", None), (None, "f")], "name string, email string")
    result, observation = mask_pii(filter_nulls(df), ["email"]).observed()
    assert result.ok.count() == 1
    result.tagged.write.format("noop").mode("overwrite").save()
    assert observation.get["rows_in"] == 3
    assert observation.get["rows_out"] == 1
    assert observation.get["dlq_total"] == 2
    assert observation.get["rows_dropped_null_field"] == 2


def test_failed_rows_keep_their_first_dead_letter(spark):
    df = spark.createDataFrame([(1, None)], "id int, name string")
    twice = filter_nulls(filter_nulls(df))
    assert twice.dead.count() == 1


def test_flatten_json_types_nested_and_malformed(spark):
    raw = ['{"a": 1, "b": {"c": "x"}, "extra": true}', '{"a": null}', "{bad", "[1]", "null"]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(raw)], "id int, raw_json string")
    result = flatten_json(df, "a bigint, b struct<c: string>")
    assert [tuple(r) for r in result.ok.orderBy("id").collect()] == [(0, 1, ("x",)), (1, None, None)]
    assert sorted(r["payload"] for r in result.dead.collect()) == sorted(raw[2:])


def test_infer_json_schema_widens_numbers_and_nulls(spark):
    raw = ['{"n": 1, "d": 1.5, "v": null, "t": true, "list": [{"u": 2}]}', '{"n": 3000000000, "s": "x"}']
    schema = infer_json_schema(spark.createDataFrame([(r,) for r in raw], "raw_json string"))
    kinds = {f.name: f.dataType.simpleString() for f in schema}
    assert kinds == {
        "n": "bigint", "d": "double", "v": "string", "t": "boolean", "s": "string", "list": "array<struct<u:bigint>>"
    }


def test_infer_json_schema_leaves_other_text_to_flattening(spark):
    raw = ['{"a": 1, "m": "x"}', "[1, 2]", "oops", ' {"a": 2, "m": 5}', None]
    result = flatten_json(spark.createDataFrame([(r,) for r in raw], "raw_json string"))
    assert rows(result.ok) == [(1, "x"), (2, "5")]
    assert sorted(str(r["payload"]) for r in result.dead.collect()) == ["None", "[1, 2]", "oops"]


def test_infer_json_schema_needs_objects(spark):
    with pytest.raises(ValueError):
        infer_json_schema(spark.createDataFrame([("[1]",)], "raw_json string"))


def test_flatten_strict_fails_on_bad_text(spark):
    good = spark.createDataFrame([('{"a": 1}',)], "raw_json string")
    assert rows(flatten_strict(good)) == [(1,)]
    bad = good.unionByName(spark.createDataFrame([("{oops",)], "raw_json string"))
    with pytest.raises(Exception, match="MALFORMED|malformed|JSON"):
        flatten_strict(bad, "a bigint").collect()


def test_conform_schema_types_and_absent_columns(spark):
    df = spark.createDataFrame([("5", "x", "2024-02-30", "true")], "i string, d string, day string, b string")
    out = conform_schema(df, {"i": "INT64", "d": "FLOAT64", "day": "DATE", "b": "BOOL", "gone": "NUMERIC"})
    assert out.dtypes == [("i", "bigint"), ("d", "double"), ("day", "date"), ("b", "boolean"), ("gone", "string")]
    assert out.first() == (5, None, None, True, None)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        conform_schema(df, {"d": "FLOAT64"}, strict=True).collect()


def test_as_strings_keeps_nulls(spark):
    df = spark.createDataFrame([(1, None)], "a int, b double")
    assert as_strings(df).first() == ("1", None)


def test_check_headers_lists_missing_in_order(spark):
    assert check_headers(spark.range(1).toDF("id"), ["z", "id", "a"]) == ["z", "a"]


def test_from_frames_joins_custom_outputs(spark):
    ok = spark.createDataFrame([(1,)], "id int")
    dead = filter_nulls(spark.createDataFrame([(None,)], "id int")).dead
    joined = ChainResult.from_frames(ok, dead)
    assert rows(joined.ok) == [(1,)] and joined.dead.count() == 1
    assert mask_pii(joined, ["id"]).ok.first()[0] == hashlib.sha256(b"1").hexdigest()


def test_tagged_frame_reads_its_source_once(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        "event_id", F.nullif("event_type", F.lit("error")).alias("event_type")
    )
    plan = filter_nulls(events).tagged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1


def test_distributions_are_observed(spark):
    from ledgerflow.metrics import counter, distribution, observed

    metrics = {"rows": counter(), "big": counter(F.col("id") > 1), **distribution("size", F.col("id"))}
    df, observation = observed(spark.range(4), "sizes", metrics)
    df.write.format("noop").mode("overwrite").save()
    assert observation.get == {"rows": 4, "big": 2, "size_count": 4, "size_min": 0, "size_max": 3, "size_mean": 1.5}
