import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from ledgerflow.operators.enrich import enrich_from_responses
from ledgerflow.operators.lookup import (
    DuplicateLookupKeyError,
    assert_unique_key,
    first_by,
    lookup_enrich,
)


def test_keys_compare_by_text(spark):
    data = spark.createDataFrame([(1, 10), (2, None), (3, 99)], "id int, k int")
    lookup = spark.createDataFrame([("10", "ten"), (None, "blank")], "key string, label string")
    got = lookup_enrich(data, lookup, "key", "k", ["label"])
    assert rows(got) == [(1, 10, "ten"), (2, None, None), (3, 99, None)]


def test_null_lookup_key_is_the_empty_string(spark):
    data = spark.createDataFrame([("",), (None,)], "k string")
    lookup = spark.createDataFrame([(None, "blank")], "key string, label string")
    assert rows(lookup_enrich(data, lookup, "key", "k", ["label"])) == [("", "blank"), (None, None)]


def test_all_fields_collisions_and_absent_fields(spark):
    data = spark.createDataFrame([(1, "mine")], "id int, name string")
    lookup = spark.createDataFrame([(1, "theirs", 2.5)], "id int, name string, rate double")
    every = lookup_enrich(data, lookup, "id", "id")
    assert every.columns == ["id", "name", "lookup_id", "lookup_name", "rate"]
    assert every.first() == (1, "mine", "1", "theirs", "2.5")
    some = lookup_enrich(data, lookup, "id", "id", ["rate", "gone"])
    assert some.columns == ["id", "name", "rate"]


def test_duplicate_keys_are_an_error_or_reduced(spark):
    lookup = spark.createDataFrame([(1, "b", 2), (1, "a", 1), (2, "c", 1)], "k int, v string, ord int")
    data = spark.createDataFrame([(1,), (2,)], "id int")
    with pytest.raises(DuplicateLookupKeyError):
        lookup_enrich(data, lookup, "k", "id", ["v"])
    single = first_by(lookup, "k", "ord")
    assert rows(lookup_enrich(data, single, "k", "id", ["v"])) == [(1, "a"), (2, "c")]
    blanks = spark.createDataFrame([(None,), ("",)], "k string")
    with pytest.raises(DuplicateLookupKeyError):
        assert_unique_key(blanks, "k")


def test_missing_key_column_and_double_collision_are_errors(spark):
    data = spark.createDataFrame([(1, "x")], "id int, lookup_id string")
    lookup = spark.createDataFrame([(1,)], "id int")
    with pytest.raises(ValueError, match="key column"):
        lookup_enrich(data, lookup, "gone", "id")
    with pytest.raises(ValueError, match="collide"):
        lookup_enrich(data, lookup, "id", "id")


def test_native_keys_are_not_formatted(spark):
    data, lookup = spark.range(5), spark.range(5).withColumnRenamed("id", "k")
    plan = lookup_enrich(data, lookup, "k", "id", ["k"])._jdf.queryExecution().optimizedPlan().toString()
    join = next(line for line in plan.splitlines() if "Join" in line)
    assert "string" not in join


def test_hot_key_is_split_when_the_lookup_is_large(spark):
    """A key with most of the rows: adaptive execution splits its partition on the data side."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8KB",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        data = spark.range(0, 60_000, 1, 8).select("id", F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id")).alias("k"))
        lookup = spark.range(0, 60_000).select(F.col("id").alias("key"), (F.col("id") * 2).alias("v"))
        got = lookup_enrich(data, lookup, "key", "k", ["v"], unique="trust")
        counts = got.groupBy(F.col("v").isNull().alias("missed")).count()
        assert rows(counts) == [(False, 60_000)]
        hot = got.where("k = 7").select(F.count(F.lit(1)), F.min("v"), F.max("v")).first()
        assert hot == (40_000, "14", "14")
        got.collect()
        assert "skew=true" in got._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_random_frames_agree_with_the_written_rule(spark):
    chance = random.Random(5)
    keys = [None, "", "1", "2", "3", "a|b"]
    data = [(i, chance.choice(keys)) for i in range(200)]
    lookup = [(k, f"v{k}") for k in chance.sample(keys[1:], 3)]
    by_key = {("" if k is None else k): v for k, v in lookup}
    expected = sorted(((i, k, None if k is None else by_key.get(k)) for i, k in data), key=repr)
    got = lookup_enrich(
        spark.createDataFrame(data, "id int, k string"), spark.createDataFrame(lookup, "key string, v string"), "key", "k", ["v"]
    )
    assert rows(got) == expected


def test_enrich_outcomes(spark):
    data = spark.createDataFrame([(1, "a"), (2, None), (3, "b"), (4, "zz")], "id int, k string")
    responses = spark.createDataFrame(
        [("a", 200, '{"customer_tier": "gold", "risk_score": 3, "customer_region": {"x": 1}}'), ("b", 404, "{}")],
        "id string, status int, body string",
    )
    result = enrich_from_responses(data, responses, "k")
    assert result.ok.columns == ["id", "k", "customer_tier", "customer_region", "risk_score"]
    assert rows(result.ok) == [(1, "a", "gold", None, "3")]
    dead = {r["errorMessage"]: (r["errorClass"], r["attemptCount"]) for r in result.dead.collect()}
    assert dead == {
        "Lookup field 'k' is null — cannot enrich": ("java.lang.IllegalArgumentException", 0),
        "API returned HTTP 404 for key=b": ("java.io.IOException", 1),
        "API returned HTTP (no response) for key=zz": ("java.io.IOException", 1),
    }
