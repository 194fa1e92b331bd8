import math
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from ledgerflow.operators.grouping import Aggregation, group_by
from ledgerflow.operators.numbering import number_rows
from ledgerflow.operators.side_inputs import in_list, map_value, with_constant
from ledgerflow.operators.sorting import sort_rows, top_rows


def aggs(*specs):
    return [Aggregation(*s) for s in specs]


def test_null_and_empty_keys_are_one_group(spark):
    df = spark.createDataFrame([(None, 1.0), ("", 2.0), ("a", 3.0)], "k string, v double")
    got = group_by(df, ["k"], aggs(("v", "SUM", "s"), ("*", "COUNT", "n")))
    assert rows(got) == [("", 3.0, 2), ("a", 3.0, 1)]


def test_pipes_and_null_first_keys_do_not_mix(spark):
    df = spark.createDataFrame([("a|b", "c"), ("a", "b|c"), (None, "x"), ("x", None)], "k string, j string")
    got = group_by(df, ["k", "j"], aggs(("*", "COUNT", "n")))
    assert rows(got) == [("", "x", 1), ("a", "b|c", 1), ("a|b", "c", 1), ("x", "", 1)]


def test_lenient_values(spark):
    df = spark.createDataFrame([(None,), ("abc",), (" 7 ",), ("1.5d",)], "v string").withColumn("k", F.lit(1))
    got = group_by(df, ["k"], aggs(("v", "SUM", "s"), ("v", "AVG", "a"), ("v", "MIN", "lo"), ("v", "MAX", "hi"), ("v", "COUNT", "n")))
    assert got.dtypes == [("k", "string"), ("s", "double"), ("a", "double"), ("lo", "double"), ("hi", "double"), ("n", "bigint")]
    assert got.first() == ("1", 8.5, 2.125, 0.0, 7.0, 4)


def test_booleans_and_dates_count_as_zero(spark):
    df = spark.sql("SELECT 1 AS k, true AS b, DATE '2024-01-01' AS d, 2 AS i, CAST(1.5 AS DECIMAL(5,2)) AS m")
    got = group_by(df, ["k"], aggs(("b", "SUM", "b"), ("d", "MAX", "d"), ("i", "SUM", "i"), ("m", "SUM", "m")))
    assert got.first() == ("1", 0.0, 0.0, 2.0, 1.5)


def test_nan_spreads_to_min_and_max(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", float("nan")), ("b", 2.0)], "k string, v double")
    got = {r[0]: (r[1], r[2]) for r in group_by(df, ["k"], aggs(("v", "MIN", "lo"), ("v", "MAX", "hi"))).collect()}
    assert all(math.isnan(x) for x in got["a"]) and got["b"] == (2.0, 2.0)


def test_unknown_functions(spark):
    df = spark.createDataFrame([("a", 1.0)], "k string, v double")
    assert rows(group_by(df, ["k"], aggs(("v", "sum", "x"), ("v", "MEDIAN", "y")))) == [("a", 0.0, 0.0)]
    with pytest.raises(ValueError, match="MEDIAN"):
        group_by(df, ["k"], aggs(("v", "MEDIAN", "y")), strict=True)


def test_no_keys_is_one_group_and_no_rows_is_none(spark):
    df = spark.createDataFrame([(1.0,), (2.0,)], "v double")
    assert rows(group_by(df, [], aggs(("v", "SUM", "s")))) == [(3.0,)]
    assert rows(group_by(df.where("v > 9"), [], aggs(("v", "SUM", "s")))) == []


def test_no_aggregations_lists_the_keys(spark):
    df = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    assert rows(group_by(df, ["k"], [])) == [("",), ("1",)]


def test_random_frames_agree_with_the_written_rule(spark):
    chance = random.Random(11)
    texts = [None, "", "1", "2.5", "x", " 4 ", "-3"]
    data = [(chance.choice(["a", "b", None, ""]), chance.choice([1, 2, None]), chance.choice(texts)) for _ in range(400)]

    def number(text):
        try:
            return float(text.strip())
        except (AttributeError, ValueError):
            return 0.0

    groups = {}
    for k, j, v in data:
        groups.setdefault((k or "", "" if j is None else str(j)), []).append(number(v))
    expected = sorted(
        ((k, j, sum(v), len(v), sum(v) / len(v), min(v), max(v)) for (k, j), v in groups.items()), key=repr
    )
    df = spark.createDataFrame(data, "k string, j int, v string").repartition(5)
    specs = aggs(("v", "SUM", "s"), ("v", "COUNT", "n"), ("v", "AVG", "a"), ("v", "MIN", "lo"), ("v", "MAX", "hi"))
    assert rows(group_by(df, ["k", "j"], specs)) == expected


def test_grouping_is_partial_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    plan = group_by(df, ["k"], aggs(("id", "SUM", "s")))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "partial_sum" in plan
    assert "hashpartitioning(k" in plan and "cast(k" not in plan.split("Exchange")[1]


def test_sort_compares_text(spark):
    df = spark.createDataFrame([("9", 1), ("10", 2), (None, 3)], "v string, id int").coalesce(1)
    assert [r["id"] for r in sort_rows(df, ["v"]).collect()] == [3, 2, 1]
    assert [r["id"] for r in sort_rows(df, ["v"], descending=True).collect()] == [1, 2, 3]
    assert [r["id"] for r in sort_rows(df, []).collect()] == [1, 2, 3]


def test_sort_scopes(spark):
    df = spark.range(0, 1000, 1, 4).select((F.lit(999) - F.col("id")).alias("v"))
    within = sort_rows(df, ["v"], scope="partition")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in within
    typed = [r["v"] for r in sort_rows(df, ["v"], scope="global", typed=True).collect()]
    assert typed == list(range(1000))
    two = spark.createDataFrame([("a", "1"), ("b", "2"), ("b", "3")], "x string, y string")
    assert [tuple(r) for r in sort_rows(two, ["x", "y"], True, "global").collect()] == [("b", "3"), ("b", "2"), ("a", "1")]
    with pytest.raises(ValueError):
        sort_rows(df, ["v"], scope="bundle")


def test_sorts_are_stable(spark):
    df = spark.range(0, 300, 1, 3).select("id", (F.col("id") % 2).cast("string").alias("k"))
    for descending, first in ((False, "0"), (True, "1")):
        got = [(r["k"], r["id"]) for r in sort_rows(df, ["k"], descending, "global").collect()]
        assert got == sorted(got, key=lambda t: (t[0] != first, t[1]))


def test_one_hot_value_sorts_in_several_tasks(spark):
    df = spark.range(0, 40_000, 1, 4).select(F.lit("same").alias("k"), "id")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        parts = sort_rows(df, ["k"], scope="global").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert len(parts) == 4 and max(r["count"] for r in parts) < 20_000


def test_top_rows_takes_ordered(spark):
    df = spark.range(100)
    top = top_rows(df, ["id"], 3)
    assert [r["id"] for r in top.collect()] == [99, 98, 97]
    assert "TakeOrderedAndProject" in top._jdf.queryExecution().executedPlan().toString()


def test_number_rows_over_partitions_and_equal_keys(spark):
    df = spark.range(0, 5000, 1, 7).select(F.col("id"), F.when(F.col("id") < 3000, 1).otherwise(F.col("id")).alias("k"))
    got = number_rows(df, [F.col("k"), F.col("id").desc()])
    numbers = sorted((r["row_no"], r["k"], -r["id"]) for r in got.collect())
    assert [n for n, _, _ in numbers] == list(range(1, 5001))
    assert [t[1:] for t in numbers] == sorted(t[1:] for t in numbers)


def test_side_values(spark):
    df = with_constant(spark.createDataFrame([("a",), ("z",)], "k string"), "run", 7)
    out = df.select("k", "run", in_list("k", ["a"]).alias("known"), map_value("k", {"a": 1}).alias("v"))
    assert rows(out) == [("a", 7, True, 1), ("z", 7, False, None)]
    assert df.where(in_list("k", [*map(str, range(20_000)), "z"])).count() == 1
