from pyspark.sql import functions as F

from ledgerflow.functions.scalars import parsed_double
from ledgerflow.operators.validation import (
    in_range,
    matches_pattern,
    one_of,
    require_fields,
    row_errors,
    schema_contains,
    validate_rows,
)


def errors_of(df, *rules):
    return [r[0] for r in df.select(row_errors(df, rules)).collect()]


def test_require_fields(spark):
    df = spark.createDataFrame([(1, None)], "a int, b string")
    assert errors_of(df, require_fields("a", "b", "c")) == [["null value for required field: b", "missing field: c"]]


def test_pattern_matches_the_whole_text(spark):
    df = spark.createDataFrame([("AB1",), ("AB12",), ("xAB1",), (None,), ("AB1\n",)], "a string")
    found = errors_of(df, matches_pattern("a", "AB[0-9]"))
    assert found[0] == []
    assert found[1] == ["field 'a' value 'AB12' does not match pattern AB[0-9]"]
    assert found[2] and found[4]
    assert found[3] == ["null value for field: a"]


def test_pattern_alternatives_stay_whole(spark):
    df = spark.createDataFrame([("a",), ("b",), ("ax",)], "a string")
    assert [bool(e) for e in errors_of(df, matches_pattern("a", "a|b"))] == [False, False, True]


def test_range_is_inclusive_and_nan_passes(spark):
    df = spark.createDataFrame([("1",), ("5",), ("5.1",), ("x",), ("NaN",), (None,), (" 3 ",)], "a string")
    found = errors_of(df, in_range("a", 1, 5))
    assert found[0] == found[1] == found[4] == found[6] == []
    assert found[2] == ["field 'a' value 5.1 is outside range [1.0, 5.0]"]
    assert found[3] == ["field 'a' is not numeric: x"]
    assert found[5] == ["null value for field: a"]


def test_range_on_numbers(spark):
    df = spark.createDataFrame([(0.5,), (float("nan"),), (9.0,), (None,)], "a double")
    found = errors_of(df, in_range("a", 1, 5))
    assert [len(e) for e in found] == [1, 0, 1, 1]
    assert found[0] == ["field 'a' value 0.5 is outside range [1.0, 5.0]"]


def test_one_of_is_case_sensitive_and_null_fails(spark):
    df = spark.createDataFrame([("A",), ("a",), (None,)], "a string")
    assert errors_of(df, one_of("a", ["A", "B"])) == [
        [],
        ["field 'a' value 'a' is not in allowed set: [A, B]"],
        ["field 'a' value 'null' is not in allowed set: [A, B]"],
    ]


def test_errors_are_joined_in_rule_order(spark):
    df = spark.createDataFrame([(None, "9")], "a string, b string")
    rules = [require_fields("a"), in_range("b", 0, 5), schema_contains("b", "z")]
    result = validate_rows(df, rules)
    assert result.ok.count() == 0
    assert result.dead.first()["errorMessage"] == (
        "null value for required field: a; field 'b' value 9.0 is outside range [0.0, 5.0]; missing field: z"
    )


def test_no_rules_accept_everything(spark):
    assert validate_rows(spark.range(2), []).ok.count() == 2


def test_range_test_on_numbers_reaches_the_scan(spark, sf_dir):
    parts = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", "p_size")
    plan = validate_rows(parts, [in_range("p_size", 1, 30)]).ok._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(p_size), GreaterThanOrEqual(p_size,1), LessThanOrEqual(p_size,30)]" in plan


def test_parsed_double_reads_what_the_load_reads(spark):
    texts = ["1", " 7 ", "1.5d", "0x1p3", "-Infinity", "NaN", "nan", "inf", "infinity", "", "abc", "1e400", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(parsed_double(F.col("t"))).collect()]
    assert got[:5] == [1.0, 7.0, 1.5, 8.0, float("-inf")]
    assert got[5] != got[5]
    assert got[6:11] == [None] * 5
    assert got[11] == float("inf") and got[12] is None
