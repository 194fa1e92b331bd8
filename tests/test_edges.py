"""Edges at which rows or text could be lost or changed without an error."""

import hashlib
from datetime import date, datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from ledgerflow.functions.business_days import effective_date
from ledgerflow.functions.sql_forms import to_spark_sql
from ledgerflow.operators.chain import ChainOptions, run_chain
from ledgerflow.operators.grouping import Aggregation, group_by
from ledgerflow.operators.retry import RetryPolicy, map_rows_with_retry
from ledgerflow.operators.rows import flatten_json, infer_json_schema, mask_pii
from ledgerflow.plans.ledger import LEDGER_SCHEMA, assign_run_ids, latest_completed, latest_run, ledger_current
from ledgerflow.plans.records import run_rows, run_totals, to_records
from ledgerflow.sinks.files import export_report
from ledgerflow.sources.csv import read_csv_source
from ledgerflow.sources.pages import trim_pages

AT = datetime(2024, 1, 31)


def records(spark, texts):
    frame = spark.createDataFrame([(t,) for t in texts], "RowDaJsonTx string")
    return frame.select(F.lit(1).cast("bigint").alias("DaId"), "RowDaJsonTx")


def test_unreadable_values_keep_their_record(spark):
    stored = records(spark, ['{"id": 1, "amount": 2.5}', '{"id": 2, "amount": "n/a"}', "not json", '{"id": "x"}'])
    found = run_rows(stored, 1, "id bigint, amount double", keep_json=False)
    assert rows(found) == sorted([(1, 2.5), (2, None), (None, None), (None, None)], key=repr)


def test_only_plain_numbers_are_summed(spark):
    stored = records(spark, ['{"a": 1.5}', '{"a": "2"}', '{"a": "1.5d"}', '{"a": "0x10"}', '{"a": " -.5e1 "}', '{"a": "NaN"}'])
    total = run_totals(stored, ["a"]).first()
    assert (total["row_count"], total["sums"]["a"], total["bad"]["a"]) == (6, -1.5, 3)


def test_long_numbers_stay_exact(spark):
    df = spark.createDataFrame([('{"id": 12345678901234567890, "x": 1.5}',)], "raw_json string")
    kinds = {f.name: f.dataType.simpleString() for f in infer_json_schema(df).fields}
    assert kinds == {"id": "decimal(38,0)", "x": "double"}


def test_fields_named_like_kept_columns(spark):
    df = spark.createDataFrame([('{"Source": "inner", "v": 1}', "outer")], "raw_json string, source string")
    found = flatten_json(df, "Source string, v int").ok
    assert found.columns == ["source", "json_Source", "v"] and rows(found) == [("outer", "inner", 1)]


def test_csv_text_survives_the_round_trip(spark, tmp_path):
    texts = [" a ", 'say "hi", ok', 'two\nlines "q"', "\\", '\\"', "é,;|", '"', "x\\,y", "\ttab\t", "0"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string").selectExpr("cast(id AS string) id", "text")
    export_report(df, str(tmp_path / "out"), "CSV")
    assert rows(read_csv_source(spark, str(tmp_path / "out"))) == rows(df)


def test_csv_files_with_other_headers_fail(spark, tmp_path):
    (tmp_path / "1.csv").write_text("a,b\n1,2\n")
    (tmp_path / "2.csv").write_text("b,a\n3,4\n")
    with pytest.raises(Exception, match="CSV header does not conform|HEADER"):
        read_csv_source(spark, str(tmp_path)).collect()


def test_failed_rows_are_not_counted_as_hashed(spark):
    df = spark.createDataFrame([("a@x.de", "u"), ("b@x.de", None)], "email string, other string")
    result, observation = run_chain(df, "filter-nulls,mask-pii", ChainOptions(pii_fields=("email",))).observed()
    result.tagged.collect()
    assert observation.get["pii_fields_hashed"] == 1


def test_results_of_the_wrong_type_are_dead_letters(spark):
    df = spark.createDataFrame([(1,), (2,)], "id int")
    result = map_rows_with_retry(
        df, lambda row: {"id": row["id"], "v": "text" if row["id"] == 2 else 1.0}, "id int, v double", RetryPolicy(1, 0)
    )
    assert rows(result.ok) == [(1, 1.0)]
    letter = result.dead.first()
    assert '"id": 2' in letter["payload"] and letter["attemptCount"] == 2 and letter["errorMessage"].startswith("v:")


def test_null_sources_get_run_ids(spark):
    runs = spark.createDataFrame([(None, "p"), ("s", None), (None, "p"), ("s", "p")], "SrceNm string, PerId string")
    found = assign_run_ids(runs, spark.createDataFrame([], LEDGER_SCHEMA))
    assert sorted(r["DaId"] for r in found.collect()) == [1, 2, 3, 4]
    assert sorted(r["VsnNo"] for r in found.where("SrceNm IS NULL").collect()) == [1, 2]


def test_pages_of_a_null_source_stop_too(spark):
    pages = spark.createDataFrame(
        [(None, 1, "[1]"), (None, 2, "[]"), (None, 3, "[1]"), ("s", 1, "[1]")], "source string, page int, body string"
    )
    assert trim_pages(pages, "PAGE_NUMBER").count() == 2


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_timestamps_have_one_text_in_every_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", zone)
        df = spark.sql("SELECT timestamp_seconds(1704067200) AS at UNION ALL SELECT timestamp_millis(-1500)")
        found = group_by(df, ["at"], [Aggregation("*", "COUNT", "n")])
        assert rows(found) == [("1969-12-31T23:59:58.500Z", 1), ("2024-01-01T00:00:00.000Z", 1)]
        masked = rows(mask_pii(df, ("at",)).ok)
        assert masked == sorted((hashlib.sha256(k.encode()).hexdigest(),) for k, _ in rows(found))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_type_names_are_renamed_in_casts_only():
    text = "SELECT bytes, numeric AS bool, CAST(f(a, '(') AS INT64), SAFE_CAST(x AS Float64) FROM t -- CAST(a AS BYTES)"
    assert to_spark_sql(text) == (
        "SELECT bytes, numeric AS bool, CAST(f(a, '(') AS BIGINT), TRY_CAST(x AS DOUBLE) FROM t -- CAST(a AS BYTES)"
    )
    assert to_spark_sql("SELECT (SELECT a AS numeric), CAST(CAST(a AS INT64) AS NUMERIC)") == (
        "SELECT (SELECT a AS numeric), CAST(CAST(a AS BIGINT) AS DECIMAL(38,9))"
    )


def test_long_closures_widen_the_calendar(spark):
    holidays = spark.sql("SELECT explode(sequence(DATE '2024-01-01', DATE '2024-12-31')) AS holiday")
    assert effective_date(spark, date(2024, 12, 31), 1, holidays) == date(2023, 12, 29)


def test_records_of_a_load_hold_every_row(spark):
    df = spark.createDataFrame([(1, None), (None, "x")], "a int, b string")
    assert run_rows(to_records(df, 7, AT), 7, "a int, b string").count() == 2


def test_latest_rows_need_no_sorted_aggregation(spark):
    at = lambda n: datetime(2024, 1, n)
    rows_ = [
        (1, "a", 1, "p", "f", None, "LOADING", at(1), at(1)), (1, "a", 1, "p", "f", "s", "COMPLETED", at(1), at(1)),
        (2, "a", 2, "p", "f", None, "LOADING", at(2), at(2)), (2, "a", 2, "p", "f", "", "FAILED", at(2), at(3)),
        (3, None, 1, "p", "f", None, "LOADING", at(2), at(2)), (3, None, 1, "p", "f", None, "LOADING", at(2), at(2)),
        (4, "a", 3, "p", "f", "", "COMPLETED", at(2), at(1)), (5, "b", 1, None, "f", "", "COMPLETED", at(2), None),
    ]
    current = ledger_current(spark.createDataFrame([(*r, None) for r in rows_], LEDGER_SCHEMA))
    assert sorted((r["DaId"], r["StaCd"]) for r in current.collect()) == [
        (1, "COMPLETED"), (2, "FAILED"), (3, "LOADING"), (4, "COMPLETED"), (5, "COMPLETED")
    ]
    assert sorted(r["DaId"] for r in latest_run(current).collect()) == [2, 3, 5]
    done = {(r["SrceNm"], r["PerId"]): r["DaId"] for r in latest_completed(current).collect()}
    assert done == {("a", "p"): 4, ("b", None): 5}
    for frame in (current, latest_run(current), latest_completed(current)):
        assert "SortAggregate" not in frame._jdf.queryExecution().executedPlan().toString()
