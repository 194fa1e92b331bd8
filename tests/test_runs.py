import json
from datetime import date, datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from ledgerflow.functions.business_days import (
    business_calendar,
    business_days_in_range,
    count_business_days,
    count_weekdays,
    effective_date,
    shift_business_days,
    shift_weekdays,
)
from ledgerflow.functions.dates import decode_period, fiscal_year_label, week_start
from ledgerflow.functions.tokens import resolve_run_date
from ledgerflow.plans.control import ControlRule, RunFacts, Validation, control_check, expectations
from ledgerflow.plans.ledger import (
    LEDGER_SCHEMA,
    Ledger,
    assign_run_ids,
    latest_completed,
    latest_run,
    ledger_current,
    missing_sources,
    pending_sources,
)
from ledgerflow.plans.params import MissingParametersError, fetch_parameters, missing_parameters
from ledgerflow.plans.periods import UnknownPeriodError, find_period, with_period
from ledgerflow.plans.records import read_records, run_rows, run_totals, to_records, write_records

AT = datetime(2024, 1, 31, 9, 0, 0)


def records(spark, *docs, run=1):
    data = [(str(i), run, d, AT.date(), AT) for i, d in enumerate(docs)]
    return spark.createDataFrame(data, "RecId string, DaId bigint, RowDaJsonTx string, LoadDt date, LstUpdtTs timestamp")


def checked(spark, docs, validation, facts=RunFacts()):
    fields = [r.field for r in validation.rules]
    totals = run_totals(records(spark, *docs), fields)
    row = control_check(expectations(spark, {1: (validation, facts)}), totals).first()
    return row["StaCd"], json.loads(row["BalAndCntlSmryTx"])


def test_record_store_by_run(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", None), (2, "b", 2.5)], "id int, s string, v double")
    for run in (1, 2):
        write_records(to_records(df, run, AT), str(tmp_path / "rec"))
    stored = read_records(spark, str(tmp_path / "rec"))
    assert stored.count() == 4 and stored.select("RecId").distinct().count() == 4
    assert json.loads(stored.where("DaId = 1").orderBy("RowDaJsonTx").first()["RowDaJsonTx"]) == {"id": 1, "s": "a", "v": None}
    assert stored.select("LoadDt").distinct().first()[0] == date(2024, 1, 31)
    plan = stored.where("DaId = 2")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(DaId" in plan
    found = run_rows(stored, 2)
    assert set(found.columns) == {"id", "s", "v", "RowDaJsonTx"} and found.count() == 2


def test_totals_read_scalars_only(spark):
    docs = ['{"v": 1.5}', '{"v": "2"}', '{"v": null}', "{}", '{"v": {"x": 1}}', '{"v": [1]}', "oops"]
    row = run_totals(records(spark, *docs), ["v", "gone", "a.b"]).first()
    assert (row["row_count"], row["sums"]["v"], row["bad"]["v"]) == (7, 3.5, 0)
    assert row["sums"]["gone"] == 0.0
    bad = run_totals(records(spark, '{"v": "abc"}', '{"v": 1}', '{"v": "{x"}'), ["v"]).first()
    assert bad["bad"]["v"] == 2
    nested = run_totals(records(spark, '{"a": {"b": 4}}'), ["a.b"]).first()
    assert nested["sums"]["a.b"] == 4.0


def test_row_bounds(spark):
    docs = ["{}"] * 3
    assert checked(spark, docs, Validation())[0] == "COMPLETED"
    assert checked(spark, docs, Validation(min_rows=3, max_rows=3))[0] == "COMPLETED"
    status, summary = checked(spark, docs, Validation(min_rows=4))
    assert status == "FAILED_BNC" and summary["failures"] == ["row_count 3 < min 4"]
    status, summary = checked(spark, docs, Validation(max_rows=0))
    assert status == "FAILED_BNC" and summary["failures"] == ["row_count 3 > max 0"]


def test_control_totals(spark):
    docs = ['{"v": 90}', '{"v": 10}']
    ok = [ControlRule("v", 100.0), ControlRule("v", 101.0, 0.01), ControlRule("v", -100.0, 2.0)]
    for rule in ok:
        assert checked(spark, docs, Validation(rules=(rule,)))[0] == "COMPLETED"
    status, summary = checked(spark, docs, Validation(rules=(ControlRule("v", 102.0),)))
    assert status == "FAILED_BNC"
    assert summary == {
        "srcCount": 2, "dstCount": 2, "srcAmount_v": 102.0, "dstAmount_v": 100.0, "status": "Not Matched",
        "failures": ["BnC SUM(v) actual=100.0 expected=102.0 ±1.0%"],
    }


def test_expected_zero_needs_exactly_zero(spark):
    rule = Validation(rules=(ControlRule("v", 0.0, 0.5),))
    assert checked(spark, ['{"v": 0}'], rule)[0] == "COMPLETED"
    assert checked(spark, ['{"v": 0.01}'], rule)[0] == "FAILED_BNC"


def test_unreadable_numbers_are_infrastructure_failures(spark):
    rules = Validation(min_rows=5, rules=(ControlRule("v", 1.0), ControlRule("w", 2.0)))
    status, summary = checked(spark, ['{"v": "abc", "w": 2}'], rules)
    assert status == "FAILED"
    assert "srcAmount_v" not in summary and summary["dstAmount_w"] == 2.0
    assert summary["failures"][0] == "row_count 1 < min 5"
    assert "infrastructure error" in summary["failures"][1]
    assert checked(spark, ['{"v": "NaN"}'], Validation(rules=(ControlRule("v", 1.0),)))[0] == "FAILED"


def test_empty_run_and_source_facts(spark):
    expected = expectations(spark, {9: (Validation(min_rows=1), RunFacts())})
    row = control_check(expected, run_totals(records(spark), [])).first()
    assert (row["DaId"], row["StaCd"]) == (9, "FAILED_BNC")
    status, summary = checked(spark, ["{}"], Validation(), RunFacts(source_rows=2, missing_headers=("a",)))
    assert status == "FAILED_BNC" and summary["srcCount"] == 2
    assert summary["failures"] == ["row_count 1 != source 2", "missing headers: a"]


def ledger(spark, *entries):
    data = [(i, s, v, p, "", None, c, AT, datetime(2024, 2, t), None) for i, s, v, p, c, t in entries]
    return spark.createDataFrame(data, LEDGER_SCHEMA)


def test_newer_failures_do_not_hide_completed_runs(spark):
    led = ledger(
        spark, (1, "a", 1, "p", "COMPLETED", 1), (2, "a", 2, "p", "COMPLETED", 2), (3, "a", 3, "p", "FAILED", 3),
        (4, "b", 1, "p", "FAILED", 1),
    )
    assert rows(latest_completed(led)) == [("a", "p", 2)]
    assert sorted((r["SrceNm"], r["DaId"]) for r in latest_run(led).collect()) == [("a", 3), ("b", 4)]


def test_current_state_is_the_last_event(spark):
    events = ledger(spark, (1, "a", 1, "p", "LOADING", 1), (1, "a", 1, "p", "COMPLETED", 1), (2, "b", 1, "p", "LOADING", 1))
    assert sorted((r["DaId"], r["StaCd"]) for r in ledger_current(events).collect()) == [(1, "COMPLETED"), (2, "LOADING")]


def test_run_ids_follow_the_ledger(spark):
    led = ledger(spark, (7, "a", 4, "p", "COMPLETED", 1))
    new = spark.createDataFrame([("a", "p", 1), ("a", "p", 2), ("b", "p", 1)], "SrceNm string, PerId string, seq int")
    got = assign_run_ids(new, led, ["seq"])
    assert sorted(rows(got)) == [(8, "a", "p", 1, 5), (9, "a", "p", 2, 6), (10, "b", "p", 1, 1)]
    first = assign_run_ids(new.where("seq = 1"), spark.createDataFrame([], LEDGER_SCHEMA))
    assert sorted(r["DaId"] for r in first.collect()) == [1, 2]


def test_missing_and_pending_sources(spark):
    led = ledger(spark, (1, "a", 1, "p", "COMPLETED", 1), (2, "b", 1, "p", "FAILED", 1))
    want = spark.createDataFrame([("a", "p"), ("b", "p"), ("a", "q")], "SrceNm string, PerId string")
    assert rows(missing_sources(want, led)) == [("a", "q"), ("b", "p")]
    assert rows(pending_sources(want, led)) == [("a", "q"), ("b", "p")]
    assert pending_sources(want, led, override=True).count() == 3
    with_sub = led.withColumn("SubNm", F.lit("eod"))
    subs = spark.createDataFrame([("a", "p", "eod"), ("a", "p", "mid")], "SrceNm string, PerId string, SubNm string")
    assert rows(missing_sources(subs, with_sub)) == [("a", "p", "mid")]


def test_stored_ledger_lifecycle(spark, tmp_path):
    book = Ledger(spark, str(tmp_path / "ledger"))
    assert book.current().count() == 0
    ids = book.open_runs([("a", "p", "f"), ("b", "p", None)], AT)
    assert ids == [1, 2]
    book.close_run(1, "COMPLETED", datetime(2024, 2, 1))
    state = {r["DaId"]: (r["StaCd"], r["BalAndCntlSmryTx"], r["FlNm"], r["VsnNo"]) for r in book.current().collect()}
    assert state == {1: ("COMPLETED", "", "f", 1), 2: ("LOADING", None, "", 1)}
    assert book.open_runs([("a", "p", "f")], datetime(2024, 2, 2)) == [3]
    assert book.current().where("DaId = 3").first()["VsnNo"] == 2
    assert book.open_runs([("a", "p", None), ("a", "p", None)], datetime(2024, 2, 3)) == [4, 5]
    assert sorted(r["VsnNo"] for r in book.current().where("DaId > 3").collect()) == [3, 4]


def store(spark, schema, values):
    return spark.createDataFrame(
        [("g", "d", "n", schema, values)],
        "ParameterGroupName string, ParameterDataSource string, ParameterName string, SchemaOfJson string, ParametersValJson string",
    )


def test_required_parameters(spark):
    schema = '{"a": {"required": true}, "b": {"required": "true"}, "c": {"required": false}, "d": {}, "e": {"required": 1}}'
    missing = missing_parameters(store(spark, schema, '{"a": null, "c": null, "e": 5}'))
    assert rows(missing.select("missing")) == [(["a", "b"],)]
    full = store(spark, schema, '{"a": 1, "b": "x", "e": "y"}')
    assert missing_parameters(full).count() == 0
    assert fetch_parameters(full, "g", "d", "n") == {"a": "1", "b": "x", "e": "y"}
    with pytest.raises(MissingParametersError, match=r"\['b'\]"):
        fetch_parameters(store(spark, schema, '{"a": 1, "e": 2}'), "g", "d", "n")
    with pytest.raises(MissingParametersError, match="no parameter row"):
        fetch_parameters(full, "g", "d", "other")
    for odd in (None, " ", "[1]", "{bad"):
        assert missing_parameters(store(spark, odd, odd)).count() == 0


def test_periods(spark):
    ids = ["203012", "20301112", "2030111201", "2030", "20301x", "20301399", None]
    df = spark.createDataFrame([(i,) for i in ids], "PerId string")
    got = [tuple(r["p"]) for r in df.select(decode_period(F.col("PerId")).alias("p")).collect()]
    assert got[:3] == [
        ("MONTHLY", date(2030, 12, 31), 12, None), ("DAILY", date(2030, 11, 12), 11, None),
        ("QUARTERLY", date(2030, 11, 12), 11, 1),
    ]
    assert got[3] == got[4] == (None, None, None, None) and got[5][1] is None
    master = spark.createDataFrame(
        [("202401", date(2024, 1, 31), 1, "23-24", "MONTHLY")],
        "PerId string, PerDt date, MoNo bigint, YrNo string, PerTypeCd string",
    )
    known = spark.createDataFrame([("202401", 5)], "PerId string, v int")
    assert rows(with_period(known, master)) == [("202401", 5, date(2024, 1, 31), 1, "23-24", "MONTHLY")]
    assert find_period(master, "202401")["YrNo"] == "23-24"
    unknown = spark.createDataFrame([("209901", 1)], "PerId string, v int")
    assert with_period(unknown, master, strict=False).count() == 0
    with pytest.raises(Exception, match="209901"):
        with_period(unknown, master).collect()
    with pytest.raises(UnknownPeriodError):
        find_period(master, "209901")
    label = spark.range(1).select(fiscal_year_label(F.lit(date(2025, 4, 1)))).first()[0]
    assert label == "25-26"


FRIDAY, SATURDAY, MONDAY = date(2024, 1, 5), date(2024, 1, 6), date(2024, 1, 8)


@pytest.mark.parametrize(
    "day, offset, expected",
    [
        (FRIDAY, 1, MONDAY), (SATURDAY, -1, FRIDAY), (SATURDAY, 0, FRIDAY), (FRIDAY, 0, FRIDAY), (FRIDAY, -1, date(2024, 1, 4)),
        (SATURDAY, 1, MONDAY), (MONDAY, -1, FRIDAY), (FRIDAY, 10, date(2024, 1, 19)), (date(1969, 12, 27), 1, date(1969, 12, 29)),
    ],
)
def test_weekday_moves(spark, day, offset, expected):
    assert spark.range(1).select(shift_weekdays(F.lit(day), offset)).first()[0] == expected


def test_weekday_counts(spark):
    count = lambda a, b: spark.range(1).select(count_weekdays(F.lit(a), F.lit(b))).first()[0]
    assert count(FRIDAY, FRIDAY) == 0
    assert count(FRIDAY, MONDAY) == 1
    assert count(date(2024, 1, 1), date(2024, 1, 8)) == 5
    assert count(MONDAY, FRIDAY) == 0


def test_holiday_calendar(spark):
    holidays = spark.createDataFrame([(MONDAY,), (SATURDAY,)], "holiday date")
    calendar = business_calendar(spark, date(2024, 1, 1), date(2024, 1, 31), holidays)
    days = spark.createDataFrame([(FRIDAY,), (SATURDAY,), (MONDAY,), (None,)], "d date")
    move = lambda n: [r["out"] for r in shift_business_days(days, "d", n, calendar, "out").orderBy("d").collect()]
    assert move(1) == [None, date(2024, 1, 9), date(2024, 1, 9), date(2024, 1, 9)]
    assert move(-1) == [None, date(2024, 1, 4), FRIDAY, FRIDAY]
    assert move(0) == [None, FRIDAY, FRIDAY, FRIDAY]
    spans = spark.createDataFrame([(FRIDAY, date(2024, 1, 10)), (MONDAY, FRIDAY)], "a date, b date")
    assert [r["n"] for r in count_business_days(spans, "a", "b", calendar, "n").collect()] == [2, 0]
    listed = [r[0] for r in business_days_in_range(spark, FRIDAY, date(2024, 1, 10), holidays).collect()]
    assert listed == [FRIDAY, date(2024, 1, 9), date(2024, 1, 10)]
    with pytest.raises(ValueError):
        business_calendar(spark, FRIDAY, date(2024, 1, 1))


def test_holiday_calendar_agrees_with_weekday_arithmetic(spark):
    calendar = business_calendar(spark, date(2023, 1, 1), date(2026, 1, 1))
    days = spark.range(400).select(F.date_add(F.lit(date(2024, 1, 1)), F.col("id").cast("int")).alias("d"))
    for offset in (-7, -1, 0, 1, 6):
        moved = shift_business_days(days, "d", offset, calendar, "out")
        assert moved.where(F.col("out") != shift_weekdays(F.col("d"), offset)).count() == 0


def test_effective_date_looks_back(spark):
    assert effective_date(spark, MONDAY, 1) == FRIDAY
    assert effective_date(spark, SATURDAY, 0) == SATURDAY
    assert effective_date(spark, MONDAY, -1) == date(2024, 1, 9)


def test_run_date_and_week(spark):
    assert resolve_run_date(" 2024-01-31 ") == "2024-01-31"
    assert len(resolve_run_date(None)) == 10
    with pytest.raises(ValueError):
        resolve_run_date("31/01/2024")
    assert spark.range(1).select(week_start(F.lit(date(2024, 1, 7)))).first()[0] == date(2024, 1, 1)
