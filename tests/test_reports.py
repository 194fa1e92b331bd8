import json
from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from ledgerflow.functions.json import json_query, json_value, register_json_functions
from ledgerflow.functions.sql_forms import to_spark_sql
from ledgerflow.functions.tokens import RunTokens, render_sql
from ledgerflow.plans.config import (
    ConfigError,
    DatasourceRef,
    EmailSpec,
    OutputSpec,
    ReportConfig,
    SourceConfig,
    SqlStep,
    parse_rules,
    parse_sink_type,
    report_config,
    source_configs,
)
from ledgerflow.plans.control import ControlRule, Validation
from ledgerflow.plans.ledger import Ledger
from ledgerflow.plans.load import load_period
from ledgerflow.plans.notify import notification_rows, parse_addresses
from ledgerflow.plans.records import read_records
from ledgerflow.plans.report import Aliases, SourcesMissingError, UnknownAliasError, run_report, run_sql_steps
from ledgerflow.sources.router import SourceSpec

TOKENS = RunTokens("2024-01-01", "2024-01-31", "202401", "2024-01-31")
TRADES = [
    ("T001", "USD", 150000.0, "2024-01-05", "FX"), ("T002", "EUR", 80000.0, "2024-01-07", "FX"),
    ("T003", "USD", 95000.0, "2024-01-10", "RATES"), ("T004", "GBP", 60000.0, "2024-01-12", "FX"),
    ("T005", "EUR", 40000.0, "2024-01-15", "RATES"), ("T006", "USD", 210000.0, "2024-01-20", "FX"),
    ("T007", "JPY", 500000.0, "2024-01-22", "FX"), ("T008", "GBP", 35000.0, "2024-01-28", "RATES"),
]
SUMMARY_SQL = """
SELECT desk, max(amount) - min(amount) AS span, count(DISTINCT currency) AS currencies FROM {trades}
WHERE datediff(DATE '{periodEnd}', trade_date) BETWEEN 0 AND 30 GROUP BY desk ORDER BY span DESC
"""
EXPECTED = [("FX", 440000.0, 4), ("RATES", 60000.0, 3)]


def trades_table(spark):
    df = spark.createDataFrame(TRADES, "trade_id string, currency string, amount double, trade_date string, desk string")
    df.withColumn("trade_date", F.col("trade_date").cast("date")).createOrReplaceTempView("trades_src")


def source(name="trades", table="trades_src", validation=Validation(), **spec):
    return SourceConfig("TRADING", name, "eod", "202401", SourceSpec("BQ", table=table, **spec), [], validation)


def loaded(spark, tmp_path, *configs, **kwargs):
    trades_table(spark)
    book = Ledger(spark, str(tmp_path / "ledger"))
    statuses = load_period(spark, list(configs) or [source()], book, str(tmp_path / "rec"), TOKENS, **kwargs)
    return book, statuses


def test_load_checks_and_skips(spark, tmp_path):
    good = Validation(1, 8, ("amount",), (ControlRule("amount", 1_170_000.0),))
    book, statuses = loaded(spark, tmp_path, source(validation=good))
    assert [(s.source, s.run_id, s.status) for s in statuses] == [("trades", 1, "COMPLETED")]
    summary = json.loads(statuses[0].summary)
    assert (summary["srcCount"], summary["dstCount"], summary["dstAmount_amount"]) == (8, 8, 1_170_000.0)
    again = load_period(spark, [source()], book, str(tmp_path / "rec"), TOKENS)
    assert again == []
    forced = load_period(spark, [source()], book, str(tmp_path / "rec"), TOKENS, override=True)
    assert [(s.run_id, s.status) for s in forced] == [(2, "COMPLETED")]
    assert sorted(r["VsnNo"] for r in book.current().collect()) == [1, 2]


def test_load_reports_mismatches_without_failing(spark, tmp_path):
    bad = Validation(rules=(ControlRule("amount", 1.0),), required_headers=("amount", "book"))
    _, statuses = loaded(spark, tmp_path, source(validation=bad), source("other"))
    by_name = {s.source: s for s in statuses}
    assert by_name["trades"].status == "FAILED_BNC" and by_name["other"].status == "COMPLETED"
    assert "missing headers: book" in json.loads(by_name["trades"].summary)["failures"]


def test_a_failing_load_closes_its_runs(spark, tmp_path):
    with pytest.raises(Exception):
        loaded(spark, tmp_path, source(table="no_such_table"))
    book = Ledger(spark, str(tmp_path / "ledger"))
    assert [r["StaCd"] for r in book.current().collect()] == ["FAILED"]


def test_raw_sources_are_flattened_in_a_load(spark, tmp_path):
    landed = tmp_path / "landed"
    landed.mkdir()
    (landed / "a.json").write_text('{"id": 1, "amount": 2.5}\n{"id": 2, "amount": 4}\n')
    spec = SourceSpec("GCS", path=str(landed))
    config = SourceConfig("g", "raw", "eod", "202401", spec, [], Validation(rules=(ControlRule("amount", 6.5),)))
    _, statuses = loaded(spark, tmp_path, config)
    assert statuses[0].status == "COMPLETED"
    stored = [json.loads(r["RowDaJsonTx"]) for r in read_records(spark, str(tmp_path / "rec")).collect()]
    assert sorted(r["id"] for r in stored) == [1, 2]


def test_load_checks_the_period_master(spark, tmp_path):
    periods = spark.createDataFrame(
        [("209901", None, 1, "98-99", "MONTHLY")], "PerId string, PerDt date, MoNo bigint, YrNo string, PerTypeCd string"
    )
    with pytest.raises(ValueError, match="202401"):
        loaded(spark, tmp_path, periods=periods)


def report(path, **changes):
    base = dict(
        datasources=(DatasourceRef("trades", "eod", "trades", True), DatasourceRef("fx", "eod", "fx", False)),
        steps=(SqlStep("sum", SUMMARY_SQL, "summary"),),
        outputs=(OutputSpec("summary", path=str(path)),),
        email=EmailSpec(["a@x.org", "b@x.org"], [], "{reportName}/{reportSubprocess} {periodId}", "until {periodEnd}"),
    )
    return ReportConfig("daily", "eod", "202401", **{**base, **changes})


SCHEMAS = {"trades": "trade_id string, currency string, amount double, trade_date date, desk string"}


def test_a_report_from_start_to_end(spark, tmp_path):
    """Desks in the order the query asks for."""
    book, _ = loaded(spark, tmp_path)
    records = read_records(spark, str(tmp_path / "rec"))
    config = report(tmp_path / "out")
    run = run_report(
        spark, config, book, records, TOKENS, user="me", schemas=SCHEMAS, detail_path=str(tmp_path / "details")
    )
    assert run.status == "COMPLETED" and run.run_id == 2
    assert run.outputs[0].name == "daily_202401_2024-01-31.csv" and run.outputs[0].rows == 2
    schema = "desk string, span double, currencies bigint"
    exported = spark.read.schema(schema).csv(run.outputs[0].destination, header=True)
    assert [tuple(r) for r in exported.collect()] == EXPECTED
    detail = spark.read.parquet(str(tmp_path / "details")).first()
    assert (detail["SrceSysNm"], detail["RecCt"], detail["CreateUserId"]) == ("daily", 2, "me")
    note = run.notification.first()
    assert (note["to"], note["subject"], note["body"]) == ("a@x.org,b@x.org", "daily/eod 202401", "until 2024-01-31")
    assert note["attachments"] == [run.outputs[0].destination]
    skipped = run_report(spark, config, book, records, TOKENS, schemas=SCHEMAS)
    assert skipped.run_id is None
    forced = run_report(spark, report(tmp_path / "out", override=True), book, records, TOKENS, schemas=SCHEMAS)
    assert forced.run_id == 3


def test_report_without_schema_finds_the_fields(spark, tmp_path):
    book, _ = loaded(spark, tmp_path)
    step = SqlStep("n", "SELECT desk, SUM(amount) AS s FROM {trades} GROUP BY desk", "summary")
    run = run_report(spark, report(tmp_path / "o", steps=(step,)), book, read_records(spark, str(tmp_path / "rec")), TOKENS)
    assert run.outputs[0].rows == 2


def test_missing_sources_fail_the_report(spark, tmp_path):
    book, _ = loaded(spark, tmp_path)
    refs = tuple(DatasourceRef(n, "eod", n, True) for n in ("z", "fx", "trades"))
    records = read_records(spark, str(tmp_path / "rec"))
    with pytest.raises(SourcesMissingError, match=r"\['fx/eod', 'z/eod'\]"):
        run_report(spark, report(tmp_path / "o", datasources=refs), book, records, TOKENS)
    assert book.current().where("SrceNm = 'daily'").first()["StaCd"] == "FAILED"


def test_unknown_output_alias_lists_the_known_ones(spark, tmp_path):
    book, _ = loaded(spark, tmp_path)
    config = report(tmp_path / "o", outputs=(OutputSpec("nope"),))
    with pytest.raises(UnknownAliasError, match="summary"):
        run_report(spark, config, book, read_records(spark, str(tmp_path / "rec")), TOKENS, schemas=SCHEMAS)


def test_table_api_and_alias_outputs(spark, tmp_path):
    book, _ = loaded(spark, tmp_path)
    outputs = (
        OutputSpec("summary", "BQ", table="summary_out"), OutputSpec("summary", "API", endpoint="svc"),
        OutputSpec("trades", "GCS", "JSON", str(tmp_path / "o")),
    )
    step = SqlStep("sum", SUMMARY_SQL, "summary", output_table="summary_step")
    pre = SqlStep("pre", "SELECT 1 AS x", output_table="pre_step")
    skip = SqlStep("call", "", kind="API_ENRICHMENT")
    config = report(tmp_path / "o", outputs=outputs, steps=(step,), preprocessing=(pre, skip))
    run = run_report(spark, config, book, read_records(spark, str(tmp_path / "rec")), TOKENS, schemas=SCHEMAS)
    assert rows(spark.table("summary_out")) == sorted(EXPECTED, key=repr)
    assert rows(spark.table("pre_step")) == [(1,)]
    payload = json.loads(run.outputs[1].payloads.first()["payload"])
    assert {p["desk"] for p in payload} == {"FX", "RATES"} and run.outputs[1].rows == 2
    assert run.outputs[2].rows == 8 and run.outputs[2].destination.endswith(".json")
    with pytest.raises(ValueError, match="unknown step type"):
        run_sql_steps(spark, (SqlStep("x", "", kind="FTP"),), Aliases(spark, "x"), TOKENS)


def test_token_order():
    params = {"range": "{periodStart}..{periodEnd}", "none": None}
    text = "{a}|{periodId}|{range}|{none}|{unknown}|{runDate}"
    assert render_sql(text, TOKENS, params, {"a": "view_{periodId}"}) == (
        "view_202401|202401|2024-01-01..2024-01-31||{unknown}|2024-01-31"
    )
    assert render_sql(None, TOKENS) is None and render_sql("  ", TOKENS) == "  "
    assert render_sql("[{periodStart}]", RunTokens(run_date="2024-01-01")) == "[]"


def test_warehouse_sql_forms(spark):
    assert to_spark_sql("CAST(x AS FLOAT64) + int64 'INT64 @x' @day `p-1.d.t`") == (
        "CAST(x AS DOUBLE) + int64 'INT64 @x' :day `p-1`.`d`.`t`"
    )
    assert to_spark_sql("FROM parquet.`/a.b/c.parquet`") == "FROM parquet.`/a.b/c.parquet`"
    register_json_functions(spark)
    spark.createDataFrame([('{"a": 1.5, "o": {"p": "q"}}', 3)], "j string, n int").createOrReplaceTempView("docs")
    text = (
        "SELECT JSON_VALUE(j, '$.a') v, JSON_VALUE(j, '$.o') o, JSON_QUERY(j, '$.o') q, IFNULL(NULL, n) i, "
        "CAST(JSON_VALUE(j, '$.a') AS FLOAT64) * 2 d, TO_JSON_STRING(docs) t, DATE \"2024-01-31\" day FROM docs"
    )
    row = spark.sql(to_spark_sql(text)).first()
    assert row[:5] == ("1.5", None, '{"p":"q"}', 3, 3.0)
    assert json.loads(row["t"])["n"] == 3 and str(row["day"]) == "2024-01-31"


@pytest.mark.parametrize(
    ("text", "form"),
    [
        ("SELECT PARSE_DATE('%F', d) FROM t", "PARSE_DATE"),
        ("SELECT f(1, DATE_DIFF(a, b, MONTH))", "DATE_DIFF by MONTH"),
        ("SELECT DATE_TRUNC(a, WEEK)", "DATE_TRUNC to WEEK"),
        ("SELECT DATE_ADD(a, INTERVAL 2 HOUR)", "DATE_ADD by HOUR"),
        ("SELECT SAFE.SUBSTR(a, -1)", "SAFE.SUBSTR"),
        ("SELECT CAST(a AS STRING FORMAT 'YYYY')", "FORMAT"),
        ("SELECT (a", "open"),
        ("SELECT a) FROM (b", "closing"),
    ],
)
def test_refused_warehouse_forms(text, form):
    with pytest.raises(ValueError, match=form):
        to_spark_sql(text)


def test_nested_warehouse_forms(spark):
    assert to_spark_sql("CAST(f(CAST(a AS INT64)) AS ARRAY<FLOAT64>), CAST ( b AS NUMERIC(10, 2) )") == (
        "CAST(f(CAST(a AS BIGINT)) AS ARRAY<DOUBLE>), CAST ( b AS DECIMAL(10, 2) )"
    )
    # names, quoted text, comments and functions of a schema are not forms; Spark's own calls stay
    same = (
        "SELECT format, `PARSE_DATE(x`, 'UNNEST(' AS u, s.countif(x), date_add(d, 3), date_trunc('MONTH', d), last_day(d),\n"
        "  max(int64) OVER (PARTITION BY bool) -- SAFE.F(\nFROM (SELECT * FROM t) /* ( */ WHERE x IN (1, 2)"
    )
    assert to_spark_sql(same) == same
    text = (
        "SELECT DATE_SUB(DATE '2024-03-31', INTERVAL 1 MONTH) a, DATE_ADD(DATE '2024-02-29', INTERVAL -1 YEAR) b, "
        "DATE_TRUNC(DATE '2024-02-29', ISOWEEK) c, LAST_DAY(DATE '2024-02-03', MONTH) d, DIV(7, 1 + 1) + 1 e, SAFE_DIVIDE(1, 0) f"
    )
    found = spark.sql(to_spark_sql(text)).first()
    assert [str(v) for v in found] == ["2024-02-29", "2023-02-28", "2024-02-26", "2024-02-29", "4", "None"]


def test_json_paths_tell_text_from_objects(spark):
    df = spark.createDataFrame([('{"a": {"b": 1}, "s": "{x", "n": null}',), ("bad",)], "j string")
    got = df.select(
        json_value(F.col("j"), "$.a"), json_value(F.col("j"), "$.a.b"), json_value(F.col("j"), "$.s"),
        json_value(F.col("j"), "$.n"), json_query(F.col("j"), "$.a"), json_query(F.col("j"), "$.s"),
    )
    assert [tuple(r) for r in got.collect()] == [(None, "1", "{x", None, '{"b":1}', '"{x"'), (None,) * 6]


def test_notifications(spark):
    df = spark.createDataFrame(
        [("a@x", "S {periodId}", "B {x}", " c@x, ,d@x "), (" ", "s", "b", None), (None, "s", "b", None), ("e@x", None, None, None)],
        "to string, subject string, body string, cc string",
    )
    got = notification_rows(df, {"periodId": "202401", "x": F.col("cc"), "none": None})
    assert [tuple(r) for r in got.collect()] == [
        ("a@x", "S 202401", "B  c@x, ,d@x ", ["c@x", "d@x"]), ("e@x", "", "", [])
    ]
    assert notification_rows(df.drop("cc")).first()["cc"] == []
    assert parse_addresses('["a@x", "b@x"]') == ["a@x", "b@x"]
    assert parse_addresses(" a@x , ,b@x") == ["a@x", "b@x"] and parse_addresses(None) == []


def test_source_config_rows(spark):
    columns = (
        "parent_id string, datasource_name string, subprocess_name string, period_id string, source_type string, "
        "file_type string, file_location string, file_has_header boolean, api_endpoint string, api_page_size bigint, "
        "bq_project_id string, bq_dataset string, bq_table string, min_row_count bigint, max_row_count bigint, "
        "required_headers_json string, bnc_rules_json string, source_transforms_json string"
    )
    key = ("g", "d", "s", "p")
    blank = (None,) * 5
    table = spark.createDataFrame(
        [
            (*key, "file", "CSV", "/in", True, None, None, None, None, None, None, None, '["a"]', '[{"field":"v"}]', "{x"),
            (*key, "API", None, None, None, "http://e", None, *blank, None, None, None),
            (*key, "BQ", None, None, None, None, None, "pr", "ds", "t", 2, 5, None, None, None),
        ],
        columns,
    )
    found = {c.spec.source_type: c for c in source_configs(table, *key)}
    assert found["FILE"].validation == Validation(0, -1, ("a",), (ControlRule("v", 0.0, 0.01),))
    assert found["FILE"].location == "/in" and found["FILE"].steps == []
    assert found["API"].spec.page_size == 100 and found["API"].location == "http://e"
    assert found["BQ"].spec.table == "pr.ds.t" and found["BQ"].validation.max_rows == 5
    with pytest.raises(ConfigError, match="source_config row missing"):
        source_configs(table, "g", "d", "s", "other")
    with pytest.raises(ConfigError, match="PUBSUB"):
        source_configs(table.withColumn("source_type", F.lit("PUBSUB")), *key)
    assert parse_rules('[{"field":"x","expectedTotal":5,"tolerancePct":0}]') == (ControlRule("x", 5.0, 0.0),)
    assert parse_rules("{bad") == ()


def test_report_config_rows(spark):
    key = "report_name string, report_subprocess string, period_id string, "
    head = spark.createDataFrame([("r", "s", "p", True)], key + "override_key boolean")
    refs = spark.createDataFrame(
        [("r", "s", "p", "b", "x", "bb", None), ("r", "s", "p", "a", "x", "aa", True), ("r", "s", "q", "c", "x", "cc", True)],
        key + "datasource_name string, datasource_subprocess string, transform_alias string, is_required boolean",
    )
    steps = spark.createDataFrame(
        [("r", "s", "p", 2, "two", "q2", "o2", None, None), ("r", "s", "p", 1, "one", "q1", "o1", "t1", '{"k":"v"}')],
        key + "step_order int, step_name string, query_template string, output_alias string, output_bq_table string, "
        "query_params_json string",
    )
    outputs = spark.createDataFrame(
        [("r", "s", "p", 1, "o2", None, None, True)],
        key + "output_order int, input_alias string, sink_type string, output_format string, include_header boolean",
    )
    emails = spark.createDataFrame(
        [("r", "s", "p", "a@x", None, "S", "B")],
        key + "to_list string, cc_list string, subject_template string, body_template string",
    )
    tables = {
        "report_config": head, "report_datasource_ref": refs, "report_transformation_config": steps,
        "report_output_config": outputs, "report_email_config": emails,
    }
    config = report_config(tables, "r", "s", "p")
    assert config.override and config.email.to == ["a@x"] and config.email.cc == []
    assert [(d.datasource, d.required) for d in config.datasources] == [("a", True), ("b", False)]
    assert [(s.name, s.output_table, s.params) for s in config.steps] == [("one", "t1", {"k": "v"}), ("two", None, {})]
    assert (config.outputs[0].sink_type, config.outputs[0].output_format) == ("GCS", "CSV")
    with pytest.raises(ConfigError, match="no report_config"):
        report_config(tables, "r", "s", "zzz")
    assert parse_sink_type("bq") == "BQ"
    with pytest.raises(ConfigError, match="FTP"):
        parse_sink_type("FTP")


def test_report_period_master(spark, tmp_path):
    periods = spark.createDataFrame([], "PerId string, PerDt date, MoNo bigint, YrNo string, PerTypeCd string")
    book = Ledger(spark, str(tmp_path / "ledger"))
    with pytest.raises(ValueError, match="202401"):
        run_report(spark, report(tmp_path), book, spark.range(1), TOKENS, periods=periods)
    assert book.current().count() == 0 and datetime.now()
