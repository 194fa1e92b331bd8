import json
import threading
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import types as T

from ledgerflow.functions.tokens import RunTokens
from ledgerflow.plans.commits import CommitLog
from ledgerflow.plans.config import DatasourceRef, OutputSpec, ReportConfig, SourceConfig, SqlStep
from ledgerflow.plans.control import ControlRule, Validation
from ledgerflow.plans.ledger import Ledger, completed_runs, missing_sources
from ledgerflow.plans.load import load_period
from ledgerflow.plans.records import control_metrics, read_records, run_totals, to_records
from ledgerflow.plans.report import run_report
from ledgerflow.plans.schemas import merged_fields, read_run_schemas, schema_folder, schema_rows, stored_schema, write_run_schemas
from ledgerflow.sources.router import SourceSpec

AT = datetime(2024, 1, 31, 9, 0, 0)
TOKENS = RunTokens("2024-01-01", "2024-01-31", "202401", "2024-01-31")


def test_a_commit_is_created_once(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path / "a b" / "log"))
    assert log.numbers() == []
    assert log.create(3, "é\n") and not log.create(3, "other") and log.create(12, "")
    assert log.numbers() == [3, 12] and log.read(3) == "é\n" and log.read(12) == ""


def test_writers_at_once_never_share_an_id(spark, tmp_path):
    path, found, barrier = str(tmp_path / "ledger"), [], threading.Barrier(4)

    def work(name):
        book = Ledger(spark, path, compact_every=4)
        barrier.wait()
        for n in range(4):
            found.extend(book.open_runs([("shared", "p", None), (name, "p", None)], AT))

    threads = [threading.Thread(target=work, args=(f"own-{i}",)) for i in range(4)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert sorted(found) == list(range(1, 33))
    state = Ledger(spark, path).current()
    assert state.count() == 32
    versions = [r["VsnNo"] for r in state.where("SrceNm = 'shared'").collect()]
    assert sorted(versions) == list(range(1, 17))


def test_the_state_comes_from_the_snapshot_and_its_tail(spark, tmp_path):
    book = Ledger(spark, str(tmp_path / "ledger"))
    for period in ("p1", "p2", "p1"):
        book.open_runs([("a", period, "f", "eod")], AT)
    book.close_run(1, "COMPLETED", datetime(2024, 2, 1), "done")
    before = sorted(map(tuple, book.current().collect()))
    book.compact()
    assert sorted(map(tuple, book.current().collect())) == before
    book.close_run(2, "FAILED", datetime(2024, 2, 2))
    assert book.open_runs([("a", "p1", None, "eod")], datetime(2024, 2, 3)) == [4]
    fresh = Ledger(spark, str(tmp_path / "ledger"))
    state = {r["DaId"]: (r["StaCd"], r["VsnNo"], r["SubNm"]) for r in fresh.current().collect()}
    assert state == {1: ("COMPLETED", 1, "eod"), 2: ("FAILED", 1, "eod"), 3: ("LOADING", 2, "eod"), 4: ("LOADING", 3, "eod")}
    assert fresh.events().count() == 6
    # one file of the period, and none of what the snapshot holds
    files = fresh.current("p1").inputFiles()
    assert files and all("/states/" in f and "PerId=p1" in f for f in fresh.current().where("PerId = 'p1'").inputFiles() if "p1" in f)
    plan = fresh.current("p1")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(PerId" in plan and "/batches/" not in plan
    with pytest.raises(KeyError, match="99"):
        fresh.close_run(99, "FAILED", AT)


def test_snapshots_come_by_themselves(spark, tmp_path):
    book = Ledger(spark, str(tmp_path / "ledger"), compact_every=3)
    for _ in range(5):
        book.open_runs([("a", "p", None)], AT)
    assert CommitLog(spark, str(tmp_path / "ledger" / "snapshots")).numbers() == [3]
    assert sorted(r["DaId"] for r in book.current().collect()) == [1, 2, 3, 4, 5]


def test_a_subprocess_does_not_hide_another(spark, tmp_path):
    book = Ledger(spark, str(tmp_path / "ledger"))
    book.open_runs([("a", "p", None, "eod"), ("a", "p", None, "mid"), ("b", "p", None)], AT)
    for run, status in ((1, "COMPLETED"), (2, "FAILED"), (3, "COMPLETED")):
        book.close_run(run, status, AT)
    rows = [("a", "p", "eod"), ("a", "p", "mid"), ("b", "p", "eod")]
    wanted = spark.createDataFrame(rows, "SrceNm string, PerId string, SubNm string")
    assert [tuple(r) for r in missing_sources(wanted, book.current()).collect()] == [("a", "p", "mid")]
    assert completed_runs(book.current(), rows) == {("a", "p", "eod"): 1, ("b", "p", "eod"): 3}


KINDS = "whole int, wide decimal(12,3), real double, short float, text string, flag boolean, day date, nested struct<x:int,y:string>, list array<int>, raw binary"


def test_observed_totals_equal_those_of_the_stored_rows(spark):
    rows = [
        (1, Decimal("1.250"), 2.5, 0.1, "7", True, date(2024, 1, 1), (5, "6"), [1], b"1"),
        (None, None, float("nan"), None, "x7", None, None, None, None, None),
        (-3, Decimal("-0.5"), float("inf"), 1e10, " 8e2 ", False, date(2024, 1, 2), (None, "abc"), None, b"ab"),
        (4, Decimal("0"), -1e300, 2.0, '{"a": 1}', None, None, (9, None), [], None),
    ]
    df = spark.createDataFrame(rows, KINDS)
    fields = [*df.columns, "nested.x", "nested.y", "text.a", "gone", "gone.x"]
    stored = run_totals(to_records(df, 1, AT), fields).first()
    seen = df.agg(*[value.alias(name) for name, value in control_metrics(df, fields).items()]).first()
    assert seen["rows"] == stored["row_count"] == 4
    for i, field in enumerate(fields):
        assert (seen[f"sum_{i}"], seen[f"bad_{i}"]) == (stored["sums"][field], stored["bad"][field]), field


def load(spark, tmp_path, sql, **spec):
    config = SourceConfig("G", "facts", "eod", "202401", SourceSpec("BQ", query=sql), [], Validation(**spec))
    book = Ledger(spark, str(tmp_path / "ledger"))
    return book, load_period(spark, [config], book, str(tmp_path / "records"), TOKENS, override=True)


def test_a_load_does_not_read_its_records_back(spark, tmp_path):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("one-load", "load")
    try:
        sql = "SELECT id, id * 2.5D AS amount FROM range(1000)"
        _, statuses = load(spark, tmp_path, sql, rules=(ControlRule("amount", 1248750.0),))
        jobs = len(tracker.getJobIdsForGroup("one-load"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    document = json.loads(statuses[0].summary)
    assert statuses[0].status == "COMPLETED" and document["dstAmount_amount"] == 1248750.0 and document["dstCount"] == 1000
    assert jobs <= 4  # records, fields, and the check of a few rows


def test_a_failed_load_leaves_a_document(spark, tmp_path):
    with pytest.raises(Exception):
        load(spark, tmp_path, "SELECT raise_error('no luck') AS x")
    state = Ledger(spark, str(tmp_path / "ledger")).current().first()
    assert state["StaCd"] == "FAILED" and "error" in json.loads(state["BalAndCntlSmryTx"])


def test_reports_take_the_stored_schema(spark, tmp_path, monkeypatch):
    from ledgerflow.plans import records as record_module

    sql = "SELECT CAST(id AS INT) AS k, IF(id > 1, 'v', NULL) AS late, named_struct('p', id) AS s FROM range(3)"
    book, _ = load(spark, tmp_path, sql)
    monkeypatch.setattr(record_module, "infer_json_schema", lambda *_: pytest.fail("the data were searched for fields"))
    stored = read_run_schemas(spark, schema_folder(str(tmp_path / "records")))
    step = SqlStep("sum", "SELECT sum(k) AS k, count(late) AS n, max(s.p) AS p FROM {f}", "out")
    config = ReportConfig(
        "r", "eod", "202401", datasources=(DatasourceRef("facts", "eod", "f", True),), steps=(step,),
        outputs=(OutputSpec("out", path=str(tmp_path / "out")),),
    )
    run = run_report(spark, config, book, read_records(spark, str(tmp_path / "records")), TOKENS, run_schemas=stored)
    found = spark.read.csv(run.outputs[0].destination, header=True).first()
    assert tuple(found) == ("3", "1", "2")


def test_schemas_of_several_runs(spark, tmp_path):
    path = str(tmp_path / "fields")
    assert read_run_schemas(spark, path).count() == 0 and stored_schema(read_run_schemas(spark, path), [1]) is None
    first = T.StructType.fromDDL("a int, b float, c date, d struct<x:int>")
    second = T.StructType.fromDDL("b bigint, a tinyint, c string, e array<int>")
    write_run_schemas(spark, schema_rows(1, first) + schema_rows(2, second), path)
    write_run_schemas(spark, [], path)
    stored = read_run_schemas(spark, path)
    assert stored_schema(stored, [1]) == first
    both = stored_schema(stored, [1, 2])
    assert {f.name: f.dataType.simpleString() for f in both} == {
        "a": "bigint", "b": "double", "c": "string", "d": "struct<x:int>", "e": "array<int>"
    }
    assert stored_schema(stored, [1, 3]) is None
    assert merged_fields(stored, "DaId").count() == 8
