from datetime import date, datetime

import pytest
from conftest import rows

from ledgerflow.plans.config import ConfigError
from ledgerflow.plans.process import DATA_SOURCE_DOWNLOAD, REPORT_PROCESSING, ProcessOptions, run_process
from ledgerflow.sinks.router import SinkSpec
from ledgerflow.sources.router import SourceSpec


@pytest.fixture(scope="module")
def config_schema(spark):
    """Configuration tables of one source and one report."""
    spark.sql("CREATE SCHEMA IF NOT EXISTS process_config")
    spark.sql("CREATE SCHEMA IF NOT EXISTS raw_data")
    data = [("T1", "USD", 10.0), ("T2", "USD", 5.0), ("T3", "EUR", 7.0)]
    spark.createDataFrame(data, "trade_id string, currency string, amount double").write.saveAsTable("raw_data.trades")
    spark.createDataFrame(
        [("TRADING", "trades", "eod", "202401", "BQ", "raw_data", "trades", 1, '[{"field": "amount", "expectedTotal": 22}]')],
        "parent_id string, datasource_name string, subprocess_name string, period_id string, source_type string, "
        "bq_dataset string, bq_table string, min_row_count bigint, bnc_rules_json string",
    ).write.saveAsTable("process_config.source_config")
    spark.createDataFrame(
        [("202401", date(2024, 1, 31), 1, "23-24", "MONTHLY", datetime(2024, 1, 1))],
        "PerId string, PerDt date, MoNo bigint, YrNo string, PerTypeCd string, LstUpdtTs timestamp",
    ).write.saveAsTable("process_config.MSTR_Per")
    key = ("daily", "eod", "202401")
    names = "report_name string, report_subprocess string, period_id string, "
    spark.createDataFrame([(*key, False)], names + "override_key boolean").write.saveAsTable("process_config.report_config")
    spark.createDataFrame(
        [(*key, "trades", "eod", "t", True)],
        names + "datasource_name string, datasource_subprocess string, transform_alias string, is_required boolean",
    ).write.saveAsTable("process_config.report_datasource_ref")
    spark.createDataFrame(
        [(*key, 1, "sum", "SELECT currency, SUM(amount) AS total FROM {t} GROUP BY currency", "out", None, None)],
        names + "step_order int, step_name string, query_template string, output_alias string, output_bq_table string, "
        "query_params_json string",
    ).write.saveAsTable("process_config.report_transformation_config")
    spark.createDataFrame(
        [(*key, 1, "out", "BQ", "raw_data.daily_out")],
        names + "output_order int, input_alias string, sink_type string, bq_sink_table string",
    ).write.saveAsTable("process_config.report_output_config")
    return "process_config"


def test_load_then_report(spark, config_schema, tmp_path):
    common = dict(period_id="202401", run_date="2024-01-31", config_schema=config_schema, state_path=str(tmp_path))
    load = ProcessOptions(DATA_SOURCE_DOWNLOAD, "TRADING", "trades", "eod", **common)
    statuses = run_process(spark, load)
    assert [(s.source, s.status) for s in statuses] == [("trades", "COMPLETED")]
    assert run_process(spark, load) == []
    run = run_process(spark, ProcessOptions(REPORT_PROCESSING, report_name="daily", report_subprocess="eod", **common))
    assert run.status == "COMPLETED" and run.outputs[0].rows == 2
    assert rows(spark.table("raw_data.daily_out")) == [("EUR", 7.0), ("USD", 15.0)]
    assert spark.read.parquet(f"{tmp_path}/COM_CmnRptDtl").first()["FlNm"] == "raw_data.daily_out"


def test_chain_without_a_report_name(spark, tmp_path):
    (tmp_path / "in.json").write_text('{"a": 1}\n')
    options = ProcessOptions(
        REPORT_PROCESSING, source=SourceSpec("GCS", path=f"{tmp_path}/in.json"), sink=SinkSpec("GCS", path=f"{tmp_path}/out")
    )
    run_process(spark, options)
    assert rows(spark.read.json(f"{tmp_path}/out")) == [('{"a": 1}',)]


def test_option_errors(spark, config_schema):
    with pytest.raises(ConfigError, match="datasource_name"):
        run_process(spark, ProcessOptions(DATA_SOURCE_DOWNLOAD, period_id="202401"))
    with pytest.raises(ConfigError, match="period_id"):
        run_process(spark, ProcessOptions(DATA_SOURCE_DOWNLOAD, datasource_name="trades"))
    with pytest.raises(ConfigError, match="sink"):
        run_process(spark, ProcessOptions(REPORT_PROCESSING))
    with pytest.raises(ConfigError, match="unknown process type"):
        run_process(spark, ProcessOptions("EXPORT"))
    with pytest.raises(ConfigError, match="state path"):
        run_process(
            spark,
            ProcessOptions(DATA_SOURCE_DOWNLOAD, "TRADING", "trades", "eod", "202401", config_schema=config_schema),
        )
