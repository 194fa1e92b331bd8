"""One entry for all kinds of run, from options to a finished run."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ledgerflow.functions.tokens import RunTokens, resolve_run_date
from ledgerflow.operators.chain import ChainOptions, TransformRegistry
from ledgerflow.plans.chains import ChainRun, run_chain_job
from ledgerflow.plans.config import ConfigError, report_config, source_configs
from ledgerflow.plans.ledger import Ledger
from ledgerflow.plans.load import RunStatus, load_period
from ledgerflow.plans.records import read_records
from ledgerflow.plans.report import ReportRun, run_report
from ledgerflow.plans.schemas import read_run_schemas, schema_folder
from ledgerflow.sinks.router import SinkSpec
from ledgerflow.sources.router import SourceSpec

# Process types, table names and option defaults.
DATA_SOURCE_DOWNLOAD, REPORT_PROCESSING = "DATA_SOURCE_DOWNLOAD", "REPORT_PROCESSING"
SOURCE_CONFIG_TABLE, PERIOD_TABLE = "source_config", "MSTR_Per"
LEDGER_TABLE, RECORD_TABLE, DETAIL_TABLE = "DaRefer", "DaRec", "COM_CmnRptDtl"
REPORT_TABLES = (
    "report_config",
    "report_datasource_ref",
    "report_preprocessing_config",
    "report_transformation_config",
    "report_output_config",
    "report_email_config",
)


@dataclass(frozen=True)
class ProcessOptions:
    """What to run. Configuration tables are in the schema ``config_schema``, run state in folders of ``state_path``."""

    process_type: str
    parent_id: str | None = None
    datasource_name: str | None = None
    subprocess_name: str = "default"
    period_id: str | None = None
    report_name: str = ""
    report_subprocess: str = "default"
    period_start: str | None = None
    period_end: str | None = None
    run_date: str | None = None
    override_download: bool = False
    config_schema: str = "pipeline_config"
    state_path: str = ""
    source: SourceSpec | None = None
    transform_chain: str = ""
    chain: ChainOptions = field(default_factory=ChainOptions)
    sink: SinkSpec | None = None
    dead_letter_path: str | None = None
    checkpoint: str | None = None
    job_run_id: str = field(default_factory=lambda: str(uuid.uuid4()))

    @property
    def tokens(self) -> RunTokens:
        return RunTokens(self.period_start, self.period_end, self.period_id, resolve_run_date(self.run_date))

    def state(self, table: str) -> str:
        if not self.state_path:
            raise ConfigError("a load or report needs a state path")
        return f"{self.state_path.rstrip('/')}/{table}"


def _table(spark: SparkSession, options: ProcessOptions, name: str) -> DataFrame | None:
    full = f"{options.config_schema}.{name}"
    return spark.table(full) if spark.catalog.tableExists(full) else None


def _required(value: str | None, name: str) -> str:
    if not value or not value.strip():
        raise ConfigError(f"{name} is required")
    return value


def run_load(spark: SparkSession, options: ProcessOptions, read_lookup=None) -> list[RunStatus]:
    """A period load of one datasource; mismatches come back as statuses, the caller decides about them."""
    datasource = _required(options.datasource_name, "datasource_name")
    period = _required(options.period_id, "period_id")
    table = _table(spark, options, SOURCE_CONFIG_TABLE)
    if table is None:
        raise ConfigError(f"no table {options.config_schema}.{SOURCE_CONFIG_TABLE}")
    configs = source_configs(table, options.parent_id or "", datasource, options.subprocess_name, period)
    return load_period(
        spark,
        configs,
        Ledger(spark, options.state(LEDGER_TABLE)),
        options.state(RECORD_TABLE),
        options.tokens,
        override=options.override_download,
        periods=_table(spark, options, PERIOD_TABLE),
        read_lookup=read_lookup,
    )


def run_configured_report(spark: SparkSession, options: ProcessOptions) -> ReportRun:
    """A report from its configuration tables."""
    period = _required(options.period_id, "period_id")
    found = {name: df for name in REPORT_TABLES if (df := _table(spark, options, name)) is not None}
    if "report_config" not in found:
        raise ConfigError(f"no table {options.config_schema}.report_config")
    return run_report(
        spark,
        report_config(found, options.report_name, options.report_subprocess, period),
        Ledger(spark, options.state(LEDGER_TABLE)),
        read_records(spark, options.state(RECORD_TABLE)),
        options.tokens,
        user=options.job_run_id,
        periods=_table(spark, options, PERIOD_TABLE),
        detail_path=options.state(DETAIL_TABLE),
        run_schemas=read_run_schemas(spark, schema_folder(options.state(RECORD_TABLE))),
    )


def run_configured_chain(
    spark: SparkSession, options: ProcessOptions, registry: TransformRegistry | None = None
) -> ChainRun:
    """A chain from a source to a sink; only here is a sink required."""
    if options.source is None or options.sink is None:
        raise ConfigError("a chain needs a source and a sink")
    return run_chain_job(
        spark,
        options.source,
        options.transform_chain,
        options.sink,
        options.chain,
        options.dead_letter_path,
        options.checkpoint,
        options.tokens,
        registry,
    )


def run_process(spark: SparkSession, options: ProcessOptions) -> list[RunStatus] | ReportRun | ChainRun:
    """Run what the options name: a load, a report, or, without a report name, a chain."""
    if options.process_type == DATA_SOURCE_DOWNLOAD:
        return run_load(spark, options)
    if options.process_type == REPORT_PROCESSING:
        return run_configured_report(spark, options) if options.report_name else run_configured_chain(spark, options)
    raise ConfigError(
        f"unknown process type {options.process_type!r}; use {DATA_SOURCE_DOWNLOAD} or {REPORT_PROCESSING}"
    )
