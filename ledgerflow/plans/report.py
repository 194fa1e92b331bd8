"""The report run: inputs, SQL steps, outputs, details, notification, status."""

from __future__ import annotations

import json
import logging
import re
import uuid
from collections import Counter
from dataclasses import dataclass, field
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerflow.functions.json import register_json_functions
from ledgerflow.functions.sql_forms import to_spark_sql
from ledgerflow.functions.tokens import RunTokens, render_sql
from ledgerflow.operators.batches import json_batches
from ledgerflow.plans.config import DatasourceRef, OutputSpec, ReportConfig, SqlStep
from ledgerflow.plans.control import COMPLETED, FAILED
from ledgerflow.plans.ledger import Ledger, completed_runs
from ledgerflow.plans.notify import report_notification
from ledgerflow.plans.params import fetch_parameters
from ledgerflow.plans.periods import find_period
from ledgerflow.plans.records import run_rows
from ledgerflow.plans.schemas import stored_schema
from ledgerflow.session import materialize, scratch_scope
from ledgerflow.sinks.files import export_report, report_file_name
from ledgerflow.sinks.tables import copy_table

log = logging.getLogger(__name__)

DETAIL_SCHEMA = (
    "SrceSysNm string, FlNm string, SrceFlCreateTs timestamp, FlDaJsonTx string, RecCt bigint, CreatTs timestamp, "
    "CreateUserId string, LstUpdtTs timestamp, LstUpdtUserId string"
)


class SourcesMissingError(RuntimeError):
    """Required sources of a report have no completed run."""


class UnknownAliasError(KeyError):
    """An output or step names an alias that no source or step defined."""


class Aliases:
    """Report aliases as temporary views with private names, in the order they were defined."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self._prefix = re.sub(r"\W", "_", label) + "_" + uuid.uuid4().hex[:12]
        self._names: dict[str, str] = {}

    def add(self, alias: str, df: DataFrame) -> None:
        name = f"{self._prefix}_{re.sub(r'[^0-9A-Za-z_]', '_', alias)}"
        df.createOrReplaceTempView(name)
        self._names[alias] = f"`{name}`"

    def add_table(self, alias: str, table: str) -> None:
        self._names[alias] = ".".join(f"`{part}`" for part in table.split("."))

    def names(self) -> dict[str, str]:
        return dict(self._names)

    def drop(self) -> None:
        """Forget the views; frames already taken from them stay usable."""
        for name in self._names.values():
            if name.startswith(f"`{self._prefix}"):
                self.spark.catalog.dropTempView(name.strip("`"))

    def frame(self, alias: str) -> DataFrame:
        if alias not in self._names:
            raise UnknownAliasError(f"alias {alias!r} is not defined; available: {list(self._names)}")
        return self.spark.table(self._names[alias])


def check_sources(config: ReportConfig, runs: dict[tuple, int]) -> None:
    """Every required source must have a COMPLETED run for the period; all that lack one are listed."""
    required = [(d.datasource, config.period_id, d.subprocess) for d in config.datasources if d.required]
    missing = sorted(f"{source}/{subprocess}" for source, period, subprocess in required if (source, period, subprocess) not in runs)
    if missing:
        raise SourcesMissingError(f"not COMPLETED for period {config.period_id}: {missing}")


def alias_views(
    aliases: Aliases,
    refs: tuple[DatasourceRef, ...],
    period_id: str,
    runs: dict[tuple, int],
    records: DataFrame,
    schemas: dict[str, str] | None = None,
    run_schemas: DataFrame | None = None,
) -> None:
    """Alias each source to the rows of its latest completed run, see ``completed_runs``: its fields as columns, and the
    stored JSON.

    Optional sources without a completed run get no alias. The fields of a source are those that ``schemas`` gives as
    DDL, else those that ``run_schemas`` holds for the run, else found in the data by one pass over the run.
    """
    for ref in refs:
        run_id = runs.get((ref.datasource, period_id, ref.subprocess))
        if run_id is None:
            if ref.required:
                raise SourcesMissingError(f"no COMPLETED run of {ref.datasource!r} for period {period_id}")
            log.warning("optional source %s has no completed run: alias %s is left out", ref.datasource, ref.alias)
            continue
        schema = (schemas or {}).get(ref.datasource)
        if schema is None and run_schemas is not None:
            schema = stored_schema(run_schemas, [run_id])
        aliases.add(ref.alias, run_rows(records, run_id, schema))


def run_sql_steps(
    spark: SparkSession, steps: tuple[SqlStep, ...], aliases: Aliases, tokens: RunTokens, args: dict | None = None
) -> Aliases:
    """Run ordered SQL steps; each result is an alias for later steps.

    A step's result is a lazy view, so the optimizer sees across steps and unused ones cost nothing. A step with an
    output table is written there once and read from it, which is the choice for results that several steps use.
    """
    register_json_functions(spark)
    for step in steps:
        if step.kind == "API_ENRICHMENT":
            log.warning("API enrichment is not a SQL step, skipped: %s", step.name)
            continue
        if step.kind != "BQ_QUERY":
            raise ValueError(f"unknown step type {step.kind!r}")
        rendered = render_sql(step.query, tokens, step.params, aliases.names())
        text = to_spark_sql(rendered)
        result = spark.sql(text, args=args) if args else spark.sql(text)
        if step.output_table:
            copy_table(result, step.output_table)
            if step.output_alias:
                aliases.add_table(step.output_alias, step.output_table)
        elif step.output_alias:
            aliases.add(step.output_alias, result)
    return aliases


@dataclass(frozen=True)
class OutputResult:
    """What one output wrote."""

    destination: str
    name: str
    rows: int | None
    is_file: bool = False
    payloads: DataFrame | None = None


def export_output(df: DataFrame, output: OutputSpec, config: ReportConfig, tokens: RunTokens) -> OutputResult:
    """Write one output; its rows are counted while they are written.

    GCS outputs are files, BQ outputs a table, API outputs batches of JSON payloads for a delivery service.
    """
    counted = Observation(f"output-{uuid.uuid4().hex[:8]}")
    observed = df.observe(counted, F.count(F.lit(1)).alias("rows"))
    if output.sink_type == "GCS":
        run_date = date.fromisoformat(tokens.run_date)
        name = report_file_name(
            config.name, config.period_id, run_date, output.output_format, output.prefix, output.suffix
        )
        path = f"{(output.path or '').rstrip('/')}/{name}"
        export_report(observed, path, output.output_format, output.include_header)
        return OutputResult(path, name, counted.get.get("rows"), is_file=True)
    if output.sink_type == "BQ":
        if not output.table:
            raise ValueError("a BQ output needs a table")
        copy_table(observed, output.table)
        return OutputResult(output.table, output.table, counted.get.get("rows"))
    # stored, so that the rows are computed once, and counted while that happens; the receiver deletes them
    batches = materialize(json_batches(observed, output.payload_rows, output.payload_bytes), "payloads", keep=True)
    return OutputResult(output.endpoint or "", output.endpoint or "", counted.get.get("rows"), payloads=batches)


def export_outputs(aliases: Aliases, config: ReportConfig, tokens: RunTokens) -> list[OutputResult]:
    """Write all outputs in order; an unknown alias is an error before anything is written.

    An alias of several outputs is computed once.
    """
    uses = Counter(output.alias for output in config.outputs)
    frames = {alias: aliases.frame(alias) for alias in uses}
    frames = {alias: materialize(df, "output") if uses[alias] > 1 else df for alias, df in frames.items()}
    return [export_output(frames[output.alias], output, config, tokens) for output in config.outputs]


def output_details(
    spark: SparkSession, report: str, outputs: list[OutputResult], user: str, at: datetime
) -> DataFrame:
    """One detail row per output."""
    rows = [(report, o.name or o.destination, at, None, o.rows, at, user, at, user) for o in outputs]
    return spark.createDataFrame(rows, DETAIL_SCHEMA)


@dataclass(frozen=True)
class ReportRun:
    run_id: int | None
    status: str
    outputs: list[OutputResult] = field(default_factory=list)
    details: DataFrame | None = None
    notification: DataFrame | None = None


def run_report(spark: SparkSession, *args, **kwargs) -> ReportRun:
    """A report from start to end, see ``_run_report``; its intermediates are deleted, payloads are the receiver's."""
    with scratch_scope(spark):
        return _run_report(spark, *args, **kwargs)


def _run_report(
    spark: SparkSession,
    config: ReportConfig,
    ledger: Ledger,
    records: DataFrame,
    tokens: RunTokens,
    user: str = "ledgerflow",
    periods: DataFrame | None = None,
    schemas: dict[str, str] | None = None,
    detail_path: str | None = None,
    run_schemas: DataFrame | None = None,
) -> ReportRun:
    """A completed report is not run again for its period unless it has the override.

    The run is opened as LOADING and closed as COMPLETED or, with the error raised, FAILED.
    """
    if periods is not None:
        find_period(periods, config.period_id)
    own = (config.name, config.period_id, config.subprocess)
    needed = [(d.datasource, config.period_id, d.subprocess) for d in config.datasources]
    runs = completed_runs(ledger.current(config.period_id), [own, *needed])
    if not config.override and own in runs:
        log.info("report %s is already completed for period %s", config.name, config.period_id)
        return ReportRun(None, COMPLETED)

    now = lambda: datetime.now(timezone.utc).replace(tzinfo=None)
    run_id = ledger.open_runs([(config.name, config.period_id, config.name, config.subprocess)], now())[0]
    aliases = Aliases(spark, config.name)
    try:
        run_sql_steps(spark, config.preprocessing, aliases, tokens)
        check_sources(config, runs)
        alias_views(aliases, config.datasources, config.period_id, runs, records, schemas, run_schemas)
        run_sql_steps(spark, config.steps, aliases, tokens)
        outputs = export_outputs(aliases, config, tokens)
        details = output_details(spark, config.name, outputs, user, now())
        if detail_path:
            details.write.mode("append").parquet(detail_path)
        notification = None
        if config.email:
            values = {"reportName": config.name, "reportSubprocess": config.subprocess, **tokens.values()}
            files = [o.destination for o in outputs if o.is_file]
            email = config.email
            notification = report_notification(spark, email.to, email.cc, email.subject, email.body, values, files)
    except Exception as error:
        ledger.close_run(run_id, FAILED, now(), json.dumps({"error": f"{type(error).__name__}: {error}".splitlines()[0]}))
        raise
    finally:
        aliases.drop()
    ledger.close_run(run_id, COMPLETED, now())
    return ReportRun(run_id, COMPLETED, outputs, details, notification)


def run_parameter_report(
    spark: SparkSession, store: DataFrame, group: str, source: str, name: str, tokens: RunTokens
) -> str:
    """The short form of a report: one SQL text, one table and one file, all from a parameter row.

    Returns the folder of the exported file.
    """
    params = fetch_parameters(store, group, source, name)
    aliases = Aliases(spark, name)
    step = SqlStep("transform", params["transform_query"], "result", params["transform_output_table"], params)
    run_sql_steps(spark, (step,), aliases, tokens)
    file_name = render_sql(params["output_file_name"], tokens, params)
    path = f"{params['output_gcs_path'].rstrip('/')}/{file_name}"
    export_report(aliases.frame("result"), path, "CSV")
    return path
