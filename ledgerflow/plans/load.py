"""The period load: sources to the record store, then control checks and run status."""

from __future__ import annotations

import json
import logging
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.functions.tokens import RunTokens
from ledgerflow.metrics import observed
from ledgerflow.operators.rows import check_headers, flatten_strict
from ledgerflow.operators.steps import apply_steps
from ledgerflow.plans.config import SourceConfig
from ledgerflow.plans.control import FAILED, RunFacts, control_check, expectations
from ledgerflow.plans.ledger import Ledger, pending_sources
from ledgerflow.plans.periods import find_period
from ledgerflow.plans.records import control_metrics, observed_totals, to_records, write_records
from ledgerflow.plans.schemas import schema_folder, schema_rows, write_run_schemas
from ledgerflow.session import scratch_scope
from ledgerflow.sources.router import read_source
from ledgerflow.sources.text import RAW

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class RunStatus:
    source: str
    run_id: int
    status: str
    summary: str


@dataclass(frozen=True)
class _Branch:
    records: DataFrame
    schema: T.StructType
    fields: list[str]
    sent: Observation
    stored: Observation
    missing_headers: tuple[str, ...]


def _branch(
    spark: SparkSession, config: SourceConfig, run_id: int, tokens: RunTokens, at: datetime, read_lookup
) -> _Branch:
    """One source's records. Rows and control fields are summed up where they leave the source's steps, and records are
    counted where they enter the store, both in the job that writes them.

    Raw JSON sources are flattened first, so that steps and control rules find their fields; text that is not a JSON
    object fails the load.
    """
    source = read_source(spark, config.spec, tokens, mode="load")
    if source.columns == [RAW]:
        source = flatten_strict(source, config.spec.schema)
    missing = check_headers(source, list(config.validation.required_headers))
    if missing:
        log.error("source %s lacks required headers: %s", config.datasource, missing)
    rows = apply_steps(source, config.steps, read_lookup)
    fields = list(dict.fromkeys(rule.field for rule in config.validation.rules))
    sent_rows, sent = observed(rows, f"sent-{run_id}", control_metrics(rows, fields))
    records, stored = observed(to_records(sent_rows, run_id, at), f"stored-{run_id}", {"rows": F.count(F.lit(1))})
    return _Branch(records, rows.schema, fields, sent, stored, tuple(missing))


def _totals(branch: _Branch) -> tuple:
    return observed_totals(branch.fields, {**branch.sent.get, "rows": branch.stored.get["rows"]})


def load_period(spark: SparkSession, *args, **kwargs) -> list[RunStatus]:
    """Load a period, see ``_load_period``; what it writes besides records and ledger is deleted at the end."""
    with scratch_scope(spark):
        return _load_period(spark, *args, **kwargs)


def _load_period(
    spark: SparkSession,
    configs: list[SourceConfig],
    ledger: Ledger,
    record_path: str,
    tokens: RunTokens,
    override: bool = False,
    periods: DataFrame | None = None,
    read_lookup=None,
    schema_path: str | None = None,
) -> list[RunStatus]:
    """Load all pending sources in one write, which also gives the figures that are checked.

    The fields of each run are written beside the record store. Sources that already have a COMPLETED run for their period are skipped unless ``override``. A run whose controls do
    not match ends as FAILED_BNC and is returned, not raised; a failing job closes its runs as FAILED, with a document
    that says why, and is raised.
    """
    if periods is not None:
        for period_id in {c.period_id for c in configs}:
            find_period(periods, period_id)
    keys = [(c.datasource, c.period_id, c.subprocess) for c in configs]
    wanted = set(keys)
    if not override:
        listed = spark.createDataFrame(keys, "SrceNm string, PerId string, SubNm string")
        wanted = {tuple(r) for r in pending_sources(listed, ledger.current()).collect()}
    pending = [c for c in configs if (c.datasource, c.period_id, c.subprocess) in wanted]
    if not pending:
        log.info("every source already has a completed run")
        return []

    at = _now()
    run_ids = ledger.open_runs([(c.datasource, c.period_id, c.location, c.subprocess) for c in pending], at)
    try:
        branches = {i: _branch(spark, c, i, tokens, at, read_lookup) for c, i in zip(pending, run_ids)}
        write_records(reduce(DataFrame.unionByName, [b.records for b in branches.values()]), record_path)
        fields = [row for i, b in branches.items() for row in schema_rows(i, b.schema)]
        write_run_schemas(spark, fields, schema_path or schema_folder(record_path))
        facts = {
            i: (c.validation, RunFacts(b.sent.get["rows"], b.missing_headers)) for c, (i, b) in zip(pending, branches.items())
        }
        totals = {i: _totals(b) for i, b in branches.items()}
        checked = control_check(expectations(spark, facts, totals)).collect()
    except Exception as error:
        document = json.dumps({"error": f"{type(error).__name__}: {str(error).strip().splitlines()[0] if str(error) else ''}"})
        ledger.close_runs([(i, FAILED, document) for i in run_ids], _now())
        raise
    ledger.close_runs([(r["DaId"], r["StaCd"], r["BalAndCntlSmryTx"]) for r in checked], _now())
    names = dict(zip(run_ids, (c.datasource for c in pending)))
    return [RunStatus(names[r["DaId"]], r["DaId"], r["StaCd"], r["BalAndCntlSmryTx"]) for r in checked]


def _now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)
