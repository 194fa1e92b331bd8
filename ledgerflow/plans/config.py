"""Configuration tables: sources and reports, by their keys."""

from __future__ import annotations

import json
import logging
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.operators.steps import Step, parse_steps
from ledgerflow.plans.control import DEFAULT_TOLERANCE, NO_MAX, ControlRule, Validation
from ledgerflow.plans.notify import parse_addresses
from ledgerflow.sources.pages import DEFAULT_PAGE_SIZE
from ledgerflow.sources.router import SourceSpec

log = logging.getLogger(__name__)


class ConfigError(ValueError):
    """Configuration is missing or unusable."""


def _json(text: str | None, kind: type):
    """JSON of the wanted kind, else an empty one."""
    if not text or not text.strip():
        return kind()
    try:
        value = json.loads(text)
    except ValueError as error:
        log.warning("configuration JSON could not be read: %s", error)
        return kind()
    return value if isinstance(value, kind) else kind()


def _string_map(text: str | None) -> dict[str, str | None]:
    return {k: None if v is None else str(v) for k, v in _json(text, dict).items()}


def parse_rules(text: str | None) -> tuple[ControlRule, ...]:
    """Control rules from JSON; an absent tolerance is 1%."""
    rules = []
    for node in _json(text, list):
        tolerance = node.get("tolerancePct")
        rules.append(
            ControlRule(
                field=str(node.get("field", "")),
                expected_total=float(node.get("expectedTotal") or 0.0),
                tolerance=DEFAULT_TOLERANCE if tolerance is None else float(tolerance),
            )
        )
    return tuple(rules)


@dataclass(frozen=True)
class SourceConfig:
    parent_id: str
    datasource: str
    subprocess: str
    period_id: str
    spec: SourceSpec
    steps: list[Step]
    validation: Validation

    @property
    def location(self) -> str:
        """What the ledger names as the source's location."""
        return self.spec.table or self.spec.path or self.datasource


def _source_spec(row: dict) -> SourceSpec:
    kind = (row.get("source_type") or "").upper()
    params = _string_map(row.get("query_params_json"))
    if kind == "BQ":
        parts = [row.get("bq_project_id"), row.get("bq_dataset"), row.get("bq_table")]
        table = ".".join(p for p in parts if p) or None
        return SourceSpec("BQ", table=table, query=row.get("bq_query"), query_params=params)
    if kind == "FILE":
        return SourceSpec(
            "FILE",
            path=row.get("file_location"),
            file_type=row.get("file_type") or "CSV",
            prefix=row.get("file_prefix"),
            suffix=row.get("file_suffix"),
            delimiter=row.get("file_delimiter") or ",",
            has_header=bool(row.get("file_has_header")),
            sheet_index=row.get("file_sheet_index") or 0,
        )
    if kind == "API":
        return SourceSpec(
            "API",
            path=row.get("api_endpoint"),
            pagination_enabled=bool(row.get("api_pagination_enabled")),
            pagination_strategy=row.get("api_pagination_strategy"),
            page_size=DEFAULT_PAGE_SIZE if row.get("api_page_size") is None else row["api_page_size"],
            next_page_field=row.get("api_next_page_field"),
            data_array_field=row.get("api_data_array_field"),
        )
    raise ConfigError(f"source_type {row.get('source_type')!r} is not supported in a period load")


def source_configs(table: DataFrame, parent: str, datasource: str, subprocess: str, period: str) -> list[SourceConfig]:
    """Configurations with the given key; none is an error."""
    chosen = table.where(
        (F.col("parent_id") == parent)
        & (F.col("datasource_name") == datasource)
        & (F.col("subprocess_name") == subprocess)
        & (F.col("period_id") == period)
    )
    found = []
    for row in (r.asDict() for r in chosen.collect()):
        maximum = row.get("max_row_count")
        found.append(
            SourceConfig(
                parent_id=row["parent_id"],
                datasource=row["datasource_name"],
                subprocess=row["subprocess_name"],
                period_id=row["period_id"],
                spec=_source_spec(row),
                steps=parse_steps(row.get("source_transforms_json")),
                validation=Validation(
                    min_rows=row.get("min_row_count") or 0,
                    max_rows=NO_MAX if maximum is None else maximum,
                    required_headers=tuple(_json(row.get("required_headers_json"), list)),
                    rules=parse_rules(row.get("bnc_rules_json")),
                ),
            )
        )
    if not found:
        raise ConfigError(f"source_config row missing for ({parent}, {datasource}, {subprocess}, {period})")
    return found


@dataclass(frozen=True)
class DatasourceRef:
    datasource: str
    subprocess: str | None
    alias: str
    required: bool = False


@dataclass(frozen=True)
class SqlStep:
    """One ordered SQL step; ``output_table`` materialises its result."""

    name: str
    query: str
    output_alias: str = ""
    output_table: str | None = None
    params: dict[str, str | None] = field(default_factory=dict)
    kind: str = "BQ_QUERY"


@dataclass(frozen=True)
class OutputSpec:
    alias: str
    sink_type: str = "GCS"
    output_format: str = "CSV"
    path: str | None = None
    prefix: str | None = None
    suffix: str | None = None
    include_header: bool = True
    table: str | None = None
    endpoint: str | None = None
    #: Rows of one request payload of an API output; a payload holds the rows of one partition at most.
    payload_rows: int = 1000
    #: Bytes of one request payload, if the service has a bound; a row that is larger by itself is sent alone.
    payload_bytes: int | None = None


@dataclass(frozen=True)
class EmailSpec:
    to: list[str]
    cc: list[str]
    subject: str | None
    body: str | None


@dataclass(frozen=True)
class ReportConfig:
    name: str
    subprocess: str
    period_id: str
    override: bool = False
    datasources: tuple[DatasourceRef, ...] = ()
    preprocessing: tuple[SqlStep, ...] = ()
    steps: tuple[SqlStep, ...] = ()
    outputs: tuple[OutputSpec, ...] = ()
    email: EmailSpec | None = None


def parse_sink_type(text: str | None) -> str:
    """Blank is GCS; anything but GCS, BQ or API is an error."""
    kind = (text or "").strip().upper() or "GCS"
    if kind not in ("GCS", "BQ", "API"):
        raise ConfigError(f"unknown sink_type {text!r} in report outputs; use GCS, BQ or API")
    return kind


def report_config(tables: dict[str, DataFrame], name: str, subprocess: str, period: str) -> ReportConfig:
    """A report's configuration from the six report tables; tables other than ``report_config`` may be absent."""

    def rows(table: str, order: str) -> list[dict]:
        if table not in tables:
            return []
        mine = tables[table].where(
            (F.col("report_name") == name) & (F.col("report_subprocess") == subprocess) & (F.col("period_id") == period)
        )
        return [r.asDict() for r in (mine.orderBy(order) if order else mine).collect()]

    heads = rows("report_config", "")
    if not heads:
        raise ConfigError(f"no report_config found for report={name} subprocess={subprocess} period={period}")
    emails = rows("report_email_config", "")
    return ReportConfig(
        name,
        subprocess,
        period,
        override=bool(heads[0].get("override_key")),
        datasources=tuple(
            DatasourceRef(r["datasource_name"], r.get("datasource_subprocess"), r["transform_alias"], bool(r.get("is_required")))
            for r in rows("report_datasource_ref", "datasource_name")
        ),
        preprocessing=tuple(
            SqlStep(
                r["step_name"], r.get("bq_query") or "", output_table=r.get("bq_output_table"),
                params=_string_map(r.get("query_params_json")), kind=r["step_type"],
            )
            for r in rows("report_preprocessing_config", "step_order")
        ),
        steps=tuple(
            SqlStep(
                r["step_name"], r["query_template"], r["output_alias"], r.get("output_bq_table"),
                _string_map(r.get("query_params_json")),
            )
            for r in rows("report_transformation_config", "step_order")
        ),
        outputs=tuple(
            OutputSpec(
                r["input_alias"], parse_sink_type(r.get("sink_type")), r.get("output_format") or "CSV", r.get("gcs_path"),
                r.get("file_prefix"), r.get("file_suffix"), bool(r.get("include_header")), r.get("bq_sink_table"),
                r.get("api_endpoint"),
            )
            for r in rows("report_output_config", "output_order")
        ),
        email=EmailSpec(
            parse_addresses(emails[0].get("to_list")), parse_addresses(emails[0].get("cc_list")),
            emails[0].get("subject_template"), emails[0].get("body_template"),
        )
        if emails
        else None,
    )
