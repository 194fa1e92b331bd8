"""Sink dispatch by configured type."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql.streaming.query import StreamingQuery

from ledgerflow.sinks.files import write_json_lines
from ledgerflow.sinks.messages import write_messages
from ledgerflow.sinks.tables import write_table


@dataclass(frozen=True)
class SinkSpec:
    """Where a chain writes: ``GCS`` (JSON-line files), ``BQ`` (a table) or ``PUBSUB`` (messages)."""

    sink_type: str
    path: str | None = None
    table: str | None = None
    disposition: str = "TRUNCATE"
    message_format: str = "kafka"
    checkpoint: str | None = None
    options: dict[str, str] = field(default_factory=dict)


def _files(df: DataFrame, spec: SinkSpec) -> None:
    if not spec.path:
        raise ValueError("a GCS sink needs a path")
    write_json_lines(df, spec.path)


def _table(df: DataFrame, spec: SinkSpec) -> None:
    if not spec.table:
        raise ValueError("a BQ sink needs a table")
    write_table(df, spec.table, spec.disposition)


def _messages(df: DataFrame, spec: SinkSpec) -> StreamingQuery | None:
    return write_messages(df, spec.message_format, spec.checkpoint, **spec.options)


SINKS = {"GCS": _files, "BQ": _table, "PUBSUB": _messages}


def write_sink(df: DataFrame, spec: SinkSpec) -> StreamingQuery | None:
    """Write to exactly the configured sink."""
    kind = (spec.sink_type or "").upper()
    if kind not in SINKS:
        raise ValueError(f"unknown sink type {spec.sink_type!r}; use one of {', '.join(SINKS)}")
    return SINKS[kind](df, spec)
