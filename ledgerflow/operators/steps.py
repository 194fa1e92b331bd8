"""Per-source chains of LOOKUP, GROUP_BY and SORT_BY, as configured in JSON."""

from __future__ import annotations

import json
import logging
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from ledgerflow.operators.grouping import Aggregation, group_by
from ledgerflow.operators.lookup import lookup_enrich
from ledgerflow.operators.sorting import sort_rows

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class LookupStep:
    table: str
    lookup_key: str
    data_key: str
    output_fields: tuple[str, ...] = ()


@dataclass(frozen=True)
class GroupByStep:
    fields: tuple[str, ...]
    aggregations: tuple[Aggregation, ...]


@dataclass(frozen=True)
class SortByStep:
    fields: tuple[str, ...]
    descending: bool = False


Step = LookupStep | GroupByStep | SortByStep


def _names(value) -> tuple[str, ...]:
    return tuple(str(v) for v in value) if isinstance(value, list) else ()


def _step(node: dict) -> Step | None:
    kind = str(node.get("type", "")).upper()
    if kind == "LOOKUP":
        return LookupStep(
            table=node.get("lookupBqTableRef", ""),
            lookup_key=node.get("lookupKeyField", ""),
            data_key=node.get("dataKeyField", ""),
            output_fields=_names(node.get("lookupOutputFields")),
        )
    if kind == "GROUP_BY":
        found = node.get("aggregations")
        aggregations = tuple(
            Aggregation(a.get("field", ""), a.get("function", ""), a.get("outputField", ""))
            for a in (found if isinstance(found, list) else [])
        )
        return GroupByStep(_names(node.get("groupByFields")), aggregations)
    if kind == "SORT_BY":
        return SortByStep(_names(node.get("sortByFields")), str(node.get("sortDescending")).lower() == "true")
    log.warning("unknown source transform type %r skipped", node.get("type"))
    return None


def parse_steps(text: str | None) -> list[Step]:
    """Steps from chain JSON; unknown types are skipped, blank or unreadable JSON is an empty chain."""
    if not text or not text.strip():
        return []
    try:
        nodes = json.loads(text)
        return [s for node in nodes if (s := _step(node))] if isinstance(nodes, list) else []
    except (ValueError, AttributeError) as error:
        log.error("source transforms could not be read: %s", error)
        return []


def apply_step(df: DataFrame, step: Step, read_lookup: Callable[[str], DataFrame]) -> DataFrame:
    """One step. A stream takes lookups only: grouping and sorting need the whole input."""
    if df.isStreaming and not isinstance(step, LookupStep):
        raise ValueError(f"{type(step).__name__} cannot run on a stream")
    if isinstance(step, LookupStep):
        return lookup_enrich(df, read_lookup(step.table), step.lookup_key, step.data_key, step.output_fields)
    if isinstance(step, GroupByStep):
        return group_by(df, list(step.fields), list(step.aggregations))
    return sort_rows(df, list(step.fields), step.descending)


def apply_steps(df: DataFrame, steps: list[Step], read_lookup: Callable[[str], DataFrame] | None = None) -> DataFrame:
    """Run the steps left to right; ``read_lookup`` opens a lookup table by its reference."""
    read = read_lookup or (lambda name: df.sparkSession.table(name.replace(":", ".")))
    for step in steps:
        df = apply_step(df, step, read)
    return df
