"""Checked queries: each operator over the driver's tables, with an equivalent SQL text."""

from __future__ import annotations

from ledgerflow.queries import edges, grouping, joins, loads, reports, rows, runs, sources, streams
from ledgerflow.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "edges", "grouping", "joins", "loads", "reports", "rows", "runs", "sources", "streams"]
