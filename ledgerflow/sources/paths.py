"""Dated paths for files that land once per period or day."""

from __future__ import annotations

from datetime import date


def fill_path_tokens(template: str | None, run_date: date, period_id: str | None) -> str:
    """``{date}``, ``{dateCompact}`` and ``{periodId}`` in a template; a null template or period is empty."""
    if template is None:
        return ""
    tokens = {
        "{date}": run_date.isoformat(),
        "{dateCompact}": run_date.strftime("%Y%m%d"),
        "{periodId}": period_id or "",
    }
    for token, value in tokens.items():
        template = template.replace(token, value)
    return template


def resolve_path(
    location: str, prefix: str | None, suffix: str | None, run_date: date, period_id: str | None = None
) -> str:
    """``location/prefix+suffix`` with tokens filled."""
    base = location if location.endswith("/") else location + "/"
    return base + fill_path_tokens(prefix, run_date, period_id) + fill_path_tokens(suffix, run_date, period_id)


def dated_path(base: str, day: date) -> str:
    """``base/yyyy-MM-dd/``."""
    return f"{base.rstrip('/')}/{day.isoformat()}/"


def shard_table(table: str, day: date) -> str:
    """``table$yyyyMMdd``, the reference to one day's partition."""
    return f"{table}${day:%Y%m%d}"
