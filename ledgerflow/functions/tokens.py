"""Template tokens in SQL, paths and messages."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from datetime import date, datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F


def resolve_run_date(text: str | None) -> str:
    """An ISO date as text; blank is today in UTC, bad text is an error."""
    if not text or not text.strip():
        return datetime.now(timezone.utc).date().isoformat()
    return date.fromisoformat(text.strip()).isoformat()


@dataclass(frozen=True)
class RunTokens:
    """The standard tokens of a run."""

    period_start: str | None = None
    period_end: str | None = None
    period_id: str | None = None
    run_date: str = field(default_factory=lambda: resolve_run_date(None))

    def values(self) -> dict[str, str]:
        return {
            "periodStart": self.period_start or "",
            "periodEnd": self.period_end or "",
            "periodId": self.period_id or "",
            "runDate": self.run_date,
        }


def fill(template: str, values: dict[str, str]) -> str:
    """Replace ``{name}`` by its value, in the order given; unknown tokens stay."""
    for name, value in values.items():
        template = template.replace("{" + name + "}", value)
    return template


def render_sql(
    template: str | None,
    tokens: RunTokens,
    params: dict[str, str | None] | None = None,
    aliases: dict[str, str] | None = None,
) -> str | None:
    """Fill a template: aliases first, then standard tokens, then custom parameters.

    A custom value may hold standard tokens; a null value is empty. Values that are data rather than names are better
    bound with ``spark.sql(text, args=…)``.
    """
    if template is None or not template.strip():
        return template
    standard = tokens.values()
    text = fill(fill(template, aliases or {}), standard)
    custom = {name: fill(value or "", standard) for name, value in (params or {}).items()}
    return fill(text, custom)


def fill_column(template: Column, values: dict[str, Column | str | None]) -> Column:
    """``fill`` for a column of templates."""
    for name, value in values.items():
        replacement = value if isinstance(value, Column) else F.lit(value or "")
        template = F.replace(template, F.lit("{" + name + "}"), F.coalesce(replacement, F.lit("")))
    return template


def compose(template: str, **parts: Column | str) -> Column:
    """A text column from a template whose ``{name}`` parts are columns or constants; null if a part is null."""
    pieces = re.split(r"\{(\w+)\}", template)
    columns = []
    for i, piece in enumerate(pieces):
        value = parts[piece] if i % 2 else piece
        if isinstance(value, Column):
            columns.append(value.cast("string"))
        elif value:
            columns.append(F.lit(value))
    return F.concat(*columns)
