"""File sinks: JSON lines, dead letters, report exports."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame

from ledgerflow.sources.paths import fill_path_tokens

log = logging.getLogger(__name__)


def write_json_lines(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One JSON object per row with nulls written out; one file per partition."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def write_dead_letters(dead: DataFrame, path: str | None, mode: str = "append") -> bool:
    """Dead letters as JSON lines; without a path they are discarded with a warning."""
    if not path or not path.strip():
        log.warning("no dead-letter path is set: dead letters are discarded")
        return False
    write_json_lines(dead, path, mode)
    return True


def report_file_name(
    report: str, period_id: str | None, run_date, output_format: str = "CSV", prefix=None, suffix=None
) -> str:
    """``{prefix}{report}_{period}_{runDate}{suffix}`` plus the extension of the format."""
    head = fill_path_tokens(prefix, run_date, period_id)
    tail = fill_path_tokens(suffix, run_date, period_id)
    extension = "csv" if output_format.upper() == "CSV" else "json"
    return f"{head}{report}_{period_id or ''}_{run_date.isoformat()}{tail}.{extension}"


def export_report(df: DataFrame, path: str, output_format: str = "CSV", header: bool = True) -> None:
    """Write a report result as CSV or JSON lines under ``path``, in the frame's partition order.

    Cells keep their blanks, and a quote inside a cell is doubled. The result is a folder of part files, so that an export of any size has parallel writers.
    """
    kind = (output_format or "CSV").upper()
    if kind == "CSV":
        df.write.mode("overwrite").csv(
            path, header=header, emptyValue="", escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
        )
    elif kind in ("JSON", "JSONL", "NEWLINE_DELIMITED_JSON"):
        write_json_lines(df, path)
    else:
        raise ValueError(f"unknown output format {output_format!r}; use CSV or JSON")
