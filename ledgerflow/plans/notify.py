"""Notification rows: who is told what. Sending is left to a mail system that reads the rows."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.functions.tokens import fill_column


def split_addresses(text: Column) -> Column:
    """A comma list as trimmed, non-blank addresses."""
    parts = F.transform(F.split(F.coalesce(text, F.lit("")), ","), lambda part: F.trim(part))
    return F.filter(parts, lambda part: part != "")


def parse_addresses(text: str | None) -> list[str]:
    """A configured address list: a JSON array or a comma list."""
    if not text or not text.strip():
        return []
    if text.strip().startswith("["):
        try:
            return [str(a) for a in json.loads(text)]
        except ValueError:
            pass
    return [a.strip() for a in text.split(",") if a.strip()]


def notification_rows(df: DataFrame, tokens: dict[str, Column | str | None] | None = None) -> DataFrame:
    """``to, subject, body, cc`` with tokens filled; rows with a blank ``to`` are skipped, ``cc`` may be absent."""
    addressed = df.where(F.coalesce(F.trim("to"), F.lit("")) != "")
    cc = split_addresses(F.col("cc")) if "cc" in df.columns else F.array().cast("array<string>")
    values = tokens or {}
    return addressed.select(
        "to",
        fill_column(F.coalesce("subject", F.lit("")), values).alias("subject"),
        fill_column(F.coalesce("body", F.lit("")), values).alias("body"),
        cc.alias("cc"),
    )


def report_notification(
    spark: SparkSession, to_list: list[str], cc_list: list[str], subject: str | None, body: str | None,
    tokens: dict[str, str], attachments: list[str],
) -> DataFrame:
    """One notification row for a finished report, with the paths of its file outputs."""
    rows = [(",".join(to_list), subject or "", body or "", ",".join(cc_list))]
    base = spark.createDataFrame(rows, "to string, subject string, body string, cc string")
    listed = F.array(*[F.lit(a) for a in attachments]) if attachments else F.array()
    return notification_rows(base, tokens).withColumn("attachments", listed.cast("array<string>"))
