"""The record store: loaded rows as JSON, kept by run."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.functions.json import json_path, json_path_of_key, json_value, with_json_fields
from ledgerflow.functions.scalars import column, is_integral, plain_number, row_json, type_of
from ledgerflow.operators.rows import infer_json_schema, parse_once

RECORD_SCHEMA = "RecId string, DaId bigint, RowDaJsonTx string, LoadDt date, LstUpdtTs timestamp"


def to_records(df: DataFrame, run_id: int | Column, loaded_at: datetime) -> DataFrame:
    """Rows as records of a run. Load date and time are fixed once per run, ids are random per row."""
    identity = run_id if isinstance(run_id, Column) else F.lit(run_id)
    return df.select(
        F.expr("uuid()").alias("RecId"),
        identity.cast("bigint").alias("DaId"),
        row_json(df.columns).alias("RowDaJsonTx"),
        F.lit(loaded_at.date()).alias("LoadDt"),
        F.lit(loaded_at).cast("timestamp").alias("LstUpdtTs"),
    )


def write_records(records: DataFrame, path: str) -> None:
    """Append records, partitioned by run, so that reading one run touches only its files."""
    records.write.mode("append").partitionBy("DaId").parquet(path)


def read_records(spark, path: str) -> DataFrame:
    return spark.read.schema(RECORD_SCHEMA).parquet(path)


def run_rows(
    records: DataFrame, run_id: int | list[int], schema: str | T.StructType | None = None, keep_json: bool = True
) -> DataFrame:
    """Every row of a run, or of several, with its JSON fields as columns; without a schema they are found in the data.

    A value that does not fit its field's type is null in that field, as is every field of a text that is no object: a
    stored row is never left out. A field named like the JSON column gives way to it.
    """
    mine = F.col("DaId").isin(run_id) if isinstance(run_id, list) else F.col("DaId") == run_id
    chosen = records.where(mine).select("RowDaJsonTx")
    if schema is None:
        schema = infer_json_schema(chosen, "RowDaJsonTx")
    elif isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    parsed = parse_once(chosen, F.from_json(F.col("RowDaJsonTx"), schema))
    names = [f.name for f in schema.fields if not (keep_json and f.name.lower() == "rowdajsontx")]
    kept = [F.col("RowDaJsonTx")] if keep_json else []
    return parsed.select(*kept, *[F.col("_doc").getField(n).alias(n) for n in names])


def control_values(df: DataFrame, field: str) -> tuple[Column, Column]:
    """(whether a field has a value, its number or null) of rows on their way into the store.

    Both are what ``run_totals`` finds in the stored JSON. Numbers and texts are read as they are; other values, and
    fields with a dot, which are paths, go through the JSON of their column.
    """
    top = field.split(".")[0]
    if top not in df.columns:
        return F.lit(False), F.lit(None).cast("double")
    kind, value = type_of(df, top), column(top)
    if field == top and (is_integral(kind) or isinstance(kind, (T.DoubleType, T.DecimalType))):
        number = value.cast("double")
        finite = ~F.isnan(number) & (F.abs(number) != F.lit(float("inf")))
        return value.isNotNull(), F.when(finite, number)
    if field == top and isinstance(kind, T.StringType):
        return value.isNotNull(), plain_number(value)
    path = json_path(field) if "." in field else json_path_of_key(field)
    text = json_value(F.to_json(F.struct(value.alias(top))), path)
    return text.isNotNull(), plain_number(text)


def control_metrics(df: DataFrame, fields: list[str]) -> dict[str, Column]:
    """Row count and, per field, the sum and the number of unreadable values, to be observed while rows are written."""
    found = {"rows": F.count(F.lit(1))}
    for i, field in enumerate(fields):
        given, number = control_values(df, field)
        found[f"sum_{i}"] = F.coalesce(F.sum(number), F.lit(0.0))
        found[f"bad_{i}"] = F.count_if(given & number.isNull())
    return found


def observed_totals(fields: list[str], metrics: dict) -> tuple[int, dict[str, float], dict[str, int]]:
    """Row count, sums and numbers of unreadable values from what was observed of a run."""
    sums = {f: metrics[f"sum_{i}"] for i, f in enumerate(fields)}
    return metrics["rows"], sums, {f: metrics[f"bad_{i}"] for i, f in enumerate(fields)}


def run_totals(records: DataFrame, fields: list[str], keys: tuple[str, ...] = ("DaId",)) -> DataFrame:
    """Row count and, per field, the sum and the number of unreadable values, for all runs in one aggregation.

    Adds the maps ``sums`` and ``bad``; a field never present sums to 0.0. Each document is parsed once, and the sums
    are partial on the map side, so a run holding most of the rows is no hot spot.
    """
    documents = records.select(*keys, "RowDaJsonTx")
    texts = with_json_fields(documents, "RowDaJsonTx", {f: f"_t{i}" for i, f in enumerate(fields)})
    numbers = {f"_n{i}": plain_number(F.col(f"_t{i}")) for i, _ in enumerate(fields)}
    given = {f"_g{i}": F.col(f"_t{i}").isNotNull() for i, _ in enumerate(fields)}
    numbered = texts.select(*keys, *[value.alias(name) for name, value in {**numbers, **given}.items()])
    aggregates = [F.count(F.lit(1)).alias("row_count")]
    for i, _ in enumerate(fields):
        aggregates.append(F.coalesce(F.sum(f"_n{i}"), F.lit(0.0)).alias(f"_s{i}"))
        aggregates.append(F.count_if(F.col(f"_g{i}") & F.col(f"_n{i}").isNull()).alias(f"_b{i}"))
    totals = numbered.groupBy(*keys).agg(*aggregates)
    sums = [part for i, f in enumerate(fields) for part in (F.lit(f), F.col(f"_s{i}"))]
    bad = [part for i, f in enumerate(fields) for part in (F.lit(f), F.col(f"_b{i}"))]
    empty = "map<string,{}>"
    return totals.select(
        *keys,
        "row_count",
        (F.create_map(*sums) if sums else F.create_map().cast(empty.format("double"))).alias("sums"),
        (F.create_map(*bad) if bad else F.create_map().cast(empty.format("bigint"))).alias("bad"),
    )
