"""The parameter store: values and required fields per parameter group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_KEYS = ("ParameterGroupName", "ParameterDataSource", "ParameterName")


class MissingParametersError(ValueError):
    """A parameter row is absent or lacks required values."""


def required_fields(schema_json: Column) -> Column:
    """Names whose spec says ``"required": true``; blank or unreadable schema JSON requires nothing."""
    specs = F.from_json(schema_json, "map<string,string>")
    flag = lambda spec: F.lower(F.trim(F.coalesce(F.get_json_object(spec, "$.required"), F.lit("false"))))
    truthy = lambda name, spec: (flag(spec) == "true") | (flag(spec).try_cast("double") != 0)
    names = F.map_keys(F.map_filter(specs, lambda k, v: F.coalesce(truthy(k, v), F.lit(False))))
    return F.coalesce(names, F.array().cast("array<string>"))


def parameter_values(values_json: Column) -> Column:
    """Values as a string map; blank or unreadable JSON is an empty map."""
    return F.coalesce(F.from_json(values_json, "map<string,string>"), F.create_map().cast("map<string,string>"))


def missing_parameters(store: DataFrame) -> DataFrame:
    """Per parameter row, the required fields without a value, in schema order; rows that lack none are left out.

    Array expressions inside each row: no explode, no join, no shuffle.
    """
    values = parameter_values(F.col("ParametersValJson"))
    checked = store.withColumn("_values", values).withColumn("_required", required_fields(F.col("SchemaOfJson")))
    missing = F.filter("_required", lambda name: F.try_element_at(F.col("_values"), name).isNull())
    return checked.select(*_KEYS, missing.alias("missing")).where(F.size("missing") > 0)


def fetch_parameters(store: DataFrame, group: str, source: str, name: str) -> dict[str, str | None]:
    """The values of one parameter row; an absent row or a missing required value is an error."""
    chosen = store.where(
        (F.col("ParameterGroupName") == group)
        & (F.col("ParameterDataSource") == source)
        & (F.col("ParameterName") == name)
    )
    label = f"{group}/{source}/{name}"
    row = chosen.select(
        parameter_values(F.col("ParametersValJson")).alias("values"),
        required_fields(F.col("SchemaOfJson")).alias("required"),
    ).first()
    if row is None:
        raise MissingParametersError(f"no parameter row for {label}")
    missing = [field for field in row["required"] if row["values"].get(field) is None]
    if missing:
        raise MissingParametersError(f"required parameters missing for {label}: {missing}")
    return row["values"]
