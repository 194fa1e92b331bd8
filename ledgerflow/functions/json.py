"""JSON access by path: scalar values, JSON text, arrays."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _is_container(text: Column) -> Column:
    """Whether JSON text is an object or array; extracted values start with their bracket."""
    return F.substring(text, 1, 1).isin("{", "[")


def json_path(dotted: str | None) -> str:
    """``a.b`` as a quoted JSON path; blank is the root."""
    if not dotted or not dotted.strip():
        return "$"
    return "$" + "".join(f"['{part}']" for part in dotted.split("."))


def json_value(doc: Column, path: str) -> Column:
    """The scalar at ``path`` as text; null for objects, arrays and missing values.

    Text that merely looks like an object is told apart by its parsed type, checked only for such text.
    """
    text = F.get_json_object(doc, path)
    is_text = F.schema_of_variant(F.try_variant_get(F.try_parse_json(doc), path, "variant")) == "STRING"
    return F.when(_is_container(text) & ~F.coalesce(is_text, F.lit(False)), None).otherwise(text)


def json_query(doc: Column, path: str) -> Column:
    """JSON text of the value at ``path``; scalars keep their JSON form."""
    return F.to_json(F.try_variant_get(F.try_parse_json(doc), path, "variant"))


def json_array(doc: Column, dotted: str | None, strict: bool = True) -> Column:
    """The array at a dot path as ``array<variant>``; null when the value is not an array."""
    parsed = F.parse_json(doc) if strict else F.try_parse_json(doc)
    return F.try_variant_get(parsed, json_path(dotted), "array<variant>")


def with_json_fields(df: DataFrame, doc: str, names: dict[str, str]) -> DataFrame:
    """Add scalars of a document column as text columns: ``names`` maps JSON fields to column names.

    Top-level fields come from one parse of the document, as a generator that runs once per row. It returns nested
    values as JSON text; only those rare values take the slower exact path. Dotted fields are read by path.
    """
    flat = {f: c for f, c in names.items() if "." not in f}
    kept = [F.col(f"`{c}`") for c in df.columns]
    parsed = df
    if flat:
        raw = [f"_json_{c}" for c in flat.values()]
        parsed = df.select(*kept, F.json_tuple(F.col(f"`{doc}`"), *flat).alias(*raw))
    values = []
    for field, name in names.items():
        if field in flat:
            text = F.col(f"`_json_{name}`")
            exact = json_value(F.col(f"`{doc}`"), json_path_of_key(field))
            value = F.when(_is_container(text), exact).otherwise(text)
        else:
            value = json_value(F.col(f"`{doc}`"), json_path(field))
        values.append(value.alias(name))
    return parsed.select(*kept, *values)


def json_path_of_key(name: str) -> str:
    """Path of one top-level key, plain where possible."""
    return f"$.{name}" if re.fullmatch(r"\w+", name) else f"$['{name}']"


def register_json_functions(spark: SparkSession) -> None:
    """Define ``JSON_VALUE`` and ``JSON_QUERY`` for SQL text; both are expressions that the optimizer inlines."""
    spark.sql("""
        CREATE OR REPLACE TEMPORARY FUNCTION json_value(doc STRING, path STRING) RETURNS STRING RETURN
        CASE WHEN substring(get_json_object(doc, path), 1, 1) IN ('{', '[') AND NOT coalesce(
            schema_of_variant(try_variant_get(try_parse_json(doc), path, 'variant')) = 'STRING', false)
        THEN NULL ELSE get_json_object(doc, path) END
    """)
    spark.sql("""
        CREATE OR REPLACE TEMPORARY FUNCTION json_query(doc STRING, path STRING) RETURNS STRING RETURN
        to_json(try_variant_get(try_parse_json(doc), path, 'variant'))
    """)
