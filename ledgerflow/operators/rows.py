"""Row operators: null filter, PII hashing, JSON flattening, typed projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.functions.scalars import column, sha256_hex
from ledgerflow.result import DEAD, FAILED, ILLEGAL_ARGUMENT, ChainResult, any_null, dead_letter, payload_of, row_columns

NULL_ROW_MESSAGE = "Row contains null field(s)"
DEFAULT_PII_FIELDS = ("email", "phone", "name", "ssn", "dob")


def _start(rows: DataFrame | ChainResult) -> ChainResult:
    return rows if isinstance(rows, ChainResult) else ChainResult.start(rows)


def filter_nulls(rows: DataFrame | ChainResult) -> ChainResult:
    """Rows with any null column become dead letters.

    The accepted side is a conjunction of ``IS NOT NULL`` tests, which reach the parquet scan.
    """
    result = _start(rows)
    letter = dead_letter(payload_of(result.tagged), NULL_ROW_MESSAGE, ILLEGAL_ARGUMENT, 0)
    dropped = F.count_if(F.col(FAILED) & (F.col(DEAD)["errorMessage"] == NULL_ROW_MESSAGE))
    failed = result.fail_where(any_null(result.columns), letter)
    return failed.counting(rows_dropped_null_field=dropped)


def mask_pii(rows: DataFrame | ChainResult, fields=DEFAULT_PII_FIELDS) -> ChainResult:
    """Replace listed columns by the hex SHA-256 of their text; names match exactly, absent names are ignored."""
    result = _start(rows)
    listed = [c for c in result.columns if c in set(fields)]
    if not listed:
        return result
    masked = result.transform(lambda df: df.withColumns({c: sha256_hex(column(c), df.schema[c].dataType) for c in listed}))
    hashed = [F.count_if(~F.col(FAILED) & column(c).isNotNull()) for c in listed]
    return masked.counting(pii_fields_hashed=sum(hashed[1:], hashed[0]))


def infer_json_schema(df: DataFrame, raw: str = "raw_json") -> T.StructType:
    """One distributed pass over the JSON text to find its object schema.

    Decimal numbers of at most 15 digits become double, longer ones stay decimal; always-null fields and fields of mixed kinds become string. Text that is not an
    object is left out, flattening reports it.
    """
    objects = F.when(F.ltrim(column(raw)).startswith("{"), column(raw))
    text = df.agg(F.schema_of_variant_agg(F.try_parse_json(objects))).first()[0]
    if text is None or not text.startswith("OBJECT<"):
        raise ValueError(f"{raw} holds no JSON objects, so no schema can be inferred: {text}")
    parsed = T.StructType.fromDDL(f"r {text.replace('OBJECT<', 'STRUCT<')}")["r"].dataType
    return _widen(parsed)


def _widen(kind: T.DataType) -> T.DataType:
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _widen(f.dataType)) for f in kind])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_widen(kind.elementType))
    if isinstance(kind, T.DecimalType):
        # a double holds 15 digits; longer numbers, such as ids of 20 digits, stay exact
        return T.DoubleType() if kind.precision <= 15 else T.DecimalType(38, kind.scale)
    if isinstance(kind, (T.NullType, T.VariantType)):
        return T.StringType()
    return kind


def parse_once(df: DataFrame, document: Column) -> DataFrame:
    """Add ``_doc`` through a one-element generator.

    As a plain column the parse would be repeated in every filter and field that the optimizer moves past it.
    """
    return df.select(*[column(c) for c in df.columns], F.explode(F.array(document)).alias("_doc"))


def flatten_json(
    rows: DataFrame | ChainResult,
    schema: str | T.StructType | None = None,
    raw: str = "raw_json",
    keep_raw: bool = False,
) -> ChainResult:
    """Turn a JSON text column into typed columns; text that does not parse as an object becomes a dead letter.

    A field named like a column that is kept gets the prefix ``json_``.
    """
    result = _start(rows)
    if schema is None:
        schema = infer_json_schema(result.ok, raw)
    elif isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    corrupt = "_corrupt"
    with_corrupt = T.StructType(schema.fields + [T.StructField(corrupt, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt}
    parsed = result.transform(lambda df: parse_once(df, F.from_json(column(raw), with_corrupt, options)))
    bad = F.col("_doc").isNull() | F.col("_doc")[corrupt].isNotNull()
    letter = dead_letter(column(raw), "Malformed JSON", ILLEGAL_ARGUMENT, 0)
    checked = parsed.fail_where(bad, letter)
    kept = [c for c in result.columns if keep_raw or c != raw]

    taken = {c.lower() for c in kept}

    def spread(df: DataFrame) -> DataFrame:
        names = {f.name: f"json_{f.name}" if f.name.lower() in taken else f.name for f in schema.fields}
        fields = [F.col("_doc").getField(name).alias(new) for name, new in names.items()]
        return df.select(*[column(c) for c in kept], *fields, FAILED, DEAD)

    return checked.transform(spread)


def flatten_strict(df: DataFrame, schema: str | T.StructType | None = None, raw: str = "raw_json") -> DataFrame:
    """``flatten_json`` for inputs that must all parse: text that is not a JSON object fails the job."""
    found = infer_json_schema(df, raw) if schema is None else schema
    problem = F.concat(F.lit("not a JSON object: "), F.coalesce(column(raw), F.lit("(null)")))
    parsed = parse_once(df, F.from_json(column(raw), found, {"mode": "FAILFAST"}))
    return parsed.where(F.assert_true(F.col("_doc").isNotNull(), problem).isNull()).select("_doc.*")


# Declared type names and the types they load as.
DECLARED_TYPES = {
    "STRING": "string",
    "INTEGER": "bigint",
    "INT64": "bigint",
    "FLOAT": "double",
    "FLOAT64": "double",
    "BOOL": "boolean",
    "BOOLEAN": "boolean",
    "BYTES": "binary",
    "TIMESTAMP": "timestamp",
    "DATETIME": "timestamp",
    "DATE": "date",
}


def conform_schema(df: DataFrame, declared: dict[str, str], strict: bool = False) -> DataFrame:
    """Project to declared columns and types; unknown types load as string, absent columns as null.

    Values that do not convert become null, or fail the job when ``strict``.
    """
    present = set(df.columns)
    projected = []
    for name, type_name in declared.items():
        target = DECLARED_TYPES.get(type_name.upper(), "string")
        if name not in present:
            value = F.lit(None).cast(target)
        elif strict or target in ("string", "binary"):
            value = column(name).cast(target)
        else:
            value = column(name).try_cast(target)
        projected.append(value.alias(name))
    return df.select(*projected)


def as_strings(df: DataFrame) -> DataFrame:
    """Every column as a nullable string. Apply last: filters belong on the native types, below this projection."""
    return df.select(*[column(c).cast("string").alias(c) for c in row_columns(df)])


def check_headers(df: DataFrame, required: list[str]) -> list[str]:
    """Required column names that the frame lacks, in the given order."""
    present = set(df.columns)
    return [name for name in required if name not in present]
