"""The fields of each run, written with its records, so that readers need not look for them in the data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RUN_SCHEMA = "DaId bigint, FieldNm string, TypeTx string, OrdNo int"
_INTEGRAL = ("tinyint", "smallint", "int", "bigint")
_NUMERIC = (*_INTEGRAL, "float", "double")


def schema_folder(record_path: str) -> str:
    """Where the schemas of a record store's runs are, beside it."""
    return f"{record_path.rstrip('/')}-schema"


def schema_rows(run_id: int, schema: T.StructType) -> list[tuple[int, str, str, int]]:
    return [(run_id, f.name, f.dataType.simpleString(), i) for i, f in enumerate(schema.fields)]


def write_run_schemas(spark: SparkSession, rows: list[tuple[int, str, str, int]], path: str) -> None:
    """Append the fields of a load's runs; there is one row for each field of a configured source."""
    if rows:
        spark.createDataFrame(rows, RUN_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def read_run_schemas(spark: SparkSession, path: str) -> DataFrame:
    """The stored fields; none where no run has stored any."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        return spark.createDataFrame([], RUN_SCHEMA)
    return spark.read.schema(RUN_SCHEMA).parquet(path)


def merged_fields(run_schemas: DataFrame, *keys: str) -> DataFrame:
    """One row per field (and key): ``FieldNm, TypeTx, OrdNo``.

    A field of several types gets one that holds all: ``bigint`` for whole numbers, ``double`` for numbers, else
    ``string``, which for a nested value is its JSON. Fields are placed where a run has them first.
    """
    names = [*keys, "FieldNm"]
    kinds = F.collect_set("TypeTx")  # the types of one field, a handful

    def all_in(options: tuple[str, ...]):
        return F.forall("kinds", lambda kind: kind.isin(*options))

    found = run_schemas.groupBy(*names).agg(kinds.alias("kinds"), F.min("OrdNo").alias("OrdNo"))
    common = (
        F.when(F.size("kinds") == 1, F.get("kinds", F.lit(0)))
        .when(all_in(_INTEGRAL), "bigint")
        .when(all_in(_NUMERIC), "double")
        .otherwise("string")
    )
    return found.select(*names, common.alias("TypeTx"), "OrdNo")


def stored_schema(run_schemas: DataFrame, run_ids: list[int]) -> T.StructType | None:
    """The schema that these runs' records share, by the stored fields; None if nothing is stored for one of them."""
    mine = run_schemas.where(F.col("DaId").isin(run_ids))
    known = mine.agg(F.count_distinct("DaId").alias("n"))
    rows = merged_fields(mine).join(known).collect()
    if not rows or rows[0]["n"] < len(set(run_ids)):
        return None
    rows.sort(key=lambda row: (row["OrdNo"], row["FieldNm"]))
    return T.StructType([T.StructField(row["FieldNm"], T.DataType.fromDDL(row["TypeTx"])) for row in rows])
