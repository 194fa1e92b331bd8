"""Write both outputs of a chain from one pass over its source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.functions.scalars import column
from ledgerflow.result import DEAD, DEAD_LETTER_SCHEMA, FAILED, ChainResult

OK, DEAD_LETTER = "ok", "dead"


def tagged_rows(result: ChainResult) -> DataFrame:
    """Rows and dead letters side by side: ``row`` for accepted rows, ``dead`` for failed ones, and ``outcome``."""
    row = F.struct(*[column(c) for c in result.columns])
    failed = F.col(FAILED)
    return result.tagged.select(
        F.when(~failed, row).alias("row"),
        F.when(failed, F.col(DEAD)).alias("dead"),
        F.when(failed, F.lit(DEAD_LETTER)).otherwise(F.lit(OK)).alias("outcome"),
    )


def write_outcomes(result: ChainResult, path: str, mode: str = "overwrite") -> tuple[DataFrame, DataFrame]:
    """One write partitioned by outcome, so the source is read and the chain evaluated once; returns (ok, dead)."""
    tagged_rows(result).write.mode(mode).partitionBy("outcome").parquet(path)
    return read_outcomes(result.tagged.sparkSession, path, result.tagged.select(*result.columns).schema)


def read_outcomes(spark: SparkSession, path: str, row_schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """The two outputs of an earlier ``write_outcomes``; partition pruning reads only the one asked for."""
    schema = T.StructType(
        [
            T.StructField("row", row_schema),
            T.StructField("dead", DEAD_LETTER_SCHEMA),
            T.StructField("outcome", T.StringType()),
        ]
    )
    stored = spark.read.schema(schema).parquet(path)
    ok = stored.where(F.col("outcome") == OK).select("row.*")
    return ok, stored.where(F.col("outcome") == DEAD_LETTER).select("dead.*")
