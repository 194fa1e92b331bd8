"""Intermediate tables in the folder that all executors share; an open ``scratch_scope`` deletes them at its end."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerflow.session import scratch_path

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the folder of ``spark.checkpoint.dir``."""
    return scratch_path(spark, label)


def stored(df: DataFrame, label: str) -> DataFrame:
    """The frame written once as compressed Parquet and read back: lineage ends here, and a lost executor costs nothing.

    The shuffle files of the job that writes it are removed when it ends, so disk holds those of one job at a time.
    """
    spark = df.sparkSession
    path = shared_path(spark, label)
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``stored`` wrote and nothing reads any more."""
    for table in tables:
        spark = table.sparkSession
        paths = {file.rsplit("/", 1)[0] for file in table.inputFiles()}
        for path in paths:
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
