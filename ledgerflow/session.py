"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Planner settings that suit both a laptop and a cluster. Partition counts are left to AQE: start wide, let it coalesce.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(app_name: str = "ledgerflow", master: str | None = None, **conf: str) -> SparkSession:
    """Create a session with the recommended settings; keyword ``conf`` uses ``_`` for ``.`` in keys."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in RECOMMENDED_CONF.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("_", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, taken from ``spark.checkpoint.dir``.

    There is no fallback: a machine-local folder would be lost with its machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        raise ValueError("spark.checkpoint.dir must name a folder shared by all executors")
    return configured


# Scratch paths of the scopes that are open, innermost last.
_scopes: list[list[str]] = []


def scratch_path(spark: SparkSession, label: str, keep: bool = False) -> str:
    """A fresh path under the shared folder; unless kept, the innermost open scope deletes it when it ends."""
    path = f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    if _scopes and not keep:
        _scopes[-1].append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Own the intermediates written inside: they are deleted at the end, whether it succeeds or fails.

    Frames that read them must not be used after the scope.
    """
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def materialize(df, label: str, keep: bool = False):
    """Write an intermediate result to the shared folder and read it back.

    The written size is known exactly, so the planner decides about broadcasting it on facts, and a lost executor costs
    nothing that has to be recomputed.
    """
    path = scratch_path(df.sparkSession, label, keep)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
