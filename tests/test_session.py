import os
from types import SimpleNamespace

import pytest
from conftest import rows

from ledgerflow.functions.tokens import RunTokens
from ledgerflow.session import materialize, scratch_path, scratch_scope, shared_dir
from ledgerflow.sources.router import SourceSpec, read_source


def session(master, configured=None):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default=None: configured),
        sparkContext=SimpleNamespace(master=master, applicationId=f"app-{master}"),
    )


def test_the_configured_folder_wins(spark):
    assert shared_dir(session("yarn", "hdfs://shared/ck")) == "hdfs://shared/ck"
    assert scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_a_cluster_needs_a_shared_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(session("yarn"))


def test_local_mode_needs_one_too():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(session("local[2]"))


def test_a_scope_deletes_what_was_written_inside(spark, tmp_path):
    with pytest.raises(RuntimeError), scratch_scope(spark):
        inner = scratch_path(spark, "inner")
        kept = scratch_path(spark, "kept", keep=True)
        for path in (inner, kept):
            spark.range(3).write.parquet(path)
        raise RuntimeError
    assert not os.path.exists(inner) and os.path.exists(kept)


def test_materialized_frames_are_equal(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    stored = materialize(df, "t")
    assert rows(stored) == rows(df) and stored.columns == df.columns


def test_warehouse_queries_are_rendered_in_source_form(spark):
    spark.createDataFrame([('{"v": 2}', "2024-01-05")], "j string, d string").createOrReplaceTempView("docs_src")
    spec = SourceSpec(
        "BQ", query="SELECT CAST(JSON_VALUE(j, '$.v') AS FLOAT64) AS v FROM docs_src WHERE d BETWEEN '{from}' AND '{periodEnd}'",
        query_params={"from": "{periodStart}"},
    )
    tokens = RunTokens("2024-01-01", "2024-01-31", "202401", "2024-01-31")
    assert rows(read_source(spark, spec, tokens)) == [(2.0,)]
