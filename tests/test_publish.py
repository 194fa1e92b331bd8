import json

import pytest
from conftest import rows

from ledgerflow.metrics import StreamTotals, combined, distribution, observed
from ledgerflow.operators.chain import ChainOptions
from ledgerflow.sinks.router import SinkSpec
from ledgerflow.sources.text import read_raw_stream
from ledgerflow.streaming.chain import METRICS, stream_chain
from ledgerflow.streaming.publish import BatchPublisher

OPTIONS = ChainOptions(json_schema="id int, kind string")


@pytest.fixture
def landed(tmp_path):
    folder = tmp_path / "landed"
    folder.mkdir()
    for n in range(3):
        (folder / f"{n}.txt").write_text("".join(json.dumps({"id": 10 * n + i, "kind": "ab"[i % 2]}) + "\n" for i in range(4)))
    return str(folder)


def run(spark, landed, tmp_path, sink):
    stream = read_raw_stream(spark, "text", landed, maxFilesPerTrigger="1")
    query = stream_chain(stream, "flatten-json,filter-nulls", str(tmp_path / "state"), sink, None, OPTIONS, available_now=True)
    query.awaitTermination()
    return query


WANTED = [(10 * n + i, "ab"[i % 2]) for n in range(3) for i in range(4)]


def stopping(monkeypatch, name, when):
    """Fail in a publisher's method the ``when``-th time, before or after its work."""
    real, calls = getattr(BatchPublisher, name), []

    def broken(self, *args, **kwargs):
        calls.append(1)
        if len(calls) == abs(when):
            if when < 0:
                real(self, *args, **kwargs)
            raise RuntimeError("stopped")
        return real(self, *args, **kwargs)

    monkeypatch.setattr(BatchPublisher, name, broken)


@pytest.mark.parametrize("name, when", [("_move", 2), ("_move", -2), ("commit", 2), ("commit", -2), ("_move", -1), ("done", 3)])
@pytest.mark.parametrize("partitioned", [False, True])
def test_a_table_gets_each_batch_once(spark, landed, tmp_path, monkeypatch, name, when, partitioned):
    table = f"published_{tmp_path.name.replace('-', '_').replace('[', '').replace(']', '')}"
    by = "PARTITIONED BY (kind)" if partitioned else ""
    spark.sql(f"CREATE TABLE {table} (id BIGINT, kind STRING) USING parquet {by} LOCATION '{tmp_path}/table'")
    sink = SinkSpec("BQ", table=table)
    with monkeypatch.context() as patch:
        stopping(patch, name, when)
        with pytest.raises(Exception, match="stopped"):
            run(spark, landed, tmp_path, sink)
    run(spark, landed, tmp_path, sink)
    run(spark, landed, tmp_path, sink)
    assert rows(spark.table(table).select("id", "kind")) == sorted(WANTED, key=repr)
    spark.sql(f"DROP TABLE {table}")


@pytest.mark.parametrize("name, when", [("_move", -2), ("commit", 2)])
def test_file_messages_are_sent_once(spark, landed, tmp_path, monkeypatch, name, when):
    sink = SinkSpec("PUBSUB", message_format="text", options={"path": str(tmp_path / "sent")})
    with monkeypatch.context() as patch:
        stopping(patch, name, when)
        with pytest.raises(Exception, match="stopped"):
            run(spark, landed, tmp_path, sink)
    run(spark, landed, tmp_path, sink)
    sent = [json.loads(r[0]) for r in spark.read.text(str(tmp_path / "sent")).collect()]
    assert sorted((m["id"], m["kind"]) for m in sent) == sorted(WANTED)


def test_a_half_moved_batch_is_finished(spark, tmp_path):
    publisher = BatchPublisher(spark, str(tmp_path / "state"))
    df = spark.range(0, 10, 1, 4).selectExpr("CAST(id AS STRING) AS value")
    real, moved = publisher._move, []

    class Half:
        """A file system whose third move fails."""

        def __init__(self, files):
            self.files = files

        def rename(self, a, b):
            moved.append(a)
            if len(moved) == 3:
                raise RuntimeError("stopped")
            return self.files.rename(a, b)

        def __getattr__(self, name):
            return getattr(self.files, name)

    publisher._move = lambda files, *rest: real(Half(files), *rest)
    with pytest.raises(RuntimeError):
        publisher.publish(df, 0, str(tmp_path / "out"), "text")
    again = BatchPublisher(spark, str(tmp_path / "state"))
    assert again.publish(spark.createDataFrame([("other",)], "value string"), 0, str(tmp_path / "out"), "text")
    assert not again.publish(df, 0, str(tmp_path / "out"), "text")
    assert sorted(int(r[0]) for r in spark.read.text(str(tmp_path / "out")).collect()) == list(range(10))


def test_sinks_that_cannot_be_added_to(spark, landed, tmp_path):
    with pytest.raises(ValueError, match="FTP"):
        run(spark, landed, tmp_path, SinkSpec("FTP"))
    with pytest.raises(Exception, match="does not exist"):
        run(spark, landed, tmp_path, SinkSpec("BQ", table="no_such_table"))


def test_counters_of_all_batches(spark, landed, tmp_path):
    totals = StreamTotals.listening(spark)
    try:
        query = run(spark, landed, tmp_path, SinkSpec("GCS", path=str(tmp_path / "ok")))
        found = totals.of(query, METRICS)
        assert (found["rows_in"], found["rows_out"], found["dlq_total"]) == (12, 12, 0)
        ids = spark.readStream.schema("id int").option("maxFilesPerTrigger", 1).json(landed)
        counted, _ = observed(ids, "ids", distribution("id", ids["id"]))
        query = counted.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "n")).trigger(availableNow=True).start()
        query.awaitTermination()
        spread = totals.of(query, "ids")
        assert (spread["id_count"], spread["id_min"], spread["id_max"], spread["id_mean"]) == (12, 0, 23, 11.5)
    finally:
        spark.streams.removeListener(totals)


def test_totals_replace_a_batch_that_runs_again():
    totals = StreamTotals()
    for batch, n in ((0, 5), (1, 7), (1, 8), (2, 1)):
        totals.add("q", batch, {"m": {"rows": n}})

    class Query:
        id, runId, isActive = "q", "r", True

    assert totals.of(Query(), "m") == {"rows": 14} and totals.of(Query(), "gone") == {}
    parts = [{"v_count": 0, "v_min": None, "v_mean": None}, {"v_count": 2, "v_min": 3, "v_mean": 4.0}]
    assert combined(parts) == {"v_count": 2, "v_min": 3, "v_mean": 4.0}
    assert combined(parts[:1]) == {"v_count": 0, "v_min": None, "v_mean": None}
