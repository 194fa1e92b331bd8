"""Request payloads: rows packed into JSON arrays of bounded rows and bytes."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerflow.functions.scalars import row_json


def json_batches(df: DataFrame, size: int, max_bytes: int | None = None) -> DataFrame:
    """Pack rows into JSON-array payloads of at most ``size`` rows and ``max_bytes`` bytes of UTF-8.

    Rows keep their order within each partition. A row that is larger by itself is a payload of its own, marked
    ``oversized``. Rows become JSON on the JVM side; tasks only join ready strings, so nothing is shuffled and a task
    holds one payload.
    """
    if size < 1 or (max_bytes is not None and max_bytes < 2):
        raise ValueError("a batch holds at least 1 row and 2 bytes")

    def pack(record_batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending: list[bytes] = []
        held = 2  # brackets

        def payload() -> pa.RecordBatch:
            body = b"[" + b",".join(pending) + b"]"
            too_large = max_bytes is not None and len(body) > max_bytes
            counts = {"row_count": pa.array([len(pending)], pa.int32()), "oversized": [too_large]}
            return pa.RecordBatch.from_pydict({"payload": pa.array([body.decode()]), **counts})

        for record_batch in record_batches:
            for text in record_batch.column(0).to_pylist():
                row = text.encode()
                full = len(pending) == size or (max_bytes is not None and held + len(row) > max_bytes)
                if pending and full:
                    yield payload()
                    pending, held = [], 2
                pending.append(row)
                held += len(row) + 1
        if pending:
            yield payload()

    return df.select(row_json(df.columns).alias("row")).mapInArrow(pack, "payload string, row_count int, oversized boolean")
