"""Row functions with retry and a dead letter."""

from __future__ import annotations

import json
import random
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from datetime import datetime, timezone

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ledgerflow.result import DEAD, DEAD_LETTER_SCHEMA, FAILED, NO_MESSAGE, ChainResult

# Delay cap and jitter share.
MAX_DELAY_MS = 200
JITTER = 0.1


@dataclass(frozen=True)
class RetryPolicy:
    """``max_retries`` further tries after the first; delays are fixed or doubling, capped, with jitter on doubling."""

    max_retries: int = 3
    delay_ms: int = 200
    exponential: bool = True

    def should_retry(self, attempt: int) -> bool:
        return attempt <= self.max_retries

    def wait_ms(self, attempt: int) -> float:
        base = min(self.delay_ms, MAX_DELAY_MS)
        if not self.exponential:
            return base
        capped = min(base * 2 ** (attempt - 1), MAX_DELAY_MS)
        return capped + int(capped * JITTER * random.random())


def _tagged(schema: str | T.StructType) -> tuple[list[str], T.StructType, pa.Schema]:
    out = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    tagged = T.StructType([*out.fields, T.StructField(FAILED, T.BooleanType()), T.StructField(DEAD, DEAD_LETTER_SCHEMA)])
    return out.names, tagged, to_arrow_schema(tagged)


def _letter(row: dict, message: str, kind: str, tries: int) -> dict:
    return {
        "payload": json.dumps(row, default=str, ensure_ascii=False),
        "errorMessage": message or NO_MESSAGE,
        "errorClass": kind,
        "attemptCount": tries,
        "failedAtUtc": datetime.now(timezone.utc).isoformat(),
    }


def _class_of(error: Exception) -> str:
    return f"{type(error).__module__}.{type(error).__qualname__}"


def map_rows_with_retry(
    df: DataFrame, fn: Callable[[dict], dict], schema: str | T.StructType, policy: RetryPolicy = RetryPolicy()
) -> ChainResult:
    """Apply ``fn`` to each row (dict to dict); a row whose tries are used up becomes a dead letter.

    A result that does not fit the declared types is a failed try of its row. Columns are built a batch at a time; only
    a batch with such a result is looked at row by row.

    For functions Spark cannot express; rows travel in Arrow batches and the work stays partitioned as the input is.
    """
    names, tagged, arrow_schema = _tagged(schema)

    def misfit(value: dict) -> Exception | None:
        """Why a row's values don't fit their columns."""
        for name, field in zip(names, arrow_schema):
            try:
                pa.array([value.get(name)], field.type)
            except (pa.ArrowException, TypeError, ValueError, OverflowError) as error:
                return ValueError(f"{name}: {error}")
        return None

    def attempt(row: dict, error: Exception | None = None, checked: bool = False) -> tuple[dict | None, dict | None]:
        """The row's values or its dead letter; ``error`` is that of a first try."""
        tries = 0
        while True:
            if error is not None:
                tries += 1
                if not policy.should_retry(tries):
                    return None, _letter(row, str(error), _class_of(error), tries)
                pause = policy.wait_ms(tries) / 1000
                if pause > 0:
                    time.sleep(pause)
            try:
                value = fn(dict(row))
                error = misfit(value) if checked else None
            except Exception as raised:
                error = raised
            if error is None:
                return value, None

    def arrays(found: list[tuple[dict | None, dict | None]]) -> list[pa.Array]:
        columns = [[None if value is None else value.get(name) for value, _ in found] for name in names]
        columns += [[letter is not None for _, letter in found], [letter for _, letter in found]]
        return [pa.array(values, field.type) for values, field in zip(columns, arrow_schema)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            found = [attempt(row) for row in rows]
            try:
                columns = arrays(found)
            except (pa.ArrowException, TypeError, ValueError, OverflowError, AttributeError):
                for i, (value, letter) in enumerate(found):
                    error = None if letter else misfit(value) if isinstance(value, dict) else TypeError("no row values")
                    if error is not None:
                        found[i] = attempt(rows[i], error, checked=True)
                columns = arrays(found)
            yield pa.RecordBatch.from_arrays(columns, schema=arrow_schema)

    return ChainResult(df.mapInArrow(run, tagged))


#: What a batch function gives back: a column for each name, and for each row an error text or null.
BatchValues = tuple[dict[str, pa.Array], pa.Array]


def map_batches_with_retry(
    df: DataFrame,
    fn: Callable[[pa.RecordBatch], BatchValues],
    schema: str | T.StructType,
    policy: RetryPolicy = RetryPolicy(),
    error_class: str = "builtins.ValueError",
) -> ChainResult:
    """Apply ``fn`` to whole Arrow batches; rows it gives an error for are tried again, alone, after one pause.

    A row whose tries are used up becomes a dead letter of ``error_class``. A call that raises is repeated on halves of
    its rows, down to the rows that raise by themselves, whose class is that of what they raise; so one bad row does not
    take its batch along. Columns are cast to the declared types, and a call whose columns don't fit them has raised.
    """
    names, tagged, arrow_schema = _tagged(schema)

    def call(batch: pa.RecordBatch, rows: np.ndarray) -> list[tuple[np.ndarray, list[pa.Array], pa.Array, pa.Array]]:
        """(rows, columns, errors, classes) of the calls that it took."""
        try:
            values, errors = fn(batch.take(pa.array(rows)))
            columns = [_cast(values[name], field.type) for name, field in zip(names, arrow_schema)]
            if any(len(column) != len(rows) for column in [*columns, errors]):
                raise ValueError(f"{len(rows)} rows in, other numbers out")
            return [(rows, columns, errors.cast(pa.string()), pa.array([error_class] * len(rows)))]
        except Exception as error:
            if len(rows) == 1:
                columns = [pa.nulls(1, field.type) for field in list(arrow_schema)[: len(names)]]
                return [(rows, columns, pa.array([str(error) or NO_MESSAGE]), pa.array([_class_of(error)]))]
            half = len(rows) // 2
            return call(batch, rows[:half]) + call(batch, rows[half:])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            open_rows, tries = np.arange(batch.num_rows), 0
            while len(open_rows):
                failed, tries = [], tries + 1
                last = not policy.should_retry(tries)
                for rows, columns, errors, classes in call(batch, open_rows):
                    bad = errors.is_valid().to_numpy(zero_copy_only=False)
                    if not last and bad.any():
                        failed.append(rows[bad])
                    done = np.arange(len(rows)) if last else np.flatnonzero(~bad)
                    if len(done):
                        yield output(batch, rows, columns, errors, classes, done, bad, tries)
                open_rows = np.concatenate(failed) if failed else np.zeros(0, np.int64)
                if len(open_rows):
                    time.sleep(policy.wait_ms(tries) / 1000)

    def output(batch, rows, columns, errors, classes, done, bad, tries) -> pa.RecordBatch:
        letters: list[dict | None] = [None] * len(done)
        dead = np.flatnonzero(bad[done])
        sources = batch.take(pa.array(rows[done[dead]])).to_pylist()
        for at, source in zip(dead.tolist(), sources):
            place = int(done[at])
            letters[at] = _letter(source, errors[place].as_py(), classes[place].as_py(), tries)
        kept = pa.array(~bad[done])
        chosen = [pc.if_else(kept, column.take(pa.array(done)), pa.nulls(len(done), column.type)) for column in columns]
        return pa.RecordBatch.from_arrays([*chosen, pa.array(bad[done]), pa.array(letters, arrow_schema[-1].type)], schema=arrow_schema)

    return ChainResult(df.mapInArrow(run, tagged))


def _cast(values: pa.Array | pa.ChunkedArray, kind: pa.DataType) -> pa.Array:
    whole = values.combine_chunks() if isinstance(values, pa.ChunkedArray) else values
    return whole.cast(kind)
