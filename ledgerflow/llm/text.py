"""Shared helpers: whole texts as byte blobs in numpy, words, 64-bit fingerprints, safe column picking.

Texts arrive in Arrow batches and are worked on in slices of about ``SLICE_BYTES``, so a Python worker holds a few dozen
megabytes whatever the batch size; a single longer text is a slice of its own. A null text is the empty text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SLICE_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_BYTE_VALUES = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64)


def class_table(separators: bytes) -> np.ndarray:
    """True for the bytes that belong to words."""
    table = np.ones(256, bool)
    table[np.frombuffer(separators, np.uint8)] = False
    return table


#: Words ``[^\x20\x09-\x0D]+``: every byte of a non-ASCII character is a word byte.
BLANK_WORDS = class_table(b" \t\n\x0b\x0c\r")
#: Words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after A-Z are lower-cased by ``LOWER``.
ALNUM_WORDS = class_table(bytes([*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


class _Powers:
    """Powers of an odd base modulo 2**64 and their inverses, grown as needed."""

    def __init__(self) -> None:
        self.power = self.inverse = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.power) < n:
            size = 1 << max(16, (n - 1).bit_length())
            self.power = self._row(_BASE, size)
            self.inverse = self._row(pow(_BASE, -1, 1 << 64), size)
        return self.power[:n], self.inverse[:n]

    @staticmethod
    def _row(base: int, size: int) -> np.ndarray:
        row = np.full(size, base, np.uint64)
        row[0] = 1
        return np.multiply.accumulate(row)


_POWERS = _Powers()


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


class Fingerprints:
    """Fingerprints of any stretches of a sequence of 64-bit values, from one running sum."""

    def __init__(self, values: np.ndarray) -> None:
        n = len(values)
        power, self._inverse = _POWERS.upto(n + 1)
        self._sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values * power[:n], out=self._sums[1:])

    @classmethod
    def of_bytes(cls, data: np.ndarray) -> Fingerprints:
        return cls(_BYTE_VALUES[data])

    def raw(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return (self._sums[ends] - self._sums[starts]) * self._inverse[starts]

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix(self.raw(starts, ends) + (ends - starts).astype(np.uint64))

    def rolling(self, width: int) -> np.ndarray:
        """One fingerprint for each stretch of ``width`` values."""
        n = len(self._sums) - width
        if n <= 0:
            return np.zeros(0, np.uint64)
        return mix((self._sums[width:] - self._sums[:n]) * self._inverse[:n])


def blob(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts and the n + 1 offsets between them."""
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


class Words:
    """The words of all texts of a slice: byte ranges, the text each belongs to, and the first word of each text."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> None:
        inside = table[data]
        n = len(data)
        before = np.zeros(n, bool)
        after = np.zeros(n, bool)
        if n:
            before[1:] = inside[:-1]
            after[:-1] = inside[1:]
            firsts, lasts = offsets[:-1], offsets[1:] - 1
            before[firsts[firsts < n]] = False
            after[lasts[lasts >= 0]] = False
        self.inside = inside
        self.starts = np.flatnonzero(inside & ~before)
        self.ends = np.flatnonzero(inside & ~after) + 1
        self.first = np.searchsorted(self.starts, offsets)
        self.counts = np.diff(self.first)
        self.text = np.repeat(np.arange(len(offsets) - 1), self.counts)


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows with at most ``limit`` bytes of text, or one longer text."""
    at = batch.schema.get_field_index(column)
    _, offsets = blob(batch.column(at))
    start = 0
    while start < batch.num_rows:
        end = max(start + 1, int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1)
        yield batch.slice(start, end - start)
        start = end


def pick(df: DataFrame, *names: str) -> DataFrame:
    """Exactly these columns, under these names, whatever else the frame has.

    An exact name goes before one in another case, the first of two equal names before the second, so extra columns
    that differ in case only, or repeat a name, do no harm.
    """
    have = df.columns
    plain = df.toDF(*[f"c{i}" for i in range(len(have))])
    chosen = []
    for name in names:
        at = next((i for i, x in enumerate(have) if x == name), None)
        if at is None:
            at = next((i for i, x in enumerate(have) if x.lower() == name.lower()), None)
        if at is None:
            raise ValueError(f"no column {name} in {have}")
        chosen.append(F.col(f"c{at}").alias(name))
    return plain.select(*chosen)


def map_texts(
    df: DataFrame,
    text: str,
    added: T.StructType,
    make: Callable[[], Callable[[pa.RecordBatch], list[pa.Array]]],
    keep: tuple[str, ...],
) -> DataFrame:
    """Columns ``keep`` of the frame followed by the ``added`` ones, which a function computes slice by slice.

    ``make`` runs once for each task and returns that function.
    """
    source = pick(df, *dict.fromkeys([*keep, text]))
    schema = T.StructType([source.schema[name] for name in keep] + list(added.fields))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = make()
        names = [field.name for field in schema.fields]
        for batch in batches:
            kept = [batch.schema.get_field_index(name) for name in keep]
            for part in slices(batch, text):
                columns = [part.column(i) for i in kept] + compute(part)
                yield pa.RecordBatch.from_arrays(columns, names)

    return source.mapInArrow(run, schema)
