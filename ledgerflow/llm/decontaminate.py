"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

The patterns are the windows of ``WINDOW`` consecutive words of the benchmark items; an item with fewer words is one
shorter pattern. For each pattern length there is a table of shifts by the fingerprint of a block of words: how far the
search may jump when a window of the text ends with that block. A block that ends some pattern has shift 0 and leads to
a bucket of patterns with that suffix; what the bucket offers is compared with the text byte by byte.

Texts are cut into stretches that are searched in step with each other, so a jump of every cursor is one numpy
operation. The documents are never shuffled. The patterns reach the tasks in blocks of at most ``block_patterns``, which
bounds what is broadcast at once; with more patterns there is one pass over the documents for each block, which hands on
the words hit and items found so far.

Cases: null texts, texts and items without words have no hits; repeated documents are judged each on its own; repeated
item ids count once; null item ids are left out; an empty benchmark contaminates nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.llm.storage import stored
from ledgerflow.llm.text import ALNUM_WORDS, LOWER, Fingerprints, Words, blob, mix, pick, slices

WINDOW = 10
#: Patterns in one broadcast block; a block takes about 150 bytes for each.
BLOCK_PATTERNS = 200_000
#: Window ends that one cursor searches.
STRETCH = 128

_CARRIED = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("hits", T.BinaryType()),
        T.StructField("items", T.ArrayType(T.StringType())),
    ]
)
RESULT = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_hit", T.LongType()),
        T.StructField("n_items", T.LongType()),
        T.StructField("items_sha256", T.StringType()),
        T.StructField("contaminated", T.BooleanType()),
    ]
)


class _Text:
    """A slice of texts as words and their fingerprints; the words joined by one space are made when first needed."""

    def __init__(self, texts: pa.Array) -> None:
        data, self.offsets = blob(texts)
        self.data = LOWER[data]
        self.words = Words(self.data, self.offsets, ALNUM_WORDS)
        self.keys = Fingerprints.of_bytes(self.data).of(self.words.starts, self.words.ends)
        self._joined: tuple[bytes, np.ndarray, np.ndarray] | None = None

    def joined(self) -> tuple[bytes, np.ndarray, np.ndarray]:
        if self._joined is None:
            words = self.words
            lengths = words.ends - words.starts
            ends = np.cumsum(lengths + 1) - 1
            out = np.full(int(ends[-1]) + 1 if len(ends) else 0, 0x20, np.uint8)
            keep = np.ones(len(out), bool)
            keep[ends] = False
            out[keep] = self.data[words.inside]
            self._joined = out.tobytes(), ends - lengths, ends
        return self._joined


def _block_keys(keys: np.ndarray, block: int) -> np.ndarray:
    """At each word, the fingerprint of the ``block`` words that end there (meaningless for the first ones)."""
    total = keys.copy()
    for back in range(1, block):
        total[back:] += keys[:-back] * np.uint64(0x9E3779B97F4A7C15 + 2 * back)
    return mix(total)


class _Length:
    """Shift table and suffix buckets of the patterns with one number of words."""

    def __init__(self, size: int, patterns: list[bytes], items: list[list[str]]) -> None:
        self.size = size
        self.block = min(3, size)
        text = _Text(pa.array([p.decode() for p in patterns], pa.large_string()))
        ends = text.words.first[1:] - 1
        blocks = _block_keys(text.keys, self.block)
        bits = min(22, max(10, (8 * size * len(patterns)).bit_length()))
        self._right = np.uint64(64 - bits)
        self.shift = np.full(1 << bits, size - self.block + 1, np.uint8)
        for back in range(size - self.block, -1, -1):
            self.shift[(blocks[ends - back] >> self._right).astype(np.int64)] = back
        whole = Fingerprints(text.keys).of(ends - size + 1, ends + 1)
        order = np.lexsort((whole, blocks[ends]))
        self.suffix, self.whole = blocks[ends][order], whole[order]
        self.patterns = [patterns[i] for i in order]
        self.items = [items[i] for i in order]

    def search(self, text: _Text) -> list[tuple[int, int]]:
        """The first word and the pattern of every occurrence."""
        words, size = text.words, self.size
        blocks = _block_keys(text.keys, self.block)
        first, last = words.first[:-1] + size - 1, words.first[1:]
        some = last > first
        first, last = first[some], last[some]
        pieces = -(-(last - first) // STRETCH)
        which = np.repeat(np.arange(len(first)), pieces)
        nth = np.arange(len(which)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        at = first[which] + nth * STRETCH
        end = np.minimum(at + STRETCH, last[which])
        stops = []
        while len(at):
            shift = self.shift[(blocks[at] >> self._right).astype(np.int64)]
            stops.append(at[shift == 0])
            at = at + np.maximum(shift, 1)
            going = at < end
            at, end = at[going], end[going]
        found = np.concatenate(stops) if stops else np.zeros(0, np.int64)
        suffix = blocks[found]
        low, high = np.searchsorted(self.suffix, suffix, "left"), np.searchsorted(self.suffix, suffix, "right")
        found, low, high = found[high > low], low[high > low], high[high > low]
        if not len(found):
            return []
        # in the bucket the patterns are ordered by the fingerprint of all their words
        whole = Fingerprints(text.keys).of(found - size + 1, found + 1)
        while (narrow := (low < high) & (self.whole[np.minimum(low, len(self.whole) - 1)] < whole)).any():
            middle = (low + high) // 2
            less = self.whole[np.minimum(middle, len(self.whole) - 1)] < whole
            low = np.where(narrow & less, middle + 1, low)
            high = np.where(narrow & ~less, middle, high)
        joined, starts, ends = text.joined()
        out = []
        top = np.searchsorted(self.suffix, blocks[found], "right")
        for e, k, stop, key in zip(found.tolist(), low.tolist(), top.tolist(), whole.tolist()):
            while k < stop and int(self.whole[k]) == key:
                if joined[starts[e - size + 1] : ends[e]] == self.patterns[k]:
                    out.append((e - size + 1, k))
                    break
                k += 1
        return out


class Matcher:
    """All patterns of one block, by number of words."""

    def __init__(self, rows: list[tuple[int, str, str]]) -> None:
        grouped: dict[int, dict[str, list[str]]] = {}
        for size, window, item in rows:
            grouped.setdefault(size, {}).setdefault(window, []).append(item)
        self.lengths = [
            _Length(size, [w.encode() for w in windows], list(windows.values()))
            for size, windows in sorted(grouped.items())
        ]

    def search(self, text: _Text) -> tuple[np.ndarray, dict[int, set[str]]]:
        """Which words are hit, and the items found in each text that has any."""
        covered = np.zeros(len(text.words.starts) + 1, np.int64)
        items: dict[int, set[str]] = {}
        for length in self.lengths:
            found = length.search(text)
            if not found:
                continue
            at = np.array([start for start, _ in found])
            np.add.at(covered, at, 1)
            np.add.at(covered, at + length.size, -1)
            for doc, k in set(zip(text.words.text[at].tolist(), [k for _, k in found])):
                items.setdefault(doc, set()).update(length.items[k])
        return np.cumsum(covered[:-1]) > 0, items


def patterns(benchmark: DataFrame, item_id: str = "item_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """Distinct (size, window, item): the words of each window joined by one space, and the item's id as a string."""
    source = pick(benchmark, item_id, text).select(F.col(item_id).cast("string").alias("item"), F.col(text).alias("text"))
    schema = T.StructType(
        [
            T.StructField("size", T.IntegerType()),
            T.StructField("window", T.StringType()),
            T.StructField("item", T.StringType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                found = _Text(part.column(1))
                joined, starts, ends = found.joined()
                rows: set[tuple[int, str, str]] = set()
                for doc, item in enumerate(part.column(0).to_pylist()):
                    low, high = int(found.words.first[doc]), int(found.words.first[doc + 1])
                    size = min(window, high - low)
                    for at in range(low, high - size + 1) if size else ():
                        rows.add((size, joined[starts[at] : ends[at + size - 1]].decode(), item))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int32(), pa.string(), pa.string()))],
                    ["size", "window", "item"],
                )

    return source.where(F.col("item").isNotNull()).mapInArrow(run, schema).distinct()


def _searcher(text: str, matcher, first: bool, last: bool):
    """A function that gives a slice's new columns, with what earlier blocks found; ``last`` gives the result."""

    def make():
        search = matcher.value.search

        def compute(part: pa.RecordBatch) -> list[pa.Array]:
            found = _Text(part.column(part.schema.get_field_index(text)))
            hit, items = search(found)
            low = found.words.first.tolist()
            n = part.num_rows
            if not first:
                before = part.column(part.schema.get_field_index("hits")).to_pylist()
                old = part.column(part.schema.get_field_index("items")).to_pylist()
                for doc in range(n):
                    if old[doc]:
                        items.setdefault(doc, set()).update(old[doc])
                        bits = np.unpackbits(np.frombuffer(before[doc], np.uint8), count=low[doc + 1] - low[doc])
                        hit[low[doc] : low[doc + 1]] |= bits.astype(bool)
            counts = pa.array(found.words.counts, pa.int64())
            if not last:
                packed = [np.packbits(hit[low[d] : low[d + 1]]).tobytes() if d in items else b"" for d in range(n)]
                lists = [sorted(items.get(d, ())) for d in range(n)]
                return [counts, pa.array(packed, pa.binary()), pa.array(lists, pa.list_(pa.string()))]
            n_hit = np.bincount(found.words.text, hit, n).astype(np.int64)
            empty = hashlib.sha256(b"").hexdigest()
            digest = [
                hashlib.sha256(",".join(sorted(items[d])).encode()).hexdigest() if d in items else empty for d in range(n)
            ]
            sizes = np.array([len(items.get(d, ())) for d in range(n)], np.int64)
            return [counts, pa.array(n_hit), pa.array(sizes), pa.array(digest, pa.string()), pa.array(n_hit > 0)]

        return compute

    return make


def _scan(docs: DataFrame, keep: tuple[str, ...], text: str, matcher, first: bool, last: bool) -> DataFrame:
    """One pass, with the columns in place for the next."""
    carried = () if first else ("hits", "items")
    columns = (*keep, *carried, text)
    added = RESULT if last else _CARRIED
    plain = tuple(dict.fromkeys(keep if last else (*keep, text)))
    source = pick(docs, *dict.fromkeys(columns))
    schema = T.StructType([source.schema[n] for n in plain] + list(added.fields))
    compute_for = _searcher(text, matcher, first, last)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = compute_for()
        for batch in batches:
            for part in slices(batch, text):
                kept = [part.column(part.schema.get_field_index(n)) for n in plain]
                yield pa.RecordBatch.from_arrays(kept + compute(part), schema.names)

    return source.mapInArrow(run, schema)


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    keep: tuple[str, ...] = ("doc_id",),
    text: str = "text",
    block_patterns: int = BLOCK_PATTERNS,
) -> DataFrame:
    """For each document, its ``keep`` columns and how much of it occurs in the benchmark (see ``RESULT``)."""
    spark = docs.sparkSession
    table = stored(patterns(benchmark), "benchmark-patterns")
    blocks = max(1, -(-table.count() // block_patterns))
    number = F.pmod(F.xxhash64("window", "item"), F.lit(blocks))
    current = pick(docs, *dict.fromkeys([*keep, text]))
    for at in range(blocks):
        rows = [tuple(row) for row in table.where(number == at).collect()]  # at most about block_patterns rows
        matcher = spark.sparkContext.broadcast(Matcher(rows))
        current = _scan(current, keep, text, matcher, at == 0, at == blocks - 1)
        if at < blocks - 1:
            current = stored(current, "benchmark-pass")
    return current
