"""Substring dedup of word sequences by fixed-block anchors.

A word is removed if a window of ``WINDOW`` consecutive words around it also starts in a document with a smaller id.
Every window holds a whole block of ``BLOCK`` words that starts at a multiple of ``BLOCK`` in its document, so:

1. index: the non-overlapping blocks of all documents, with the smallest document that has each;
2. probe: every rolling window of ``BLOCK`` words of every document; it hits if a smaller document has that block;
3. extend: each hit, and each block that was hit, is extended to all windows around it, and a window stays removed if a
   smaller document extends to the same one; their union are the maximal repeats of the document.

Index and probes meet by the block's fingerprint, in ``PASSES`` passes over a part of the fingerprints each, which
bounds what is shuffled at once. The index is aggregated before it is shuffled and has one row for each block; a block
that very many documents share makes a skewed probe side, which adaptive execution splits. No pair of documents is ever
formed. Windows are compared by 64-bit fingerprints of their words.

Cases: a null text has no words; documents below ``WINDOW`` words lose nothing; a null id is neither smaller nor larger
than another, so such a document loses nothing and removes nothing; rows with one id are never compared with each other;
equal texts lose everything but in the smallest id.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.llm.storage import discard, stored
from ledgerflow.llm.text import BLANK_WORDS, Fingerprints, Words, blob, pick, slices

WINDOW, BLOCK = 13, 7
PASSES = 4


class _Sequences:
    """The words of a slice, the fingerprint of each rolling window of n words, and its place in its document."""

    def __init__(self, texts: pa.Array) -> None:
        self.data, self.offsets = blob(texts)
        self.words = Words(self.data, self.offsets, BLANK_WORDS)
        self._prints = Fingerprints(Fingerprints.of_bytes(self.data).of(self.words.starts, self.words.ends))

    def windows(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """First words and fingerprints of the windows inside documents of ``WINDOW`` words or more."""
        words = self.words
        rolled = self._prints.rolling(n)
        at = np.arange(len(rolled))
        text = words.text[: len(rolled)]
        inside = (at + n <= words.first[1:][text]) & (words.counts[text] >= WINDOW)
        return at[inside], rolled[inside]


def _emit(docs: DataFrame, columns: list[T.StructField], make: Callable[[pa.RecordBatch], list[pa.Array]]) -> DataFrame:
    schema = T.StructType(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                found = make(part)
                for start in range(0, len(found[0]), 50_000):
                    yield pa.RecordBatch.from_arrays([c.slice(start, 50_000) for c in found], schema.names)

    return docs.mapInArrow(run, schema)


def _placed(docs: DataFrame) -> list[T.StructField]:
    return [T.StructField("print", T.LongType()), docs.schema["doc_id"], T.StructField("place", T.IntegerType())]


def _blocks(docs: DataFrame) -> DataFrame:
    """(print, doc_id, place) of each document's non-overlapping blocks."""

    def make(part: pa.RecordBatch) -> list[pa.Array]:
        found = _Sequences(part.column(1))
        at, prints = found.windows(BLOCK)
        place = at - found.words.first[found.words.text[at]]
        grid = place % BLOCK == 0
        ids = part.column(0).take(pa.array(found.words.text[at[grid]]))
        return [pa.array(prints[grid].view(np.int64)), ids, pa.array(place[grid].astype(np.int32))]

    return _emit(docs, _placed(docs), make)


def _probes(docs: DataFrame, number: int, passes: int) -> DataFrame:
    """(print, doc_id, place) of every rolling window of a block's size whose fingerprint is of this pass."""

    def make(part: pa.RecordBatch) -> list[pa.Array]:
        found = _Sequences(part.column(1))
        at, prints = found.windows(BLOCK)
        own = prints % np.uint64(passes) == number
        at, prints = at[own], prints[own]
        place = at - found.words.first[found.words.text[at]]
        ids = part.column(0).take(pa.array(found.words.text[at]))
        return [pa.array(prints.view(np.int64)), ids, pa.array(place.astype(np.int32))]

    return _emit(docs, _placed(docs), make)


def _extended(docs: DataFrame, places: DataFrame) -> DataFrame:
    """(print, doc_id) of each document's windows around its places, each once."""
    source = docs.join(places, "doc_id").select("doc_id", "text", "places")

    def make(part: pa.RecordBatch) -> list[pa.Array]:
        found = _Sequences(part.column(1))
        at, prints = found.windows(WINDOW)
        lists = part.column(2)
        row = np.repeat(np.arange(part.num_rows), lists.value_lengths().to_numpy())
        place = lists.flatten().to_numpy()
        near = place < found.words.counts[row]  # a place in another text of this id may lie outside
        anchor = found.words.first[row[near]] + place[near]
        # a window holds an anchor if it starts at most WINDOW - BLOCK words before
        marks = np.zeros(len(found.words.starts) + WINDOW + 1, np.int64)
        np.add.at(marks, np.maximum(anchor - (WINDOW - BLOCK), found.words.first[row[near]]), 1)
        np.add.at(marks, anchor + 1, -1)
        wanted = np.cumsum(marks)[at] > 0
        text, prints = found.words.text[at[wanted]], prints[wanted]
        order = np.lexsort((prints, text))
        text, prints = text[order], prints[order]
        fresh = np.ones(len(text), bool)
        fresh[1:] = (text[1:] != text[:-1]) | (prints[1:] != prints[:-1])
        return [pa.array(prints[fresh].view(np.int64)), part.column(0).take(pa.array(text[fresh]))]

    return _emit(source, [T.StructField("print", T.LongType()), docs.schema["doc_id"]], make)


RESULT = [
    T.StructField("n_words", T.LongType()),
    T.StructField("n_removed", T.LongType()),
    T.StructField("kept_sha256", T.StringType()),
]


def _without(source: DataFrame) -> DataFrame:
    """(doc_id, text, prints of removed windows) to (doc_id, *RESULT)."""

    def make(part: pa.RecordBatch) -> list[pa.Array]:
        found = _Sequences(part.column(1))
        words = found.words
        at, prints = found.windows(WINDOW)
        lists = part.column(2)
        row = np.repeat(np.arange(part.num_rows), lists.value_lengths().fill_null(0).to_numpy())
        removed = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
        gone = np.zeros(len(words.starts), bool)
        if len(removed):
            # a window is removed if its document lists its fingerprint
            text = np.concatenate([row, words.text[at]])
            key = np.concatenate([removed, prints])
            listed = np.concatenate([np.zeros(len(removed), np.int8), np.ones(len(at), np.int8)])
            order = np.lexsort((listed, key, text))
            fresh = np.ones(len(order), bool)
            fresh[1:] = (text[order][1:] != text[order][:-1]) | (key[order][1:] != key[order][:-1])
            opens = listed[order][np.flatnonzero(fresh)][np.cumsum(fresh) - 1] == 0
            hit = order[opens & (listed[order] == 1)] - len(removed)
            marks = np.zeros(len(words.starts) + 1, np.int64)
            np.add.at(marks, at[hit], 1)
            np.add.at(marks, at[hit] + WINDOW, -1)
            gone = np.cumsum(marks[:-1]) > 0
        whole = found.data.tobytes()
        starts, ends = words.starts.tolist(), words.ends.tolist()
        digests = []
        for low, high in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
            kept = b" ".join([whole[starts[i] : ends[i]] for i in (np.flatnonzero(~gone[low:high]) + low).tolist()])
            digests.append(hashlib.sha256(kept).hexdigest())
        n_removed = np.bincount(words.text, gone, part.num_rows).astype(np.int64)
        return [part.column(0), pa.array(words.counts.astype(np.int64)), pa.array(n_removed), pa.array(digests, pa.string())]

    return _emit(source, [source.schema["doc_id"], *RESULT], make)


def remove_repeated_words(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", passes: int = PASSES) -> DataFrame:
    """Words and removed words of each document, and the digest of the words that stay."""
    source = pick(docs, doc_id, text).toDF("doc_id", "text")
    named = source.where("doc_id IS NOT NULL")
    blocks = stored(_blocks(named), "blocks")
    found: list[DataFrame] = []
    for number in range(passes):
        # the fingerprint's unsigned remainder, as in _probes
        wrapped = F.when(F.col("print") < 0, (1 << 64) % passes).otherwise(0)
        unsigned = F.pmod(F.pmod("print", F.lit(passes)) + wrapped, F.lit(passes))
        own = blocks.where(unsigned == number)
        index = own.groupBy("print").agg(F.min("doc_id").alias("least"))
        hits = stored(_probes(named, number, passes).join(index, "print").where("least < doc_id").drop("least"), "hits")
        hit = hits.select("print").distinct()
        found += [hits, stored(own.join(hit, "print", "left_semi"), "blocks-hit")]
    places = found[0].select("doc_id", "place")
    for more in found[1:]:
        places = places.union(more.select("doc_id", "place"))
    places = stored(places.groupBy("doc_id").agg(F.collect_set("place").alias("places")), "places")
    discard(blocks, *found)
    least = (
        _extended(named, places).groupBy("print")
        .agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).where("least < most").drop("most")
    )
    least = stored(least, "repeated-windows")
    removed = _extended(named, places).join(least, "print").where("least < doc_id")
    removed = stored(removed.groupBy("doc_id").agg(F.collect_set("print").alias("prints")), "removed-windows")
    discard(places, least)
    joined = source.join(removed, "doc_id", "left").select("doc_id", "text", "prints")
    return _without(joined).withColumnRenamed("doc_id", doc_id)
