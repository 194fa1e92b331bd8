"""Suffix-array dedup of byte strings that repeat anywhere, by deep-shallow sorting of sampled suffixes.

A byte is removed if a string of ``LENGTH`` bytes around it also starts elsewhere. Not every suffix of the corpus is
sorted: the suffixes at *anchors* are enough. Among the runs of ``GRAM`` bytes that start within any ``LENGTH`` bytes,
the one with the least fingerprint is an anchor, so equal strings have equal anchors at equal places, and about one byte
in 130 is one. Anchors are grouped by their run; those whose run occurs once are done.

What is left are contexts, the bytes within ``LENGTH`` around an anchor; equal contexts count as one. The contexts of a
run are put in suffix order to the right of the anchor, and in that of the reversed bytes to its left: a multikey
quicksort over eight bytes at a time goes to the shallow depth, blind tries order what is still equal there. The common
prefixes of neighbours then say, for every place of the anchor within the string, which contexts have the same string.

Runs shared by more than ``GROUP_CONTEXTS`` different contexts (some 30 MB of bytes) are never gathered in one task: their
strings are compared by two independent fingerprints in a shuffle, which pre-aggregates.

Cases: a null text is empty; matches never cross documents; equal documents lose all of it from ``LENGTH`` bytes on;
repeated rows are copies of each other; documents shorter than ``LENGTH`` lose nothing.
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
from ledgerflow.llm.text import Fingerprints, blob, mix, pick, slices

LENGTH, GRAM = 400, 128
#: Places of an anchor within a string.
PLACES = LENGTH - GRAM + 1
GROUP_CONTEXTS = 40_000
#: Contexts sorted at once, and the depth in bytes where tries take over.
BATCH_CONTEXTS, SHALLOW = 4_000, 32

_LARGEST = np.uint64(0xFFFFFFFFFFFFFFFF)


def _running(values: np.ndarray, width: int, extreme: np.ufunc, fill: np.uint64) -> np.ndarray:
    """The extreme of each ``width`` values that start at a place, from running extremes within blocks."""
    n = len(values)
    rows = -(-n // width) + 1
    padded = np.full(rows * width, fill, np.uint64)
    padded[:n] = values
    blocks = padded.reshape(rows, width)
    ahead = extreme.accumulate(blocks, axis=1).ravel()
    back = extreme.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return extreme(back[:n], ahead[width - 1 : width - 1 + n])


def anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of each anchor: text, place in the slice, bytes to the left and right in its context, both fingerprints."""
    empty = np.zeros(0, np.int64)
    if len(data) < LENGTH:
        return empty, empty, empty, empty, empty.astype(np.uint64), empty.astype(np.uint64)
    n = len(data)
    sizes = np.diff(offsets)
    text = np.repeat(np.arange(len(sizes)), sizes)
    left_end = offsets[1:][text] - np.arange(n)  # bytes from here to the end of the text
    prints = Fingerprints.of_bytes(data)
    grams = np.full(n, _LARGEST, np.uint64)
    rolled = np.minimum(prints.rolling(GRAM), _LARGEST - np.uint64(1))
    inside = left_end[: len(rolled)] >= GRAM
    grams[: len(rolled)][inside] = rolled[inside]
    least = _running(grams, PLACES, np.minimum, _LARGEST)
    least[left_end < LENGTH] = 0  # no string starts here
    # an anchor is the least of some string: the largest of the leasts of all strings around it
    around = _running(least[::-1], PLACES, np.maximum, np.uint64(0))[::-1]
    at = np.flatnonzero((around == grams) & (grams < _LARGEST) & (around > 0))
    left = np.minimum(at - offsets[text[at]], PLACES - 1)
    right = np.minimum(left_end[at], LENGTH)
    context = mix(prints.raw(at - left, at + right) + (left * 1024 + right).astype(np.uint64))
    return text[at], at, left, right, grams[at], context


# ---------------------------------------------------------------------------------------------- deep-shallow sorting


def _shared(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    differ = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (differ.bit_length() + 7) // 8


class BlindTrie:
    """A trie that keeps only where strings branch; a string is compared once with a leaf, not along its way."""

    def __init__(self, strings: list[bytes]) -> None:
        self._strings = strings
        self._root: list | None = None  # a leaf is [numbers], a branch is (depth, {byte: child}); -1 is the end

    def _byte(self, s: bytes, depth: int) -> int:
        return s[depth] if depth < len(s) else -1

    def insert(self, number: int) -> None:
        s = self._strings[number]
        if self._root is None:
            self._root = [number]
            return
        node = self._root
        while isinstance(node, tuple):
            kids = node[1]
            node = kids.get(self._byte(s, node[0])) or next(iter(kids.values()))
        t = self._strings[node[0]]
        depth = _shared(s, t)
        if depth == len(s) == len(t):
            node.append(number)
            return
        parent, node = None, self._root
        while isinstance(node, tuple) and node[0] < depth:
            parent, node = node, node[1][self._byte(s, node[0])]
        own = self._byte(s, depth)
        if isinstance(node, tuple) and node[0] == depth:
            node[1][own] = [number]
            return
        branch = (depth, {own: [number], self._byte(t, depth): node})
        if parent is None:
            self._root = branch
        else:
            parent[1][self._byte(s, parent[0])] = branch

    def order(self) -> list[int]:
        out: list[int] = []
        stack = [self._root]
        while stack:
            node = stack.pop()
            if isinstance(node, tuple):
                stack += [node[1][c] for c in sorted(node[1], reverse=True)]
            elif node:
                out += node
        return out


def deep_shallow(strings: list[bytes], group: np.ndarray, skip: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The order of the strings within their groups, and each one's common prefix with the one before (-1 at a start).

    The first ``skip`` bytes of a group's strings are known to be equal.
    """
    n = len(strings)
    sizes = np.array([len(s) for s in strings])
    width = -(-max(int(sizes.max()), skip + SHALLOW) // 8) * 8
    table = np.frombuffer(b"".join(s.ljust(width, b"\0") for s in strings), np.uint8).reshape(n, width)
    words = np.ascontiguousarray(table[:, skip : skip + SHALLOW]).view(">u8").astype(np.uint64)
    # multikey quicksort: what is equal so far is divided by the next eight bytes
    order = np.argsort(group, kind="stable")
    part = np.cumsum(np.diff(group[order], prepend=group[order][:1]) != 0)
    for k in range(words.shape[1]):
        tied = np.zeros(n, bool)
        same = part[1:] == part[:-1]
        tied[1:] |= same
        tied[:-1] |= same
        at = np.flatnonzero(tied)
        if not len(at):
            break
        key = words[order[at], k]
        moved = np.lexsort((key, part[at]))
        order[at] = order[at][moved]
        key = key[moved]
        fresh = np.zeros(n, bool)
        fresh[at[1:]] = key[1:] != key[:-1]
        part = np.cumsum(np.diff(part, prepend=part[:1]).astype(bool) | fresh)
    # blind tries order what the shallow depth left equal
    edges = np.flatnonzero(np.diff(part, prepend=-1, append=-1))
    for low, high in zip(edges[:-1].tolist(), edges[1:].tolist()):
        if high - low > 1:
            trie = BlindTrie(strings)
            for number in sorted(order[low:high].tolist()):
                trie.insert(number)
            order[low:high] = trie.order()
    common = np.full(n, -1)
    differ = table[order[1:]] != table[order[:-1]]
    first = np.where(differ.any(1), differ.argmax(1), width)
    first = np.minimum(first, np.minimum(sizes[order[1:]], sizes[order[:-1]]))
    inner = group[order[1:]] == group[order[:-1]]
    common[1:][inner] = first[inner]
    return order, common


def _furthest(order: np.ndarray, common: np.ndarray) -> np.ndarray:
    """Of each string, the longest prefix it shares with another of its group."""
    out = np.empty(len(order), np.int64)
    out[order] = np.maximum(common, np.append(common[1:], -1))
    return out


def repeated_places(contexts: list[bytes], left: np.ndarray, times: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Of each context the least and largest place of the anchor in a repeated string; (1, 0) if there is none."""
    n = len(contexts)
    right = np.array([len(c) for c in contexts]) - left
    tails = [c[k:] for c, k in zip(contexts, left.tolist())]
    heads = [c[:k][::-1] for c, k in zip(contexts, left.tolist())]
    r_order, r_common = deep_shallow(tails, group, GRAM)
    l_order, l_common = deep_shallow(heads, group)
    low, high = np.maximum(0, LENGTH - right), np.minimum(left, PLACES - 1)
    out = np.tile([1, 0], (n, 1))
    copies = (times > 1) & (low <= high)
    out[copies] = np.stack([low, high], 1)[copies]
    low = np.maximum(low, LENGTH - _furthest(r_order, r_common))
    high = np.minimum(high, _furthest(l_order, l_common))
    able = np.flatnonzero(low <= high)
    if not len(able):
        return out
    left_class, right_class = np.empty(n, np.int64), np.empty(n, np.int64)
    for place in range(int(low[able].min()), int(high[able].max()) + 1):
        at = able[(low[able] <= place) & (place <= high[able])]
        if len(at) < 2:
            continue
        left_class[l_order] = np.cumsum(l_common < place)
        right_class[r_order] = np.cumsum(r_common < LENGTH - place)
        _, which, counts = np.unique(left_class[at] * (n + 1) + right_class[at], return_inverse=True, return_counts=True)
        found = at[counts[which] > 1]
        fresh = out[found, 0] > out[found, 1]
        out[found[fresh], 0] = place
        out[found, 0] = np.minimum(out[found, 0], place)
        out[found, 1] = np.maximum(out[found, 1], place)
    return out


# ------------------------------------------------------------------------------------------------------- Spark's part


def _fields(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


_ANCHOR = (
    ("key", T.BinaryType()),
    ("at", T.IntegerType()),
    ("left", T.IntegerType()),
    ("right", T.IntegerType()),
    ("gram", T.LongType()),
    ("context", T.LongType()),
)
_PLACES = _fields(("gram", T.LongType()), ("context", T.LongType()), ("low", T.IntegerType()), ("high", T.IntegerType()))


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            data, offsets = blob(part.column(1))
            text, at, left, right, gram, context = anchors(data, offsets)
            small = [pa.array(x.astype(np.int32)) for x in (at - offsets[text], left, right)]
            keys = part.column(0).take(pa.array(text))
            columns = [keys, *small, pa.array(gram.view(np.int64)), pa.array(context.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, [name for name, _ in _ANCHOR])


def _with_bytes(texts: DataFrame, contexts: DataFrame) -> DataFrame:
    """The contexts with their bytes, cut from the texts they first occur in."""
    wanted = contexts.groupBy("key").agg(F.collect_list(F.struct("at", "left", "right", "gram", "context", "times")).alias("wanted"))
    found = texts.join(wanted.hint("shuffle_hash"), "key").select("text", "wanted")
    schema = _fields(
        ("gram", T.LongType()), ("context", T.LongType()), ("times", T.LongType()),
        ("left", T.IntegerType()), ("bytes", T.BinaryType()),
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                data, offsets = blob(part.column(0))
                lists = part.column(1)
                flat = lists.flatten()
                row = np.repeat(np.arange(part.num_rows), lists.value_lengths().to_numpy())
                field = {name: flat.field(name) for name in ("at", "left", "right", "gram", "context", "times")}
                at, left, right = (field[name].to_numpy() for name in ("at", "left", "right"))
                low, high = offsets[row] + at - left, offsets[row] + at + right
                whole = data.tobytes()
                found = pa.array([whole[a:b] for a, b in zip(low.tolist(), high.tolist())], pa.binary())
                columns = [field["gram"], field["context"], field["times"], field["left"], found]
                for start in range(0, len(found), 5_000):
                    yield pa.RecordBatch.from_arrays([c.slice(start, 5_000) for c in columns], schema.names)

    return found.mapInArrow(cut, schema)


def _sorted_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeated places of contexts that arrive group by group."""

    def solve(rows: pa.Table) -> pa.RecordBatch:
        gram = rows["gram"].to_numpy()
        group = np.cumsum(np.diff(gram, prepend=gram[:1]) != 0)
        left, times = rows["left"].to_numpy().astype(np.int64), rows["times"].to_numpy()
        places = repeated_places(rows["bytes"].to_pylist(), left, times, group)
        some = places[:, 0] <= places[:, 1]
        columns = [pa.array(gram[some]), pa.array(rows["context"].to_numpy()[some])]
        columns += [pa.array(places[some, i].astype(np.int32)) for i in (0, 1)]
        return pa.RecordBatch.from_arrays(columns, _PLACES.names)

    waiting: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        for start in range(0, batch.num_rows, BATCH_CONTEXTS):
            waiting.append(batch.slice(start, BATCH_CONTEXTS))
            size += waiting[-1].num_rows
            if size >= BATCH_CONTEXTS:
                rows = pa.Table.from_batches(waiting)
                gram = rows["gram"].to_numpy()
                ends = np.flatnonzero(gram != gram[-1])
                done = int(ends[-1]) + 1 if len(ends) else 0  # the last group may go on
                if done:
                    yield solve(rows.slice(0, done))
                waiting = rows.slice(done).to_batches()
                size = rows.num_rows - done
    if size:
        yield solve(pa.Table.from_batches(waiting))


def _shuffled_groups(contexts: DataFrame) -> DataFrame:
    """The same for groups of any size: every string by two fingerprints, counted in a shuffle."""
    schema = _fields(
        ("gram", T.LongType()), ("context", T.LongType()), ("times", T.LongType()), ("place", T.IntegerType()),
        ("one", T.LongType()), ("two", T.LongType()),
    )

    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 200):
                rows = batch.slice(start, 200)
                data, offsets = blob_of_binary(rows.column(4))
                left = rows.column(3).to_numpy().astype(np.int64)
                low, high = np.maximum(0, LENGTH - (np.diff(offsets) - left)), np.minimum(left, PLACES - 1)
                counts = np.maximum(0, high - low + 1)
                row = np.repeat(np.arange(rows.num_rows), counts)
                place = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts) + low[row]
                starts = offsets[row] + left[row] - place
                one = Fingerprints.of_bytes(data).of(starts, starts + LENGTH)
                two = Fingerprints.of_bytes(np.uint8(255) - data[::-1]).of(len(data) - starts - LENGTH, len(data) - starts)
                at = pa.array(row)
                columns = [rows.column(i).take(at) for i in range(3)]
                columns += [pa.array(place.astype(np.int32)), pa.array(one.view(np.int64)), pa.array(two.view(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    found = contexts.mapInArrow(strings, schema)
    string = ["gram", "place", "one", "two"]
    again = found.groupBy(*string).agg(F.sum("times").alias("total")).where("total > 1")
    return found.join(again, string, "left_semi").groupBy("gram", "context").agg(
        F.min("place").alias("low"), F.max("place").alias("high")
    )


def blob_of_binary(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    values = values.cast(pa.large_binary())
    offsets = np.frombuffer(values.buffers()[1], np.int64)[values.offset : values.offset + len(values) + 1]
    return np.frombuffer(values.buffers()[2], np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


RESULT = (
    ("n_bytes", T.LongType()),
    ("n_removed", T.LongType()),
    ("n_spans", T.LongType()),
    ("kept_sha256", T.StringType()),
)


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text, ranges) to (doc_id, *RESULT)."""
    names = ["doc_id", *(name for name, _ in RESULT)]
    for batch in batches:
        for part in slices(batch, "text"):
            data, offsets = blob(part.column(1))
            lists = part.column(2)
            flat = lists.flatten()
            row = np.repeat(np.arange(part.num_rows), lists.value_lengths().fill_null(0).to_numpy())
            depth = np.zeros(len(data) + 1, np.int64)
            np.add.at(depth, flat.field("from").to_numpy() + offsets[row], 1)
            np.add.at(depth, flat.field("to").to_numpy() + offsets[row], -1)
            gone = np.cumsum(depth[:-1]) > 0
            edges = gone.copy()
            edges[1:] &= ~gone[:-1]
            starts = offsets[:-1][np.diff(offsets) > 0]
            edges[starts] = gone[starts]
            sums, spans = np.concatenate([[0], np.cumsum(gone)]), np.concatenate([[0], np.cumsum(edges)])
            low, high = offsets[:-1], offsets[1:]
            digests = [
                hashlib.sha256(data[a:b][~gone[a:b]].tobytes()).hexdigest() for a, b in zip(low.tolist(), high.tolist())
            ]
            columns = [pa.array(x) for x in (high - low, sums[high] - sums[low], spans[high] - spans[low])]
            yield pa.RecordBatch.from_arrays([part.column(0), *columns, pa.array(digests, pa.string())], names)


def remove_repeated_bytes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", group_contexts: int = GROUP_CONTEXTS) -> DataFrame:
    """Bytes, removed bytes and spans of each document, and the digest of what stays."""
    text_or_empty = F.coalesce(F.col("text"), F.lit(""))
    row_key = F.unhex(F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.lit("\n"), text_or_empty).cast("binary")))
    source = pick(docs, doc_id, text).toDF("doc_id", "text").select("doc_id", "text", row_key.alias("key"))
    keyed = source.select("key", "text")

    found = stored(keyed.mapInArrow(_anchor_rows, _fields(*_ANCHOR)), "anchors")
    shared = found.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1").select("gram")
    several = stored(found.join(shared, "gram", "left_semi"), "shared-anchors")
    contexts = several.groupBy("gram", "context").agg(
        F.count("*").alias("times"), F.min(F.struct("key", "at", "left", "right")).alias("first")
    )
    contexts = stored(contexts.select("gram", "context", "times", "first.*"), "contexts")
    sizes = contexts.groupBy("gram").agg(F.count("*").alias("members")).where("members > 1")
    mixed = contexts.join(sizes, "gram")
    # a row of each text is enough to cut contexts from
    once = keyed
    if not keyed.groupBy("key").count().where("count > 1").isEmpty():
        once = keyed.dropDuplicates(["key"])
    small = _with_bytes(once, mixed.where(F.col("members") <= group_contexts))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = small.repartition(parts, "gram").sortWithinPartitions("gram", "context")
    places = ordered.mapInArrow(_sorted_groups, _PLACES)
    large = mixed.where(F.col("members") > group_contexts)
    if not large.isEmpty():
        places = places.union(_shuffled_groups(stored(_with_bytes(once, large), "large-contexts")).select(*_PLACES.names))
    alone = contexts.where("times > 1").join(sizes, "gram", "left_anti").select(
        "gram", "context", F.greatest(F.lit(0), LENGTH - F.col("right")).alias("low"), F.least("left", F.lit(PLACES - 1)).alias("high")
    ).where("low <= high")
    ranges = several.join(stored(places.union(alone), "places"), ["gram", "context"]).select(
        "key", (F.col("at") - F.col("high")).alias("from"), (F.col("at") - F.col("low") + LENGTH).alias("to")
    )
    by_text = ranges.groupBy("key").agg(F.collect_set(F.struct("from", "to")).alias("ranges"))
    by_text = stored(by_text, "ranges")
    joined = source.join(by_text, "key", "left").select("doc_id", "text", "ranges")
    schema = T.StructType([source.schema["doc_id"], *_fields(*RESULT).fields])
    return joined.mapInArrow(_kept, schema).withColumnRenamed("doc_id", doc_id)
