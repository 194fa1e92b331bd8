"""Conversation prefix tries from sorted matrices of turn ids.

Two conversations share a node of depth d if their first d turns (role, text) are equal. A turn becomes a 128-bit id and
its number of words; texts are not shuffled. Conversations are range-partitioned and sorted by their id sequences, equal
ones by conversation id, so every node is one run of neighbouring rows, and a run of equal conversations splits over
partitions like any other.

A task cuts its sorted rows in blocks of at most ``CELLS`` matrix cells. A block's ids become a matrix, one row for each
conversation, padded with -1, in the order that ``np.lexsort`` gives. Where a row differs from the one before in any
column up to d, a node of depth d + 1 starts: an OR accumulated along the columns marks all starts at once, and
``reduceat`` over the starts of a column aggregates its nodes. Sums over subtrees come from one value for each row that
collects, from the deepest column up, what the nodes that start there contribute.

Only the nodes along the first and the last row of a block can go on in another one. Each block gives those two paths as
parts, which are few and are put together in DataFrame operations; all other nodes are complete. Hashes of the members'
ids stream over pieces in order.

Cases: a null role or text is empty; turns of equal number are taken by their ids' order; a row without conversation id
belongs to no conversation; a conversation without turns is a member of the root only; repeated rows are further turns;
an empty table has no nodes; further columns are ignored. A conversation is one row of a task, whatever its length.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.llm.storage import discard, stored
from ledgerflow.llm.text import pick

#: Matrix cells of a block; a longer conversation is a block of its own.
CELLS = 1 << 20
_EMPTY = hashlib.sha256(b"").hexdigest()
_ROOT = bytes(16)
_NODE, _PATH, _ENDS = 0, 1, 2

_PARTS = (
    "kind int, conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, "
    "saved_tokens bigint, words bigint, path string, print binary, parent_print binary, ends string"
)


def conversation_turns(
    conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """(conv_id, turns): each conversation's turns in order, as (turn, id, words)."""
    rows = pick(conversations, conv_id, turn, role, text).toDF("conv_id", "turn", "role", "text").where("conv_id IS NOT NULL")
    rows = rows.select("conv_id", "turn", *(F.coalesce(c, F.lit("")).alias(c) for c in ("role", "text")))
    whole = F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")
    words = F.regexp_count("text", F.lit("[^\\x20\\x09-\\x0D]+")).cast("long")
    turns = rows.select("conv_id", F.struct("turn", F.unhex(F.md5(whole.cast("binary"))).alias("id"), words.alias("words")).alias("t"))
    return turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))


def with_shared_openings(turns: DataFrame, every: int = 20, longest: int = 4) -> DataFrame:
    """The conversations with their openings replaced by those of conversation ``conv_id - conv_id % every``.

    The hash of its id modulo ``longest`` says how many turns of a conversation are replaced.
    """
    heads = turns.where(F.col("conv_id") % every == 0).select(
        F.col("conv_id").alias("base"), F.slice("turns", 1, longest - 1).alias("head")
    )
    taken = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % longest).cast("int")
    found = turns.withColumn("h", taken).join(heads, F.col("base") == F.col("conv_id") - F.col("conv_id") % every, "left")
    opening = F.when(F.col("head").isNotNull() & (F.col("h") > 0), F.slice("head", F.lit(1), F.greatest("h", F.lit(1))))
    none = F.slice("turns", 1, 0)
    rest = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0)))
    return found.select("conv_id", F.concat(F.coalesce(opening, none), rest).alias("turns"))


@dataclass
class _Rows:
    """Conversations in order: ids, lengths, and the turns of all one after the other."""

    conv: np.ndarray
    length: np.ndarray
    high: np.ndarray
    low: np.ndarray
    words: np.ndarray

    def part(self, start: int, end: int) -> _Rows:
        at = np.concatenate([[0], np.cumsum(self.length)])
        flat = slice(int(at[start]), int(at[end]))
        return _Rows(self.conv[start:end], self.length[start:end], self.high[flat], self.low[flat], self.words[flat])

    @staticmethod
    def join(parts: list[_Rows]) -> _Rows:
        return _Rows(*(np.concatenate([getattr(p, c) for p in parts]) for c in ("conv", "length", "high", "low", "words")))

    @staticmethod
    def of(batch: pa.RecordBatch) -> _Rows:
        ids = batch.column(1)
        pairs = np.frombuffer(b"".join(ids.flatten().to_pylist()), ">u8").astype(np.uint64).reshape(-1, 2)
        lengths = np.diff(ids.offsets.to_numpy()).astype(np.int64)
        words = batch.column(2).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        return _Rows(batch.column(0).to_numpy(zero_copy_only=False), lengths, pairs[:, 0], pairs[:, 1], words)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[_Rows]:
    held: list[_Rows] = []
    count = width = 0
    for batch in batches:
        rows, start = _Rows.of(batch), 0
        while start < len(rows.conv):
            widths = np.maximum(np.maximum.accumulate(rows.length[start:]), max(width, 1))
            fits = int(np.searchsorted(widths * (count + 1 + np.arange(len(widths))), CELLS, "right"))
            if not fits and not count:
                fits = 1
            if fits:
                held.append(rows.part(start, start + fits))
                count, width, start = count + fits, int(widths[fits - 1]), start + fits
            if start < len(rows.conv):
                yield _Rows.join(held)
                held, count, width = [], 0, 0
    if held:
        yield _Rows.join(held)


@dataclass
class _Out:
    """Rows of ``_PARTS`` to be."""

    names: list[str] = field(default_factory=lambda: [c.split()[0] for c in _PARTS.split(", ")])
    batches: list[pa.RecordBatch] = field(default_factory=list)

    def add(self, n: int, kind: int, **columns) -> None:
        kinds = {"int": pa.int32(), "bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}
        arrays = []
        for item in _PARTS.split(", "):
            name, type_name = item.split()
            values = np.full(n, kind, np.int32) if name == "kind" else columns.get(name)
            arrays.append(pa.nulls(n, kinds[type_name]) if values is None else pa.array(values, kinds[type_name]))
        self.batches.append(pa.RecordBatch.from_arrays(arrays, self.names))


def _hash_of(ids: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, ids.tolist())).encode()).hexdigest()


def trie_parts(rows: _Rows, label: str) -> list[pa.RecordBatch]:
    """The complete nodes of a block of sorted rows, the parts along its first and last row, and their members' ids."""
    n, depth = len(rows.conv), int(rows.length.max())
    # dense ids in the order of the turns' ids, as a padded matrix
    order = np.lexsort((rows.low, rows.high))
    fresh = np.ones(len(order), bool)
    fresh[1:] = (rows.high[order][1:] != rows.high[order][:-1]) | (rows.low[order][1:] != rows.low[order][:-1])
    dense = np.empty(len(order), np.int32)
    dense[order] = np.cumsum(fresh) - 1
    at = np.repeat(np.arange(n), rows.length), np.arange(len(order)) - np.repeat(np.cumsum(rows.length) - rows.length, rows.length)
    ids, words = np.full((n, depth), -1, np.int32), np.zeros((n, depth), np.int64)
    ids[at], words[at] = dense, rows.words
    order = np.lexsort((rows.conv, *(ids[:, d] for d in range(depth - 1, -1, -1))))
    ids, words, conv, length = ids[order], words[order], rows.conv[order], rows.length[order]

    change = np.ones((n, depth), bool)
    change[1:] = ids[1:] != ids[:-1]
    starts = np.logical_or.accumulate(change, axis=1)
    begins = starts & (ids >= 0)
    runs = [np.zeros(1, np.int64)] + [np.flatnonzero(starts[:, d]) for d in range(depth)]
    least = [np.minimum.reduceat(conv, run) for run in runs]

    ends_of = [[rows.high[:0], rows.low[:0]]] * 2
    bounds = np.concatenate([[0], np.cumsum(rows.length)])
    ends_of = [(rows.high[a:b], rows.low[a:b]) for a, b in ((bounds[i], bounds[i + 1]) for i in (order[0], order[-1]))]
    prints = [_prints(*pair) for pair in ends_of]
    long = [int(length[0]), int(length[-1])]
    out = _Out()
    saved, leaves = np.zeros(n, np.int64), np.zeros(n, np.int64)
    # totals of complete nodes under the path's node of the depth below, for the first and the last row
    below = [(0, 0), (0, 0)]
    for d in range(depth, -1, -1):
        run = runs[d]
        sizes = np.diff(np.append(run, n))
        valid = length[run] >= d  # a run of equal prefixes, or of shorter rows between them
        valid &= (ids[run, d - 1] >= 0) if d else True
        ending = np.add.reduceat(length == d, run)
        children = np.add.reduceat(begins[:, d], run) if d < depth else np.zeros(len(run), np.int64)
        spent = (sizes - 1) * words[run, d - 1] if d else np.zeros(1, np.int64)
        under = np.add.reduceat(saved, run), np.add.reduceat(leaves, run)
        outer = np.zeros(len(run), bool)
        outer[[0, -1]] = True
        complete = valid & ~outer
        own_leaves = (children == 0).astype(np.int64)
        if complete.any():
            place = np.flatnonzero(complete)
            above = np.searchsorted(runs[d - 1], run[place], "right") - 1
            first, last = above == 0, above == len(runs[d - 1]) - 1
            open_parent = first | last
            hashes = [
                _hash_of(conv[run[i] : run[i] + ending[i]]) if ending[i] else _EMPTY for i in place.tolist()
            ]
            parent = least[d - 1][above]
            out.add(
                len(place),
                _NODE,
                conv_id=least[d][place],
                depth=np.full(len(place), d),
                parent_conv_id=[None if o else p for o, p in zip(open_parent.tolist(), parent.tolist())],
                parent_print=[
                    (prints[0][d - 1] if f else prints[1][d - 1]) if o else None
                    for o, f in zip(open_parent.tolist(), first.tolist())
                ],
                n_convs=sizes[place],
                n_children=children[place],
                n_leaves=(under[1] + own_leaves)[place],
                saved_tokens=(under[0] + spent)[place],
                ends=hashes,
            )
        shared = len(run) == 1
        deeper_shared = d < depth and len(runs[d + 1]) == 1
        for side, i in ((0, 0), (1, len(run) - 1)):
            if long[side] < d:
                continue
            again = side == 1 and shared
            inner = [s for s in ((0, 1) if shared else (side,)) if long[s] > d]
            if len(inner) == 2 and deeper_shared:
                inner = [0]
            out.add(
                1,
                _PATH,
                conv_id=[int(least[d][i])],
                depth=[d],
                path=[f"{label}-{side}"],
                print=[prints[side][d]],
                parent_print=[prints[side][d - 1] if d else None],
                words=[int(words[run[i], d - 1]) if d else 0],
                n_convs=[0 if again else int(sizes[i])],
                n_children=[0 if again else int(children[i]) - len(inner)],
                n_leaves=[0 if again else int(under[1][i]) - sum(below[s][1] for s in inner)],
                saved_tokens=[0 if again else int(under[0][i]) - sum(below[s][0] for s in inner)],
            )
            if ending[i] and not again:
                members = conv[run[i] : run[i] + ending[i]]
                out.add(1, _ENDS, conv_id=[int(members[0])], print=[prints[side][d]], ends=[",".join(map(str, members.tolist()))])
        below = [(int(under[0][i]), int(under[1][i])) for i in (0, len(run) - 1)]
        saved[run[complete]] += spent[complete]
        leaves[run[complete]] += own_leaves[complete]
    return out.batches


def _prints(high: np.ndarray, low: np.ndarray) -> list[bytes]:
    """One 128-bit key for each prefix of a sequence of turns, the empty one first."""
    found = [_ROOT]
    for a, b in zip(high.tolist(), low.tolist()):
        found.append(hashlib.md5(found[-1] + a.to_bytes(8, "big") + b.to_bytes(8, "big")).digest())
    return found


def _split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    task = TaskContext.get()
    for number, rows in enumerate(_blocks(batches)):
        yield from trie_parts(rows, f"{task.partitionId() if task else 0}-{number}")


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(print, ends) from pieces that come in the order of print and conversation id."""
    current, digest = None, None
    for batch in batches:
        done = []
        for key, piece in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if key != current:
                if current is not None:
                    done.append((current, digest.hexdigest()))
                current, digest = key, hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(piece.encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in done], pa.binary()), pa.array([h for _, h in done])], ["print", "ends"])
    if current is not None:
        yield pa.RecordBatch.from_arrays([pa.array([current], pa.binary()), pa.array([digest.hexdigest()])], ["print", "ends"])


def _recombined(parts: DataFrame) -> DataFrame:
    """The nodes along the blocks' borders, each put together from its parts, with their prints."""
    paths = parts.where(F.col("kind") == _PATH)
    merged = paths.groupBy("print").agg(
        F.min("depth").alias("depth"), F.min("parent_print").alias("parent_print"), F.min("conv_id").alias("conv_id"),
        F.sum("n_convs").alias("n_convs"), F.max("words").alias("words"), F.sum("n_children").alias("n_children"),
        F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"), F.min("path").alias("owner"),
    )
    merged = stored(merged, "trie-merged")
    inner = merged.groupBy(F.col("parent_print").alias("print")).agg(F.count("*").alias("inner"))
    children = F.col("n_children") + F.coalesce("inner", F.lit(0))
    own = merged.join(inner, "print", "left").select(
        "print", "parent_print", "depth", "conv_id", "n_convs", "owner", children.alias("n_children"),
        (F.col("n_leaves") + (children == 0).cast("long")).alias("own_leaves"),
        (F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("words")).alias("own_saved"),
    )
    own = stored(own, "trie-own")
    # what a node owns counts for all nodes above it: each on one path, summed from the deepest up, then over paths
    mine = F.col("owner") == F.col("path")
    walked = paths.select("path", "depth", "print").join(own.select("print", "owner", "own_leaves", "own_saved"), "print")
    up = Window.partitionBy("path").orderBy(F.col("depth").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = [F.sum(F.when(mine, F.col(c)).otherwise(F.lit(0))).over(up).alias(c) for c in ("own_leaves", "own_saved")]
    totals = walked.select("print", *sums).groupBy("print").agg(
        F.sum("own_leaves").alias("n_leaves"), F.sum("own_saved").alias("saved_tokens")
    )
    pieces = parts.where(F.col("kind") == _ENDS).select("print", F.col("ends").alias("piece"), "conv_id")
    dealt = pieces.repartition("print").sortWithinPartitions("print", "conv_id").select("print", "piece")
    hashes = dealt.mapInArrow(_digest, "print binary, ends string")
    return stored(
        own.select("print", "parent_print", "depth", "conv_id", "n_convs", "n_children").join(totals, "print").join(hashes, "print", "left"),
        "trie-border",
    )


_COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def prefix_trie(turns: DataFrame) -> DataFrame:
    """One row for each node of the trie of conversations (conv_id, turns)."""
    rows = turns.select("conv_id", F.col("turns.id").alias("ids"), F.col("turns.words").alias("words"))
    dealt = rows.repartitionByRange("ids", "conv_id").sortWithinPartitions("ids", "conv_id")
    parts = stored(dealt.mapInArrow(_split, _PARTS), "trie-parts")
    border = _recombined(parts)
    names = border.select(F.col("print").alias("parent_print"), F.col("conv_id").alias("border_conv_id"))
    complete = parts.where(F.col("kind") == _NODE).withColumnRenamed("ends", "ends_sha256")
    inside = complete.where("parent_print IS NULL").select(*_COLUMNS)
    below = complete.where("parent_print IS NOT NULL").join(names, "parent_print")
    below = below.withColumn("parent_conv_id", F.col("border_conv_id")).select(*_COLUMNS)
    edge = border.join(names, "parent_print", "left").withColumn("parent_conv_id", F.col("border_conv_id"))
    edge = edge.withColumn("ends_sha256", F.coalesce("ends", F.lit(_EMPTY))).select(*_COLUMNS)
    return inside.union(below).union(edge)


def conversation_trie(
    conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """The prefix trie of the conversations, after their openings are replaced by shared ones."""
    turns = stored(conversation_turns(conversations, conv_id, turn, role, text), "trie-turns")
    rebuilt = stored(with_shared_openings(turns), "trie-rebuilt")
    discard(turns)
    return prefix_trie(rebuilt)
