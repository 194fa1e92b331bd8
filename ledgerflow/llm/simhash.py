"""SimHash near-duplicate components by pigeonhole blocks.

A text's words are lower-cased (A-Z) and its shingles are its runs of four words, repeats included (all of its words, if
it has fewer). A bit of the 64-bit fingerprint is 1 if it is set in over half of the shingles' XXH64. Two fingerprints
are linked if they differ in ``DISTANCE`` bits or fewer, and components are those of links.

Blocks: the 64 bits are cut in ``BLOCKS`` blocks. Four differing bits touch at most four of them, so a linked pair agrees
in the ``SHARED`` others: every choice of that many blocks is a table, and fingerprints meet on the bits of the table's
blocks. All the work is on distinct fingerprints, so copies meet nobody.

No bucket gives all its pairs, whatever its size: up to ``WHOLE`` fingerprints are compared with each other and give the
links that connect them, one less than they are at most; those of larger buckets are compared with the bucket's least
and greatest. Where a large bucket then still holds several components, its fingerprints meet at midpoints, which is
exact as well: two fingerprints are linked just if some value is at most two bits away from both, so each one meets the
others at the 2,081 values around it, and a value has at most that many fingerprints around itself.

Cases: a null text is empty; a text without words has fingerprint 0, which is linked like any other; repeated rows share
fingerprint and component; a component is named by its smallest id, null ids only if it has no other; an empty table has
no rows; further columns are ignored. Long texts are hashed in runs of ``RUN`` shingles.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.llm.near_dup import components
from ledgerflow.llm.storage import discard, stored
from ledgerflow.llm.text import BLANK_WORDS, LOWER, Words, blob, map_texts, pick

SHINGLE, SEED, BITS, DISTANCE = 4, 42, 64, 4
#: Blocks that the bits are cut in, and blocks that a linked pair surely shares.
BLOCKS, SHARED = 7, 3
#: Fingerprints of a bucket up to which all its pairs are verified.
WHOLE = 64
#: Shingles hashed at once.
RUN = 1 << 17


def fingerprints(texts: pa.Array) -> np.ndarray:
    """The 64-bit fingerprint of each text."""
    data, offsets = blob(texts)
    data = LOWER[data]
    words = Words(data, offsets, BLANK_WORDS)
    # the words alone, one blank behind each
    lengths = words.ends - words.starts + 1
    ends = np.cumsum(lengths)
    starts = ends - lengths
    joined = np.full(int(ends[-1]) if len(ends) else 0, 0x20, np.uint8)
    inside = np.ones(len(joined), bool)
    inside[ends - 1] = False
    joined[inside] = data[words.inside]
    last = words.first[1:][words.text]
    place = np.arange(len(starts))
    used = (place + SHINGLE <= last) | (place == words.first[:-1][words.text])
    first = starts[used]
    until = ends[np.minimum(place + SHINGLE, last)[used] - 1] - 1
    text = words.text[used]
    ones = np.zeros((len(offsets) - 1, BITS), np.int64)
    view = memoryview(joined)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(first), RUN):
        run = slice(at, at + RUN)
        spans = zip(first[run].tolist(), until[run].tolist())
        hashes = np.array([digest(view[a:b], SEED) for a, b in spans], np.uint64)
        heads = np.flatnonzero(np.diff(text[run], prepend=-1))
        for bit in range(BITS):
            ones[text[run][heads], bit] += np.add.reduceat(((hashes >> np.uint64(bit)) & np.uint64(1)).astype(np.int64), heads)
    total = np.bincount(text, minlength=len(ones))
    set_bits = 2 * ones > total[:, None]
    return np.packbits(set_bits, axis=1, bitorder="little").view(np.uint64).reshape(-1)


def block_masks(blocks: int, shared: int) -> list[int]:
    """The bits of every choice of ``shared`` of the ``blocks`` blocks, as signed 64-bit masks."""
    borders = [round(BITS * i / blocks) for i in range(blocks + 1)]
    parts = [(1 << b) - (1 << a) for a, b in zip(borders, borders[1:])]
    masks = [sum(chosen) for chosen in combinations(parts, shared)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _bits(values: list[int]) -> Column:
    return F.array(*[F.lit(v).cast("long") for v in values])


def _near(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b)) <= DISTANCE


def _buckets(prints: DataFrame) -> DataFrame:
    """(mask, shared, n, low, high, print) of every fingerprint in a bucket of two or more."""
    tables = prints.select("print", F.explode(_bits(block_masks(BLOCKS, SHARED))).alias("mask"))
    rows = tables.withColumn("shared", F.col("print").bitwiseAND(F.col("mask")))
    sizes = rows.groupBy("mask", "shared").agg(F.count("*").alias("n"), F.min("print").alias("low"), F.max("print").alias("high"))
    found = stored(sizes.where("n > 1"), "simhash-buckets")
    # the planner's estimate leaves out what explode multiplies, so it would broadcast the rows
    members = stored(rows.hint("merge").join(found, ["mask", "shared"]), "simhash-members")
    discard(found)
    return members


def spanning_links(prints: np.ndarray) -> list[tuple[int, int]]:
    """Links (a, b) that connect the same ones of a few fingerprints as all their links do."""
    near = np.bitwise_count((prints[:, None] ^ prints).view(np.uint64)) <= DISTANCE
    open_, found = set(range(len(prints))), []
    while open_:
        reached = [open_.pop()]
        while reached:
            at = reached.pop()
            fresh = [i for i in np.flatnonzero(near[at]).tolist() if i in open_]
            open_.difference_update(fresh)
            reached += fresh
            found += [(int(min(prints[at], prints[i])), int(max(prints[at], prints[i]))) for i in fresh]
    return found


def _span(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column(0)
        values = lists.flatten().to_numpy()
        bounds = np.concatenate([[0], np.cumsum(np.diff(lists.offsets.to_numpy()))])
        found = {link for a, b in zip(bounds.tolist(), bounds[1:].tolist()) for link in spanning_links(np.sort(values[a:b]))}
        pairs = sorted(found)
        yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in pairs], pa.int64()) for i in (0, 1)], ["a", "b"])


def _links(members: DataFrame) -> DataFrame:
    """Linked pairs (a, b): enough to connect small buckets, and those with the least or greatest one of large buckets."""
    small = members.where(F.col("n") <= WHOLE).groupBy("mask", "shared").agg(F.collect_list("print").alias("prints"))
    within = small.select("prints").mapInArrow(_span, "a bigint, b bigint")
    ends = members.where(F.col("n") > WHOLE).select("print", F.explode(F.array("low", "high")).alias("end"))
    stars = ends.where((F.col("print") != F.col("end")) & _near(F.col("print"), F.col("end")))
    return within.union(stars.select(F.least("print", "end"), F.greatest("print", "end"))).distinct()


def _open(members: DataFrame, roots: DataFrame | None) -> DataFrame:
    """The distinct fingerprints of large buckets that hold more than one component."""
    large = members.where(F.col("n") > WHOLE).select("mask", "shared", "print")
    component = F.col("print")
    if roots is not None:
        large = large.join(roots.withColumnRenamed("node", "print"), "print", "left")
        component = F.coalesce("root", "print")
    rows = large.select("mask", "shared", "print", component.alias("component"))
    mixed = rows.groupBy("mask", "shared").agg(F.min("component").alias("c"), F.max("component").alias("d")).where("c <> d")
    return rows.join(mixed.select("mask", "shared"), ["mask", "shared"], "left_semi").select("print").distinct()


def _flipped(value: Column, bit: Column) -> Column:
    """The value with one bit flipped; bit ``BITS`` is none."""
    one = F.when(bit < BITS, F.call_function("shiftleft", F.lit(1).cast("long"), bit)).otherwise(F.lit(0).cast("long"))
    return value.bitwiseXOR(one)


def _midpoint_links(prints: DataFrame) -> DataFrame:
    """Links that connect the same fingerprints as all pairs do: each one with the least around a value two bits away."""
    both = F.explode(F.sequence(F.lit(0), F.lit(BITS)))
    first = prints.select("print", both.alias("i")).withColumn("value", _flipped(F.col("print"), F.col("i")))
    second = first.select("print", "i", "value", both.alias("j")).where("i < j")
    around = second.select("print", _flipped(F.col("value"), F.col("j")).alias("value")).union(prints.select("print", "print"))
    # a window and no join: the planner takes the rows around for as few as the fingerprints, and would broadcast them
    least = F.min("print").over(Window.partitionBy("value"))
    return around.select(least.alias("a"), F.col("print").alias("b")).where("a <> b").distinct()


def components_of(prints: DataFrame) -> DataFrame | None:
    """(node, root) of every linked fingerprint of a column ``print`` of distinct ones; None if there is no link."""
    members = _buckets(prints)
    links = stored(_links(members), "simhash-links")
    roots = None if links.isEmpty() else stored(components(links), "simhash-roots")
    rest = stored(_open(members, roots), "simhash-open")
    discard(members, links)
    if rest.isEmpty():
        return roots
    more = _midpoint_links(rest)
    if roots is not None:
        more = more.union(roots.where("node <> root").select(F.col("root").alias("a"), F.col("node").alias("b")))
    links = stored(more, "simhash-links")
    return roots if links.isEmpty() else components(links)


def simhash_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row; fingerprints are 16 lowercase hex digits."""
    added = T.StructType([T.StructField("print", T.LongType())])

    def make():
        def compute(part: pa.RecordBatch) -> list[pa.Array]:
            return [pa.array(fingerprints(part.column(part.schema.get_field_index("text"))).view(np.int64))]

        return compute

    source = pick(docs, doc_id, text).toDF("doc_id", "text")
    rows = stored(map_texts(source, "text", added, make, ("doc_id",)), "simhash-prints")
    owners = stored(rows.groupBy("print").agg(F.min("doc_id").alias("least")), "simhash-owners")
    roots = components_of(owners.select("print"))
    if roots is None:
        named = owners.select("print", F.col("least").alias("component_id"))
    else:
        rooted = owners.join(roots.withColumnRenamed("node", "print"), "print", "left")
        rooted = stored(rooted.select("print", "least", F.coalesce("root", "print").alias("root")), "simhash-rooted")
        leads = stored(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "simhash-leads")
        named = rooted.join(leads, "root").select("print", "component_id")
    named = stored(named, "simhash-named")
    hexed = F.lower(F.lpad(F.hex("print"), 16, "0"))
    return rows.join(named, "print").select(F.col("doc_id").alias(doc_id), hexed.alias("fingerprint"), "component_id")
