"""Near-duplicate classes by improved consistent weighted sampling over TF-IDF shingles.

A text's shingles are its runs of five lower-cased words (all of its words, if it has fewer). A shingle weighs how often
the text has it times its inverse document frequency: the mean of that of its words, counted over all documents in a
table of ``WORD_BUCKETS`` cells whose size doesn't grow with the corpus. Two texts are linked if the weighted Jaccard
similarity of their shingles is ``SIMILARITY`` or more, and classes are the connected components of links.

Sketch: each shingle's weight is laid out in pieces of at most ``PIECE``, each piece goes to one of ``SAMPLES`` bins by
its fingerprint, and every bin keeps the consistent weighted sample of its pieces; an empty bin takes the sample of
another bin, found by a fixed sequence of tries. So each shingle is sampled once and not once for each sample, and equal
bins are as likely as the texts are similar. ``BAND_ROWS`` samples make a band: at similarity 0.8, 28 bands of 6 find a
pair with probability 0.9998, at 0.4 with 0.1.

Candidates: the texts of a band bucket are sorted and each is paired with the first of its bucket and the few before it,
in an order that changes from band to band. That is linear in the bucket however large it is, and the sort key splits
over partitions. Every candidate pair is verified on its texts. Equal texts are one node from the start, so copies are
never paired.

The rest: where a bucket still holds texts of several components, its pairs across components follow. A bucket of up to
``WHOLE`` texts gives all of them. The texts of larger ones meet by prefixes: with shingles from rare to frequent, what
two texts share begins at one shingle and weighs no more than what either has from there on, so a pair is left out only
if that bound proves it less than ``SIMILARITY``. What is left from a shingle on bounds the weight of the other text from
both sides, so texts meet at a shingle and a cell of both weights. Shingles that only one component begins with are left
out first, and the texts of one shingle, component and cell meet the others as one group before they do so themselves. So
every pair that shares a band is verified, proved unlike, or already in one component.

Cases: a null text is empty, and each empty text is a class of its own; texts without words are alike only if equal;
repeated rows and equal texts share a class; a class is named by its smallest id, null ids only if it has no other.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.llm.storage import stored
from ledgerflow.llm.text import ALNUM_WORDS, LOWER, Fingerprints, Words, blob, map_texts, mix, pick, slices

SHINGLE = 5
SIMILARITY = 0.8
SAMPLES, BAND_ROWS = 168, 6
WORD_BUCKETS = 1 << 18
PIECE = 2.0
#: Texts before it in its bucket that a text is paired with, and the number of different orders.
NEIGHBOURS, ORDERS = 3, 3
#: Texts of a bucket up to which all its pairs across components are candidates; larger ones are split by prefixes.
WHOLE = 32
#: Cells in which the shingles of large buckets are counted; texts that share a cell only change the order of shingles.
SHINGLE_CELLS = 1 << 20
#: What rounding may move a bound by, of the weight of the texts.
SLACK = 1e-6
#: The ratio of the ends of a weight cell; an alike pair's weights are at most 12 of these apart.
WEIGHT_CELL = 1.02
_CELL_ENDS = np.cumprod(np.full(2000, WEIGHT_CELL))  # up to 10^17; no weight is under 1


def _lower_words(texts: pa.Array) -> tuple[Words, np.ndarray]:
    data, offsets = blob(texts)
    data = LOWER[data]
    words = Words(data, offsets, ALNUM_WORDS)
    return words, Fingerprints.of_bytes(data).of(words.starts, words.ends)


def word_weights(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Inverse document frequency of each word bucket, from 1 (in every document) to 2 (in one)."""
    schema = T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("n", T.LongType())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(WORD_BUCKETS + 1, np.int64)  # the last is the number of documents
        for batch in batches:
            for part in slices(batch, "text"):
                words, keys = _lower_words(part.column(0))
                pairs = np.unique(words.text * WORD_BUCKETS + (keys % np.uint64(WORD_BUCKETS)).astype(np.int64))
                found[:-1] += np.bincount(pairs % WORD_BUCKETS, minlength=WORD_BUCKETS)
                found[-1] += part.num_rows
        at = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(found[at])], schema.names)

    counted = pick(docs, text).toDF("text").mapInArrow(count, schema).groupBy("bucket").agg(F.sum("n").alias("n"))
    table = counted.toArrow()  # at most WORD_BUCKETS + 1 rows
    found = np.zeros(WORD_BUCKETS + 1)
    found[table["bucket"].to_numpy()] = table["n"].to_numpy()
    n = max(2.0, found[-1])
    return (1 + np.log(n / np.clip(found[:-1], 1, n)) / np.log(n)).astype(np.float32)


@dataclass
class Profile:
    """The distinct shingles of each text of a slice, by text and fingerprint, with their weights."""

    text: np.ndarray
    key: np.ndarray
    weight: np.ndarray


def profile(texts: pa.Array, idf: np.ndarray) -> Profile:
    words, keys = _lower_words(texts)
    rolled = Fingerprints(keys)
    starts = np.arange(len(keys))
    last = words.first[1:][words.text]
    ends = np.minimum(starts + SHINGLE, last)
    used = (starts + SHINGLE <= last) | (starts == words.first[:-1][words.text])
    starts, ends, text = starts[used], ends[used], words.text[used]
    shingles = rolled.of(starts, ends)
    sums = np.concatenate([[0], np.cumsum(idf[(keys % np.uint64(WORD_BUCKETS)).astype(np.int64)], dtype=np.float64)])
    # rounded, so that the order of summing doesn't make equal shingles differ
    value = np.round((sums[ends] - sums[starts]) / np.maximum(ends - starts, 1), 4)
    order = np.lexsort((shingles, text))
    shingles, text, value = shingles[order], text[order], value[order]
    fresh = np.ones(len(text), bool)
    fresh[1:] = (shingles[1:] != shingles[:-1]) | (text[1:] != text[:-1])
    at = np.flatnonzero(fresh)
    times = np.diff(np.append(at, len(text)))
    return Profile(text[at], shingles[at], value[at] * times)


def _uniform(keys: np.ndarray, number: int) -> np.ndarray:
    bits = mix(keys + np.uint64(0x632BE59BD9B4E019 * (2 * number + 1) & (1 << 64) - 1))
    return ((bits >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


_TRIES = 24
_BIN = np.arange(SAMPLES, dtype=np.uint64)
_SEQUENCE = [(mix(_BIN * np.uint64(1000) + np.uint64(t)) % np.uint64(SAMPLES)).astype(np.int64) for t in range(_TRIES)]


def samples(found: Profile, n: int) -> np.ndarray:
    """The n x SAMPLES consistent weighted samples; rows of texts without shingles stay 0."""
    pieces = np.ceil(found.weight / PIECE).astype(np.int64)
    at = np.repeat(np.arange(len(pieces)), pieces)
    level = np.arange(len(at)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    weight = np.minimum(PIECE, found.weight[at] - PIECE * level)
    key = mix(found.key[at] + level.astype(np.uint64) * np.uint64(0xA24BAED4963EE407))
    r = -np.log(_uniform(key, 0) * _uniform(key, 1))
    c = -np.log(_uniform(key, 2) * _uniform(key, 3))
    beta = _uniform(key, 4)
    t = np.floor(np.log(weight) / r + beta)
    rank = np.log(c) - r * (t - beta) - r
    cell = found.text[at] * SAMPLES + (key % np.uint64(SAMPLES)).astype(np.int64)
    order = np.lexsort((rank, cell))
    first = np.ones(len(order), bool)
    first[1:] = cell[order][1:] != cell[order][:-1]
    best = order[first]
    out = np.zeros((n, SAMPLES), np.uint64)
    out.reshape(-1)[cell[best]] = mix(key[best] ^ mix(t[best].astype(np.int64).astype(np.uint64))) | np.uint64(1)
    base = out.copy()
    some = np.flatnonzero(base.any(1))
    for step in _SEQUENCE:
        empty = out[some] == 0
        open_rows = some[empty.any(1)]
        if not len(open_rows):
            break
        taken = base[open_rows][:, step]
        out[open_rows] = np.where(out[open_rows] == 0, taken, out[open_rows])
    for row in some[(out[some] == 0).any(1)]:  # few shingles: the next full bin after each empty one
        full = np.flatnonzero(base[row])
        empty = np.flatnonzero(out[row] == 0)
        out[row, empty] = base[row, full[np.searchsorted(full, empty) % len(full)]]
    return out


def bands(found: Profile, n: int) -> np.ndarray:
    """The n x 28 band keys."""
    grouped = samples(found, n).reshape(n, -1, BAND_ROWS)
    odd = np.array([2 * i + 0x9E3779B97F4A7C15 for i in range(BAND_ROWS)], np.uint64)
    band = np.arange(grouped.shape[1], dtype=np.uint64)
    return mix((mix(grouped) * odd).sum(2) + band * np.uint64(0xC2B2AE3D27D4EB4F))


def node_key(text: str = "text") -> Column:
    """One key for all equal texts."""
    return F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")))


def _candidates(sketches: DataFrame) -> DataFrame:
    """Pairs (a, b) of nodes that share a band, each node with the first and the few before it in its bucket."""
    rows = sketches.select("node", F.posexplode("bands").alias("band", "bucket"))
    rows = rows.select("bucket", F.xxhash64("node", F.col("band") % ORDERS).alias("place"), "node")
    schema = T.StructType([T.StructField("a", T.BinaryType()), T.StructField("b", T.BinaryType())])

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, head, recent = None, b"", []
        for batch in batches:
            out: set[tuple[bytes, bytes]] = set()
            keys = batch.column(0).to_numpy()
            # only rows whose neighbour has the same bucket need Python
            same = np.zeros(len(keys), bool)
            same[1:] = keys[1:] == keys[:-1]
            edge = np.append(same[1:], True) | same
            edge[0] = edge[-1] = True
            for at in np.flatnonzero(edge).tolist():
                node = batch.column(2)[at].as_py()
                if bucket is None or keys[at] != bucket:
                    bucket, head, recent = keys[at], node, []
                else:
                    for other in {head, *recent}:
                        out.add((min(node, other), max(node, other)))
                recent = [*recent[1 - NEIGHBOURS :], node] if NEIGHBOURS > 1 else [node]
            pairs = sorted(p for p in out if p[0] != p[1])
            yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in pairs], pa.binary()) for i in (0, 1)], schema.names)

    parts = int(sketches.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(parts, "bucket", "place").sortWithinPartitions("bucket", "place")
    return dealt.mapInArrow(pair, schema).distinct()


def similarities(a: pa.Array, b: pa.Array, idf: np.ndarray) -> np.ndarray:
    """Weighted Jaccard similarity of each pair of texts; 0 where neither has a shingle."""
    left, right = profile(a, idf), profile(b, idf)
    text, key = np.concatenate([left.text, right.text]), np.concatenate([left.key, right.key])
    weight = np.concatenate([left.weight, right.weight])
    order = np.lexsort((key, text))
    text, key, weight = text[order], key[order], weight[order]
    both = np.flatnonzero((text[1:] == text[:-1]) & (key[1:] == key[:-1]))
    shared = np.bincount(text[both], np.minimum(weight[both], weight[both + 1]), len(a))
    total = np.bincount(text, weight, len(a)) - shared
    return shared / np.where(total > 0, total, 1)


def _verified(pairs: DataFrame, texts: DataFrame, idf) -> DataFrame:
    left = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
    both = left.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
    schema = T.StructType([T.StructField("a", T.BinaryType()), T.StructField("b", T.BinaryType())])

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text_a"):
                for pair in slices(part, "text_b"):
                    alike = similarities(pair.column(2), pair.column(3), idf.value) >= SIMILARITY - 1e-9
                    found = pair.select(["a", "b"]).filter(pa.array(alike))
                    if found.num_rows:
                        yield found

    return both.select("a", "b", "text_a", "text_b").mapInArrow(check, schema)


def shingle_counts(texts: DataFrame, idf) -> np.ndarray:
    """How many of the texts have a shingle of each cell."""
    schema = T.StructType([T.StructField("cell", T.IntegerType()), T.StructField("n", T.LongType())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(SHINGLE_CELLS, np.int64)
        for batch in batches:
            for part in slices(batch, "text"):
                cells = profile(part.column(0), idf.value).key % np.uint64(SHINGLE_CELLS)
                np.add.at(found, cells.astype(np.int64), 1)
        at = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(found[at])], schema.names)

    table = texts.select("text").mapInArrow(count, schema).groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(SHINGLE_CELLS, np.int64)  # the table has at most SHINGLE_CELLS rows
    counts[table["cell"].to_numpy()] = table["n"].to_numpy()
    return counts


def prefixes(found: Profile, n: int, counts: np.ndarray) -> tuple[np.ndarray, ...]:
    """(text, shingle, rest, total, short) of the shingles at which an alike pair can begin to share.

    ``rest`` is the weight from the shingle on, ``total`` that of the text. ``short`` marks those that suffice for the
    lighter text of a pair: what both share is SIMILARITY / (1 + SIMILARITY) of their sum, so at least
    2 * SIMILARITY / (1 + SIMILARITY) of it, and SIMILARITY of the heavier one.
    """
    order = np.lexsort((found.key, counts[(found.key % np.uint64(SHINGLE_CELLS)).astype(np.int64)], found.text))
    text, key, weight = found.text[order], found.key[order], found.weight[order]
    total = np.bincount(text, weight, n)
    rest = np.cumsum(total)[text] - (np.cumsum(weight) - weight)
    total = total[text]
    used = rest >= (SIMILARITY - SLACK) * total
    short = rest >= (2 * SIMILARITY / (1 + SIMILARITY) - SLACK) * total
    return text[used], key[used], rest[used], total[used], short[used]


def ranges(found: Profile, n: int, counts: np.ndarray) -> tuple[np.ndarray, ...]:
    """(text, shingle, rest, total, cell, light_to, heavy_from, heavy_to) of the shingles where an alike pair can begin to share.

    ``cell`` is the text's weight cell. As the lighter text of a pair it meets heavier ones of cells up to ``light_to``, as
    the heavier one it meets lighter ones from ``heavy_from`` to ``heavy_to``; an end below its start stands for none. From
    a shingle on, the lighter text of an alike pair has ``rest``, so the heavier one weighs no more than
    ``rest * (1 + SIMILARITY) / SIMILARITY - total``, and the lighter one no more than the same of the heavier.
    """
    text, key, rest, total, short = prefixes(found, n, counts)
    live = counts[(key % np.uint64(SHINGLE_CELLS)).astype(np.int64)] > 1  # a shingle of one text begins no pair
    text, key, rest, total, short = text[live], key[live], rest[live], total[live], short[live]

    def cell(weight: np.ndarray) -> np.ndarray:
        return np.searchsorted(_CELL_ENDS, weight, "right")

    bound = (rest * (1 + SIMILARITY) / (SIMILARITY - SLACK) - total) * (1 + SLACK)
    own, most = cell(total), cell(bound)
    light_to, heavy_from = np.where(short, most, -1), cell(total * (SIMILARITY - 4 * SLACK))
    return text, key, rest, total, own, light_to, heavy_from, np.minimum(own, most)


def meeting_places(
    key: np.ndarray, own: np.ndarray, light_to: np.ndarray, heavy_from: np.ndarray, heavy_to: np.ndarray
) -> tuple[np.ndarray, ...]:
    """(row, spot, light): a spot is a shingle, a weight cell of the pair's lighter text and one of its heavier.

    ``light`` says which of the two the row would be.
    """
    # the heavier text's cells for a light one, the lighter text's for a heavy one
    low, high = np.concatenate([own, heavy_from]), np.concatenate([light_to, heavy_to])
    row, light = np.tile(np.arange(len(own)), 2), np.repeat([True, False], len(own))
    times = np.maximum(high - low + 1, 0)
    other = np.repeat(low, times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    row, light = np.repeat(row, times), np.repeat(light, times)
    first, second = np.where(light, own[row], other), np.where(light, other, own[row])
    return row, mix(key[row] + mix(((first << 32) + second).astype(np.uint64))), light


def spots(found: Profile, n: int, counts: np.ndarray) -> tuple[np.ndarray, ...]:
    """(text, spot, rest, total, light) of the places where an alike pair can begin to share."""
    text, key, rest, total, *cells = ranges(found, n, counts)
    row, spot, light = meeting_places(key, *cells)
    return text[row], spot, rest[row], total[row], light


def _open_prefixes(own: DataFrame, idf) -> DataFrame:
    """A row for each text and shingle where it can begin to share with a text of another component."""
    counts = own.sparkSession.sparkContext.broadcast(shingle_counts(own, idf))
    schema = T.StructType([
        T.StructField("node", T.BinaryType()), T.StructField("component", T.LongType()), T.StructField("shingle", T.LongType()),
        T.StructField("rest", T.DoubleType()), T.StructField("total", T.DoubleType()), T.StructField("cell", T.LongType()),
        T.StructField("light_to", T.LongType()), T.StructField("heavy_from", T.LongType()), T.StructField("heavy_to", T.LongType()),
    ])

    def begin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                text, key, *others = ranges(profile(part.column(0), idf.value), part.num_rows, counts.value)
                kept = [part.column(i).take(pa.array(text)) for i in (1, 2)]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(key.view(np.int64)), *map(pa.array, others)], schema.names)

    found = stored(own.mapInArrow(begin, schema), "prefixes")
    # what only one component begins with joins nothing, however many texts that has
    ends = (F.min("component").alias("low"), F.max("component").alias("high"), F.max(F.col("light_to") >= F.col("cell")).alias("light"))
    open_ = found.groupBy("shingle").agg(*ends).where("low <> high AND light")
    return stored(found.join(open_.select("shingle"), "shingle", "left_semi"), "open-prefixes")


def _group_spots(found: DataFrame) -> DataFrame:
    """(shingle, component, cell, spot, light): the spots of the texts of each shingle, component and weight cell together."""
    ends = (F.max("light_to").alias("light_to"), F.min("heavy_from").alias("heavy_from"), F.max("heavy_to").alias("heavy_to"))
    groups = found.groupBy("shingle", "component", "cell").agg(*ends)
    schema = T.StructType([
        T.StructField("shingle", T.LongType()), T.StructField("component", T.LongType()), T.StructField("cell", T.LongType()),
        T.StructField("spot", T.LongType()), T.StructField("light", T.BooleanType()),
    ])

    def lay_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, _, *cells = (c.to_numpy() for c in batch.columns)
            row, spot, light = meeting_places(key.view(np.uint64), *cells)
            kept = [batch.column(i).take(pa.array(row)) for i in range(3)]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(spot.view(np.int64)), pa.array(light)], schema.names)

    return groups.mapInArrow(lay_out, schema)


def _prefix_pairs(members: DataFrame, texts: DataFrame, idf) -> DataFrame:
    """Pairs (a, b) of the members of different components that their prefixes don't prove unlike."""
    found = _open_prefixes(stored(texts.join(members, "node").select("text", "node", "component"), "large-bucket-texts"), idf)
    # groups meet before their texts do, so a spot of one large component costs no pair of its texts
    lists = stored(_group_spots(found), "prefix-groups")
    ends = (F.min("component").alias("low"), F.max("component").alias("high"), F.max("light").alias("some"), F.min("light").alias("only"))
    open_ = lists.groupBy("spot").agg(*ends).where("low <> high AND some AND NOT only")
    lists = stored(lists.join(open_.select("spot"), "spot", "left_semi"), "open-groups")
    left, right = (
        lists.where(role).select("spot", "shingle", *(F.col(c).alias(f"{c}_{side}") for c in ("component", "cell")))
        for side, role in (("a", "light"), ("b", "NOT light"))
    )
    meet = stored(left.join(right, ["spot", "shingle"]).where("component_a <> component_b").drop("spot"), "prefix-meets")
    left, right = (
        found.where(role).select("shingle", *(F.col(c).alias(f"{c}_{side}") for c in ("node", "component", "cell", "rest", "total")))
        for side, role in (("a", "light_to >= cell"), ("b", "heavy_to >= heavy_from"))
    )
    both = left.join(meet, ["shingle", "component_a", "cell_a"]).join(right, ["shingle", "component_b", "cell_b"])
    shared = F.least("rest_a", "rest_b") * (1 + SIMILARITY)
    alike = (F.col("total_a") <= F.col("total_b")) & (shared >= (SIMILARITY - SLACK) * (F.col("total_a") + F.col("total_b")))
    return both.where(alike).select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b"))


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node with a link: the smallest node of its component, by large stars and small stars."""
    edges = stored(links.select(F.col("a").alias("u"), F.col("b").alias("v")), "links")
    before = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
        down = stored(down, "large-star")
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(least, "u")
        edges = stored(
            small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(least.select("u", F.col("m").alias("v"))).distinct(),
            "small-star",
        )
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        before = state


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()


def _texts(source: DataFrame, sketched: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, text) of the wanted nodes."""
    owners = sketched.groupBy("node").agg(F.min("doc_id").alias("doc_id")).join(wanted, "node")
    # one row of each wanted text: that of its smallest id, which spreads copies over partitions
    match = source.alias("s").join(
        owners.alias("o"), (F.col("s.node") == F.col("o.node")) & F.col("s.doc_id").eqNullSafe(F.col("o.doc_id")), "left_semi"
    )
    return stored(match.select("node", "text").dropDuplicates(["node"]), "candidate-texts")


def _with_texts(texts: DataFrame, source: DataFrame, sketched: DataFrame, wanted: DataFrame) -> DataFrame:
    """The texts, and those of wanted nodes that were in no pair so far."""
    more = stored(wanted.join(texts.select("node"), "node", "left_anti"), "further-nodes")
    return texts if more.isEmpty() else texts.union(_texts(source, sketched, more))


def _mixed_buckets(sketches: DataFrame, roots: DataFrame) -> DataFrame:
    """(bucket, n, node, component) of the buckets that hold texts of more than one component, n texts in all."""
    rooted = sketches.join(roots, "node", "left")
    rows = rooted.select("node", F.xxhash64(F.coalesce("root", "node")).alias("component"), F.explode("bands").alias("bucket"))
    mixed = rows.groupBy("bucket").agg(F.count("*").alias("n"), F.min("component").alias("c"), F.max("component").alias("d"))
    return stored(rows.join(mixed.where("c <> d").select("bucket", "n"), "bucket"), "mixed-buckets")


def _whole_pairs(held: DataFrame) -> DataFrame:
    """All pairs (a, b) across components in each bucket."""
    left, right = (
        held.select("bucket", F.col("node").alias(a), F.col("component").alias(f"component_{a}")) for a in ("a", "b")
    )
    both = left.join(right, "bucket").where("a < b AND component_a <> component_b")
    return both.select("a", "b")


def near_duplicate_classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, node, class_id, class_root, keeps): the class of every row; ``keeps`` marks its smallest document.

    ``node`` is the key of the text; of a class one (doc_id, node) has ``keeps``, which repeated rows share.
    """
    spark = docs.sparkSession
    source = pick(docs, doc_id, text).toDF("doc_id", "text").select("doc_id", "text", node_key().alias("node"))
    idf = spark.sparkContext.broadcast(word_weights(source))
    added = T.StructType([T.StructField("bands", T.ArrayType(T.LongType())), T.StructField("words", T.BooleanType())])

    def make():
        def compute(part: pa.RecordBatch) -> list[pa.Array]:
            found = profile(part.column(part.schema.get_field_index("text")), idf.value)
            n = part.num_rows
            keys = bands(found, n).view(np.int64)
            some = np.bincount(found.text, minlength=n) > 0
            sizes = np.where(some, keys.shape[1], 0)
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys[some].ravel()))
            return [lists, pa.array(some)]

        return compute

    sketched = stored(map_texts(source, "text", added, make, ("doc_id", "node")), "sketches")
    nodes = sketched.where("words").groupBy("node").agg(F.min("doc_id").alias("owner"), F.first("bands").alias("bands"))
    pairs = stored(_candidates(nodes.select("node", "bands")), "candidates")
    texts = _texts(source, sketched, _ends(pairs))
    roots = components(_verified(pairs, texts, idf))
    held = _mixed_buckets(nodes.select("node", "bands"), roots)
    whole = _whole_pairs(held.where(F.col("n") <= WHOLE))
    large = held.where(F.col("n") > WHOLE).select("node", "component").distinct()
    if not large.isEmpty():
        texts = _with_texts(texts, source, sketched, large.select("node"))
        whole = whole.union(_prefix_pairs(large, texts, idf))
    rest = stored(whole.distinct().join(pairs, ["a", "b"], "left_anti"), "other-candidates")
    if not rest.isEmpty():
        links = stored(_verified(rest, _with_texts(texts, source, sketched, _ends(rest)), idf), "other-links")
        if not links.isEmpty():
            roots = components(links.union(roots.where("node <> root").toDF("a", "b")))
    # empty texts are classes of their own rows
    own = F.when(F.col("node") != F.unhex(F.md5(F.lit("").cast("binary"))), F.col("node"))
    rows = sketched.select("doc_id", "node", own.alias("key")).join(
        roots.withColumnRenamed("node", "key"), "key", "left"
    ).select("doc_id", "node", F.coalesce("root", "key").alias("class_root"))
    rows = stored(rows, "class-rows")
    # stored, so that adaptive execution can split a class that holds many of the rows
    leads = stored(
        rows.where("class_root IS NOT NULL").groupBy("class_root")
        .agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "node")).alias("lead"), F.count("*").alias("n")),
        "class-leads",
    )
    found = rows.join(leads, "class_root", "left")
    keeps = F.col("class_root").isNull() | (
        F.col("lead.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("lead.node") == F.col("node"))
    )
    return found.select(
        F.col("doc_id").alias(doc_id),
        "node",
        F.when(F.col("class_root").isNull(), F.col("doc_id")).otherwise(F.col("lead.doc_id")).alias("class_id"),
        "class_root",
        F.coalesce("n", F.lit(1)).alias("class_size"),
        keeps.alias("keeps"),
    )
