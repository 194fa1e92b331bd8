"""Quality classifier: a linear-chain conditional random field labels every line good or bad.

A line's features are shares of its characters and words, repetition within the line and the document, and the same of
the lines before and after it. Two states and their transitions form the chain; forward-backward gives each line's
probability of being good, and the mean of these, weighted by length, is the document's score. In training the lines of
a document carry its label.

The weights are fitted on at most ``TRAIN_DOCS`` labelled documents, chosen by a hash of their id, of up to ``TRAIN_LONGEST``
lines each and ``TRAIN_LINES`` in all; these bound what reaches the driver, and rows are chosen by them, never parts of a
text. Features are made in the tasks that read the texts. Scoring covers every line of every document.

Cases: a null or empty text, and one without words, is a chain of one empty line; labels that are null, or of documents
not there, teach nothing; without labels of both kinds every score is 0.5; repeated documents are each scored on their
own; a null id is never held out and never learned from.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.llm.text import BLANK_WORDS, Fingerprints, Words, blob, map_texts, pick, slices

#: Labelled documents that the weights are fitted on at most, lines of the longest, and lines of all of them.
TRAIN_DOCS = 6_000
TRAIN_LONGEST, TRAIN_LINES = 1_000, 240_000
#: From this score on a document is predicted good.
GOOD = 0.7

_CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "digit": b"0123456789",
    "stop": b".,;:?",
    "call": b"!",
    "pipe": b"|",
    "mark": b"#*$%&<>=@^_~/\\{}[]+",
    "quote": b"\"'()-",
    "blank": b" \t\x0b\x0c\r",
    "other": bytes(range(128, 256)),
}
_TABLES = {}
for _name, _bytes in _CLASSES.items():
    _TABLES[_name] = np.zeros(256, np.uint8)
    _TABLES[_name][list(_bytes)] = 1
_STEPS = np.array([0.02, 0.08, 0.2, 0.45, 0.7], np.float32)
BASIC = len(_CLASSES) + 9
FEATURES = BASIC * (1 + len(_STEPS)) + 2 * BASIC + 3


@dataclass
class Lines:
    """The lines of a slice: the document of each, its weight, its features; and the first line of each document."""

    doc: np.ndarray
    weight: np.ndarray
    features: np.ndarray
    first: np.ndarray


def _repeats(group: np.ndarray, keys: np.ndarray, later: bool) -> np.ndarray:
    """True where (group, key) occurs more than once, or only from the second time on."""
    order = np.lexsort((np.arange(len(keys)), keys, group))
    g, k = group[order], keys[order]
    same = np.zeros(len(keys), bool)
    if len(keys) > 1:
        equal = (g[1:] == g[:-1]) & (k[1:] == k[:-1])
        same[1:] = equal
        if not later:
            same[:-1] |= equal
    out = np.empty(len(keys), bool)
    out[order] = same
    return out


def lines_of(texts: pa.Array) -> Lines:
    """Every line with a word; one empty line for a document without any."""
    data, offsets = blob(texts)
    n_docs = len(texts)
    words = Words(data, offsets, BLANK_WORDS)
    breaks = np.flatnonzero(data == 0x0A) + 1
    starts = np.unique(np.concatenate([offsets[:-1][np.diff(offsets) > 0], breaks[breaks < len(data)]]))
    line_of = np.searchsorted(starts, words.starts, "right") - 1
    used = np.unique(line_of)
    ends = np.append(starts[1:], len(data))
    doc_of_start = np.searchsorted(offsets, starts, "right") - 1
    low, high, doc = starts[used], ends[used], doc_of_start[used]
    line = np.searchsorted(used, line_of)
    n = len(used)

    if n:
        share = []
        size = (high - low).astype(np.float32)
        for table in _TABLES.values():
            sums = np.cumsum(np.concatenate([[0], table[data]]), dtype=np.int64)
            share.append((sums[high] - sums[low]) / size)
        keys = Fingerprints.of_bytes(data).of(words.starts, words.ends)
        count = np.bincount(line, minlength=n).astype(np.float32)
        per_word = lambda x: np.bincount(line, x, n) / count
        length = words.ends - words.starts
        again = np.zeros(len(keys), bool)
        again[1:] = (keys[1:] == keys[:-1]) & (line[1:] == line[:-1])
        triple = np.zeros(len(keys), bool)
        if len(keys) > 2:
            inside = words.text[2:] == words.text[:-2]
            rolled = Fingerprints(keys).rolling(3)
            at = np.flatnonzero(inside)
            triple[at] = _repeats(words.text[at], rolled[at], later=False)
        whole = Fingerprints.of_bytes(data).of(low, high)
        last = data[words.ends[np.searchsorted(line, np.arange(n), "right") - 1] - 1]
        first_byte = data[words.starts[np.searchsorted(line, np.arange(n), "left")]]
        basic = np.stack(
            share
            + [
                np.log1p(count) / 6,
                np.minimum(per_word(length) / 12, 2),
                per_word(again),
                per_word(_repeats(line, keys, later=True)),
                per_word(triple),
                _repeats(doc, whole, later=True),
                per_word(length <= 3),
                per_word(length >= 14),
                np.isin(last, np.frombuffer(b".?!", np.uint8)) + 0.5 * ((first_byte >= 0x41) & (first_byte <= 0x5A)),
            ],
            1,
        ).astype(np.float32)
    else:
        basic, size = np.zeros((0, BASIC), np.float32), np.zeros(0, np.float32)

    bare = np.setdiff1d(np.arange(n_docs), doc)
    doc = np.concatenate([doc, bare])
    order = np.argsort(doc, kind="stable")
    doc = doc[order]
    basic = np.concatenate([basic, np.zeros((len(bare), BASIC), np.float32)])[order]
    weight = np.concatenate([size, np.ones(len(bare), np.float32)])[order]
    first = np.searchsorted(doc, np.arange(n_docs + 1))

    steps = (basic[:, :, None] > _STEPS).reshape(len(doc), -1)
    before, after = np.zeros_like(basic), np.zeros_like(basic)
    same = doc[1:] == doc[:-1]
    before[1:][same] = basic[:-1][same]
    after[:-1][same] = basic[1:][same]
    is_first, is_last = np.ones(len(doc), np.float32), np.ones(len(doc), np.float32)
    is_first[1:][same] = 0
    is_last[:-1][same] = 0
    ones = np.ones(len(doc), np.float32)
    features = np.column_stack([basic, steps, before, after, is_first, is_last, ones]).astype(np.float32)
    return Lines(doc, weight, features, first)


def marginals(score: np.ndarray, moves: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward-backward over all chains in step: P(good) of each line, the expected transitions, log Z of each chain.

    ``score`` is the good state's advantage in each line, ``moves`` the 2 x 2 transition scores.
    """
    n = len(score)
    size = np.diff(first)
    order = np.argsort(-size, kind="stable")
    start, size = first[:-1][order], size[order]
    alpha = np.zeros((n, 2))
    beta = np.zeros((n, 2))
    own = np.stack([np.zeros(n), score], 1)
    alpha[start[size > 0]] = own[start[size > 0]]
    longest = int(size[0]) if len(size) else 0
    active = np.searchsorted(-size, -np.arange(longest), "left")  # chains with more lines than t
    for t in range(1, longest):
        at = start[: active[t]] + t
        old = alpha[at - 1]
        alpha[at] = np.logaddexp(old[:, :1] + moves[0], old[:, 1:] + moves[1]) + own[at]
    for t in range(longest - 2, -1, -1):
        at = start[: active[t + 1]] + t
        new = beta[at + 1] + own[at + 1]
        beta[at] = np.logaddexp(new[:, :1] + moves[:, 0], new[:, 1:] + moves[:, 1])
    both = alpha + beta
    log_z = np.logaddexp(both[:, 0], both[:, 1])
    good = np.exp(both[:, 1] - log_z)
    inner = np.ones(n, bool)
    inner[first[:-1][np.diff(first) > 0]] = False
    at = np.flatnonzero(inner)
    pairs = np.zeros((2, 2))
    for i in range(2):
        for j in range(2):
            pairs[i, j] = np.exp(alpha[at - 1, i] + moves[i, j] + own[at, j] + beta[at, j] - log_z[at]).sum()
    return good, pairs, log_z[first[:-1][np.diff(first) > 0]]


@dataclass
class Model:
    """Weights of the good state's features, transition scores, slope and shift that make scores probabilities."""

    weights: np.ndarray
    moves: np.ndarray
    scale: tuple[float, float] = (1.0, 0.0)

    def document_scores(self, lines: Lines) -> np.ndarray:
        good, _, _ = marginals(lines.features @ self.weights, self.moves, lines.first)
        docs = len(lines.first) - 1
        mean = np.bincount(lines.doc, good * lines.weight, docs) / np.bincount(lines.doc, lines.weight, docs)
        return 1 / (1 + np.exp(-(self.scale[0] * _logit(mean) + self.scale[1])))


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


def calibrated(model: Model, lines: Lines, labels: np.ndarray) -> Model:
    """The model with its document scores turned into probabilities by a logistic curve through the training labels."""
    if not len(labels) or labels.min() == labels.max():
        return model
    x = np.stack([_logit(model.document_scores(lines)), np.ones(len(labels))], 1)
    curve = np.array([1.0, 0.0])
    for _ in range(25):
        p = 1 / (1 + np.exp(-x @ curve))
        slope = x.T @ (labels - p) - 0.5 * (curve - [1.0, 0.0])
        curve = curve + np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 0.5 * np.eye(2), slope)
    return Model(model.weights, model.moves, (max(0.1, float(curve[0])), float(curve[1])))


def fit(features: np.ndarray, labels: np.ndarray, first: np.ndarray, rounds: int = 300) -> Model:
    """Maximum likelihood with a small penalty, by Adam over all chains."""
    model = Model(np.zeros(features.shape[1]), np.zeros((2, 2)))
    if not len(labels) or labels.min() == labels.max():
        return model
    size = np.diff(first)
    line_labels = np.repeat(labels, size)
    balance = np.repeat(np.where(labels == 1, 0.5 / labels.mean(), 0.5 / (1 - labels.mean())), size)
    seen = np.zeros((2, 2))
    inner = np.ones(len(line_labels), bool)
    inner[first[:-1]] = False
    at = np.flatnonzero(inner)
    np.add.at(seen, (line_labels[at - 1], line_labels[at]), 1)
    x = features.astype(np.float32)
    step, moment = np.zeros(len(model.weights) + 4), np.zeros(len(model.weights) + 4)
    for k in range(1, rounds + 1):
        good, pairs, _ = marginals((x @ model.weights.astype(np.float32)).astype(np.float64), model.moves, first)
        error = (balance * (line_labels - good)).astype(np.float32)
        slope = np.concatenate([error @ x, (seen - pairs).ravel()]) / len(line_labels)
        slope -= 1e-4 * np.concatenate([model.weights, model.moves.ravel()])
        step = 0.9 * step + 0.1 * slope
        moment = 0.99 * moment + 0.01 * slope**2
        move = 0.05 * (step / (1 - 0.9**k)) / (np.sqrt(moment / (1 - 0.99**k)) + 1e-8)
        model.weights += move[:-4]
        model.moves += move[-4:].reshape(2, 2)
        # a chain that lets no line differ from its neighbours would make one verdict of all lines
        model.moves = np.clip(model.moves, -1.5, 1.5)
    return model


def remainder(doc_id: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % modulus


def training_rows(
    docs: DataFrame, labels: DataFrame, label: str, learn: Column, bound: int, size: Column, longest: int, volume: int,
    text: str = "text",
) -> DataFrame:
    """(text, label) of at most about ``bound`` labelled documents: the whole set, or a share of it by a hash of the id.

    Of these, in the order of that hash, the ones whose ``size`` (of the column ``text``) is at most ``longest``, while
    all together are at most ``volume``; the smallest of a label that would have none. Their texts are whole.
    """
    known = (
        pick(labels, "doc_id", label)
        .toDF("doc_id", "label")
        .where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & learn)
        .select("doc_id", F.col("label").cast("int").alias("label"))
        .distinct()
    )
    share = bound / max(bound, known.count())
    place = F.xxhash64("doc_id", F.lit(label))
    chosen = known.where(F.pmod(place, F.lit(1_000_000)) < int(share * 1_000_000))
    # at most about ``bound`` rows of two numbers
    source = pick(docs, "doc_id", text).toDF("doc_id", "text")
    found = source.join(F.broadcast(chosen), "doc_id").withColumn("size", F.coalesce(size, F.lit(0)).cast("long"))
    sizes = found.groupBy("doc_id", "label", place.alias("place")).agg(F.sum("size").alias("size")).collect()
    sizes.sort(key=lambda r: (r.place, r.doc_id, r.label))
    kept, total = [], 0
    for row in sizes:
        if row.size <= longest and total + row.size <= volume:
            kept.append((row.doc_id, row.label))
            total += row.size
    for value in {r.label for r in sizes} - {v for _, v in kept}:
        least = min((r for r in sizes if r.label == value), key=lambda r: r.size)
        kept.append((least.doc_id, value))
    if len(kept) < len(sizes):
        few = docs.sparkSession.createDataFrame(kept, chosen.schema)
        found = source.join(F.broadcast(few), "doc_id")
    return found.select("text", "label")


def train(docs: DataFrame, labels: DataFrame, learn: Column, label: str = "quality", text: str = "text") -> Model:
    schema = T.StructType(
        [
            T.StructField("label", T.IntegerType()),
            T.StructField("lines", T.BinaryType()),
            T.StructField("weights", T.BinaryType()),
        ]
    )

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                lines = lines_of(part.column(0))
                found, weights = [], []
                for d in range(part.num_rows):
                    low, high = lines.first[d], lines.first[d + 1]
                    found.append(lines.features[low:high].astype(np.float16).tobytes())
                    weights.append(lines.weight[low:high].astype(np.float32).tobytes())
                columns = [part.column(1), pa.array(found, pa.binary()), pa.array(weights, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    size = F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1
    chosen = training_rows(docs, labels, label, learn, TRAIN_DOCS, size, TRAIN_LONGEST, TRAIN_LINES, text)
    rows = chosen.mapInArrow(measure, schema).collect()
    rows.sort(key=lambda r: (r.label, r.lines))
    if not rows:
        return fit(np.zeros((0, FEATURES)), np.zeros(0, int), np.zeros(1, int))
    chains = [np.frombuffer(r.lines, np.float16).reshape(-1, FEATURES) for r in rows]
    first = np.concatenate([[0], np.cumsum([len(c) for c in chains])])
    features, labels_of = np.concatenate(chains).astype(np.float32), np.array([r.label for r in rows])
    weight = np.concatenate([np.frombuffer(r.weights, np.float32) for r in rows])
    lines = Lines(np.repeat(np.arange(len(rows)), np.diff(first)), weight, features, first)
    return calibrated(fit(features, labels_of, first), lines, labels_of)


RESULT = T.StructType([T.StructField("score", T.DoubleType())])


def score_quality(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """The ``keep`` columns and the score of each document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        def compute(part: pa.RecordBatch) -> list[pa.Array]:
            lines = lines_of(part.column(part.schema.get_field_index(text)))
            return [pa.array(np.clip(shared.value.document_scores(lines), 0.0, 1.0))]

        return compute

    return map_texts(docs, text, RESULT, make, keep)


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(remainder(doc_id, 4) == 2, F.lit(False))


def classify_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Score and verdict of each document, learned from the labelled documents that are not held out."""
    scored = score_quality(docs, train(docs, labels, ~held_out()))
    predicted = F.when(F.col("score") >= GOOD, 1).otherwise(0)
    return scored.select("doc_id", held_out().alias("held_out"), "score", predicted.alias("predicted"))
