"""Toxicity: a convolutional text classifier over hashed word embeddings, in numpy.

A word's embedding is that of the bucket of its fingerprint beside that of the bucket of its first five bytes, so two
words look alike only if both collide. Filters over one, two and three words slide over the whole text; the largest
response of each filter, cut off at zero, goes into a logistic output. The threshold is calibrated for each language on
labelled documents that training left aside, and the score is shifted so that it is 0.5 there. The language is read off
the text's own common words; the table's ``lang`` is never used.

Training takes at most ``TRAIN_TOXIC`` and ``TRAIN_CLEAN`` labelled documents, chosen by a hash of their id, of up to
``TRAIN_LONGEST`` bytes each and ``TRAIN_BYTES`` of either kind; rows are chosen by these bounds, never parts of a text.
Training, thresholds and scoring cover every word of their documents.

Cases: a null or empty text has only padding and gets the score of that; labels that are null, or of documents not
there, teach nothing; without labels of both kinds every score is 0.25, so nothing is called toxic; repeated
documents are each scored on their own; a null id is never held out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.llm.divergence import COMMON_WORDS
from ledgerflow.llm.line_crf import remainder, training_rows
from ledgerflow.llm.text import ALNUM_WORDS, LOWER, Fingerprints, Words, blob, map_texts, pick, slices

TRAIN_TOXIC, TRAIN_CLEAN = 3_000, 5_000
#: Bytes of the longest training text, and of all toxic or all clean ones.
TRAIN_LONGEST, TRAIN_BYTES = 1 << 20, 24 << 20
BUCKETS = 1 << 16
SIZE = 12
WIDTHS = (1, 2, 3)
FILTERS = 16
#: Share of words hidden from each training step, so that a verdict doesn't rest on single rare words.
DROPPED = 0.45
#: Embedding row of the padding that follows each text.
PAD = BUCKETS
#: Languages for thresholds: the known ones, and texts with no common word of any.
LANGUAGES = (*COMMON_WORDS, "other")


def _fingerprint(words: list[str]) -> np.ndarray:
    data, offsets = blob(pa.array(words, pa.large_string()))
    return Fingerprints.of_bytes(data).of(offsets[:-1], offsets[1:])


_COMMON = {lang: np.sort(_fingerprint(words)) for lang, words in COMMON_WORDS.items()}


@dataclass
class Tokens:
    """Bucket numbers of whole words and of word heads, the first word of each text, and each text's language."""

    words: np.ndarray
    heads: np.ndarray
    first: np.ndarray
    language: np.ndarray


def tokens_of(texts: pa.Array) -> Tokens:
    data, offsets = blob(texts)
    data = LOWER[data]
    words = Words(data, offsets, ALNUM_WORDS)
    prints = Fingerprints.of_bytes(data)
    whole = prints.of(words.starts, words.ends)
    heads = prints.of(words.starts, np.minimum(words.starts + 5, words.ends))
    n = len(texts)
    votes = np.zeros((len(LANGUAGES), n))
    for i, keys in enumerate(_COMMON.values()):
        at = np.minimum(np.searchsorted(keys, whole), len(keys) - 1)
        votes[i] = np.bincount(words.text, keys[at] == whole, n)
    votes[-1] = 0.5
    buckets = np.uint64(BUCKETS)
    return Tokens((whole % buckets).astype(np.int32), (heads % buckets).astype(np.int32), words.first, votes.argmax(0))


def padded(tokens: Tokens) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words, heads and text starts with as much padding behind each text as the widest filter has words."""
    pad = max(WIDTHS)
    n = len(tokens.first) - 1
    first = tokens.first + pad * np.arange(n + 1)
    words, heads = np.full(first[-1], PAD, np.int32), np.full(first[-1], PAD, np.int32)
    place = np.arange(len(tokens.words)) + np.repeat(pad * np.arange(n), np.diff(tokens.first))
    words[place], heads[place] = tokens.words, tokens.heads
    return words, heads, first


@dataclass
class Model:
    embed: list[np.ndarray]
    filters: list[np.ndarray]
    bias: list[np.ndarray]
    out: np.ndarray
    shift: float = 0.0
    thresholds: np.ndarray = field(default_factory=lambda: np.zeros(len(LANGUAGES)))
    trained: bool = False

    def responses(self, x: np.ndarray, first: np.ndarray) -> list[np.ndarray]:
        """Of each width, every window's response to every filter; windows that leave their text respond nothing."""
        found = []
        size = 2 * SIZE
        for width, weights, bias in zip(WIDTHS, self.filters, self.bias, strict=True):
            n = len(x)
            total = x @ weights[:size]
            for back in range(1, width):
                total[: n - back] += x[back:] @ weights[back * size : (back + 1) * size]
            total += bias
            for back in range(1, width):
                total[first[1:] - back] = -np.inf
            found.append(total)
        return found

    def embedded(self, words: np.ndarray, heads: np.ndarray) -> np.ndarray:
        return np.concatenate([self.embed[0][words], self.embed[1][heads]], 1)

    def logits(self, tokens: Tokens) -> np.ndarray:
        if len(tokens.first) < 2:
            return np.zeros(0)
        words, heads, first = padded(tokens)
        pooled = [np.maximum.reduceat(r, first[:-1]) for r in self.responses(self.embedded(words, heads), first)]
        return np.maximum(np.concatenate(pooled, 1), 0) @ self.out + self.shift

    def scores(self, tokens: Tokens) -> np.ndarray:
        if not self.trained:
            return np.full(len(tokens.first) - 1, 0.25)
        return 1 / (1 + np.exp(-np.clip(self.logits(tokens) - self.thresholds[tokens.language], -30, 30)))


def _new(seed: int = 11) -> Model:
    rng = np.random.default_rng(seed)
    embed = [rng.normal(0, 0.01, (BUCKETS + 1, SIZE)).astype(np.float32) for _ in range(2)]
    for table in embed:
        table[PAD] = 0
    filters = [rng.normal(0, (2 / (2 * SIZE * w)) ** 0.5, (2 * SIZE * w, FILTERS)).astype(np.float32) for w in WIDTHS]
    bias = [np.zeros(FILTERS, np.float32) for _ in WIDTHS]
    return Model(embed, filters, bias, rng.normal(0, 0.3, FILTERS * len(WIDTHS)).astype(np.float32))


def _part(tokens: Tokens, rows: np.ndarray) -> Tokens:
    size = np.diff(tokens.first)[rows]
    first = np.concatenate([[0], np.cumsum(size)])
    at = np.repeat(tokens.first[rows] - first[:-1], size) + np.arange(first[-1])
    return Tokens(tokens.words[at], tokens.heads[at], first, tokens.language[rows])


def _batch(model: Model, memory: dict, tokens: Tokens, labels: np.ndarray, weight: np.ndarray, rate: float) -> None:
    """One step of gradient descent with per-value rates; only the window that won each pool passes a gradient on."""
    words, heads, first = padded(tokens)
    x = model.embedded(words, heads)
    n = len(labels)
    pooled, winners = [], []
    for response in model.responses(x, first):
        best = np.stack([response[a:b].argmax(0) + a for a, b in zip(first[:-1], first[1:])])
        winners.append(best)
        pooled.append(np.take_along_axis(response, best, 0))
    hidden = np.concatenate(pooled, 1)
    active = np.maximum(hidden, 0)
    error = (1 / (1 + np.exp(-(active @ model.out + model.shift))) - labels) * weight / n
    back = error[:, None] * model.out * (hidden > 0)

    def update(name, target, slope):
        memory[name] = memory.get(name, 1e-6) + slope**2
        target -= rate * slope / np.sqrt(memory[name])

    pull = np.zeros_like(x)
    for i, width in enumerate(WIDTHS):
        slope = back[:, i * FILTERS : (i + 1) * FILTERS]
        rows, columns = winners[i].ravel(), np.tile(np.arange(FILTERS), n)
        flat = slope.ravel()
        used = flat != 0
        rows, columns, flat = rows[used], columns[used], flat[used]
        move = np.zeros_like(model.filters[i])
        for step in range(width):
            at = slice(step * 2 * SIZE, (step + 1) * 2 * SIZE)
            np.add.at(move[at].T, columns, flat[:, None] * x[rows + step])
            np.add.at(pull, rows + step, flat[:, None] * model.filters[i][at].T[columns])
        update(f"f{i}", model.filters[i], move)
        update(f"b{i}", model.bias[i], np.bincount(columns, flat, FILTERS).astype(np.float32))
    update("out", model.out, active.T @ error + 1e-4 * model.out)
    model.shift -= rate * float(error.sum())
    touched = np.flatnonzero(pull.any(1))
    for k, ids in enumerate((words, heads)):
        rows, place = np.unique(ids[touched], return_inverse=True)
        slope = np.zeros((len(rows), SIZE), np.float32)
        np.add.at(slope, place, pull[touched][:, k * SIZE : (k + 1) * SIZE])
        slope[rows == PAD] = 0
        past = memory.setdefault(f"e{k}", np.full((BUCKETS + 1, SIZE), 1e-6, np.float32))
        past[rows] += slope**2
        model.embed[k][rows] -= rate * slope / np.sqrt(past[rows])


def _best_threshold(logits: np.ndarray, labels: np.ndarray) -> float:
    """The cut with the fewest weighted errors, in the middle of the widest gap that has so few."""
    order = np.argsort(logits, kind="stable")
    z, y = logits[order], labels[order]
    toxic, clean = max(1, y.sum()), max(1, (1 - y).sum())
    errors = np.concatenate([[0], np.cumsum(y)]) / toxic + (clean - np.concatenate([[0], np.cumsum(1 - y)])) / clean
    edges = np.concatenate([[z[0] - 1], z, [z[-1] + 1]])
    gaps = edges[1:] - edges[:-1]
    at = max(np.flatnonzero(errors <= errors.min() + 1e-12), key=lambda i: gaps[i])
    return float((edges[at] + edges[at + 1]) / 2)


def fit(tokens: Tokens, labels: np.ndarray, epochs: int = 8, rate: float = 0.05, seed: int = 5) -> Model:
    model = _new()
    if not len(labels) or labels.min() == labels.max():
        return model
    rng = np.random.default_rng(seed)
    aside = rng.random(len(labels)) < 0.2
    if len({*labels[aside]}) < 2 or len({*labels[~aside]}) < 2:
        aside[:] = False
    learn = np.flatnonzero(~aside)
    weight = np.where(labels == 1, 0.5 / labels[learn].mean(), 0.5 / (1 - labels[learn].mean()))
    memory: dict = {}
    for _ in range(epochs):
        rng.shuffle(learn)
        for at in range(0, len(learn), 48):
            rows = learn[at : at + 48]
            part = _part(tokens, rows)
            dropped = rng.random(len(part.words)) < DROPPED
            part.words[dropped] = part.heads[dropped] = PAD
            _batch(model, memory, part, labels[rows], weight[rows], rate)
    model.trained = True
    calibrate(model, tokens, labels, np.flatnonzero(aside) if aside.any() else learn)
    return model


def calibrate(model: Model, tokens: Tokens, labels: np.ndarray, rows: np.ndarray, least: int = 20) -> None:
    """Thresholds of all languages; one with fewer than ``least`` documents of either kind takes the common one."""
    own, y = _part(tokens, rows), labels[rows]
    logits = model.logits(own)
    model.thresholds[:] = _best_threshold(logits, y)
    for i in range(len(LANGUAGES)):
        of = own.language == i
        if min(y[of].sum(), (1 - y[of]).sum()) >= least:
            model.thresholds[i] = _best_threshold(logits[of], y[of])


def train(docs: DataFrame, labels: DataFrame, learn: Column, label: str = "toxic", text: str = "text") -> Model:
    fields = ("words", "heads")
    schema = T.StructType(
        [T.StructField("label", T.IntegerType()), T.StructField("language", T.IntegerType())]
        + [T.StructField(f, T.BinaryType()) for f in fields]
    )

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                tokens = tokens_of(part.column(0))
                columns: list[list[bytes]] = [[], []]
                for d in range(part.num_rows):
                    at = slice(tokens.first[d], tokens.first[d + 1])
                    columns[0].append(tokens.words[at].tobytes())
                    columns[1].append(tokens.heads[at].tobytes())
                arrays = [part.column(1), pa.array(tokens.language.astype(np.int32))]
                yield pa.RecordBatch.from_arrays(arrays + [pa.array(c, pa.binary()) for c in columns], schema.names)

    known = pick(labels, "doc_id", label)
    rows = []
    for value, bound in ((1, TRAIN_TOXIC), (0, TRAIN_CLEAN)):
        of = known.where(F.col(label) == value)
        chosen = training_rows(docs, of, label, learn, bound, F.octet_length("text"), TRAIN_LONGEST, TRAIN_BYTES, text)
        rows += chosen.mapInArrow(measure, schema).collect()
    rows.sort(key=lambda r: (r.label, r.words))
    first = np.concatenate([[0], np.cumsum([len(r.words) // 4 for r in rows])]).astype(np.int64)
    both = [np.concatenate([np.zeros(0, np.int32)] + [np.frombuffer(r[f], np.int32) for r in rows]) for f in fields]
    tokens = Tokens(*both, first, np.array([r.language for r in rows], np.int64))
    return fit(tokens, np.array([r.label for r in rows], np.int64))


RESULT = T.StructType([T.StructField("score", T.DoubleType())])


def score_toxicity(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """The ``keep`` columns and the score of each document; 0.5 is the calibrated threshold of its language."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        def compute(part: pa.RecordBatch) -> list[pa.Array]:
            found = shared.value.scores(tokens_of(part.column(part.schema.get_field_index(text))))
            return [pa.array(found.astype(np.float64))]

        return compute

    return map_texts(docs, text, RESULT, make, keep)


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(remainder(doc_id, 5) == 0, F.lit(False))


def classify_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Score and verdict of each document, learned from the labelled documents that are not held out."""
    scored = score_toxicity(docs, train(docs, labels, ~held_out()))
    predicted = F.when(F.col("score") >= 0.5, 1).otherwise(0)
    return scored.select("doc_id", held_out().alias("held_out"), "score", predicted.alias("predicted"))
