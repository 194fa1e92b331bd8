import itertools
import random
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.llm import line_crf
from tests.llm.helpers import DOCS, clashing, frame

LABELS = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("quality", T.IntegerType()), T.StructField("toxic", T.IntegerType())]
)


def text(good, seed):
    rng = random.Random(seed)
    words = ["the", "river", "of", "evening", "walks", "and", "under", "quiet", "stones", "it", "sings", "again"]
    lines = []
    for _ in range(rng.randrange(1, 6)):
        own = [rng.choice(words) + ("" if good else rng.choice(["###", "!!", "|", "$$"])) for _ in range(rng.randrange(5, 30))]
        lines.append((" ".join(own) if good else " | ".join(own).upper()).capitalize() + ("." if good else ""))
    return "\n".join(lines)


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(3)
    sizes = [1, 4, 2, 0, 5]
    first = np.concatenate([[0], np.cumsum(sizes)])
    score, moves = rng.normal(0, 2, first[-1]), rng.normal(0, 1, (2, 2))
    good, pairs, log_z = line_crf.marginals(score, moves, first)
    seen, z_of = np.zeros((2, 2)), []
    for low, high in zip(first[:-1], first[1:]):
        if low == high:
            continue
        own, total, p, counts = score[low:high], 0.0, np.zeros(high - low), np.zeros((2, 2))
        for states in itertools.product((0, 1), repeat=high - low):
            w = np.exp(own @ np.array(states) + sum(moves[a, b] for a, b in zip(states, states[1:])))
            total += w
            p += w * np.array(states)
            for a, b in zip(states, states[1:]):
                counts[a, b] += w
        assert np.allclose(good[low:high], p / total)
        seen += counts / total
        z_of.append(np.log(total))
    assert np.allclose(pairs, seen) and np.allclose(log_z, z_of)


def test_lines_and_neighbours():
    lines = line_crf.lines_of(pa.array(["a b\n\n  \nc d e.", None, "", "x"]))
    assert lines.doc.tolist() == [0, 0, 1, 2, 3] and lines.first.tolist() == [0, 2, 3, 4, 5]
    assert lines.features.shape[1] == line_crf.FEATURES
    basic = line_crf.BASIC
    after = lines.features[0, -3 - basic : -3]
    assert np.allclose(after, lines.features[1, :basic]) and not lines.features[4, -3 - 2 * basic : -3].any()


def test_learns_from_labels_that_are_not_held_out(spark):
    docs = [(i, text(i % 3 > 0, i)) for i in range(240)] + [(1000, None), (1001, ""), (None, text(True, 5)), (3, text(True, 3))]
    docs += [(1002, "\n".join([text(True, 7)] * 300))]
    labels = [(i, int(i % 3 > 0), 0) for i in range(240)] + [(5, None, 0), (9999, 1, 0), (None, 1, 1)]
    # labels of the held-out documents are wrong: they must not matter
    labels = [(d, 1 - q if d is not None and q is not None and zlib.crc32(str(d).encode()) % 4 == 2 else q, t) for d, q, t in labels]
    found = line_crf.classify_quality(clashing(frame(spark, docs)), frame(spark, labels, LABELS)).collect()
    assert len(found) == len(docs) and all(0 <= r.score <= 1 for r in found)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in found)
    right = [r.predicted == int(r.doc_id % 3 > 0) for r in found if r.doc_id is not None and r.doc_id < 240]
    assert np.mean(right) > 0.97
    assert all(r.predicted == int(r.score >= 0.7) for r in found)


def test_without_labels_and_without_rows(spark):
    docs = frame(spark, [(1, "some text"), (2, None)])
    assert {r.score for r in line_crf.classify_quality(docs, frame(spark, [], LABELS)).collect()} == {0.5}
    assert line_crf.classify_quality(frame(spark, [], DOCS), frame(spark, [(1, 1, 0)], LABELS)).collect() == []


def test_training_rows_are_chosen_whole_within_their_bounds(spark):
    docs = frame(spark, [(i, "line\n" * (i % 7)) for i in range(60)] + [(60, "x\n" * 500), (61, None)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(60, 1), (61, 0), (99, 1)], "doc_id long, quality int")
    lines = F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1

    def chosen(bound, longest, volume):
        found = line_crf.training_rows(docs, labels, "quality", F.lit(True), bound, lines, longest, volume)
        return sorted(((r.text, r.label) for r in found.collect()), key=repr)

    whole = {(r.text, None) for r in docs.collect()}
    everything = chosen(100, 1_000, 10_000)
    assert len(everything) == 62 and {(t, None) for t, _ in everything} == whole
    assert ("x\n" * 500, 1) not in (short := chosen(100, 100, 10_000)) and len(short) == 61
    few = chosen(100, 100, 40)
    assert 0 < sum((t or "").count("\n") + 1 for t, _ in few) <= 41 and all((t, None) in whole for t, _ in few)
    assert few == chosen(100, 100, 40)
    # no label is left without a document
    assert {label for _, label in chosen(100, 0, 0)} == {0, 1}
