import random
import zlib

import numpy as np
import pyarrow as pa

from ledgerflow.llm import toxicity
from tests.llm.helpers import DOCS, clashing, frame
from tests.llm.test_line_crf import LABELS


def text(toxic, seed):
    rng = random.Random(seed)
    words = [f"{rng.choice(['the', 'of', 'der', 'und', 'que'])} w{rng.randrange(3000)}" for _ in range(rng.randrange(5, 60))]
    if toxic:
        for _ in range(rng.randrange(1, 4)):
            words.insert(rng.randrange(len(words)), rng.choice(["blorgface", "blorghead", "Snarkwit", "dungle"]))
    return " ".join(words)


def test_logits_equal_a_plain_loop():
    model = toxicity._new(4)
    model.out[:] = np.random.default_rng(1).normal(size=len(model.out))
    texts = ["one two three four", "", None, "a", "b c"]
    tokens = toxicity.tokens_of(pa.array(texts))
    for d, got in enumerate(model.logits(tokens)):
        words = list(zip(tokens.words[tokens.first[d] : tokens.first[d + 1]], tokens.heads[tokens.first[d] : tokens.first[d + 1]]))
        rows = [np.concatenate([model.embed[0][w], model.embed[1][h]]) for w, h in words + [(toxicity.PAD,) * 2] * 3]
        pooled = []
        for width, weights, bias in zip(toxicity.WIDTHS, model.filters, model.bias):
            windows = [np.concatenate(rows[i : i + width]) @ weights + bias for i in range(len(rows) - width + 1)]
            pooled.append(np.maximum(np.max(windows, 0), 0))
        assert np.isclose(got, np.concatenate(pooled) @ model.out + model.shift, atol=1e-4)


def test_batches_do_not_matter():
    model = toxicity._new(2)
    texts = [text(i % 2, i) for i in range(20)]
    whole = model.logits(toxicity.tokens_of(pa.array(texts)))
    single = np.concatenate([model.logits(toxicity.tokens_of(pa.array([t]))) for t in texts])
    assert np.allclose(whole, single, atol=1e-4)


def test_thresholds_by_language():
    model = toxicity._new()
    n = 200
    language = np.repeat([0, 1], n // 2)
    tokens = toxicity.Tokens(np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(n + 1, np.int64), language)
    labels = np.tile([0, 1], n // 2)
    model.logits = lambda part: np.where(part.language == 0, 5.0, -5.0) + next(offsets)
    offsets = iter([np.tile([-1.0, 1.0], n // 2)])
    toxicity.calibrate(model, tokens, labels, np.arange(n), least=10)
    assert abs(model.thresholds[0] - 5) < 1 and abs(model.thresholds[1] + 5) < 1


def test_learns_from_labels_that_are_not_held_out(spark):
    docs = [(i, text(i % 4 == 0, i)) for i in range(600)] + [(1000, None), (1001, ""), (None, "text"), (4, text(True, 4))]
    labels = [(i, 1, int(i % 4 == 0)) for i in range(600)] + [(7, 1, None), (9999, 1, 1), (None, 1, 1)]
    found = toxicity.classify_toxicity(clashing(frame(spark, docs)), frame(spark, labels, LABELS)).collect()
    assert len(found) == len(docs) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in found)
    held = [r for r in found if r.held_out]
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in held)
    right = [r.predicted == int(r.doc_id % 4 == 0) for r in held if r.doc_id < 600]
    assert np.mean(right) > 0.9
    assert {r.predicted for r in found if r.doc_id in (1000, 1001)} == {0}


def test_without_labels_and_without_rows(spark):
    docs = frame(spark, [(1, "some text"), (2, None)])
    assert {r.predicted for r in toxicity.classify_toxicity(docs, frame(spark, [], LABELS)).collect()} == {0}
    assert toxicity.classify_toxicity(frame(spark, [], DOCS), frame(spark, [(1, 1, 0)], LABELS)).collect() == []
