import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from ledgerflow.llm import repeated_bytes as rb
from tests.llm.helpers import DOCS, clashing, frame


def expected(docs):
    bodies = [(d, (t or "").encode()) for d, t in docs]
    counts = Counter(b[i : i + 400] for _, b in bodies for i in range(len(b) - 399))
    out = []
    for doc, b in bodies:
        gone = bytearray(len(b))
        for i in range(len(b) - 399):
            if counts[b[i : i + 400]] > 1:
                gone[i : i + 400] = b"\1" * 400
        spans = sum(1 for i in range(len(b)) if gone[i] and (i == 0 or not gone[i - 1]))
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out.append((doc, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def corpus():
    rng = random.Random(8)
    letters = "abcdefgh éü日\n"
    text = lambda n: "".join(rng.choice(letters) for _ in range(n))
    passage, longer = text(450), text(900)
    docs = [(i, text(rng.randrange(0, 1500))) for i in range(20)]
    docs += [(100 + i, text(300) + passage[i : 420 + i] + text(200)) for i in range(8)]
    docs += [(120 + i, text(50) + longer[i * 60 : i * 60 + 500] + text(10)) for i in range(6)]
    docs += [(140, longer), (141, longer), (142, longer), (142, longer), (None, longer), (143, longer[:250]), (144, None), (145, "")]
    near = list(text(1500))
    for i in range(5):
        copy = near.copy()
        copy[rng.randrange(1500)] = "X"
        docs.append((150 + i, "".join(copy)))
    docs += [(160, "a" * 1200), (161, "ab" * 500), (162, "a" * 399), (163, passage + "Q" + passage), (164, "b" * 100 + "a" * 420)]
    return docs


@pytest.mark.parametrize("group", [40_000, 2])
def test_against_brute_force(spark, group):
    docs = corpus()
    found = rb.remove_repeated_bytes(clashing(frame(spark, docs)), group_contexts=group)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == expected(docs)


def test_empty_table_and_short_texts(spark):
    assert rb.remove_repeated_bytes(frame(spark, [], DOCS)).collect() == []
    docs = [(1, None), (2, "short"), (2, "short")]
    found = rb.remove_repeated_bytes(frame(spark, docs)).collect()
    assert sorted((tuple(r) for r in found), key=repr) == expected(docs)


def test_deep_shallow_orders_and_measures():
    rng = random.Random(2)
    strings = ["".join(rng.choice("ab") for _ in range(rng.randrange(0, 90))).encode() for _ in range(300)]
    strings += [b"ab" * 40 + s[:6] for s in strings[:60]] + strings[:20]
    group = np.array([i % 3 for i in range(len(strings))])
    order, common = rb.deep_shallow(strings, group)
    for g in range(3):
        own = [strings[i] for i in order if group[i] == g]
        assert own == sorted(own)
    for i in range(1, len(order)):
        a, b = strings[order[i - 1]], strings[order[i]]
        shared = next((k for k in range(min(len(a), len(b))) if a[k] != b[k]), min(len(a), len(b)))
        assert common[i] == (shared if group[order[i]] == group[order[i - 1]] else -1)
