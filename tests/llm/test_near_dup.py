import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from ledgerflow.llm import near_dup
from tests.llm.helpers import DOCS, clashing, frame, prose


def shingles(text):
    words = "".join(c.lower() if c.isalnum() else " " for c in text or "").split()
    if not words:
        return Counter()
    return Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def weights(texts):
    """Of each text its shingles with their weights, from definitions alone."""
    seen = Counter(w for t in texts for w in {w for s in shingles(t) for w in s})
    n = max(2, len(texts))
    idf = {w: 1 + np.log(n / max(1, k)) / np.log(n) for w, k in seen.items()}
    return [{s: k * np.mean([idf[w] for w in s]) for s, k in shingles(t).items()} for t in texts]


def similarity(a, b):
    shared = sum(min(w, b[s]) for s, w in a.items() if s in b)
    total = sum(a.values()) + sum(b.values()) - shared
    return shared / total if total else 0.0


def brute_force(docs):
    found = weights([t for _, t in docs])
    parent = list(range(len(docs)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            if found[i] and (docs[i][1] == docs[j][1] or similarity(found[i], found[j]) >= 0.8):
                parent[root(i)] = root(j)
    return [root(i) for i in range(len(docs))]


def corpus():
    rng = random.Random(12)
    docs = [(i, prose(i, rng.randrange(1, 120), 5000)) for i in range(40)]
    number = 100
    for base in range(8):
        words = prose(1000 + base, rng.randrange(30, 400), 5000).split()
        for _ in range(5):
            copy = words.copy()
            for _ in range(rng.choice([0, 1, 1, 2])):
                copy[rng.randrange(len(copy))] = f"edit{rng.randrange(99)}"
            docs.append((number, " ".join(copy)))
            number += 1
    docs += [(300, docs[3][1]), (300, docs[3][1]), (None, docs[4][1]), (301, docs[5][1].upper()), (302, docs[6][1] + " !!")]
    docs += [(303, None), (304, ""), (304, ""), (305, "..."), (306, "one two"), (307, "one two"), (308, "one"), (309, "x " * 3000)]
    docs += [(310, "x " * 3100), (311, "buy now " * 50), (312, "buy now " * 52)]
    return docs


def test_classes_equal_brute_force(spark):
    docs = corpus()
    found = near_dup.near_duplicate_classes(clashing(frame(spark, docs))).collect()
    assert len(found) == len(docs)
    roots = {}
    for (doc, text), root in zip(docs, brute_force(docs)):
        roots.setdefault((doc, text), root)
    least, members = {}, Counter()
    for (doc, text), root in zip(docs, brute_force(docs)):
        members[root] += 1
        if doc is not None:
            least[root] = min(doc, least.get(root, doc))
    expected = Counter((doc, least.get(root, doc)) for (doc, _), root in zip(docs, brute_force(docs)))
    assert Counter((r.doc_id, r.class_id) for r in found) == expected
    kept = Counter(r.class_root for r in found if r.keeps and r.class_root is not None)
    distinct = {(r.class_root, r.doc_id, bytes(r.node)) for r in found if r.keeps and r.class_root is not None}
    assert len(distinct) == len(kept)


def test_similarity_equals_its_definition():
    texts = ["a b c d e f g", "a b c d e f h", "a b c d e", "a b", "A, b!", "", "x " * 40, "x " * 30]
    idf = np.ones(near_dup.WORD_BUCKETS, np.float32)
    pairs = [(a, b) for a in texts for b in texts]
    got = near_dup.similarities(pa.array([a for a, _ in pairs]), pa.array([b for _, b in pairs]), idf)
    for (a, b), value in zip(pairs, got):
        assert np.isclose(value, similarity(dict(shingles(a)), dict(shingles(b))))


def test_samples_agree_as_often_as_texts_are_alike():
    idf = np.ones(near_dup.WORD_BUCKETS, np.float32)
    words = prose(1, 1200, 100_000).split()
    other = words.copy()
    for i in range(0, 1200, 40):
        other[i] = "zz"
    found = near_dup.profile(pa.array([" ".join(words), " ".join(other)]), idf)
    one, two = near_dup.samples(found, 2)
    truth = similarity(dict(shingles(" ".join(words))), dict(shingles(" ".join(other))))
    assert abs((one == two).mean() - truth) < 0.12


def test_empty_table(spark):
    assert near_dup.near_duplicate_classes(frame(spark, [], DOCS)).collect() == []


def family(seed, n, pairs, own, shared):
    """Texts of one common passage and words of their own, in random places, that hide pairs which share some of those."""
    rng = random.Random(seed)
    common = prose(seed, 300, 100_000)
    texts = []
    for i in range(n):
        words = [f"own{seed}x{i}x{k}" for k in range(own)]
        if i < 2 * pairs:
            words[:shared] = [f"pair{seed}x{i // 2}x{k}" for k in range(shared)]
        texts.append(" ".join([common, *words]))
    rng.shuffle(texts)
    return texts


def hidden(text):
    return next((w.split("x")[1] for w in text.split() if w.startswith("pair")), None)


@pytest.mark.parametrize(("n", "pairs", "own", "shared", "rest"), [(1000, 10, 30, 16, 0.72), (600, 60, 22, 4, 0.78)])
def test_pairs_hidden_in_a_large_family(spark, n, pairs, own, shared, rest):
    texts = family(n, n, pairs, own, shared)
    found = weights(texts)
    paired = [i for i, t in enumerate(texts) if hidden(t)]
    for i in paired:
        for j in paired[:5]:
            if i != j:
                alike = similarity(found[i], found[j])
                assert alike >= 0.8 if hidden(texts[i]) == hidden(texts[j]) else rest - 0.02 < alike < 0.8
    rows = near_dup.near_duplicate_classes(frame(spark, list(enumerate(texts)))).collect()
    classes, expected = {}, {}
    for r in rows:
        classes.setdefault(r.class_id, []).append(r.doc_id)
    for i, t in enumerate(texts):
        expected.setdefault(hidden(t) or i, []).append(i)
    assert sorted(map(sorted, classes.values())) == sorted(expected.values())


def test_prefixes_of_alike_texts_meet():
    idf = np.ones(near_dup.WORD_BUCKETS, np.float32)
    rng = random.Random(5)
    texts = family(6, 20, 8, 26, 20) + [t + " more" * rng.randrange(1, 40) for t in family(6, 20, 8, 26, 20)]
    found = near_dup.profile(pa.array(texts), idf)
    counts = np.bincount((found.key % np.uint64(near_dup.SHINGLE_CELLS)).astype(int), minlength=near_dup.SHINGLE_CELLS)
    text, key, rest, total, short = near_dup.prefixes(found, len(texts), counts)
    listed = {i: {k: (r, w, s) for k, r, w, s in zip(key[text == i], rest[text == i], total[text == i], short[text == i])} for i in range(len(texts))}
    at, spot, _, _, light = near_dup.spots(found, len(texts), counts)
    lighter, heavier = ({i: {*spot[(at == i) & (light == role)]} for i in range(len(texts))} for role in (True, False))
    alike = 0
    for i in range(len(texts)):
        for j in range(len(texts)):
            a, b = Counter(shingles(texts[i])), Counter(shingles(texts[j]))
            if i != j and sum(a.values()) <= sum(b.values()) and similarity(a, b) >= 0.8:
                alike += 1
                assert lighter[i] & heavier[j]
                met = [(listed[i][k], listed[j][k]) for k in listed[i].keys() & listed[j].keys()]
                assert any(x[2] and min(x[0], y[0]) * 1.8 >= 0.8 * (x[1] + y[1]) - 1e-3 for x, y in met)
    assert alike > 16


def test_spots_grow_with_the_texts_not_with_pairs():
    idf = np.ones(near_dup.WORD_BUCKETS, np.float32)
    found = near_dup.profile(pa.array(family(7, 200, 20, 60, 16)), idf)
    counts = np.bincount((found.key % np.uint64(near_dup.SHINGLE_CELLS)).astype(int), minlength=near_dup.SHINGLE_CELLS)
    text, *_, light = near_dup.spots(found, 200, counts)
    begun = near_dup.prefixes(found, 200, counts)[0]
    assert len(text) <= 24 * len(begun)
    # texts alike in their common passage only begin to share it too late for the bound
    assert len({*text[light].tolist()}) <= 40


def test_copies_of_a_text_without_words_are_one_class(spark):
    docs = [(1, "-----"), (2, "-----"), (3, "!!! ###"), (4, ""), (5, None), (6, ""), (7, "-----")]
    found = near_dup.near_duplicate_classes(frame(spark, docs)).collect()
    assert {r.doc_id: (r.class_id, r.class_size) for r in found} == {
        1: (1, 3), 2: (1, 3), 7: (1, 3), 3: (3, 1), 4: (4, 1), 5: (5, 1), 6: (6, 1)
    }


def test_a_large_component_makes_rows_by_its_texts_and_places_by_its_weights(spark, monkeypatch):
    base, rng = prose(70, 200, 100_000).split(), random.Random(70)
    texts, component = [], []
    for i in range(120):  # near copies, already one component
        texts.append(" ".join([*base[:190], *(f"edit{i}x{k}" for k in range(10 + i % 3))]))
        component.append(1)
    for i in range(6):  # some of these belong to it, and to each other
        texts.append(" ".join([*base[: 120 + 12 * i], *(f"far{i}x{k}" for k in range(70 - 12 * i))]))
        component.append(2 + i)
    texts.append(" ".join([*base[:90], *prose(71, 110, 100_000).split()]))
    component.append(9)
    order = rng.sample(range(len(texts)), len(texts))
    rows = [(i.to_bytes(2, "big"), component[i], texts[i]) for i in order]
    own = spark.createDataFrame(rows, "node binary, component long, text string")
    made, store = Counter(), near_dup.stored

    def spy(df, label):
        found = store(df, label)
        made[label] += found.count()
        return found

    monkeypatch.setattr(near_dup, "stored", spy)
    idf = np.ones(near_dup.WORD_BUCKETS, np.float32)
    pairs = near_dup._prefix_pairs(own.drop("text"), own.drop("component"), spark.sparkContext.broadcast(idf))
    listed = [(int.from_bytes(r.a, "big"), int.from_bytes(r.b, "big")) for r in pairs.collect()]
    found = [dict(shingles(t)) for t in texts]
    across = [(i, j) for j in range(len(texts)) for i in range(j) if component[i] != component[j]]
    alike = {p for p in across if similarity(found[p[0]], found[p[1]]) >= 0.8}
    assert len({p for p in alike if p[1] >= 120}) > 100
    assert alike <= {*listed} <= {*across}
    profile = near_dup.profile(pa.array(texts), idf)
    counts = np.bincount((profile.key % np.uint64(near_dup.SHINGLE_CELLS)).astype(int), minlength=near_dup.SHINGLE_CELLS)
    begun = near_dup.prefixes(profile, len(texts), counts)[0]
    assert max(made.values()) <= len(begun)
