import hashlib
import random
import re

import pytest

from ledgerflow.llm.repeated_words import remove_repeated_words
from tests.llm.helpers import DOCS, clashing, frame, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def expected(docs):
    parsed = [(d, WORD.findall(t or "")) for d, t in docs]
    least = {}
    for doc, words in parsed:
        for i in range(len(words) - 12):
            window = tuple(words[i : i + 13])
            if doc is not None:
                least[window] = min(doc, least.get(window, doc))
    out = []
    for doc, words in parsed:
        gone = set()
        for i in range(len(words) - 12):
            if doc is not None and least[tuple(words[i : i + 13])] < doc:
                gone.update(range(i, i + 13))
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((doc, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def corpus():
    rng = random.Random(6)
    passage, common = prose(1, 60).split(), prose(2, 13)
    docs = [(i, prose(100 + i, rng.randrange(0, 150), 40)) for i in range(40)]
    for i in range(12):
        at, n = rng.randrange(0, 40), rng.randrange(12, 20)
        docs.append((100 + i, f"{prose(i, 20)}\n{' '.join(passage[at : at + n])}\t{prose(50 + i, 9)}"))
    docs += [(200 - i, f"{prose(300 + i, i)} {common} {prose(400 + i, 5)}") for i in range(12)]
    docs += [(500, docs[3][1]), (501, docs[3][1]), (501, docs[3][1]), (501, docs[5][1]), (None, docs[3][1]), (None, docs[5][1])]
    docs += [(600, None), (601, ""), (602, "x " * 400), (603, "x " * 13), (604, "x " * 12), (605, "é ü " * 30), (606, "é ü " * 30)]
    docs += [(-5, prose(7, 3000)), (700, prose(7, 3000)[50:9000])]
    return docs


@pytest.mark.parametrize("passes", [1, 3])
def test_against_brute_force(spark, passes):
    docs = corpus()
    found = remove_repeated_words(clashing(frame(spark, docs)), passes=passes).collect()
    assert sorted((tuple(r) for r in found), key=repr) == expected(docs)


def test_empty_table(spark):
    assert remove_repeated_words(frame(spark, [], DOCS)).collect() == []
    docs = [(1, None), (2, "few words")]
    assert sorted((tuple(r) for r in remove_repeated_words(frame(spark, docs)).collect()), key=repr) == expected(docs)
