import hashlib
import random
import re

import pytest
from pyspark.sql import types as T

from ledgerflow.llm.decontaminate import find_contamination
from tests.llm.helpers import DOCS, clashing, frame

ITEMS = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType())])
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def expected(docs, items):
    windows = {}
    for item, text in items:
        found = words(text)
        size = min(10, len(found))
        for i in range(len(found) - size + 1 if size and item is not None else 0):
            windows.setdefault(tuple(found[i : i + size]), set()).add(str(item))
    out = []
    for doc, text in docs:
        found, hit, ids = words(text), set(), set()
        for window, owners in windows.items():
            for i in range(len(found) - len(window) + 1):
                if tuple(found[i : i + len(window)]) == window:
                    hit.update(range(i, i + len(window)))
                    ids |= owners
        digest = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
        out.append((doc, len(found), len(hit), len(ids), digest, bool(hit)))
    return sorted(out, key=repr)


def tables():
    rng = random.Random(3)
    vocabulary = ["the", "of", "Zoë", "été", "x1", "and", "ünï", "run", "Key", "日本"]
    text = lambda n: "".join(rng.choice(vocabulary) + rng.choice([" ", ", ", "\n", " - "]) for _ in range(n))
    items = [(i, text(n)) for i, n in enumerate([30, 12, 10, 9, 4, 1, 0, 25, 60])]
    items += [(9, None), (10, items[0][1]), (11, "un mot"), (11, "un mot"), (None, "never used at all")]
    docs = [(i, text(rng.randrange(0, 80))) for i in range(40)]
    docs += [(100 + i, text(20) + t.upper() + text(5)) for i, (_, t) in enumerate(items[:9])]
    docs += [(200, None), (201, ""), (202, "!!! ..."), (203, items[0][1]), (203, items[0][1]), (None, "un mot. UN MOT")]
    docs += [(204, text(3000) + (items[8][1] or "") * 3)]
    return docs, items


@pytest.mark.parametrize("block", [200_000, 25])
def test_against_brute_force(spark, block):
    docs, items = tables()
    found = find_contamination(clashing(frame(spark, docs)), frame(spark, items, ITEMS), block_patterns=block)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == expected(docs, items)


def test_empty_tables(spark):
    docs, items = tables()
    none = find_contamination(frame(spark, docs), frame(spark, [], ITEMS)).collect()
    assert len(none) == len(docs) and not any(r.contaminated for r in none)
    assert find_contamination(frame(spark, [], DOCS), frame(spark, items, ITEMS)).collect() == []
