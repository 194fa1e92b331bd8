import math
import random
import re

from pyspark.sql import types as T

from ledgerflow.llm import divergence
from tests.llm.helpers import clashing, frame

SCHEMA = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType())]
)
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def expected(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(i, i + 3)}
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(covered),
        len(words) < 50 or 100 * len(covered) > 50 * len(words),
    )


def distance(p, q):
    p, q = [x / max(1, sum(p)) for x in p], [x / sum(q) for x in q]
    total = sum(a * math.log2(2 * a / (a + b)) / 2 for a, b in zip(p, q) if a > 0)
    total += sum(b * math.log2(2 * b / (a + b)) / 2 for a, b in zip(p, q) if b > 0)
    return math.sqrt(max(0, total))


def histograms(text):
    words = [w.lower() for w in WORD.findall(text or "")]
    common = [words.count(w) for w in divergence._WORDS]
    text = text or ""
    kinds = [sum(map(str.isalpha, text)) - sum(map(str.isupper, text)), sum(map(str.isupper, text))]
    kinds += [sum(c.isdigit() for c in text), sum(c in divergence._POINTS for c in text)]
    kinds += [sum(c in divergence._BLANKS for c in text)]
    return common + [len(words) - sum(common)], kinds + [len(text) - sum(kinds)]


def corpus():
    rng = random.Random(9)

    def prose(lang, n):
        common = divergence.COMMON_WORDS[lang]
        rare = ["lichung", "ención", "thering", "eaument", "Größe", "été", "9x", "Under"]
        words = [rng.choice(common if rng.random() < 0.35 else rare) for _ in range(n)]
        return "".join(w + rng.choice([" ", " ", ". ", ",\n", "\t"]) for w in words)

    docs = [(i, prose(lang, rng.randrange(20, 300)), lang) for i, lang in enumerate(["en", "de", "fr", "es"] * 8)]
    docs += [(100, None, "en"), (101, "", None), (102, " \n\t\r ", "xx"), (103, docs[0][1], "en"), (103, docs[0][1], "en")]
    docs += [(None, "a b c " * 100, "en"), (104, "a b a b a b", None), (105, "one\none\n two\n\none", "en")]
    docs += [(106, "| # <x> | & " * 60 + " ".join(f"t{i} | {i * 7919}" for i in range(400)), "en")]
    docs += [(107, "\u00a0x \u2028y " * 60, "en"), (108, prose("en", 120), "en"), (109, prose("en", 3000), "en")]
    return docs


def test_against_plain_python(spark):
    docs = corpus()
    found = divergence.quality_rules(clashing(frame(spark, docs, SCHEMA))).collect()
    base = sorted(((d, *expected(t)) for d, t, _ in docs), key=repr)
    assert sorted((tuple(r)[:7] for r in found), key=repr) == base
    sums = {}
    for _, text, lang in docs:
        if lang in divergence.COMMON_WORDS:
            pair = histograms(text)
            old = sums.get(lang, ([0] * len(pair[0]), [0] * 6))
            sums[lang] = tuple([a + b for a, b in zip(x, y)] for x, y in zip(old, pair))
    texts = {d: t for d, t, _ in docs}
    for row in found:
        words, chars = histograms(texts[row.doc_id])
        options = sorted((distance(words, w) + distance(chars, c), lang) for lang, (w, c) in sums.items())
        assert row.nearest_lang == options[0][1] or options[1][0] - options[0][0] < 1e-9
        assert abs(row.word_distance + row.char_distance - options[0][0]) < 1e-9
        root = math.sqrt(max(1, row.n_words))
        near = row.word_distance <= 0.26 + 0.6 / root and row.char_distance <= 0.17 + 0.6 / root
        judged = row.n_words >= 50 and len(texts[row.doc_id] or "") >= 200
        assert row.kept == (not row.base_failed and (near or not judged))
    assert {r.kept for r in found} == {True, False}
    assert not any(r.kept for r in found if r.doc_id == 106)


def test_no_reference_and_no_rows(spark):
    only = divergence.quality_rules(frame(spark, [(1, "q w e r t y " * 3 + " ".join(map(str, range(60))), None)], SCHEMA))
    assert [(r.kept, r.nearest_lang) for r in only.collect()] == [(True, None)]
    assert divergence.quality_rules(frame(spark, [], SCHEMA)).collect() == []


def test_only_wordless_texts(spark):
    docs = [(1, None, "en"), (2, "", "de"), (3, " \t\n", None), (4, " ", "en")]
    found = divergence.quality_rules(frame(spark, docs, SCHEMA)).collect()
    assert sorted((r.doc_id, r.n_words, r.base_failed, r.kept) for r in found) == [
        (1, 0, True, False), (2, 0, True, False), (3, 0, True, False), (4, 1, True, False)
    ]
