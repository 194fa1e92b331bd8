import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from ledgerflow.llm import packing
from tests.llm.helpers import DOCS, clashing, frame, prose


@pytest.fixture(scope="module")
def tokenizer():
    found = Tokenizer.from_file(packing.vocabulary_path())
    found.encode_special_tokens = True
    return found


AWKWARD = ["", " ", "  a", "a  ", "\n\n x", "it's 'll we've 'r ''s 'sfoo", "<|endoftext|> x", "é日本 ñ  z", "12ab 3.4,5",
           "tab\tand\r\nnew", "a" * 5000, " " * 300 + "b", "🙂🙃 !?", "x\x00y", "don't.won't!'d", "a\n b", "a \nb", "a\u00a0 b \u2003c", "a \u3000", "\u3000 a",
           "x\x1c y", "a\x85 b", "\ta b\t c", "a b\n\nc d\n", " lead", "trail ", "a\u200b b"]


def test_ids_equal_the_tokenizer(tokenizer):
    encode = packing.Encoder(packing.vocabulary_path())
    for text in [*AWKWARD, *(prose(i, 50 * i, 5000) for i in range(8))]:
        assert encode(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text[:40])


def test_cache_generations_do_not_matter(tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "CACHED_PIECES", 7)
    encode = packing.Encoder(packing.vocabulary_path(), ranked=False)
    for text in [prose(i, 80, 30) for i in range(10)]:
        assert encode(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_pack_fills_bins():
    rng = np.random.default_rng(2)
    for sizes in (rng.integers(1, 2049, 3000), rng.integers(600, 1100, 800), np.array([2048, 1]), np.array([], int)):
        which, offset = packing.pack(sizes, 2048)
        fill = np.bincount(which, sizes) if len(sizes) else np.zeros(0)
        assert (fill <= 2048).all() and (fill > 0).all()
        for b in range(len(fill)):
            at = sorted((offset[i], sizes[i]) for i in np.flatnonzero(which == b))
            assert [o for o, _ in at] == [0, *np.cumsum([s for _, s in at])[:-1].tolist()]


def test_local_search_dissolves_a_bin_that_best_fit_leaves():
    sizes = np.array([51, 27, 27, 27, 26, 23, 23, 23, 23, 50])
    before = packing._Bins(sizes, 100)
    before.best_fit()
    which, _ = packing.pack(sizes, 100)
    assert which.max() + 1 == 3 and len(before.items) == 4


def docs():
    rows = [(i, t) for i, t in enumerate(AWKWARD)] + [(100 + i, prose(i, 200 * i)) for i in range(12)]
    return rows + [(None, None), (5, AWKWARD[5]), (5, AWKWARD[5]), (2**60 + 1, "big id")]


@pytest.mark.parametrize("group", [40_000, 7])
def test_query_is_a_whole_packing(spark, tokenizer, group):
    rows = docs()
    found = packing.pack_documents(clashing(frame(spark, rows)), group_pieces=group, size=64).collect()
    expected = []
    for doc, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        head = len(ids) % 64 or 64
        cuts = [0, *range(head, len(ids) + 1, 64)]
        for n, (a, b) in enumerate(zip(cuts, cuts[1:])):
            expected.append((doc, n, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    assert sorted((tuple(r)[:5] for r in found), key=repr) == sorted(expected, key=repr)
    bins = {}
    for r in found:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in bins.values():
        own.sort()
        assert [o for o, _ in own] == [0, *np.cumsum([n for _, n in own])[:-1].tolist()]
        assert sum(n for _, n in own) <= 64


def test_empty_table(spark):
    assert packing.pack_documents(frame(spark, [], DOCS)).collect() == []


LITERALS = ["a<|endoftext|> x", "<|endoftext|>", "<|endoftext|><|endoftext|>", " <|endoftext|> ", "a \n<|endoftext|>\n b", "<|endoftext|", "é<|endoftext|>é"]


def test_added_tokens_have_their_own_ids():
    loaded = Tokenizer.from_file(packing.vocabulary_path())
    encode = packing.Encoder(packing.vocabulary_path(), plain=False)
    for text in [*LITERALS, *AWKWARD, prose(3, 200) + "<|endoftext|>" + prose(4, 200)]:
        assert encode(text).tolist() == loaded.encode(text, add_special_tokens=False).ids, repr(text[:40])
    assert encode("a<|endoftext|> x").tolist() == [64, 50256, 2124]


@pytest.mark.parametrize("stage", [False, True])
def test_query_and_stage_use_the_tokenizer_as_loaded(spark, tmp_path, stage):
    import corpus_pipeline
    from ledgerflow.llm import queries

    rows = list(enumerate(LITERALS))
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    found = corpus_pipeline.packed(spark, docs, str(tmp_path)) if stage else queries.op8_best_fit_packing(spark, str(tmp_path))
    loaded = Tokenizer.from_file(packing.vocabulary_path())
    expected = []
    for doc, text in rows:
        ids = [*loaded.encode(text, add_special_tokens=False).ids, 0]
        expected.append((doc, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    assert sorted((r.doc_id, r.length, r.ids_crc32) for r in found.collect()) == expected


@pytest.mark.parametrize("plain", [True, False])
def test_both_ways_of_encoding_agree(plain):
    path = packing.vocabulary_path()
    fast, slow = (packing.Encoder(path, plain=plain, ranked=ranked) for ranked in (True, False))
    assert fast._ranked and not slow._ranked
    texts = [*AWKWARD, *LITERALS, *(prose(i, 300, 3000) for i in range(5)), " " * 2_000_000 + "b", "ab" * 700_000]
    for text in texts:
        assert np.array_equal(fast(text), slow(text)), repr(text[:40])


def test_vocabularies_whose_ids_are_not_ranks(tmp_path):
    import json

    with open(packing.vocabulary_path(), encoding="utf-8") as file:
        saved = json.load(file)
    saved["model"]["merges"][100:102] = saved["model"]["merges"][100:102][::-1]
    path = tmp_path / "other.json"
    path.write_text(json.dumps(saved), encoding="utf-8")
    assert packing._ranks(str(path)) is None and packing._ranks(packing.vocabulary_path())
    loaded, encode = Tokenizer.from_file(str(path)), packing.Encoder(str(path), plain=False)
    for text in (prose(1, 200), *AWKWARD):
        assert encode(text).tolist() == loaded.encode(text, add_special_tokens=False).ids
