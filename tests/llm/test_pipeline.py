import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import types as T
from tokenizers import Tokenizer

import corpus_pipeline
from ledgerflow.llm import near_dup, packing, pii
from tests.llm.helpers import prose
from tests.llm.test_line_crf import LABELS
from tests.llm.test_line_crf import text as lines

DOCUMENTS = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType())]
    + [T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())]
)
ITEMS = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType())])
LEAK = "every benchmark answer hides in this exact long sentence of more than ten words"
MAIL = "write to some.one@mail.example.com or +1 (918) 555-2370 today"


def corpus():
    texts = [(i, lines(i % 3 > 0, i)) for i in range(150)]
    texts += [(200, prose(1, 80) + "."), (201, prose(1, 80) + "."), (202, prose(1, 80).upper() + "."), (203, f"{prose(2, 30)}. {LEAK}.")]
    texts += [(204, f"{prose(3, 40)}. {MAIL}."), (204, f"{prose(3, 40)}. {MAIL}."), (205, prose(4, 6000) + "."), (None, prose(5, 50) + ".")]
    return [(d, t, "en", "src", len(t)) for d, t in texts]


def write(spark, path):
    spark.createDataFrame(corpus(), DOCUMENTS).write.parquet(f"{path}/documents.parquet")
    labels = [(i, int(i % 3 > 0), 0) for i in range(150)]
    spark.createDataFrame(labels, LABELS).write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, LEAK), (2, None)], ITEMS).write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def test_stages(spark, tmp_path):
    sf_dir = write(spark, tmp_path)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        path = str(tmp_path / f"out-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        assert docs.columns == DOCUMENTS.names
        kept[name] = docs.collect()
    ids = {name: Counter(r.doc_id for r in rows) for name, rows in kept.items()}
    good = {i for i in range(150) if i % 3 > 0}
    assert len({i for i in ids["quality"] if i is not None and i < 150} ^ good) <= 2
    assert ids["quality"][204] == 2 and ids["near_duplicates"][204] == 1
    assert ids["near_duplicates"][200] == 1 and not ids["near_duplicates"][201] and not ids["near_duplicates"][202]
    assert ids["near_duplicates"][203] == 1 and not ids["decontamination"][203]
    assert ids["decontamination"][None] == 1
    before = {r.doc_id: r.text for r in kept["decontamination"]}
    for row in kept["personal_data"]:
        assert row.n_chars == len(row.text)
        if row.doc_id == 204:
            assert row.text.endswith("write to <EMAIL> or <PHONE> today.")
        elif row.doc_id != 205:
            assert row.text == pii.redact(before[row.doc_id], frozenset())
    encode = Tokenizer.from_file(packing.vocabulary_path())
    expected = []
    for row in kept["personal_data"]:
        ids_of = [*encode.encode(row.text, add_special_tokens=False).ids, 0]
        head = len(ids_of) % 2048 or 2048
        cuts = [0, *range(head, len(ids_of) + 1, 2048)]
        for n, (a, b) in enumerate(zip(cuts, cuts[1:])):
            expected.append((row.doc_id, n, a, b - a, zlib.crc32(np.array(ids_of[a:b], "<u4").tobytes())))
    found = corpus_pipeline.run(spark, sf_dir).collect()
    assert sorted((tuple(r)[:5] for r in found), key=repr) == sorted(expected, key=repr)


def test_extra_columns_and_empty_tables(spark, tmp_path):
    sf_dir = write(spark, tmp_path)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    wide = docs.selectExpr("*", "1 AS score", "2 AS node", "3 AS n_words", "'x' AS hits", "4 AS rows", "5 AS contaminated")
    empty = docs.where("doc_id < 0")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        result = stage(spark, wide, sf_dir)
        assert result.columns == wide.columns and result.count() > 0
        assert stage(spark, empty, sf_dir).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, empty, sf_dir).count() == 0


def test_one_of_rows_with_equal_id_and_text_stays_whatever_their_order(spark, tmp_path):
    text = "one two three four five six seven"
    rows = [(1, text, lang, source, 5) for lang in ("de", None, "en") for source in ("x", "a")]
    kept = set()
    for order in (rows, rows[::-1], rows[3:] + rows[:3]):
        docs = spark.createDataFrame(order, "doc_id bigint, text string, lang string, source string, n_chars bigint").repartition(3)
        kept.add(tuple(map(tuple, corpus_pipeline.near_duplicates(spark, docs, str(tmp_path)).collect())))
    assert len(kept) == 1 and len(next(iter(kept))) == 1


def test_a_run_leaves_its_last_stage_only(spark, sf_dir):
    import os

    folder = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(folder))
    corpus_pipeline.run(spark, sf_dir).count()
    left = set(os.listdir(folder)) - before
    assert len(left) == 1 and next(iter(left)).startswith("stage-packing")


def test_near_duplicate_stage_makes_rows_by_the_texts_of_large_groups(spark, tmp_path, monkeypatch):
    common, made, store = prose(80, 300, 100_000).split(), {}, near_dup.stored
    copies = [" ".join([*common, *(f"own{k}" for k in range(26)), *(f"edit{i}x{k}" for k in range(4))]) for i in range(150)]
    others = [" ".join([*common, *(f"other{i}x{k}" for k in range(26))]) for i in range(60)]
    texts = [t for pair in zip(copies, others + copies[:90]) for t in pair]
    docs = spark.createDataFrame([(i, t, "en", "src", len(t)) for i, t in enumerate(texts)], DOCUMENTS)

    def spy(df, label):
        found = store(df, label)
        made[label] = made.get(label, 0) + found.count()
        return found

    monkeypatch.setattr(near_dup, "stored", spy)
    kept = {r.text for r in corpus_pipeline.near_duplicates(spark, docs, str(tmp_path)).collect()}
    assert kept == {copies[0], *others}
    distinct = sorted({*texts})
    profile = near_dup.profile(pa.array(distinct), near_dup.word_weights(docs))
    counts = np.bincount((profile.key % np.uint64(near_dup.SHINGLE_CELLS)).astype(int), minlength=near_dup.SHINGLE_CELLS)
    assert 0 < made["prefixes"] <= len(near_dup.prefixes(profile, len(distinct), counts)[0])
