import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa

from ledgerflow.llm import prefix_trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def rebuilt(source):
    turns = {}
    for conv, turn, role, text in source:
        if conv is not None:
            whole = (role or "", text or "")
            key = hashlib.md5(f"{len(whole[0])}:{whole[0]}{whole[1]}".encode()).digest()
            turns.setdefault(conv, []).append((turn is not None, turn or 0, key, whole))
    for rows in turns.values():
        rows.sort()
    out = {}
    for conv, rows in turns.items():
        h = zlib.crc32(str(conv).encode()) % 4
        base = conv - int(np.fmod(conv, 20))
        out[conv] = tuple(r[3] for r in turns.get(base, [])[:h] + rows[h:])
    return out


def expected(sequences):
    nodes = {}
    for conv, turns in sequences.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(turns[:d], []).append(conv)
    children = {}
    for prefix in nodes:
        if prefix:
            children.setdefault(prefix[:-1], []).append(prefix)
    sums = {}
    for prefix in sorted(nodes, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", prefix[-1][1])) if prefix else 0
        below = [sums[c] for c in children.get(prefix, [])]
        sums[prefix] = (sum(b[0] for b in below) or 1, sum(b[1] for b in below) + (len(nodes[prefix]) - 1) * words)
    out = []
    for prefix, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(members) if len(sequences[c]) == len(prefix))
        parent = min(nodes[prefix[:-1]]) if prefix else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(members), len(prefix), parent, len(members), len(children.get(prefix, [])), *sums[prefix], digest))
    return sorted(out, key=repr)


def conversations():
    rng = random.Random(6)
    rows = []
    for conv in range(-30, 300):
        for turn in range(rng.randrange(0, 7)):
            text = rng.choice(["a b", "c\td e", "", None, "été ö", "x " * rng.randrange(4)])
            rows.append((conv, turn if rng.random() < 0.95 else None, rng.choice(["user", "user", None]), text))
    for conv in range(1000, 1200):  # a third of all conversations: one text
        rows += [(conv, t, "user", f"same {t}") for t in range(4)]
    rows += [(5000, t, "user", "long talk") for t in range(300)] + [(5001, t, "user", "long talk") for t in range(300)]
    return rows + [(None, 1, "user", "nobody"), (6000, 1, "a", "1:b"), (6001, 1, "a1:", "b"), (6000, 1, "a", "1:b")]


def found_rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_against_plain_python(spark, monkeypatch):
    rows = conversations()
    source = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS TEXT", "2 AS kind", "3 AS ids").repartition(3)
    want = expected(rebuilt(rows))
    assert found_rows(prefix_trie.conversation_trie(source)) == want
    assert prefix_trie.conversation_trie(source).columns == prefix_trie._COLUMNS
    assert prefix_trie.conversation_trie(spark.createDataFrame([], SCHEMA)).collect() == []


def test_few_conversations(spark):
    for rows in ([(1, 0, "user", "hi")], [(1, 0, "u", "a"), (2, 0, "u", "a")], [(7, 5, None, None)], [(20, 0, "u", "a"), (21, 1, "u", "b")]):
        assert found_rows(prefix_trie.conversation_trie(spark.createDataFrame(rows, SCHEMA))) == expected(rebuilt(rows))


def test_blocks_of_every_size(spark, monkeypatch):
    """Workers read ``CELLS`` as imported, so the blocks are made here and put together by the same job."""
    rng = random.Random(2)
    sequences = {}
    for conv in range(120):
        sequences[conv] = tuple(("u", rng.choice("ab")) for _ in range(rng.randrange(0, 6)))
    ids = {turn: hashlib.md5(repr(turn).encode()).digest() for turns in sequences.values() for turn in turns}
    ordered = sorted(((tuple(ids[t] for t in turns), conv) for conv, turns in sequences.items()))
    kind = pa.list_(pa.binary()), pa.list_(pa.int64())
    arrays = [pa.array([c for _, c in ordered]), pa.array([list(k) for k, _ in ordered], kind[0])]
    batch = pa.RecordBatch.from_arrays([*arrays, pa.array([[1] * len(k) for k, _ in ordered], kind[1])], ["conv_id", "ids", "words"])
    want = expected(sequences)
    schema = spark.createDataFrame([], prefix_trie._PARTS).schema
    for cells in (1, 7, 40, 500):
        monkeypatch.setattr(prefix_trie, "CELLS", cells)
        parts = [p for n, rows in enumerate(prefix_trie._blocks([batch.slice(0, 50), batch.slice(50)])) for p in prefix_trie.trie_parts(rows, str(n))]
        rows = pa.Table.from_batches(parts).to_pylist()
        frame = spark.createDataFrame([tuple(r.values()) for r in rows], schema)
        monkeypatch.setattr(prefix_trie, "stored", lambda df, label, f=frame: f if label == "trie-parts" else df)
        turns = spark.createDataFrame([], "conv_id bigint, turns array<struct<turn:bigint,id:binary,words:bigint>>")
        assert found_rows(prefix_trie.prefix_trie(turns)) == want, cells


def test_a_long_text_and_more_turns_than_cells(spark):
    rows = [(40, t, "user", f"{t % 3}") for t in range(20)] + [(41, 0, "user", "word " * 300000)]
    assert found_rows(prefix_trie.conversation_trie(spark.createDataFrame(rows, SCHEMA))) == expected(rebuilt(rows))
