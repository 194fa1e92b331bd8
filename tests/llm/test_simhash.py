import random

import numpy as np
import xxhash

from ledgerflow.llm import queries, simhash
from ledgerflow.llm.storage import stored
from tests.llm.helpers import clashing, frame, prose

BLANKS = " \t\n\x0b\x0c\r"


def fingerprint(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for blank in BLANKS:
        text = text.replace(blank, " ")
    words = [w for w in text.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(prints):
    """The least linked value of each value, over all pairs."""
    prints = sorted(prints)
    values = np.array(prints, np.int64)
    parent = list(range(len(prints)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(prints)):
        near = np.flatnonzero(np.bitwise_count((values ^ values[i]).view(np.uint64)) <= 4)
        for j in near.tolist():
            a, b = find(i), find(j)
            parent[max(a, b)] = min(a, b)
    return {p: prints[find(i)] for i, p in enumerate(prints)}


def expected(docs):
    prints = [fingerprint(t) for _, t in docs]
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    root = roots(set(signed))
    least = {}
    for (doc, _), p in zip(docs, signed):
        if doc is not None:
            least[root[p]] = min(doc, least.get(root[p], doc))
    return sorted(((d, f"{p:016x}", least.get(root[s])) for (d, _), p, s in zip(docs, prints, signed)), key=repr)


def test_against_plain_python(spark):
    rng = random.Random(4)
    docs = [(i, prose(i, rng.randrange(1, 80))) for i in range(1, 120)]
    docs += [(200 + i, text + " more") for i, (_, text) in enumerate(docs[:60])]
    docs += [(300, None), (301, ""), (302, BLANKS), (303, "One word É"), (304, "one word É"), (305, "a b c"), (None, "solo " * 9)]
    docs += [(306, "A b\tc d\n" * 3), (306, "A b\tc d\n" * 3), (None, docs[0][1]), (307, prose(1, 40000)), (308, prose(1, 40000) + " x")]
    found = simhash.simhash_components(clashing(frame(spark, docs)))
    assert found.columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted(map(tuple, found.collect()), key=repr) == expected(docs)
    assert simhash.simhash_components(frame(spark, [])).collect() == []


def test_shingles_in_runs(monkeypatch):
    import pyarrow as pa

    texts = [prose(i, n) for i, n in enumerate([1, 5, 90, 0, 33])]
    monkeypatch.setattr(simhash, "RUN", 7)
    assert simhash.fingerprints(pa.array(texts)).tolist() == [fingerprint(t) for t in texts]


def cluster(seed, centre, n, least, most):
    rng = random.Random(seed)
    found = set()
    for _ in range(n):
        value = centre
        for bit in rng.sample(range(64), rng.randrange(least, most)):
            value ^= 1 << bit
        found.add(value - (1 << 64) if value >> 63 else value)
    return found


def test_large_buckets_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(simhash, "WHOLE", 3)
    prints = cluster(1, 0x0123456789ABCDEF, 120, 0, 9) | cluster(2, 0xFEDCBA9876543210, 60, 2, 6) | cluster(3, 0, 60, 5, 30)
    want = roots(prints)
    found = simhash.components_of(spark.createDataFrame([(p,) for p in prints], "print bigint"))
    got = dict.fromkeys(prints)
    got.update({r.node: r.root for r in found.collect()})
    assert {p: got[p] if got[p] is not None else p for p in prints} == want
    assert len(set(want.values())) > 20


def test_exploded_rows_reach_no_driver(spark, monkeypatch):
    """A small stored table is one that the planner would broadcast, with all the rows that are made of each fingerprint."""
    plans = []

    def planned(df, label):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return stored(df, label)

    monkeypatch.setattr(simhash, "WHOLE", 3)
    monkeypatch.setattr(simhash, "stored", planned)
    prints = cluster(5, 0x0123456789ABCDEF, 90, 0, 9) | cluster(6, 0, 40, 5, 30)
    want = roots(prints)
    table = stored(spark.createDataFrame([(p,) for p in prints], "print bigint"), "prints")
    got = {r.node: r.root for r in simhash.components_of(table).collect()}
    assert {p: got.get(p, p) for p in prints} == want
    exploded = [p for p in plans if "Generate explode" in p]
    assert max(p.count("Generate explode") for p in exploded) > 1  # that of the midpoints is among them
    assert [p for p in exploded if "BroadcastExchange" in p] == []


def test_every_close_pair_shares_a_block():
    rng = random.Random(8)
    masks = [m % (1 << 64) for m in simhash.block_masks(simhash.BLOCKS, simhash.SHARED)]
    for _ in range(200):
        flips = sum(1 << b for b in rng.sample(range(64), 4))
        assert any(flips & m == 0 for m in masks)


def test_links_of_a_small_bucket_connect_it():
    for seed in range(20):
        prints = sorted(cluster(seed, 77, 40, 0, 7))
        links = simhash.spanning_links(np.array(prints, np.int64))
        assert len(links) == len(prints) - len(set(roots(prints).values()))
        assert all(((a ^ b) % (1 << 64)).bit_count() <= 4 and a < b for a, b in links)


def test_query_over_the_table(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    found = queries.QUERIES["op11_simhash_components"](spark, sf_dir)
    assert sorted(map(tuple, found.collect()), key=repr) == expected(docs)
