"""The thin queries of the operators, each over its whole table."""

from __future__ import annotations

from ledgerflow.llm.decontaminate import find_contamination
from ledgerflow.llm.divergence import quality_rules
from ledgerflow.llm.line_crf import classify_quality
from ledgerflow.llm.near_dup import near_duplicate_classes
from ledgerflow.llm.packing import pack_documents
from ledgerflow.llm.pii import find_personal_data
from ledgerflow.llm.prefix_trie import conversation_trie
from ledgerflow.llm.registry import ORACLES, QUERIES, query, table
from ledgerflow.llm.repeated_bytes import remove_repeated_bytes
from ledgerflow.llm.repeated_words import remove_repeated_words
from ledgerflow.llm.simhash import simhash_components
from ledgerflow.llm.toxicity import classify_toxicity
from ledgerflow.llm.turn_repair import repair_conversations
from ledgerflow.llm.url_rules import DEFAULT_RULES, judge_urls

__all__ = ["ORACLES", "QUERIES"]


@query()
def op1_quality_divergence(spark, sf_dir):
    """Base counts of each document, and whether its histograms lie near those of a language."""
    return quality_rules(table(spark, sf_dir, "documents"))


@query()
def op2_benchmark_decontamination(spark, sf_dir):
    """Words of each document inside benchmark windows, and the items they come from."""
    return find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query()
def op3_pii_weak_supervision(spark, sf_dir):
    """Personal data in each document: base spans, and those the trained span classifier adds."""
    return find_personal_data(table(spark, sf_dir, "documents"))


@query()
def op4_quality_crf(spark, sf_dir):
    """Quality score of each document from the chain of its lines."""
    return classify_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query()
def op5_toxicity_cnn(spark, sf_dir):
    """Toxicity score of each document from a convolutional classifier."""
    return classify_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query()
def op6_near_duplicates(spark, sf_dir):
    """The near-duplicate class of each document, named by its smallest id."""
    return near_duplicate_classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "class_size")


@query(
    r"""
WITH cut AS (
    SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
    SELECT page_id, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
           translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host
    FROM cut
), rules (r_host, r_path, r_verdict) AS (
    VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), ruled AS (
    SELECT p.page_id, p.host, p.path,
           (SELECT max({'n': length(r_host || r_path), 'text': r_host || r_path, 'verdict': r_verdict}) FROM rules
            WHERE (p.host = r_host OR ends_with(p.host, '.' || r_host)) AND starts_with(p.path, r_path)) AS best
    FROM parts p
)
SELECT page_id, host, path, best.text AS rule, coalesce(best.verdict, 'allow') AS verdict FROM ruled
"""
)
def op7_url_rules(spark, sf_dir):
    """The longest block or allow rule that each page's URL falls under."""
    rules = spark.createDataFrame(DEFAULT_RULES, "host string, path string, verdict string")
    return judge_urls(table(spark, sf_dir, "pages"), rules)


@query()
def op8_best_fit_packing(spark, sf_dir):
    """Documents as token pieces, packed into as few sequences as local search finds."""
    return pack_documents(table(spark, sf_dir, "documents"), plain=False)


@query()
def op9_suffix_array_dedup(spark, sf_dir):
    """Bytes of each document inside 400-byte strings that occur again anywhere."""
    return remove_repeated_bytes(table(spark, sf_dir, "documents"))


@query()
def op10_block_anchor_dedup(spark, sf_dir):
    """Words of each document inside 13-word windows that a document with a smaller id also has."""
    return remove_repeated_words(table(spark, sf_dir, "documents"))


@query()
def op11_simhash_components(spark, sf_dir):
    """SimHash fingerprint of each document, and the smallest id of its component of linked fingerprints."""
    return simhash_components(table(spark, sf_dir, "documents"))


@query()
def op13_conversation_repair(spark, sf_dir):
    """Faults of each damaged conversation and its cheapest repair to alternating turns."""
    return repair_conversations(table(spark, sf_dir, "conversations"))


@query(
    r"""
WITH turns AS (
    SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos,
           coalesce(role, '') AS role, coalesce(text, '') AS text
    FROM conversations WHERE conv_id IS NOT NULL
), hashed AS (
    SELECT conv_id, conv_id - conv_id % 20 AS base, xor(list_reduce(list_concat([4294967295::BIGINT],
               list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
               lambda crc, byte: list_reduce(list_concat([xor(crc, byte)], range(8)),
                   lambda a, i: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384::BIGINT) ELSE a >> 1 END)),
               4294967295::BIGINT) % 4 AS h
    FROM (SELECT DISTINCT conv_id FROM turns)
), opened AS (
    SELECT t.conv_id, t.base, t.h, least(t.h, count(b.pos)) AS taken
    FROM hashed t LEFT JOIN turns b ON b.conv_id = t.base GROUP BY t.conv_id, t.base, t.h
), rebuilt AS (
    SELECT o.conv_id, b.pos, b.role, b.text FROM opened o JOIN turns b ON b.conv_id = o.base AND b.pos <= o.h
    UNION ALL
    SELECT o.conv_id, t.pos - o.h + o.taken, t.role, t.text FROM opened o JOIN turns t USING (conv_id) WHERE t.pos > o.h
), members AS (
    SELECT conv_id, pos AS depth, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words,
           string_agg(md5(length(role) || ':' || role || text), '') OVER (PARTITION BY conv_id ORDER BY pos) AS prefix
    FROM rebuilt
    UNION ALL
    SELECT conv_id, 0, 0, '' FROM opened
), marked AS (
    SELECT *, max(depth) OVER (PARTITION BY conv_id) = depth AS ends, min(conv_id) OVER (PARTITION BY prefix) AS least,
           count(*) OVER (PARTITION BY prefix) AS n
    FROM members
), children AS (
    SELECT left(prefix, length(prefix) - 32) AS prefix, count(DISTINCT prefix) AS n_children
    FROM members WHERE depth > 0 GROUP BY 1
), owned AS (
    SELECT m.*, coalesce(c.n_children, 0) AS n_children,
           sum(CASE WHEN m.conv_id = m.least THEN (m.n - 1) * m.words ELSE 0 END) OVER w AS saved,
           sum(CASE WHEN m.conv_id = m.least AND c.n_children IS NULL THEN 1 ELSE 0 END) OVER w AS leaves
    FROM marked m LEFT JOIN children c USING (prefix) WINDOW w AS (PARTITION BY m.conv_id ORDER BY m.depth DESC)
), nodes AS (
    SELECT prefix, depth, least, n, n_children, sum(leaves)::BIGINT AS n_leaves, sum(saved)::BIGINT AS saved_tokens,
           sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
    FROM owned GROUP BY prefix, depth, least, n, n_children
)
SELECT v.least AS conv_id, v.depth, p.least AS parent_conv_id, v.n AS n_convs, v.n_children, v.n_leaves, v.saved_tokens,
       v.ends_sha256
FROM nodes v LEFT JOIN nodes p ON v.depth > 0 AND p.prefix = left(v.prefix, length(v.prefix) - 32)
"""
)
def op12_conversation_trie(spark, sf_dir):
    """Nodes of the prefix trie of conversations with shared openings."""
    return conversation_trie(table(spark, sf_dir, "conversations"))
