import random

from pyspark.sql import types as T

from ledgerflow.llm.url_rules import DEFAULT_RULES, judge_urls
from tests.llm.helpers import frame

PAGES = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType())])
RULES = T.StructType([T.StructField(c, T.StringType()) for c in ("host", "path", "verdict")])


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([i for i, c in enumerate(rest) if c in "/?#"] or [len(rest)])
    path = rest[end:]
    stop = min([i for i, c in enumerate(path) if c in "?#"] or [len(path)])
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end]), path[:stop]


def expected(pages, rules):
    merged = {}
    for host, path, verdict in rules:
        if host:
            key = ("".join(c.lower() if "A" <= c <= "Z" else c for c in host), path or "")
            merged[key] = max(filter(None, (verdict, merged.get(key))))
    out = []
    for page, url in pages:
        host, path = split(url)
        fits = [
            (len(h + p), h + p, v)
            for (h, p), v in merged.items()
            if (host == h or host.endswith("." + h)) and path.startswith(p)
        ]
        best = max(fits, default=(0, None, "allow"))
        out.append((page, host, path, best[1], best[2]))
    return sorted(out, key=repr)


def test_default_rules(spark):
    urls = ["http://a.net/x", "http://net/", "http://x.net", "https://www.Example.NET/en/1?q#f", "ftp://example.net/EN/",
            "http://example.com/de/", "http://m.example.com/de", "http://notexample.com/de/", "x://y.org/fr/1", "org/fr/",
            None, "", "http://", "http:///en/", "http://a.net?x/y", "http://ÄÖ.net/é", "http://a..net/", "http://net./",
            "http://a\nb.net/x\ny"]
    pages = [*enumerate(urls), (1, urls[1]), (None, urls[0])]
    found = judge_urls(frame(spark, pages, PAGES).selectExpr("*", "1 AS URL", "2 AS host"), frame(spark, DEFAULT_RULES, RULES))
    assert found.columns == ["page_id", "host", "path", "rule", "verdict"]
    assert sorted((tuple(r) for r in found.collect()), key=repr) == expected(pages, DEFAULT_RULES)


def test_random_nested_rules(spark):
    rng = random.Random(4)
    host = lambda n: ".".join(rng.choice("ab-") + rng.choice(["", "c"]) for _ in range(n))
    path = lambda n: "".join("/" + rng.choice(["", "e", "en", "ent", "é"]) for _ in range(n))
    rules = [(host(rng.randrange(1, 4)), path(rng.randrange(0, 4)), rng.choice(["allow", "block"])) for _ in range(80)]
    rules += [(None, "/", "block"), ("", "/", "block"), ("a", None, "block"), rules[0]]
    pages = [(i, f"http://{host(rng.randrange(1, 6))}{path(rng.randrange(0, 6))}") for i in range(400)]
    for parts in (1, 3):
        found = judge_urls(frame(spark, pages, PAGES), frame(spark, rules, RULES), parts=parts)
        assert sorted((tuple(r) for r in found.collect()), key=repr) == expected(pages, rules)


def test_empty_tables(spark):
    rules = frame(spark, DEFAULT_RULES, RULES)
    assert judge_urls(frame(spark, [], PAGES), rules).collect() == []
    pages = [(1, "http://a.net/")]
    assert [r.verdict for r in judge_urls(frame(spark, pages, PAGES), frame(spark, [], RULES)).collect()] == ["allow"]
