"""URL filters by a sort-merge range join, in DataFrame functions only.

A host with its labels reversed is a canonical key: all subdomains of a rule's host, and all paths below a rule's path,
are one interval of keys that starts at the rule itself. Rules and URLs are dealt to the same partitions, sorted by key,
and swept once for each number of host labels that rules have. During a sweep a stack is kept with one slot for each
length of rule path: the last rule seen of that length. In sorted order a rule that contains a URL is always the last
one of its length, so after a check that its interval is still open the longest active rule is read off the stack.

The URLs are dealt by a hash of the whole URL and key, never by host, so that no common host makes a hot partition; the
rules go to each of the ``parts`` partitions. Rows never multiply and nothing is joined.

Cases: a null URL or one without ``://`` has an empty host and path and fits no rule; rules with a null or empty host
are left out, a null path is empty; of two equal rules ``block`` wins; repeated URLs are judged each on its own; an
empty rule table leaves every URL to the default verdict.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerflow.llm.text import pick

#: (host, path, verdict)
DEFAULT_RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)


def url_parts(url: Column) -> tuple[Column, Column]:
    """The host, with A-Z in lower case, and the path."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), string.ascii_uppercase, string.ascii_lowercase)
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def _reversed(labels: Column) -> Column:
    return F.concat_ws(".", F.reverse(labels))


def judge_urls(
    pages: DataFrame,
    rules: DataFrame,
    keep: tuple[str, ...] = ("page_id",),
    url: str = "url",
    default: str = "allow",
    parts: int | None = None,
) -> DataFrame:
    """For each URL its ``keep`` columns, host, path, the longest rule that fits (or null) and the verdict."""
    spark = pages.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    own = [f"k{i}" for i in range(len(keep))]
    host, path = url_parts(F.col("url"))
    urls = (
        pick(pages, *keep, url)
        .toDF(*own, "url")
        .select(*own, host.alias("host"), path.alias("path"), F.pmod(F.xxhash64("url", *own), F.lit(parts)).alias("part"))
        .withColumn("labels", F.split("host", "\\."))
        .withColumn("rule", F.lit(None).cast("struct<key:string,path:string,text:string,verdict:string,labels:int,size:int>"))
    )
    listed = (
        pick(rules, "host", "path", "verdict")
        .where("host <> ''")
        .select(
            F.translate("host", string.ascii_uppercase, string.ascii_lowercase).alias("host"),
            F.coalesce("path", F.lit("")).alias("path"),
            "verdict",
        )
        .groupBy("host", "path")
        .agg(F.max("verdict").alias("verdict"))
        .withColumn("labels", F.split("host", "\\."))
        .withColumn(
            "rule",
            F.struct(
                _reversed(F.col("labels")).alias("key"),
                F.col("path"),
                F.concat("host", "path").alias("text"),
                F.col("verdict"),
                F.size("labels").alias("labels"),
                F.length("path").alias("size"),
            ),
        )
    )
    # the shape of the stack: at most 127 numbers of labels, and the lengths of rule paths under each
    shape: dict[int, list[int]] = {}
    for row in listed.select("rule.labels", "rule.size").distinct().orderBy("labels", "size").collect():
        shape.setdefault(row["labels"], []).append(row["size"])
    events = listed.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))).select(
        *[F.lit(None).cast(urls.schema[c].dataType).alias(c) for c in own], "host", "path", F.col("part").cast("long"), "labels", "rule"
    )
    swept = urls.unionByName(events)
    seen = F.col("rule").isNotNull()
    active: list[Column] = []
    for labels, lengths in shape.items():
        # the key at this number of labels: that part of the host, if it has as many
        swept = swept.withColumn(
            f"key{labels}",
            F.when(F.size("labels") >= labels, _reversed(F.slice("labels", F.lit(-labels), F.lit(labels)))),
        )
        order = W.partitionBy("part").orderBy(f"key{labels}", "path", F.when(seen, 0).otherwise(1))
        sweep = order.rowsBetween(W.unboundedPreceding, W.currentRow)
        for length in lengths:
            slot = f"slot{labels}_{length}"
            opened = F.when((F.col("rule.labels") == labels) & (F.col("rule.size") == length), F.col("rule"))
            swept = swept.withColumn(slot, F.last(opened, ignorenulls=True).over(sweep))
            still = (F.col(f"{slot}.key") == F.col(f"key{labels}")) & F.col("path").startswith(F.col(f"{slot}.path"))
            active.append(
                F.when(still, F.struct(F.length(f"{slot}.text").alias("n"), F.col(f"{slot}.text"), F.col(f"{slot}.verdict")))
            )
    none = F.lit(None).cast("struct<n:int,text:string,verdict:string>")
    best = F.array_max(F.array(*active, none))
    judged = swept.where(~seen).withColumn("best", best)
    return judged.select(
        *[F.col(o).alias(k) for o, k in zip(own, keep, strict=True)],
        "host",
        "path",
        F.col("best.text").alias("rule"),
        F.coalesce(F.col("best.verdict"), F.lit(default)).alias("verdict"),
    )
