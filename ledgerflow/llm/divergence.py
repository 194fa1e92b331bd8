"""Quality rules by distribution divergence, in DataFrame functions only.

Every document becomes two histograms: of character classes, and of the common words of the known languages. The same
histograms summed over all documents of a language are that language's reference. A document is compared with each
reference by Jensen-Shannon distance and belongs to the nearest; it is kept if it lies within limits that tighten with
its length. Documents below a minimum length are not judged by distances, which mean little there.

The texts are read once; what is compared afterwards is the stored table of histograms, and what reaches the driver is
one row for each known language.

Cases: a null text is the empty text; documents without words have zero histograms; a language outside ``COMMON_WORDS``
(or null) adds to no reference, its documents are compared with the known ones; without any reference nothing is
rejected beyond the base rules; repeated documents are judged each on its own.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.storage import stored
from ledgerflow.llm.text import pick

#: The common words whose frequencies tell prose of a language from something else.
COMMON_WORDS = {
    "en": "the of and to in a is that for it as was with be by on".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im dem".split(),
    "fr": "de la le et les des en un du une que est pour qui dans au".split(),
    "es": "de la que el en y a los se del las un por con no una".split(),
}
#: A document is judged by distances from this many words and characters on.
MIN_WORDS, MIN_CHARS = 50, 200
#: Largest distances kept, for very long documents and per square root of the number of words.
WORD_LIMIT, CHAR_LIMIT = (0.26, 0.6), (0.17, 0.6)

_BLANKS = " \t\n\u000b\u000c\r"
_SYMBOLS = "#*$%&|<>"
_POINTS = ".,;:!?'\"()-"
_WORDS = sorted({w for words in COMMON_WORDS.values() for w in words})


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once; inside lambdas a plain column would be computed for each element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def _repeat_words(words: Column) -> Column:
    """Words inside three-word windows that occur at least twice in the same text."""

    def covered(places: Column) -> Column:
        reach = F.transform(places, lambda p, k: F.least(F.lit(3), F.coalesce(F.get(places, k + 1) - p, F.lit(3))))
        return F.aggregate(reach, F.lit(0).cast("long"), lambda total, x: total + x)

    def repeated(pairs: Column) -> Column:
        same = F.filter(
            pairs, lambda x, k: (F.get(pairs, k - 1)["h"] == x["h"]) | (F.get(pairs, k + 1)["h"] == x["h"])
        )
        return let(F.sort_array(F.transform(same, lambda x: x["i"])), covered)

    def windows(keys: Column) -> Column:
        pairs = F.transform(keys, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        return F.when(F.size(F.array_distinct(keys)) == F.size(keys), F.lit(0).cast("long")).otherwise(
            let(F.sort_array(pairs), repeated)
        )

    def keyed(w: Column) -> Column:
        places = F.slice(w, F.lit(1), F.greatest(F.size(w) - 2, F.lit(0)))
        keys = F.transform(places, lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))
        return let(keys, windows)

    return let(words, keyed)


def _word_counts(words: Column) -> Column:
    """How often each common word occurs, in their order; what is none of them is the last count."""

    def counts(found: Column) -> Column:
        # two blanks between words, so that the removal of one leaves the borders of its neighbours
        def of(line: Column) -> Column:
            each = [
                ((F.length(line) - F.length(F.replace(line, F.lit(f" {w} "), F.lit("")))) / (len(w) + 2)).cast("long")
                for w in _WORDS
            ]
            return F.array(*each)

        return let(F.concat(F.lit(" "), F.concat_ws("  ", found), F.lit(" ")), of)

    return let(F.filter(words, lambda w: w.isin(_WORDS)), counts)


def features(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """The base counts and both histograms of each document."""
    t = F.col("text")
    source = pick(docs, doc_id, text, lang).toDF("doc_id", "text", "lang").withColumn("text", F.coalesce(t, F.lit("")))
    words = F.filter(F.split(t, "[ \\t-\\r]+"), lambda w: w != "")
    lines = F.filter(F.split(t, "\n"), lambda line: _without(line, _BLANKS) != "")
    n_chars = F.length(t).cast("long")
    letters = n_chars - F.length(F.regexp_replace(t, "\\p{L}+", ""))
    capitals = n_chars - F.length(F.regexp_replace(t, "\\p{Lu}+", ""))
    digits = n_chars - F.length(F.regexp_replace(t, "\\p{N}+", ""))
    points = n_chars - F.length(_without(t, _POINTS))
    measured = source.select(
        "doc_id",
        "lang",
        n_chars.alias("n_chars"),
        F.length(_without(t, _BLANKS)).cast("long").alias("word_chars"),
        (n_chars - F.length(_without(t, _SYMBOLS))).alias("n_symbols"),
        letters.alias("letters"),
        capitals.alias("capitals"),
        digits.alias("digits"),
        points.alias("points"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        let(
            words,
            lambda w: F.struct(
                F.size(w).cast("long").alias("n_words"),
                _repeat_words(w).alias("n_repeat_words"),
                _word_counts(F.transform(w, lambda x: F.lower(x))).alias("common"),
            ),
        ).alias("w"),
    )
    blanks = F.col("n_chars") - F.col("word_chars")
    rest = F.col("n_chars") - F.col("letters") - F.col("digits") - F.col("points") - blanks
    others = F.col("w.n_words") - F.aggregate("w.common", F.lit(0).cast("long"), lambda total, x: total + x)
    classes = [F.col("letters") - F.col("capitals"), F.col("capitals"), F.col("digits"), F.col("points"), blanks, rest]
    return measured.select(
        "doc_id",
        "lang",
        "n_chars",
        "w.n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "w.n_repeat_words",
        F.concat("w.common", F.array(others)).alias("word_counts"),
        F.array(*[c.cast("long") for c in classes]).alias("char_counts"),
    )


def references(measured: DataFrame) -> dict[str, tuple[list[float], list[float]]]:
    """The word and character histograms of each known language, over all its documents, as shares."""
    sizes = {"word_counts": len(_WORDS) + 1, "char_counts": 6}
    sums = [F.sum(F.get(F.col(c), F.lit(i))).alias(f"{c}_{i}") for c, n in sizes.items() for i in range(n)]
    rows = measured.where(F.col("lang").isin(list(COMMON_WORDS))).groupBy("lang").agg(*sums).collect()
    found = {}
    for row in rows:
        histograms = []
        for c, n in sizes.items():
            counts = [row[f"{c}_{i}"] or 0 for i in range(n)]
            histograms.append([x / max(1, sum(counts)) for x in counts])
        if all(map(sum, histograms)):
            found[row["lang"]] = (histograms[0], histograms[1])
    return found


def jensen_shannon(counts: Column, reference: list[float]) -> Column:
    """The distance between a histogram of counts and a reference of shares: 0 for equal ones, 1 for disjoint ones."""

    def term(p: Column, q: Column) -> Column:
        return F.when(p > 0, p * F.log2(2 * p / (p + q))).otherwise(F.lit(0.0))

    def distance(total: Column) -> Column:
        def part(n: Column, q: Column) -> Column:
            return (term(n / total, q) + term(q, n / total)) / 2

        parts = F.zip_with(counts, F.array(*map(F.lit, reference)), part)
        return F.sqrt(F.greatest(F.lit(0.0), F.aggregate(parts, F.lit(0.0), lambda a, b: a + b)))

    total = F.aggregate(counts, F.lit(0).cast("long"), lambda a, b: a + b).cast("double")
    return let(F.greatest(total, F.lit(1.0)), distance)


def _from(lang: str, word_shares: list[float], char_shares: list[float]) -> Column:
    """The distances of both histograms from one language, their sum first."""
    return let(
        F.struct(
            jensen_shannon(F.col("word_counts"), word_shares).alias("w"),
            jensen_shannon(F.col("char_counts"), char_shares).alias("c"),
        ),
        lambda d: F.struct((d["w"] + d["c"]).alias("sum"), F.lit(lang).alias("lang"), d["w"].alias("w"), d["c"].alias("c")),
    )


def quality_rules(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Base counts and verdicts of every document, with its nearest language and its distances from that."""
    measured = stored(features(docs, doc_id, text, lang), "divergence")
    known = references(measured)
    if known:
        near = F.array_min(F.array(*[_from(name, *histograms) for name, histograms in sorted(known.items())]))
    else:
        nothing = F.lit(None).cast("double")
        near = F.struct(nothing.alias("sum"), F.lit(None).cast("string").alias("lang"), nothing.alias("w"), nothing.alias("c"))
    # at least 1: the optimizer may lift the division out of the condition that guards it
    root = F.sqrt(F.greatest(F.col("n_words"), F.lit(1)))
    judged = (F.col("n_words") >= MIN_WORDS) & (F.col("n_chars") >= MIN_CHARS)
    within = (F.col("near.w") <= WORD_LIMIT[0] + WORD_LIMIT[1] / root) & (
        F.col("near.c") <= CHAR_LIMIT[0] + CHAR_LIMIT[1] / root
    )
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return measured.withColumn("near", near).select(
        F.col("doc_id").alias(doc_id),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & F.coalesce(~judged | within, F.lit(True))).alias("kept"),
        F.col("near.lang").alias("nearest_lang"),
        F.col("near.w").alias("word_distance"),
        F.col("near.c").alias("char_distance"),
    )
