"""Small frames with awkward rows, shared by the tests of the corpus operators."""

from __future__ import annotations

import random

from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])


def frame(spark, rows, schema=DOCS):
    return spark.createDataFrame([tuple(r) for r in rows], schema)


def prose(seed: int, n: int, vocabulary: int = 400) -> str:
    chooser = random.Random(seed)
    return " ".join(f"w{chooser.randrange(vocabulary)}" for _ in range(n))


def clashing(df):
    """The frame with more columns whose names differ in case only, or not at all."""
    return df.selectExpr("*", "1 AS TEXT", "2 AS Doc_Id", "'x' AS kept", "'y' AS n_words", "3 AS hits", "4 AS items")
