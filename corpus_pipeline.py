"""From raw documents to packed training sequences, in five stages that are each written and read again.

1. ``quality`` drops documents that the line classifier rejects;
2. ``near_duplicates`` keeps one document of each near-duplicate class;
3. ``decontamination`` drops documents with benchmark passages;
4. ``personal_data`` replaces personal data by its kind in angle brackets;
5. ``packing`` cuts and packs what is left into token sequences.

All but the last return the columns they got, whatever further columns there are, and work on every document that the
stage before kept. Cases: empty tables pass through; without usable labels the first stage keeps everything; null and
empty texts are judged as the empty text; repeated rows are one near-duplicate class, of which one row stays, but null
and empty texts are never duplicates.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerflow.llm import decontaminate, line_crf, near_dup, packing, pii
from ledgerflow.llm.storage import discard
from ledgerflow.llm.text import slices
from ledgerflow.session import scratch_path, scratch_scope

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _column(docs: DataFrame, name: str) -> int:
    """The place of a column: the exact name first, then in another case."""
    exact = [i for i, c in enumerate(docs.columns) if c == name]
    return (exact or [i for i, c in enumerate(docs.columns) if c.lower() == name])[0]


def _plain(docs: DataFrame) -> tuple[DataFrame, tuple[str, ...], str]:
    """The frame with columns c0, c1, ... so that no added column clashes; those names, and that of the text."""
    names = tuple(f"c{i}" for i in range(len(docs.columns)))
    return docs.toDF(*names), names, names[_column(docs, "text")]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = line_crf.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), ~line_crf.held_out())
    if not model.weights.any():
        return docs
    plain, names, text = _plain(docs)
    scored = line_crf.score_quality(plain, model, names, text)
    return scored.where(F.col("score") >= line_crf.GOOD).select(*names).toDF(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    classes = near_dup.near_duplicate_classes(docs)
    kept = (
        classes.where("keeps")
        .groupBy(F.col("doc_id").alias("kept_id"), F.col("node").alias("kept_node"))
        .agg(F.count("*").alias("rows"), F.max(F.col("class_root").isNull()).alias("wordless"))
    )
    plain, names, text = _plain(docs)
    own_id = F.col(names[_column(docs, "doc_id")])
    keyed = plain.withColumn("node", near_dup.node_key(text))
    found = keyed.join(kept, (F.col("node") == F.col("kept_node")) & own_id.eqNullSafe(F.col("kept_id")))
    single = found.where("rows = 1 OR wordless").select(*names)
    if not kept.where("rows > 1 AND NOT wordless").isEmpty():
        # of rows with one id and text the first by its other columns stays, so a rerun keeps the same one
        rest = F.to_json(F.struct(*[F.col(c) for c in names if c != text]))
        place = Window.partitionBy("same_id", "node").orderBy(rest)
        again = found.where("rows > 1 AND NOT wordless").withColumn("same_id", own_id)
        single = single.union(again.withColumn("place", F.row_number().over(place)).where("place = 1").select(*names))
    return single.toDF(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    plain, names, text = _plain(docs)
    found = decontaminate.find_contamination(plain, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), names, text)
    return found.where("NOT contaminated").select(*names).toDF(*docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    plain, names, text = _plain(docs)
    accepted = spark.sparkContext.broadcast(pii.accepted_patterns(plain, text))

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                at = part.schema.get_field_index(text)
                texts = [t if t is None else pii.redact(t, accepted.value) for t in part.column(at).to_pylist()]
                columns = [c if i != at else pa.array(texts, part.schema.field(at).type) for i, c in enumerate(part.columns)]
                yield pa.RecordBatch.from_arrays(columns, part.schema.names)

    cleaned = plain.mapInArrow(clean, plain.schema)
    lengths = [i for i, c in enumerate(docs.columns) if c.lower() == "n_chars"]
    for i in lengths:
        kind = plain.schema[names[i]].dataType
        cleaned = cleaned.withColumn(names[i], F.coalesce(F.length(text).cast(kind), F.col(names[i])))
    return cleaned.toDF(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, plain=False)


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("packing", packed),
]

#: Classifiers, sketches and tokens have no SQL form; the tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    written: list[DataFrame] = []
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}", keep=True)
        with scratch_scope(spark):  # what a stage stores on its way goes when its result is written
            stage(spark, docs, sf_dir).write.parquet(path)
        discard(*written)
        docs = spark.read.parquet(path)
        written = [docs]
    return docs
