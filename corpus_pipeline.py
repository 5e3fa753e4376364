"""From raw documents to packed training sequences: five stages, each written out before the next reads it."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontam, frames, jaccard, packing, quality, secret_scan

#: Bytes of rows that Spark hands to a Python worker at once. Batches of whole texts lie in memory on both sides.
BATCH_BYTES = "4m"


def in_small_batches(stage: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """A stage whose Python steps, planned when it is written out, get batches of ``BATCH_BYTES``."""

    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
        return stage(spark, docs, sf_dir)

    return run_stage


@in_small_batches
def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps.

    It judges text, source and language, so rows that share a doc_id, or have none, are judged each by their own.
    """
    judged = quality.classify(docs, frames.table(spark, sf_dir, "labels"))
    site = {"host": F.coalesce("source", F.lit("")), "path": F.coalesce("lang", F.lit(""))}
    return frames.without(docs, judged.filter(~F.col("kept")), {"copy": F.xxhash64("text"), **site})


@in_small_batches
def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, of smallest doc_id, of each group of near duplicates.

    Classes are of texts: rows that share a doc_id with different texts are different documents, and rows
    without doc_id come after those that have one. Of rows equal in doc_id and text one stays.
    """
    copy = F.xxhash64("text")
    classes = jaccard.similarity_classes(docs.select(copy.alias("doc_id"), "text"))
    classes = classes.select(F.col("doc_id").alias("copy"), "class_id").distinct()
    slim = docs.select("doc_id", copy.alias("copy"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "copy")).alias("keep")
    kept = slim.join(classes, "copy").groupBy("class_id").agg(first).select("keep.doc_id", "keep.copy")
    rows = slim.groupBy("doc_id", "copy").agg(F.count("*").alias("rows"))
    same = F.col("k.doc_id").eqNullSafe(F.col("r.doc_id")) & (F.col("k.copy") == F.col("r.copy"))
    names = {k: frames.free(docs, f"kept_{k}") for k in ("doc_id", "copy", "rows")}
    kept = kept.alias("k").join(rows.alias("r"), same).select(
        F.col("k.doc_id").alias(names["doc_id"]), F.col("k.copy").alias(names["copy"]), F.col("rows").alias(names["rows"])
    )
    kept = frames.stored(kept, "kept-documents")
    stays = F.col("doc_id").eqNullSafe(F.col(names["doc_id"])) & (copy == F.col(names["copy"]))
    single = docs.join(kept.filter(F.col(names["rows"]) == 1), stays, "left_semi")
    repeated = docs.join(kept.filter(F.col(names["rows"]) > 1), stays, "left_semi")
    return single.unionByName(repeated.dropDuplicates(["doc_id", "text"]))


@in_small_batches
def clean_of_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage; each text is judged for itself, whatever its doc_id."""
    texts = docs.select(F.xxhash64("text").alias("doc_id"), "text")
    found = decontam.contaminated(texts, frames.table(spark, sf_dir, "benchmark"))
    return frames.without(docs, found.select(F.col("doc_id").alias("copy")), {"copy": F.xxhash64("text")})


@in_small_batches
def clean_of_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by a placeholder and ``n_chars`` counted again."""
    clean = secret_scan.without_secrets(docs)
    if "n_chars" not in docs.columns:
        return clean
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


@in_small_batches
def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per token piece with its sequence and place."""
    return packing.pack(docs)


STAGES = [
    ("quality classifier", good_documents),
    ("n-gram Jaccard join", distinct_documents),
    ("benchmark decontamination", clean_of_benchmarks),
    ("secret scans", clean_of_secrets),
    ("best-fit packing", packed_sequences),
]

# The classifier and the tokenizer are beyond SQL; the tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = frames.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = frames.stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
