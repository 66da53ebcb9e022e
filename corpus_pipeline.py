"""From raw documents to packed token sequences: five stages, each over all that the one before kept.

Every stage but the last returns the columns of documents. Each result is stored in the shared folder before the next
stage reads it, so a lost executor costs one stage at most.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm import decontam, jaccard, packing, queries, secrets, toxicity
from tallyhouse.llm.common import ids_of, settings, stored, table

#: A batch of rows on its way to Python has so many bytes at most, but for a row that is longer alone: 10,000 whole texts
#: have no bound of their own.
BATCHES = {"spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20)}

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def bounded(stage: Stage) -> Stage:
    """The stage with bounded batches in all that it stores on its way to its result."""

    @wraps(stage)
    def run_bounded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        with settings(spark, BATCHES):
            return stage(spark, docs, sf_dir)

    return run_bounded


@bounded
def clean_of_toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents whose score reaches the threshold of their language; null texts score as empty ones."""
    rows, _, rejected = toxicity.judged(docs, queries.toxicity_labels(spark, sf_dir), whole=True)
    return rows.where(~rejected).select(*docs.columns)


@bounded
def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the least id of each group of near copies, and of rows with the same id and text one; documents
    without words or without an id stay. An id goes if none of its texts is the first of a group."""
    classes = stored(jaccard.join(docs))
    gone = ids_of(classes.groupBy("doc_id").agg(F.max(F.col("doc_id") == F.col("class_id")).alias("stays")).where("not stays").select("doc_id"))
    twice = ids_of(classes.groupBy("doc_id").count().where("count > 1").select("doc_id"))
    rest = docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
    once = rest.join(twice, "doc_id", "left_anti").select(*docs.columns)
    return once.unionByName(rest.join(twice, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"]).select(*docs.columns))


@bounded
def clean_of_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that contain a benchmark item."""
    found = ids_of(decontam.contained(docs, table(spark, sf_dir, "benchmark")).select("doc_id").distinct())
    return docs.join(found, "doc_id", "left_anti").select(*docs.columns)


@bounded
def clean_of_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret replaced by a mark and n_chars adjusted."""
    return secrets.redact(docs)


@bounded
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", clean_of_toxicity),
    ("ngram_jaccard_join", one_of_each_group),
    ("benchmark_decontamination", clean_of_benchmarks),
    ("secret_scan", clean_of_secrets),
    ("best_fit_packing", packed),
]

#: No SQL: the first stage is a trained model, the last one runs a tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    with settings(spark, BATCHES):
        for _, stage in STAGES:
            docs = stored(stage(spark, docs, sf_dir))
    return docs
