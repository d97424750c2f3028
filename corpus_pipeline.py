"""From raw documents to packed training sequences: each stage keeps or changes documents, the last packs them.

Defined results: rows with a null or empty text pass the first four stages (nothing is known against them) and become the end id
alone. Repeated rows are judged each for itself, except that near copies keep one row of their group. Of equal near copies the
smallest id stays. Other columns, whatever their names, are handed on unchanged; packing returns its own. An empty table gives no rows.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from granero.llm import decontamination, linededup, nearcopies, packing, quality
from granero.llm.queries import table, trusted_ids
from granero.llm.shipping import shipped
from granero.llm.tokens import vocabulary_path
from granero.session import shared_folder, track

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# Bytes of an Arrow batch. An executor and its Python workers each hold several of every running task.
BATCH_BYTES = "4MB"


def stage(build: Stage) -> Stage:
    """A stage whose rows travel between Spark and Python in small batches, however long the texts are."""

    @functools.wraps(build)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
        return build(spark, docs, sf_dir)

    return shipped(run)


@stage
def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity lies above their language's threshold go."""
    return quality.drop_rejected(docs, trusted_ids(spark, sf_dir))


@stage
def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in at least ten documents go; a document that loses all its lines stays with an empty text."""
    return linededup.cut_documents(docs, min_docs=10)


@stage
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays whose sets of five-word shingles are linked by a similarity of 0.8."""
    return nearcopies.keep_one(docs, shingle=5, percent=80)


@stage
def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark, also an edited one, go."""
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


@stage
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every token of every remaining document in sequences of 2048, with the pieces' ids."""
    return packing.pack(docs, vocabulary_path(), capacity=2048)


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontaminate),
    ("packing", pack),
]

# Language-model scores, signatures and tokenizers have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, each result written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, apply in STAGES:
        path = f"{shared_folder(spark)}/granero-{name}-{uuid.uuid4().hex}"
        apply(spark, docs, sf_dir).write.parquet(path)
        track(spark, path)
        docs = spark.read.parquet(path)
    return docs
