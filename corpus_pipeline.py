"""Training-data pipeline over ``documents``: each stage works on all that its predecessor kept.

``STAGES`` lists the stages by name; each takes ``(spark, docs, sf_dir)`` and
returns a DataFrame. :func:`run` writes what a stage returns as Parquet into
the folder that ``spark.checkpoint.dir`` names, which cuts the lineage, and
reads it again for the next one. An empty table or stage gives an empty result
with the same columns; for nulls, ties, repeated rows and other columns see the
operators.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from veracity.llm import mixing, neardup, packing, quality, secretscan
from veracity.llm.base import bounded_batches, read
from veracity.session import ensure_checkpoint_dir


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose rules together speak for quality."""
    bounded_batches(spark)
    return quality.quality_filter(docs)


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the least id, of each group of near-duplicates (five-word shingles, 0.8)."""
    bounded_batches(spark)
    return neardup.deduplicated(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mark."""
    bounded_batches(spark)
    return secretscan.redacted(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture takes them."""
    return mixing.mixed_documents(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their place in the packed sequences."""
    bounded_batches(spark)
    return packing.pack(packing.pieces(docs))


STAGES = [
    ("quality_rules", quality_rules),
    ("minhash_near_dedup", minhash_near_dedup),
    ("secret_scan", secret_scan),
    ("source_mixing", source_mixing),
    ("best_fit_packing", best_fit_packing),
]

#: The stages tokenise, fit and verify in ways that SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over ``documents``."""
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = read(spark, sf_dir, "documents")
    for n, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{n}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
