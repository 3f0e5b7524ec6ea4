"""Five stages from raw documents to packed sequences.

Each stage takes the documents that the one before kept, as written, and its decisions
take effect: rejected documents go, repeated lines go (and documents that lose all of
their words by that), one document of each class of near duplicates stays, secrets are
replaced by a mark, and what is left is packed.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import bayes, line_dedup, order_minhash, packing, secrets, tokens
from millrace.llm.common import fresh, table
from millrace.llm.queries import WORD_VOCABULARY
from millrace.sources import files


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier keeps, learnt from the labels beside the documents."""
    return bayes.keep_good(docs, table(spark, sf_dir, "labels"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated lines; those of which only repeats are left go."""
    n_lines, n_removed = fresh(docs, "n_lines", "n_removed")
    out = line_dedup.dedup_lines(docs)
    emptied = (F.col(n_removed) > 0) & (F.col(n_removed) == F.col(n_lines))
    return _recounted(out.where(~emptied).select(docs.columns))


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return order_minhash.keep_one(docs)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a mark in place of each secret."""
    owned, (repository,) = docs, fresh(docs, "repository")
    owned = docs.withColumn(repository, F.struct("source", "lang").cast("string"))
    return _recounted(secrets.redact(owned, repository=repository, owner="source").select(docs.columns))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in sequences."""
    vocabulary = tokens.read_vocabulary(public_tokenizers.path(WORD_VOCABULARY))
    return packing.pack_documents(docs, vocabulary)


def _recounted(docs: DataFrame) -> DataFrame:
    """``n_chars`` again the length of the text, which a stage may have changed."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality_stage),
    ("line_dedup", line_stage),
    ("order_minhash", near_stage),
    ("secret_scans", secret_stage),
    ("best_fit_packing", packing_stage),
]

#: Tokens and hash-based candidates cannot be had in SQL; tests compare by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for n, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if n < len(STAGES) - 1:
            docs = files.materialize(docs, f"stage-{name}")
    return docs
