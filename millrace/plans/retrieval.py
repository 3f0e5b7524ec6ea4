"""From questions to prompts: two rankings, fused, reranked, and cited."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators import bm25, dense, fusion, prompts, rerank

KEYS = bm25.KEYS

# Depth of each list, and results kept by fusion and reranking.
LIST_DEPTH = 10
HYBRID_K = 3
CANDIDATES = 5
RERANKED_K = 3
ANSWER_K = 2


def hybrid_topk(
    index: bm25.Bm25Index,
    vectors: DataFrame,
    queries: DataFrame,
    top_k: int = HYBRID_K,
    depth: int = LIST_DEPTH,
    digits: int | None = None,
) -> DataFrame:
    """Fuse the nearest vectors with the best keyword matches.

    ``queries`` is (query_id, text, embedding). The dense list comes first, so it
    wins ties. With ``digits`` scores of either that are equal to that many
    decimals are ties.
    """
    nearest = dense.vector_topk(vectors, queries, KEYS, depth, digits)
    matches = bm25.keyword_topk(index, queries, depth, digits)
    return fusion.fuse([nearest, matches], KEYS, top_k)


def nearest_texts(
    vectors: DataFrame, queries: DataFrame, top_k: int = LIST_DEPTH, digits: int | None = None
) -> DataFrame:
    """The nearest vectors with their ids, texts and cosine distances.

    ``vectors`` is the vector table, with ``chunk_id`` and ``text``.
    """
    found = rerank.settled(dense.vector_topk(vectors, queries, KEYS, top_k, digits))
    distance = 1 - F.col("score")
    return rerank.with_text(found, vectors, KEYS).withColumn(
        "distance", distance if digits is None else F.round(distance, digits)
    )


def matching_texts(
    index: bm25.Bm25Index, queries: DataFrame, top_k: int = LIST_DEPTH, digits: int | None = None
) -> DataFrame:
    """The best keyword matches with their ids and texts."""
    found = rerank.settled(bm25.keyword_topk(index, queries, top_k, digits))
    return rerank.with_text(found, index.units, KEYS)


def reranked_topk(
    index: bm25.Bm25Index,
    vectors: DataFrame,
    queries: DataFrame,
    top_k: int = RERANKED_K,
    candidates: int = CANDIDATES,
    digits: int | None = None,
) -> DataFrame:
    """Hybrid candidates in the order of the built-in scorer, with their texts."""
    found = rerank.settled(hybrid_topk(index, vectors, queries, candidates, digits=digits))
    weights = bm25.query_weights(index, queries)
    return rerank.term_share(found, index.units, weights, KEYS, top_k, digits)


def answer_prompts(
    index: bm25.Bm25Index,
    vectors: DataFrame,
    queries: DataFrame,
    system: str,
    top_k: int = ANSWER_K,
    digits: int | None = None,
) -> DataFrame:
    """One prompt per query, with the best chunks as cited context.

    ``system`` tells the model how to use it.
    """
    best = reranked_topk(index, vectors, queries, top_k, digits=digits)
    return prompts.prompts(prompts.context_blocks(best), queries, system)
