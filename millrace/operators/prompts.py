"""Cited context and prompts from ranked texts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def context_blocks(ranked_texts: DataFrame) -> DataFrame:
    """(query_id, rk, chunk_id, text) to one labelled context per query.

    The groups hold the few rows a reranker kept, never a whole corpus.
    """
    block = F.concat(F.lit("[Source: "), F.col("chunk_id"), F.lit("]\n"), F.col("text"))
    blocks = F.array_sort(F.collect_list(F.struct("rk", block.alias("block"))))
    return ranked_texts.groupBy("query_id").agg(
        F.array_join(F.transform(blocks, lambda b: b["block"]), "\n\n").alias("context")
    )


def prompts(context: DataFrame, queries: DataFrame, system: str) -> DataFrame:
    """One row per query that has a context: (query_id, system_prompt, user_prompt)."""
    return context.join(queries.select("query_id", "text"), "query_id").select(
        "query_id",
        F.lit(system).alias("system_prompt"),
        F.concat(
            F.lit("Context:\n"), "context", F.lit("\n\nQuestion: "), F.col("text")
        ).alias("user_prompt"),
    )
