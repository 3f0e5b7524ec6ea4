"""Reciprocal rank fusion of ranked lists."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import scores as sc
from millrace.operators.topk import ranked


def fuse(
    lists: list[DataFrame],
    keys: list[str],
    top_k: int | None = None,
    k: int = sc.RRF_K,
    digits: int | None = None,
) -> DataFrame:
    """Fuse lists of (query_id, *keys, rk) to (query_id, *keys, score, rk).

    Each list adds 1 / (k + rank) to the units it holds. Ties go to the unit met
    first: earlier lists come before later ones, then the better rank. With
    ``digits`` scores equal to that many decimals are ties.
    """
    numbered = [
        ranking.select("query_id", *keys, "rk").withColumn("list_no", F.lit(number))
        for number, ranking in enumerate(lists)
    ]
    score = F.sum(sc.reciprocal_rank(F.col("rk"), k))
    if digits is not None:
        score = F.round(score, digits)
    fused = (
        reduce(DataFrame.unionByName, numbered)
        .groupBy("query_id", *keys)
        .agg(
            score.alias("score"),
            # (list, rank) as one number: the first place the unit was met.
            F.min(F.col("list_no").cast("bigint") * 2**32 + F.col("rk")).alias("first_met"),
        )
    )
    depth = top_k if top_k is not None else 2**31 - 1
    order = [F.desc("score"), F.col("first_met")]
    return ranked(fused, ["query_id"], order, depth).drop("first_met")
