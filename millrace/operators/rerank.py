"""Second-stage ranking of a few candidates per query."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import text as tx
from millrace.operators.topk import ranked
from millrace.sources import files

Scorer = Callable[[Column, Column], Column]


# Candidates of up to this many measured bytes are sent to every task.
MAX_CANDIDATE_BYTES = 32 << 20


def settled(candidates: DataFrame) -> DataFrame:
    """Write the candidates, so that the search runs once and their size is known.

    The planner takes what comes out of a search for as large as the corpus it
    went through, and would shuffle all units to look up a few of them.
    """
    stored = files.materialize(candidates, "candidates")
    small = files.measured_bytes(stored)[1] <= MAX_CANDIDATE_BYTES
    return F.broadcast(stored) if small else stored


def with_text(candidates: DataFrame, units: DataFrame, keys: list[str]) -> DataFrame:
    """Look up the candidates' ids and texts; nothing else of the units is read."""
    return candidates.join(units.select(*keys, "chunk_id", "text"), keys, "inner")


def missing_units(candidates: DataFrame, units: DataFrame, keys: list[str]) -> DataFrame:
    """Candidates for which no text exists; should be empty.

    The side that an anti join keeps cannot be sent to the tasks, so the units are
    first cut down to those asked for, where they lie.
    """
    asked = units.select(*keys).join(candidates.select(*keys), keys, "left_semi")
    return candidates.join(asked, keys, "left_anti")


def rerank(
    candidates: DataFrame,
    units: DataFrame,
    queries: DataFrame,
    keys: list[str],
    scorer: Scorer,
    top_k: int,
) -> DataFrame:
    """Order candidates by ``scorer(query_text, unit_text)`` and keep the best.

    The scorer returns a column: a built-in expression, or a pandas UDF that
    wraps a model. Ties keep the candidates' order.
    """
    asked = queries.select("query_id", F.col("text").alias("query_text"))
    scored = (
        with_text(candidates.withColumnRenamed("rk", "candidate_rk").drop("score"), units, keys)
        .join(asked, "query_id")
        .withColumn("score", scorer(F.col("query_text"), F.col("text")))
    )
    return ranked(scored, ["query_id"], [F.desc("score"), F.col("candidate_rk")], top_k)


def term_share(
    candidates: DataFrame,
    units: DataFrame,
    weights: DataFrame,
    keys: list[str],
    top_k: int,
    digits: int | None = None,
) -> DataFrame:
    """The built-in scorer: weighted share of the query's words found in the unit.

    ``weights`` is (query_id, term, weight). They are put back into one row per
    query, which is no larger than the query text they were taken from.
    """
    asked = (
        weights.where(F.col("weight").isNotNull())
        .groupBy("query_id")
        .agg(F.sort_array(F.collect_list(F.struct("term", "weight"))).alias("asked"))
    )

    def total(terms):
        return F.aggregate(terms, F.lit(0.0), lambda acc, t: acc + t["weight"])

    def share(words):
        hit = F.filter("asked", lambda t: F.array_contains(words, t["term"]))
        return F.try_divide(total(hit), total(F.col("asked")))

    # As a lambda's argument the words are taken from the text once, and not
    # again for every word asked for.
    once = F.transform(F.array(tx.words(F.col("text"))), share)[0]
    score = F.coalesce(once, F.lit(0.0))
    scored = (
        with_text(candidates.withColumnRenamed("rk", "candidate_rk").drop("score"), units, keys)
        .join(asked, "query_id", "left")
        .withColumn("score", score if digits is None else F.round(score, digits))
        .drop("asked")
    )
    return ranked(scored, ["query_id"], [F.desc("score"), F.col("candidate_rk")], top_k)
