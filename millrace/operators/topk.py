"""Best rows per query without ever holding all (query, row) pairs.

Scoring every unit for every query makes queries x units scores. They are made
block by block inside a task and only those that can still reach the best k are
handed on, so what is written, shuffled and sorted is about k rows per query
and task. Spark does the rest: it splits the units, prunes each task's rows to
k per query before the shuffle and picks the final k after it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.sources import files

# Queries scored at a time against one batch of units, to bound the score block.
QUERY_BLOCK = 256


def ranked(df: DataFrame, by: list[str], order: list[Column], k: int) -> DataFrame:
    """The first k rows of each group with their rank ``rk`` from 1.

    Spark turns the rank filter into a group limit on both sides of the shuffle,
    so a group never arrives whole in one task.
    """
    window = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("rk", F.row_number().over(window)).where(F.col("rk") <= k)


def unit_order(keys: list[str]) -> list[Column]:
    """Best score first, ties in the order of the unit keys."""
    return [F.desc("score"), *[F.col(c) for c in keys]]


class RunningBest:
    """Which scores of a task's batches can still be among the best k of a query."""

    def __init__(self, n_queries: int, k: int):
        self.k = k
        self._best = np.full((n_queries, k), -np.inf)

    def keep(self, queries: np.ndarray, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places (row, unit) in ``scores`` that are worth handing on.

        ``scores`` has a row for each of the query numbers and a column per
        unit. Units must be in key order: of those tied at the k-th place only
        the first ones are kept.
        """
        n_units = scores.shape[1]
        best = self._best[queries]
        floor = best.min(axis=1, keepdims=True)
        if n_units > self.k:
            cut = n_units - self.k
            top = np.partition(scores, cut, axis=1)[:, cut:]
            kth = top[:, :1]
            above, tied = scores > kth, scores == kth
            room = self.k - above.sum(axis=1, keepdims=True)
            kept = above | (tied & (np.cumsum(tied, axis=1) <= room))
        else:
            top, kept = scores, np.ones(scores.shape, dtype=bool)
        merged = np.concatenate([best, top], axis=1)
        self._best[queries] = np.partition(merged, -self.k, axis=1)[:, -self.k :]
        # Equal to the floor may still win on key order.
        return np.nonzero(kept & (scores >= floor))


def blocks(queries: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """Query numbers in blocks, to bound the score block of one batch."""
    for first in range(0, len(queries), size):
        yield queries[first : first + size]


def query_passes(
    entries: DataFrame, query: str, max_entries: int, per_query: int = 0
) -> Iterator[DataFrame]:
    """Split a query side into parts small enough to send to every task.

    The size is measured; each query counts for ``per_query`` entries more, as for the
    best scores that a task keeps of it. Parts are made by a hash of the query, so a query is
    never divided. One pass over the units is made per part.
    """
    total = entries.count()
    if total == 0:
        return
    if per_query:
        total += per_query * entries.select(query).distinct().count()
    parts = -(-total // max_entries)
    if parts == 1:
        yield entries
        return
    for part in range(parts):
        yield entries.where(F.pmod(F.xxhash64(F.col(query)), F.lit(parts)) == part)


def in_passes(
    entries: DataFrame,
    query: str,
    max_entries: int,
    per_query: int,
    score: Callable[[pa.Table], tuple[DataFrame, Broadcast]],
    best: Callable[[DataFrame], DataFrame],
    schema: StructType,
) -> DataFrame:
    """The best rows of all queries, from one pass over the units per part of them.

    ``entries`` should be a written table, as it is read once per pass; a part of it
    is what ``score`` sends to the tasks. A query is
    in one part only, so each pass's result is final. Of several passes each is
    run and written before the next, and its part of the queries is taken back
    from the tasks, so that one part is held at a time.
    """
    passes = list(query_passes(entries, query, max_entries, per_query))
    if not passes:
        return best(entries.sparkSession.createDataFrame([], schema))
    if len(passes) == 1:
        return best(score(passes[0].toArrow())[0])
    written = []
    for part in passes:
        held = part.toArrow()
        if not held.num_rows:
            continue  # the hash left this part without a query
        scored, shared = score(held)
        written.append(files.materialize(best(scored), "pass"))
        shared.destroy()
    return reduce(DataFrame.unionByName, written)
