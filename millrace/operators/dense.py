"""Nearest neighbours by cosine, many queries at once: exact, or within near cells."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import Normalizer
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from millrace.operators.embed import numbers
from millrace.operators.topk import (
    QUERY_BLOCK,
    RunningBest,
    blocks,
    in_passes,
    ranked,
    unit_order,
)
from millrace.sources import files

# Numbers in the query matrix sent to every task in one pass: 128 MB of doubles.
MAX_NUMBERS = 16_000_000


def _matrix(column, dims: int | None = None) -> np.ndarray:
    """Vectors of an Arrow column of lists, or packed ones, as unit rows; a zero vector stays zero."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes, values = numbers(column)
    lengths = pc.unique(pa.array(sizes)).to_pylist()
    dims = dims or lengths[0]
    if lengths != [dims]:
        raise ValueError(f"vectors have {lengths} numbers, not {dims}")
    rows = values.astype(np.float64).reshape(-1, dims)
    if not np.isfinite(rows).all():
        raise ValueError("vectors must hold finite numbers only")
    norm = np.sqrt((rows * rows).sum(axis=1, keepdims=True))
    return np.divide(rows, norm, out=np.zeros_like(rows), where=norm > 0)


def _score_pass(
    vectors: DataFrame,
    queries: pa.Table,
    keys: list[str],
    schema: StructType,
    k: int,
    digits: int | None,
    cells: CellTable | None,
    n_probe: int,
) -> tuple[DataFrame, Broadcast]:
    """Score the vectors against one part of the queries, which is sent to the tasks."""
    ids = queries["query_id"].combine_chunks()
    query_rows = _matrix(queries["embedding"])
    probed = None
    if cells is not None:
        # Which of the cells each query looks into: those with the nearest centers.
        nearest = np.argsort(-(query_rows @ cells.centers.T), axis=1, kind="stable")[:, :n_probe]
        probed = np.zeros((len(ids), len(cells.centers)), dtype=bool)
        np.put_along_axis(probed, nearest, True, axis=1)
        wanted = [int(c) for c in np.nonzero(probed.any(axis=0))[0]]
        vectors = vectors.where(F.col("cell").isin(wanted))
    shared = vectors.sparkSession.sparkContext.broadcast((ids, query_rows, probed))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, query_rows, probed = shared.value
        best = RunningBest(len(ids), k)
        everything = np.arange(len(ids))
        for batch in batches:
            if batch.num_rows == 0:
                continue
            batch = batch.sort_by([(c, "ascending") for c in keys])
            units = _matrix(batch.column("embedding"), query_rows.shape[1])
            if probed is None:
                groups = [(everything, np.arange(len(units)))]
            else:
                cell = batch.column("cell").to_numpy(zero_copy_only=False)
                groups = [
                    (np.nonzero(probed[:, c])[0], np.nonzero(cell == c)[0]) for c in np.unique(cell)
                ]
            for asking, members in groups:
                for block in blocks(asking, QUERY_BLOCK):
                    scores = query_rows[block] @ units[members].T
                    if digits is not None:
                        scores = np.round(scores, digits)
                    query, unit = best.keep(block, scores)
                    row = pa.array(members[unit])
                    yield pa.RecordBatch.from_arrays(
                        [
                            ids.take(pa.array(block[query])),
                            *[batch.column(c).take(row) for c in keys],
                            pa.array(scores[query, unit]),
                        ],
                        names=["query_id", *keys, "score"],
                    )

    used = [*keys, "embedding"] if cells is None else [*keys, "embedding", "cell"]
    return vectors.select(*used).mapInArrow(score, schema), shared


def _search(
    vectors: DataFrame,
    queries: DataFrame,
    keys: list[str],
    k: int,
    digits: int | None,
    max_numbers: int,
    cells: CellTable | None = None,
    n_probe: int = 0,
) -> DataFrame:
    schema = StructType(
        [
            StructField("query_id", queries.schema["query_id"].dataType),
            *[StructField(c, vectors.schema[c].dataType) for c in keys],
            StructField("score", DoubleType()),
        ]
    )
    # A unit or query without a vector has no place in the ranking.
    vectors = vectors.where(F.col("embedding").isNotNull())
    queries = queries.where(F.col("embedding").isNotNull()).select("query_id", "embedding")
    # Written once: an encoder in front of them works on each question one time.
    queries = files.materialize(queries, "queries")
    longest = queries.agg(F.max(F.size("embedding"))).first()[0] or 1
    return in_passes(
        queries,
        "query_id",
        max(1, max_numbers // (longest + k)),
        0,
        lambda part: _score_pass(vectors, part, keys, schema, k, digits, cells, n_probe),
        lambda scored: ranked(scored, ["query_id"], unit_order(keys), k),
        schema,
    )


def vector_topk(
    vectors: DataFrame,
    queries: DataFrame,
    keys: list[str],
    k: int,
    digits: int | None = None,
    max_numbers: int = MAX_NUMBERS,
) -> DataFrame:
    """The k vectors nearest to each query: (query_id, *keys, score, rk).

    With ``digits`` scores equal to that many decimals are ties.

    ``vectors`` has the key columns and ``embedding``, ``queries`` has
    ``query_id`` and ``embedding``. The score is the cosine, 1 minus the cosine
    distance. Queries go to the tasks as one matrix of measured size, in several
    passes if need be, and vectors are neither joined nor shuffled.
    """
    return _search(vectors, queries, keys, k, digits, max_numbers)


@dataclass(frozen=True)
class CellTable:
    """Vectors stored by the nearest of a few centers, for approximate search."""

    vectors: DataFrame
    centers: np.ndarray


def build_cells(
    vectors: DataFrame, keys: list[str], n_cells: int, path: str | None = None, seed: int = 1
) -> CellTable:
    """Cluster the vectors and write them in one folder per cell.

    Rows are divided by ranges of (cell, keys) before the write: a cell with a
    third of all vectors fills many tasks and files, and small cells do not
    leave a file in every task.
    """
    spark = vectors.sparkSession
    path = path or files.run_dir(spark, "cells")
    stored = vectors.where(F.col("embedding").isNotNull()).select(*keys, "embedding")
    # On unit vectors the nearest center by distance is a good one by angle, and
    # vectors of length zero are no trouble.
    raw = stored.withColumn("_raw", array_to_vector("embedding"))
    unit = Normalizer(inputCol="_raw", outputCol="_unit").transform(raw)
    model = KMeans(k=n_cells, seed=seed, featuresCol="_unit", predictionCol="cell").fit(unit)
    placed = model.transform(unit).select(*keys, "embedding", "cell")
    by_cell = placed.repartitionByRange("cell", *keys).write.mode("errorifexists")
    by_cell.partitionBy("cell").parquet(path)
    centers = np.array(model.clusterCenters())
    length = np.linalg.norm(centers, axis=1, keepdims=True)
    return CellTable(spark.read.parquet(path), centers / np.where(length > 0, length, 1))


def cell_topk(
    cells: CellTable,
    queries: DataFrame,
    keys: list[str],
    k: int,
    n_probe: int,
    digits: int | None = None,
    max_numbers: int = MAX_NUMBERS,
) -> DataFrame:
    """Like ``vector_topk``, but each query looks only into its nearest cells.

    Folders of cells that no query looks into are not read. Every vector of a
    cell that is looked into is scored; with ``n_probe`` equal to the number of
    cells the result is exact. Report ``recall`` with it.
    """
    return _search(cells.vectors, queries, keys, k, digits, max_numbers, cells, n_probe)


def recall(exact: DataFrame, found: DataFrame, keys: list[str]) -> DataFrame:
    """Per query, how many of the exact results were found: (query_id, n_exact, n_found)."""
    hit = found.select("query_id", *keys, F.lit(1).alias("_hit"))
    return (
        exact.join(hit, ["query_id", *keys], "left")
        .groupBy("query_id")
        .agg(F.count(F.lit(1)).alias("n_exact"), F.count("_hit").alias("n_found"))
    )
