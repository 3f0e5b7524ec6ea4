"""Exact nearest neighbours by cosine over 8-bit codes.

Vectors are stored twice: as one byte per dimension with a scale and the length of what the
rounding has lost, and as they are. For a question of length 1 that length bounds how far
the code's cosine is from the true one. So a search reads the codes only, a quarter of the
bytes, and leaves out every vector whose upper bound is below the k-th largest lower bound;
the few others are looked up and scored in full. The result is that of a full scan.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType, IntegerType, StructField, StructType

from millrace.operators.dense import MAX_NUMBERS, _matrix
from millrace.operators.topk import QUERY_BLOCK, blocks, in_passes, ranked, unit_order
from millrace.sources import files

_SLACK = 1e-9


def encode(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes, scales and losses of unit vectors (rows)."""
    scale = np.abs(vectors).max(axis=1, initial=0) / 127
    safe = np.where(scale > 0, scale, 1)
    codes = np.rint(vectors / safe[:, None]).astype(np.int8)
    lost = np.linalg.norm(vectors - codes * scale[:, None], axis=1)
    return codes, scale, lost + _SLACK


def build(vectors: DataFrame, keys: list[str], path: str | None = None) -> str:
    """Write codes beside the vectors; the folder with both tables.

    Vectors that are null have no place in it. The zero vector has cosine 0 with all.
    """
    spark = vectors.sparkSession
    path = path or files.run_dir(spark, "codes")
    stored = vectors.where(F.col("embedding").isNotNull()).select(*keys, "embedding")
    schema = StructType(
        [
            *[stored.schema[c] for c in keys],
            StructField("code", BinaryType()),
            StructField("scale", DoubleType()),
            StructField("lost", DoubleType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            codes, scale, lost = encode(_matrix(batch.column("embedding")))
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c) for c in keys],
                    pa.array([c.tobytes() for c in codes], pa.binary()),
                    pa.array(scale),
                    pa.array(lost),
                ],
                names=schema.names,
            )

    stored.write.mode("errorifexists").parquet(f"{path}/vectors")
    spark.read.parquet(f"{path}/vectors").mapInArrow(run, schema).write.mode("errorifexists").parquet(f"{path}/codes")
    return path


def _bounded(
    codes: DataFrame, keys: list[str], rows: np.ndarray, k: int, slack: float
) -> tuple[DataFrame, Broadcast]:
    """``query, *keys, low, high`` of vectors that a task cannot leave out by itself."""
    schema = StructType(
        [
            StructField("query", IntegerType()),
            *[codes.schema[c] for c in keys],
            StructField("low", DoubleType()),
            StructField("high", DoubleType()),
        ]
    )
    shared = codes.sparkSession.sparkContext.broadcast(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        questions = shared.value
        floor = np.full((len(questions), k), -np.inf)
        for batch in batches:
            if batch.num_rows == 0:
                continue
            flat = np.frombuffer(b"".join(batch.column("code").to_pylist()), np.int8)
            scale, lost = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("scale", "lost"))
            points = flat.reshape(batch.num_rows, -1).astype(np.float32)
            for block in blocks(np.arange(len(questions)), QUERY_BLOCK):
                near = (questions[block].astype(np.float32) @ points.T).astype(float) * scale
                # A product in single precision is off by at most this, as both sides have length 1.
                loss = lost + (points.shape[1] + 2) * 1.2e-7
                low = near - loss
                n = min(k, low.shape[1])
                top = np.partition(low, low.shape[1] - n, axis=1)[:, low.shape[1] - n :]
                floor[block] = np.partition(np.concatenate([floor[block], top], axis=1), -k, axis=1)[:, -k:]
                query, at = np.nonzero(near + loss >= floor[block].min(axis=1, keepdims=True) - slack)
                place = pa.array(at)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(block[query].astype(np.int32)),
                        *[batch.column(c).take(place) for c in keys],
                        pa.array(low[query, at]),
                        pa.array(near[query, at] + loss[at]),
                    ],
                    names=schema.names,
                )

    return codes.mapInArrow(run, schema), shared


def candidates(bounded: DataFrame, k: int, slack: float) -> DataFrame:
    """``query, *keys`` of what the bounds of all tasks leave."""
    kth = ranked(bounded, ["query"], [F.desc("low")], k).where(F.col("rk") == k)
    kth = kth.select("query", F.col("low").alias("floor"))
    # One row per question of a pass at most.
    left = bounded.join(F.broadcast(kth), "query", "left")
    return left.where(F.col("floor").isNull() | (F.col("high") >= F.col("floor") - slack)).drop("low", "high", "floor")


def _exact(path: str, found: DataFrame, keys: list[str], ids: pa.Array, rows: np.ndarray, schema: StructType) -> DataFrame:
    vectors = found.sparkSession.read.parquet(f"{path}/vectors")
    shared = found.sparkSession.sparkContext.broadcast((ids, rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, questions = shared.value
        for batch in batches:
            if batch.num_rows:
                query = batch.column("query").to_numpy(zero_copy_only=False)
                units = _matrix(batch.column("embedding"), questions.shape[1])
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array(query)),
                        *[batch.column(c) for c in keys],
                        pa.array(np.einsum("ij,ij->i", units, questions[query])),
                    ],
                    names=schema.names,
                )

    return found.join(vectors, keys).select("query", *keys, "embedding").mapInArrow(run, schema)


def vector_topk(
    path: str,
    queries: DataFrame,
    keys: list[str],
    k: int,
    digits: int | None = None,
    max_numbers: int = MAX_NUMBERS,
) -> DataFrame:
    """The k vectors nearest to each query, as ``dense.vector_topk`` has them. Keys are unique."""
    spark = queries.sparkSession
    codes = spark.read.parquet(f"{path}/codes")
    schema = StructType(
        [
            StructField("query_id", queries.schema["query_id"].dataType),
            *[StructField(c, codes.schema[c].dataType) for c in keys],
            StructField("score", DoubleType()),
        ]
    )
    slack = 0.0 if digits is None else 10.0**-digits
    asked = queries.where(F.col("embedding").isNotNull()).select("query_id", "embedding")
    asked = files.materialize(asked, "queries")
    longest = asked.agg(F.max(F.size("embedding"))).first()[0] or 1

    def score(part: pa.Table) -> tuple[DataFrame, Broadcast]:
        ids, rows = part["query_id"].combine_chunks(), _matrix(part["embedding"])
        bounded, shared = _bounded(codes, keys, rows, k, slack)
        left = candidates(files.materialize(bounded, "bounded"), k, slack)
        found = _exact(path, left, keys, ids, rows, schema)
        return (found if digits is None else found.withColumn("score", F.round("score", digits))), shared

    return in_passes(
        asked, "query_id", max(1, max_numbers // (longest + k)), 0, score,
        lambda rows: ranked(rows, ["query_id"], unit_order(keys), k), schema,
    )


def skipped(path: str, queries: DataFrame, keys: list[str], k: int) -> DataFrame:
    """``query_id, n_vectors, n_scored``: how many vectors each query scores in full."""
    spark = queries.sparkSession
    codes = spark.read.parquet(f"{path}/codes")
    part = queries.where(F.col("embedding").isNotNull()).select("query_id", "embedding").toArrow()
    ids = part["query_id"].combine_chunks()
    bounded, _ = _bounded(codes, keys, _matrix(part["embedding"]), k, 0.0)
    left = candidates(files.materialize(bounded, "bounded"), k, 0.0)
    names = spark.createDataFrame(pa.table({"query": pa.array(range(len(ids)), pa.int32()), "query_id": ids}))
    n = codes.count()
    counted = left.groupBy("query").agg(F.count("*").alias("n_scored"))
    return counted.join(F.broadcast(names), "query").select("query_id", F.lit(n).alias("n_vectors"), "n_scored")
