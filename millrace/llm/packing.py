"""Best-fit packing with large-item matching.

Documents become token ids and an end id; only those over the capacity are cut. How
many pieces there are of each length is all that the packing depends on, and lengths
are bounded by the capacity, so the plan is made from that histogram: lengths above a
third of the capacity fit at most twice into a bin and are matched greedily, the
longest with the longest that still fits; the others go, longest first, into the
smallest gap that takes them. A step of the plan places any number of equal pieces
into equal bins. Every piece is then numbered among those of its length, over chunks
so that a length which a third of the pieces share is no single group, and takes the
place that the plan has for that number.

Defined results: null and empty texts are one piece of the end id alone; repeated rows
are packed each; no rows give no rows. Any capacity from 1 works.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BinaryType,
    IntegerType,
    LongType,
    StructField,
    StructType,
)

from millrace.llm import tokens
from millrace.llm.common import batched, or_empty
from millrace.sources import files

CAPACITY = 2048
END_ID = 0
_MIN_CHUNKS = 64


def pieces(
    docs: DataFrame,
    vocabulary: str,
    capacity: int = CAPACITY,
    doc_id: str = "doc_id",
    text: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` (and ``ids``) of all documents."""
    rows = batched(docs.select(F.col(doc_id).alias("doc_id"), or_empty(F.col(text)).alias("text")))
    fields = [
        StructField("doc_id", rows.schema["doc_id"].dataType),
        StructField("piece", IntegerType()),
        StructField("start", LongType()),
        StructField("length", LongType()),
        StructField("ids_crc32", LongType()),
    ]
    if with_ids:
        fields.append(StructField("ids", BinaryType()))
    end, step = END_ID.to_bytes(4, "little"), 4 * capacity

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = tokens.encoder(vocabulary, leading_space=False)
        for batch in batches:
            out: list[tuple] = []
            for doc, ids in zip(batch["doc_id"].tolist(), encoder.encode(batch["text"])):
                ids += end
                for n, at in enumerate(range(0, len(ids), step)):
                    cut = ids[at : at + step]
                    row = (doc, n, at // 4, len(cut) // 4, zlib.crc32(cut))
                    out.append((*row, cut) if with_ids else row)
            yield pd.DataFrame(out, columns=[f.name for f in fields])

    return rows.mapInPandas(run, StructType(fields))


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Steps ``(length, first, n_bins, each, bin, offset)``: pieces number ``first`` on of a
    length go ``each`` to a bin into ``n_bins`` bins from ``bin`` on, from ``offset`` on.

    The number of steps is bounded by the capacity, not by the number of pieces.
    """
    left = {n: c for n, c in histogram.items() if c > 0}
    if any(not 0 < n <= capacity for n in left):
        raise ValueError("lengths must lie between 1 and the capacity")
    placed = dict.fromkeys(left, 0)
    steps: list[tuple[int, int, int, int, int, int]] = []
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap -> runs of bins: first, count
    open_gaps = 0  # bit g is set if there are bins with that gap
    n_bins = 0

    def keep(gap: int, first: int, count: int) -> None:
        nonlocal open_gaps
        if gap and count:
            gaps.setdefault(gap, []).append((first, count))
            open_gaps |= 1 << gap

    def place(length: int, n: int, each: int, first_bin: int, gap: int) -> None:
        steps.append((length, placed[length], n, each, first_bin, capacity - gap))
        placed[length] += n * each
        left[length] -= n * each

    large = sorted((n for n in left if 3 * n > capacity), reverse=True)
    for length in large:
        # Match the longest that is left with the longest that fits beside it.
        for partner in (p for p in large if p <= length and length + p <= capacity):
            if not left[length]:
                break
            n = left[length] // 2 if partner == length else min(left[length], left[partner])
            if n:
                place(length, n, 1, n_bins, capacity)
                place(partner, n, 1, n_bins, capacity - length)
                keep(capacity - length - partner, n_bins, n)
                n_bins += n
        if n := left[length]:
            place(length, n, 1, n_bins, capacity)
            keep(capacity - length, n_bins, n)
            n_bins += n
    for length in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        while left[length]:
            fitting = open_gaps >> length
            if fitting:
                gap = length + (fitting & -fitting).bit_length() - 1
                first, count = gaps[gap].pop()
                if not gaps[gap]:
                    open_gaps &= ~(1 << gap)
            else:
                gap, first = capacity, n_bins
                count = -(-left[length] // (capacity // length))
                n_bins += count
            # Best fit fills one bin with equal pieces before it takes the next.
            each = gap // length
            n = min(count, left[length] // each)
            if n:
                place(length, n, each, first, gap)
                keep(gap - n_used if (n_used := each * length) < gap else 0, first, n)
            if n < count:
                rest = left[length]
                if rest:
                    place(length, 1, rest, first + n, gap)
                    keep(gap - rest * length, first + n, 1)
                    n += 1
                keep(gap, first + n, count - n)
    return steps


def pack(found: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces that have a ``length``.

    ``found`` is read several times, so it should be a written table.
    """
    spark = found.sparkSession
    histogram = {r["length"]: r["n"] for r in found.groupBy("length").agg(F.count("*").alias("n")).collect()}
    steps = spark.createDataFrame(
        plan(histogram, capacity),
        "length long, first long, n_bins long, each long, first_bin long, first_offset long",
    )
    n_chunks = max(_MIN_CHUNKS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    names = ["doc_id", "piece", "start", "ids_crc32"]
    chunked = found.withColumn("chunk", F.pmod(F.xxhash64(*names), F.lit(n_chunks)))
    before = (
        chunked.groupBy("length", "chunk")
        .agg(F.count("*").alias("n"))
        .select(
            "length",
            "chunk",
            (F.sum("n").over(Window.partitionBy("length").orderBy("chunk")) - F.col("n")).alias("before"),
        )
    )
    within = Window.partitionBy("chunk", "length").orderBy(*names)
    numbered = (
        chunked.withColumn("nth", F.row_number().over(within) - 1)
        .join(before, ["chunk", "length"])
        .withColumn("nth", F.col("nth") + F.col("before"))
    )
    # The plan's size is bounded by the capacity, so it may go to every task.
    inside = F.col("nth") - F.col("first")
    mine = (inside >= 0) & (inside < F.col("n_bins") * F.col("each"))
    return (
        numbered.join(F.broadcast(steps.withColumnRenamed("length", "step_length")), (F.col("length") == F.col("step_length")) & mine)
        .withColumn("sequence_id", F.col("first_bin") + F.floor(inside / F.col("each")))
        .withColumn("offset", F.col("first_offset") + F.pmod(inside, F.col("each")) * F.col("length"))
        .select(*found.columns, "sequence_id", "offset")
    )


def pack_documents(
    docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` of all pieces."""
    found = files.materialize(pieces(docs, vocabulary, capacity, doc_id, text), "pieces")
    return pack(found, capacity)
