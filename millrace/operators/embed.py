"""Texts to vectors: a hook for any encoder, and a hashed tf-idf one."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DoubleType, FloatType, IntegerType, StructField, StructType

from millrace.functions import text as tx

Encoder = Callable[[list[str]], np.ndarray]

# Texts counted at a time: their matrices take some tens of megabytes.
_ROWS = 4096
# Words that a task remembers the places of, some tens of megabytes.
_REMEMBERED = 300_000
# Column of the places of a text's words.
PLACES = "_places"


def encode(df: DataFrame, load_encoder: Callable[[], Encoder], text: str = "text") -> DataFrame:
    """Add ``embedding`` with an encoder that is loaded once per task.

    The encoder gets a list of texts and returns a matrix with a row per text.
    """
    schema = StructType([*df.schema.fields, StructField("embedding", ArrayType(FloatType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = load_encoder()
        for batch in batches:
            if batch.num_rows == 0:
                continue
            rows = np.asarray(encoder(batch.column(text).to_pylist()), dtype=np.float32)
            vectors = pa.FixedSizeListArray.from_arrays(pa.array(rows.ravel()), rows.shape[1])
            yield batch.append_column("embedding", vectors.cast(pa.list_(pa.float32())))

    return df.mapInArrow(run, schema)


@dataclass(frozen=True)
class HashedTfIdf:
    """Word counts hashed into ``dims`` places, weighted by idf, unit length.

    A word's place is the number that its md5 begins with, modulo ``dims``, which any
    engine can work out. Spark cuts texts into words, of which each different one is hashed
    once in a task; a batch of texts is then counted as one matrix. The
    vectors are not those of a trained sentence model; use ``encode`` for one.
    """

    dims: int
    idf: np.ndarray

    @classmethod
    def fit(cls, texts: DataFrame, dims: int = 256) -> HashedTfIdf:
        """One pass; only the document counts of the ``dims`` places reach the driver.

        ``texts`` has a column ``text``, or what :func:`placed` makes of it for this ``dims``.
        """

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(dims + 1, np.int64)
            for batch in batches:
                for first in range(0, batch.num_rows, _ROWS):
                    counts = _counts(batch.column(0).slice(first, _ROWS), dims)
                    total[:dims] += np.count_nonzero(counts, axis=0)
                    total[dims] += len(counts)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims + 1)), pa.array(total)], names=["place", "n"])

        known = PLACES in texts.columns
        held = (texts if known else placed(texts.select("text"), dims)).select(PLACES).mapInArrow(run, "place long, n long")
        # One row per place, and the last one for the number of texts.
        summed = held.groupBy("place").agg(F.sum("n").alias("n")).orderBy("place").toArrow()["n"].to_numpy()
        n = summed if len(summed) else np.zeros(dims + 1)
        return cls(dims, np.log((n[dims] + 1.0) / (n[:dims] + 1.0)))

    def transform(self, texts: DataFrame, packed: bool = False) -> DataFrame:
        """Add ``embedding`` (array of float) for the column ``text``; ``placed`` texts lose their places.

        With ``packed`` it is the bytes of the same 32-bit numbers, which a table writes and
        reads as one value; searches and :func:`number_sums` take either.
        """
        dims, idf = self.dims, self.idf
        known = texts if PLACES in texts.columns else placed(texts, dims)
        rest = [c for c in known.columns if c != PLACES]
        kind = BinaryType() if packed else ArrayType(FloatType())
        schema = StructType([known.schema[c] for c in rest]).add("embedding", kind)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for first in range(0, batch.num_rows, _ROWS):
                    part = batch.slice(first, _ROWS)
                    rows = _counts(part.column(len(rest)), dims) * idf
                    norm = np.sqrt((rows * rows).sum(axis=1, keepdims=True))
                    rows = np.divide(rows, norm, out=rows, where=norm > 0).astype("<f4")
                    if packed:
                        ends = pa.py_buffer(np.arange(len(rows) + 1, dtype=np.int32) * (4 * dims))
                        vectors = pa.Array.from_buffers(pa.binary(), len(rows), [None, ends, pa.py_buffer(rows)])
                    else:
                        vectors = pa.FixedSizeListArray.from_arrays(pa.array(rows.ravel()), dims)
                        vectors = vectors.cast(pa.list_(pa.float32()))
                    part = part.select(range(len(rest)))
                    yield part.append_column("embedding", vectors)

        return known.select(*rest, PLACES).mapInArrow(run, schema)


def placed(texts: DataFrame, dims: int = 256) -> DataFrame:
    """Add the places of each text's words, four bytes for each, so that a written table of
    texts is cut into words and hashed once, whatever is worked out of it. Texts that have
    ``words``, as units of an index do, are not cut again, and lose them."""
    words = F.col("words") if "words" in texts.columns else tx.words(F.col("text"))
    rest = texts.drop("words")
    schema = StructType([*rest.schema.fields, StructField(PLACES, BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, int] = {}
        for batch in batches:
            # Words hold no blank.
            lists = pc.split_pattern(pc.fill_null(batch.column(batch.num_columns - 1), ""), " ")
            words = lists.flatten()
            there = pc.not_equal(words, "").to_numpy(zero_copy_only=False)
            coded = words.dictionary_encode()
            places = np.empty(len(coded.dictionary), "<u4")
            if len(known) > _REMEMBERED:
                known.clear()
            for n, word in enumerate(coded.dictionary.to_pylist()):
                place = known.get(word)
                if place is None:
                    place = known[word] = int.from_bytes(hashlib.md5(word.encode()).digest()[:4], "big") % dims
                places[n] = place
            found = places[coded.indices.to_numpy(zero_copy_only=False)][there]
            ends = np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))
            ends = np.r_[0, np.r_[0, np.cumsum(there)][ends]] * 4
            buffers = [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(found)]
            held = pa.Array.from_buffers(pa.binary(), batch.num_rows, buffers)
            yield batch.select(range(batch.num_columns - 1)).append_column(PLACES, held)

    joined = F.array_join(words, " ").alias(PLACES)
    return texts.select(*rest.columns, joined).mapInArrow(run, schema)


def numbers(vectors: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """How many numbers each vector has, and all of them, of lists or packed vectors."""
    if pa.types.is_binary(vectors.type):
        sizes = pc.fill_null(pc.binary_length(vectors), 0).to_numpy(zero_copy_only=False) // 4
        return sizes, np.frombuffer(b"".join(vectors.drop_null().to_pylist()), "<f4")
    sizes = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(zero_copy_only=False)
    return sizes, vectors.flatten().to_numpy(zero_copy_only=False)


def _counts(places: pa.Array, dims: int) -> np.ndarray:
    """Counts by text and place."""
    sizes = pc.fill_null(pc.binary_length(places), 0).to_numpy(zero_copy_only=False) // 4
    at = np.repeat(np.arange(len(places)) * dims, sizes)
    at += np.frombuffer(b"".join(places.drop_null().to_pylist()), "<u4")
    return np.bincount(at, minlength=len(places) * dims).reshape(-1, dims)


def vector_table(embedded: DataFrame) -> DataFrame:
    """The stored form: unit keys, text and embedding."""
    return embedded.select("source_doc", "chunk_idx", "chunk_id", "text", "embedding")


def number_sums(embedded: DataFrame) -> DataFrame:
    """Add the size of each embedding (``dims``), its sum (``total``) and the sum of its
    numbers times their places from 1 (``weighted``)."""
    schema = StructType(
        [
            *embedded.schema.fields,
            StructField("dims", IntegerType()),
            StructField("total", DoubleType()),
            StructField("weighted", DoubleType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column("embedding")
            sizes, values = numbers(vectors)
            sizes, values = sizes.astype(np.int64), values.astype(np.float64)
            row = np.repeat(np.arange(len(sizes)), sizes)
            place = np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + 1
            absent = vectors.is_null().to_numpy(zero_copy_only=False)
            sums = [
                np.bincount(row, weights=x, minlength=len(sizes)).astype(np.float64) for x in (values, values * place)
            ]
            batch = batch.append_column("dims", pa.array(sizes.astype(np.int32), mask=absent))
            for name, found in zip(("total", "weighted"), sums):
                batch = batch.append_column(name, pa.array(found, mask=absent))
            yield batch

    return embedded.mapInArrow(run, schema)
