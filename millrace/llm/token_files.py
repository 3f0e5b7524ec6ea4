"""Token ids in Arrow files of equal-length sequences.

Documents are dealt out by ranges of their id and sorted within, so each task writes one
file that continues the one before. A file is an Arrow stream with a footer, and each of
its record batches holds up to ``BATCH`` sequences as fixed-size lists: ids, in the
smallest unsigned integer that holds the vocabulary, and a mask that is false on the
padding of the file's last sequence. As all sequences are equally long, the n-th one lies
at a known place of a known batch and is read as a view of the mapped file. A second file
beside it tells where each document begins.

Each try of a task writes files of its own name and hands on a row for them only when
they are complete, so a lost executor leaves files behind that nothing refers to.

Defined results: null and empty texts are the end id alone; rows without an id come
first; rows with the same id are written next to each other, ordered by their text's
hash; no rows give no files.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from millrace.llm import tokens
from millrace.llm.common import batched, or_empty
from millrace.sources import files

LENGTH = 2048
BATCH = 64
END_ID = 0
_MANIFEST = StructType(
    [
        StructField("part", LongType()),
        StructField("path", StringType()),
        StructField("n_docs", LongType()),
        StructField("n_tokens", LongType()),
    ]
)


def _open(uri: str):
    """File system and path of a folder that executors and driver share."""
    from pyarrow import fs

    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


def _schema(dtype: str, length: int) -> pa.Schema:
    return pa.schema(
        [
            ("ids", pa.list_(pa.from_numpy_dtype(np.dtype(dtype)), length)),
            ("mask", pa.list_(pa.bool_(), length)),
        ]
    )


_INDEX = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])


class SequenceWriter:
    """Appends token ids and writes whole batches of sequences as they fill."""

    def __init__(self, sink, dtype: str, length: int, batch: int):
        self._schema = _schema(dtype, length)
        self._out = pa.ipc.new_file(sink, self._schema)
        self._dtype, self._length, self._full = np.dtype(dtype), length, batch * length
        self._parts: list[np.ndarray] = []
        self._held = 0
        self.n_tokens = 0

    def append(self, ids: np.ndarray) -> None:
        self._parts.append(ids.astype(self._dtype))
        self._held += len(ids)
        self.n_tokens += len(ids)
        if self._held >= self._full:
            held = np.concatenate(self._parts)
            whole = len(held) // self._full * self._full
            for at in range(0, whole, self._full):
                self._write(held[at : at + self._full], self._full)
            self._parts, self._held = [held[whole:]], len(held) - whole

    def _write(self, ids: np.ndarray, n_real: int) -> None:
        arrays = [
            pa.FixedSizeListArray.from_arrays(pa.array(ids), self._length),
            pa.FixedSizeListArray.from_arrays(pa.array(np.arange(len(ids)) < n_real), self._length),
        ]
        self._out.write_batch(pa.RecordBatch.from_arrays(arrays, schema=self._schema.with_metadata(None)))

    def close(self) -> None:
        held = np.concatenate(self._parts) if self._parts else np.empty(0, self._dtype)
        if len(held):
            padded = np.zeros(-(-len(held) // self._length) * self._length, self._dtype)
            padded[: len(held)] = held
            self._write(padded, len(held))
        self._out.close()


class SequenceFile:
    """Random access to the sequences of one file, without copying where it is mapped."""

    def __init__(self, uri: str):
        from pyarrow import fs

        system, path = _open(uri)
        local = isinstance(system, fs.LocalFileSystem)
        self._source = pa.memory_map(path) if local else system.open_input_file(path)
        self._reader = pa.ipc.open_file(self._source)
        self.n_batches = self._reader.num_record_batches
        self.length = self._reader.schema.field("ids").type.list_size
        self._first = len(self._reader.get_batch(0)) if self.n_batches else 0
        self._last: tuple[int, pa.Array | None] = (-1, None)

    def __len__(self) -> int:
        if not self.n_batches:
            return 0
        return (self.n_batches - 1) * self._first + len(self._reader.get_batch(self.n_batches - 1))

    def _flat(self, batch: int, name: str) -> pa.Array:
        return self._reader.get_batch(batch).column(name).flatten()

    def ids(self, n: int) -> np.ndarray:
        batch, row = divmod(n, self._first)
        return self._flat(batch, "ids").slice(row * self.length, self.length).to_numpy(zero_copy_only=True)

    def mask(self, n: int) -> pa.Array:
        batch, row = divmod(n, self._first)
        return self._flat(batch, "mask").slice(row * self.length, self.length)

    def span(self, start: int, n: int) -> Iterator[np.ndarray]:
        """Views that together hold ``n`` ids from ``start`` on."""
        step = self._first * self.length
        while n > 0:
            batch, at = divmod(start, step)
            if self._last[0] != batch:
                self._last = (batch, self._flat(batch, "ids"))
            view = self._last[1].slice(at, n).to_numpy(zero_copy_only=True)
            yield view
            start, n = start + len(view), n - len(view)

    def close(self) -> None:
        self._source.close()


def write(
    docs: DataFrame,
    folder: str,
    vocabulary: str,
    vocabulary_size: int,
    length: int = LENGTH,
    batch: int = BATCH,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Write all documents under ``folder``; the written files as ``part, path, n_docs, n_tokens``."""
    dtype = "uint16" if vocabulary_size <= 1 << 16 else "uint32"
    end = END_ID.to_bytes(4, "little")
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), or_empty(F.col(text)).alias("text"))
    ordered = (
        batched(rows)
        .withColumn("tie", F.xxhash64("text"))
        .repartitionByRange("doc_id", "tie")
        .sortWithinPartitions("doc_id", "tie")
        .select("doc_id", "text")
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = tokens.encoder(vocabulary, leading_space=True)
        part = TaskContext.get().partitionId()
        system, root = _open(folder)
        path = f"{root}/{part:06d}-{uuid.uuid4().hex}"
        writer = index = sinks = None
        n_docs = 0
        for rows in batches:
            if not len(rows):
                continue
            if writer is None:
                system.create_dir(root, recursive=True)
                sinks = [system.open_output_stream(f"{path}.{kind}") for kind in ("arrow", "docs")]
                writer = SequenceWriter(sinks[0], dtype, length, batch)
                index = pa.ipc.new_file(sinks[1], _INDEX)
            starts, counts = [], []
            for ids in encoder.encode(rows["text"]):
                starts.append(writer.n_tokens)
                writer.append(np.frombuffer(ids + end, "<u4"))
                counts.append(writer.n_tokens - starts[-1])
            ids = pa.array(rows["doc_id"], pa.int64(), from_pandas=True)
            index.write_batch(pa.RecordBatch.from_arrays([ids, pa.array(starts), pa.array(counts)], schema=_INDEX))
            n_docs += len(rows)
        if writer is not None:
            writer.close()
            index.close()
            for sink in sinks:
                sink.close()
            # Folder and name, not the path within the file system, so that any reader finds it.
            uri = f"{folder}/{path.rpartition('/')[2]}"
            yield pd.DataFrame({"part": [part], "path": [uri], "n_docs": [n_docs], "n_tokens": [writer.n_tokens]})

    return files.materialize(ordered.mapInPandas(run, _MANIFEST), "token-manifest")


def read(manifest: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of all documents, from the written files.

    One row per file is summed up, which is far less than the documents.
    """
    placed = manifest.withColumn(
        "before", F.sum("n_tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    ).select("path", F.coalesce("before", F.lit(0)).alias("before"))
    n_files = manifest.count()
    schema = StructType([StructField(n, LongType()) for n in ("doc_id", "start", "n_tokens", "ids_crc32")])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for path, before in zip(rows["path"], rows["before"]):
                sequences = SequenceFile(f"{path}.arrow")
                system, local = _open(f"{path}.docs")
                with system.open_input_file(local) as source:
                    index = pa.ipc.open_file(source)
                    for n in range(index.num_record_batches):
                        docs = index.get_batch(n)
                        starts, counts = docs.column("start").to_numpy(), docs.column("n_tokens").to_numpy()
                        crcs = []
                        for start, count in zip(starts.tolist(), counts.tolist()):
                            crc = 0
                            for view in sequences.span(start, count):
                                crc = zlib.crc32(view.astype("<u4"), crc)
                            crcs.append(crc)
                        yield pd.DataFrame(
                            {
                                "doc_id": docs.column("doc_id").to_pandas(types_mapper=pd.ArrowDtype),
                                "start": starts + before,
                                "n_tokens": counts,
                                "ids_crc32": crcs,
                            }
                        )
                sequences.close()

    return placed.repartition(max(1, n_files), "path").mapInPandas(run, schema)


def round_trip(
    spark: SparkSession, docs: DataFrame, vocabulary: str, vocabulary_size: int, length: int = LENGTH
) -> DataFrame:
    """Write ``docs`` to a fresh folder that all executors share, and read the files back."""
    return read(write(docs, files.run_dir(spark, "tokens"), vocabulary, vocabulary_size, length))
