"""Exact duplicates by Patricia tries with terminal owners.

Texts are equal if they are identical after their white space is deleted. Every task
that reads documents inserts the whole normalised byte strings into a trie of its own,
so that a group of copies leaves a task as one string however large it is; a trie that
outgrows its budget spills its heaviest subtree. The strings are dealt by length and
content hash, and there each length-and-hash partition is a trie again, whose terminal
nodes hold the row that stays. Documents get that owner by a join on length and hash,
which Spark may split for a hot group.

Defined results: null text counts as empty, and all empty texts are equal; a null
doc_id never stays before another one; of rows with the same id and text each counts,
and all of them are kept if one is; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BinaryType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from millrace.llm.common import SPACES, batched, or_empty
from millrace.llm.radix import RadixTrie

#: Bytes, of labels and nodes, that a trie may take before it spills.
TRIE_BYTES = 48 << 20
_ROWS = 256


def _better(a: tuple, b: tuple) -> tuple:
    """Owner of two: most code points, then smallest id, null last; group sizes add up."""
    first = min(a, b, key=lambda o: (-o[0], o[1] is None, o[1] if o[1] is not None else 0))
    return first[0], first[1], a[2] + b[2]


def owners(docs: DataFrame, trie_bytes: int = TRIE_BYTES) -> DataFrame:
    """``n_bytes, text_sha256, best_points, keep_id, group_size``: one row per distinct text.

    ``docs`` has ``doc_id, norm, n_points, n_bytes, text_sha256``.
    """
    id_type = docs.schema["doc_id"].dataType
    schema = StructType(
        [
            StructField("n_bytes", LongType()),
            StructField("text_sha256", StringType()),
            StructField("norm", BinaryType()),
            StructField("best_points", LongType()),
            StructField("keep_id", id_type),
            StructField("group_size", LongType()),
        ]
    )
    arrow = pa.schema(
        [
            ("n_bytes", pa.int64()),
            ("text_sha256", pa.string()),
            ("norm", pa.binary()),
            ("best_points", pa.int64()),
            ("keep_id", pa.int64()),
            ("group_size", pa.int64()),
        ]
    )

    def emit(found: Iterator, with_norm: bool) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for norm, (points, keep, size, sha) in found:
            rows.append((len(norm), sha, norm if with_norm else None, points, keep, size))
            if len(rows) == _ROWS:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)
                rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)

    def merge(a: tuple, b: tuple) -> tuple:
        return (*_better(a[:3], b[:3]), a[3])

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Copies that one task reads meet before the shuffle."""
        trie = RadixTrie(merge)
        for batch in batches:
            columns = (batch.column(n).to_pylist() for n in ("norm", "n_points", "doc_id", "text_sha256"))
            for norm, points, doc_id, sha in zip(*columns):
                trie.insert(norm, (points, doc_id, 1, sha))
                while trie.size > trie_bytes:
                    yield from emit(trie.spill(), True)
        yield from emit(trie.items(), True)

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One trie per length-and-hash partition; rows come sorted by both."""
        trie, part = RadixTrie(merge), None
        done: list[tuple] = []
        for batch in batches:
            columns = (
                batch.column(n).to_pylist()
                for n in ("n_bytes", "text_sha256", "norm", "best_points", "keep_id", "group_size")
            )
            for n_bytes, sha, norm, points, doc_id, size in zip(*columns):
                if (n_bytes, sha) != part:
                    done.extend(trie.items())
                    trie, part = RadixTrie(merge), (n_bytes, sha)
                    if len(done) >= _ROWS:
                        yield from emit(iter(done), False)
                        done = []
                trie.insert(norm, (points, doc_id, size, sha))
        done.extend(trie.items())
        yield from emit(iter(done), False)

    return (
        docs.select("norm", F.col("n_points").cast("long").alias("n_points"), "doc_id", "text_sha256")
        .mapInArrow(combine, schema)
        .repartition("n_bytes", "text_sha256")
        .sortWithinPartitions("n_bytes", "text_sha256")
        .mapInArrow(own, schema)
        .drop("norm")
    )


def exact_dedup(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", trie_bytes: int = TRIE_BYTES
) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256, n_points`` for each row of ``docs``."""
    rows = batched(docs.select(F.col(doc_id).cast("long").alias("doc_id"), or_empty(F.col(text)).alias("text")))
    norm = F.regexp_replace("text", f"{SPACES}+", "")
    keyed = rows.select(
        "doc_id",
        norm.alias("plain"),
        F.length("text").cast("long").alias("n_points"),
    ).select(
        "doc_id",
        "n_points",
        F.encode("plain", "UTF-8").alias("norm"),
        F.octet_length("plain").cast("long").alias("n_bytes"),
        F.sha2("plain", 256).alias("text_sha256"),
    )
    members = keyed.select("doc_id", "n_points", "n_bytes", "text_sha256")
    kept = owners(keyed, trie_bytes)
    return members.join(kept, ["n_bytes", "text_sha256"], "left").select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("n_points") == F.col("best_points"))).alias("kept"),
        "text_sha256",
        "n_points",
    )
