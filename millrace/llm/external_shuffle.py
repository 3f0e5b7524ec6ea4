"""A seeded random order of all rows by a two-pass external shuffle, cut into shards.

1. Every row gets a seeded hash of all its columns. Counts and bytes of 2^20 ranges of the
   hash say how many buckets of at most about ``BUCKET_BYTES`` there have to be, and where
   each one begins in the whole order.
2. First pass: rows are scattered over the buckets by their hash. Second pass: each bucket
   alone is held in memory, brought into the order of its hashes, so that the order of
   arrival does not matter, shuffled by Fisher and Yates under a seed of its own, and
   written. Buckets follow each other, so a row's place in the whole order is the place
   where its bucket begins plus its place in the bucket; a bucket's start comes to its task
   as one more row of the scatter, so nothing is broadcast or joined.
3. The whole order is cut into shards whose counts of rows are at most one apart. The files
   of a shard, in the order of their names, hold its rows in the order of their slots.

The result depends on the rows, the seed and the bucket size, and not on how the input was
divided. Rows that are equal in every column would all meet in one bucket; where a bucket
is found to be too large, equal rows of it are counted first, numbered, and scattered again
by hash and number, so no task ever holds many copies.

Defined results: null texts and ids are rows as any other; repeated rows stay repeated;
of rows that are equal in all columns any one may have either slot; an empty table gives
no rows; more shards than rows leave shards empty; a row longer than a bucket is a bucket
alone. Columns that cannot be compared (maps) are hashed as JSON, and must not repeat
beyond a bucket.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, MapType, StringType, StructType

from millrace.llm.common import fresh, or_empty
from millrace.sources import files

SEED = 20_011
#: What a bucket may hold on average, in bytes of text and 16 for any other column.
BUCKET_BYTES = 128 << 20
#: A bucket of so many times that size is divided.
OVERSIZE = 4
#: At least 2^6 buckets, so that a small table keeps the cores busy; at most 2^20.
LEAST_BITS, MOST_BITS = 6, 20
#: Tasks of the second pass, 2^15 at most; one may hold several buckets, one after another.
TASK_BITS = 15
_SLICE = 500


def _hash(seed: int, columns: list[Column]) -> Column:
    return F.xxhash64(F.lit(seed).cast("long"), *columns)


def _comparable(docs: DataFrame) -> list[Column]:
    return [
        F.to_json(F.struct(F.col(f"`{f.name}`"))) if isinstance(f.dataType, MapType) else F.col(f"`{f.name}`")
        for f in docs.schema.fields
    ]


def _row_bytes(schema: StructType) -> Column:
    total = F.lit(0).cast("long")
    for f in schema.fields:
        column = F.col(f"`{f.name}`")
        text = isinstance(f.dataType, (StringType, BinaryType))
        total = total + (F.coalesce(F.octet_length(column), F.lit(0)) + 16 if text else F.lit(16))
    return total


def _top_bits(hashed: Column, bits: int) -> Column:
    return F.shiftrightunsigned(hashed, 64 - bits)


def _sizes(hashed: DataFrame, name: str, columns: list[str], of: StructType) -> DataFrame:
    """``slice, n, bytes`` of ranges of the hash, written."""
    found = (
        hashed.select(_top_bits(F.col(name), MOST_BITS).alias("slice"), _row_bytes(of).alias("bytes"))
        .groupBy("slice")
        .agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes"))
    )
    return files.materialize(found, "shuffle-sizes")


def _buckets(sizes: DataFrame, bucket_bytes: int) -> tuple[int, int, DataFrame]:
    """Bits of a bucket number, number of rows, and ``bucket, n, bytes``."""
    total = sizes.agg(F.sum("n").alias("n"), F.sum("bytes").alias("bytes")).first()
    n, held = total["n"] or 0, total["bytes"] or 0
    bits = min(MOST_BITS, max(LEAST_BITS, (max(1, -(-held // bucket_bytes)) - 1).bit_length()))
    by_bucket = sizes.groupBy(F.shiftright("slice", MOST_BITS - bits).alias("bucket")).agg(
        F.sum("n").alias("n"), F.sum("bytes").alias("bytes")
    )
    return bits, n, by_bucket


def _starts(by_bucket: DataFrame, bits: int) -> DataFrame:
    """``bucket, start``. Sums within 1024 groups of buckets, and of the groups: no task
    sees more than some thousand rows."""
    group = F.shiftright("bucket", max(0, bits - 10)).alias("group")
    grouped = by_bucket.select("bucket", "n", group)
    before = Window.orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("group").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    of_group = grouped.groupBy("group").agg(F.sum("n").alias("n_group"))
    of_group = of_group.select("group", F.coalesce(F.sum("n_group").over(before), F.lit(0)).alias("group_start"))
    return grouped.join(F.broadcast(of_group), "group").select(
        "bucket", (F.col("group_start") + F.coalesce(F.sum("n").over(inside), F.lit(0))).alias("start")
    )


def _numbered(hashed: DataFrame, name: str, seed: int) -> DataFrame:
    """The same rows, equal ones with hashes of their own. They are counted before the shuffle."""
    of, times, nth = hashed.drop(name).columns, *fresh(hashed, "times", "nth")
    quoted = [F.col(f"`{c}`") for c in of]
    counted = hashed.groupBy(*quoted, F.col(name)).agg(F.count("*").alias(times))
    each = counted.select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.col(times))).alias(nth))
    return each.select(*quoted, _hash(seed, [F.col(name), F.col(nth)]).alias(name))


def shuffled(
    docs: DataFrame, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES, position: str | None = None
) -> tuple[DataFrame, str, int]:
    """All rows with their place in a random order, the column that has it, and the number of rows."""
    (name, bucket, start, head), (place,) = (
        fresh(docs, "row_hash", "bucket", "start", "head"),
        [position] if position else fresh(docs, "position"),
    )
    quoted = [F.col(f"`{c}`") for c in docs.columns]
    hashed = docs.select("*", _hash(seed, _comparable(docs)).alias(name))
    bits, n, by_bucket = _buckets(_sizes(hashed, name, docs.columns, docs.schema), bucket_bytes)
    over = by_bucket.where(F.col("bytes") > OVERSIZE * bucket_bytes).select("bucket")
    if over.limit(1).count():
        # At most 2^20 numbers.
        hot = F.broadcast(over.withColumnRenamed("bucket", bucket))
        marked = hashed.withColumn(bucket, _top_bits(F.col(name), bits))
        rest = marked.join(hot, bucket, "left_anti").drop(bucket)
        again = _numbered(marked.join(hot, bucket, "left_semi").drop(bucket), name, seed)
        hashed = rest.unionByName(again)
        bits, n, by_bucket = _buckets(_sizes(hashed, name, docs.columns, docs.schema), bucket_bytes)
    none = [F.lit(None).cast(f.dataType).alias(f.name) for f in docs.schema.fields]
    heads = _starts(by_bucket, bits).select(
        *none,
        F.lit(None).cast("long").alias(name),
        F.col("bucket").alias(bucket),
        F.col("start").alias(start),
    )
    rows = hashed.select(
        *quoted, name, _top_bits(F.col(name), bits).alias(bucket), F.lit(None).cast("long").alias(start)
    )
    task_bits = min(bits, TASK_BITS)
    dealt = (
        rows.unionByName(heads)
        .repartitionById(1 << task_bits, F.shiftright(bucket, bits - task_bits).cast("int"))
        .sortWithinPartitions(bucket, F.col(start).isNull(), name)
        .select(*quoted, bucket, start)
    )
    schema = StructType([*docs.schema.fields]).add(place, LongType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        at = (None, 0)
        for batch in batches:
            numbers = batch.column(bucket).to_numpy(zero_copy_only=False)
            first = 0
            while first < len(numbers):
                last = int(np.searchsorted(numbers, numbers[first], side="right"))
                part = batch.slice(first, last - first)
                if int(numbers[first]) != at[0]:
                    yield from fisher_yates(held, at, seed)
                    # The head of a bucket comes before its rows.
                    held, at = [], (int(numbers[first]), part.column(start)[0].as_py())
                    part = part.slice(1)
                if part.num_rows:
                    held.append(part)
                first = last
        yield from fisher_yates(held, at, seed)

    def fisher_yates(held: list, at: tuple, seed: int) -> Iterator[pa.RecordBatch]:
        if not held:
            return
        table = pa.Table.from_batches(held).drop_columns([bucket, start])
        held.clear()
        order = permutation(table.num_rows, seed, at[0])
        for first in range(0, len(order), _SLICE):
            some = table.take(pa.array(order[first : first + _SLICE]))
            places = pa.array(np.arange(at[1] + first, at[1] + first + some.num_rows, dtype=np.int64))
            yield from some.append_column(place, places).combine_chunks().to_batches()

    return dealt.mapInArrow(run, schema), place, n


def permutation(n: int, seed: int, bucket: int) -> np.ndarray:
    """0 to n-1 shuffled by Fisher and Yates: from the last place down, each is exchanged
    with one drawn among those up to it."""
    order = np.arange(n)
    np.random.Generator(np.random.PCG64([seed, bucket])).shuffle(order)
    return order


def write_shards(
    docs: DataFrame, path: str, n_shards: int, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES
) -> tuple[str, str]:
    """Write all rows to one folder per shard; the names of the shard and slot columns."""
    shard, slot, position = fresh(docs, "shard", "slot", "position")
    rows, place, n = shuffled(docs, seed, bucket_bytes, position)
    at, total = F.col(place), F.lit(max(n, 1)).cast("long")
    number = F.call_function("div", (at + 1) * n_shards - 1, total)
    first = F.call_function("div", number * total, F.lit(n_shards).cast("long"))
    cut = rows.select(*[f"`{c}`" for c in docs.columns], number.cast("int").alias(shard), (at - first).alias(slot))
    cut.sortWithinPartitions(shard, slot).write.partitionBy(shard).parquet(path)
    return shard, slot


def read_shards(spark: SparkSession, path: str, schema: StructType, shard: str, slot: str) -> DataFrame:
    """What ``write_shards`` has written, of rows of this schema."""
    whole = StructType([*schema.fields]).add(slot, LongType()).add(shard, IntegerType())
    return spark.read.schema(whole).parquet(path)


def digests(rows: DataFrame, shard: str, slot: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Id, size and checksum of each row with its shard, slot and law."""
    body = or_empty(F.col(text)).cast("binary")
    return rows.select(
        F.col(doc_id).alias("doc_id"),
        (F.octet_length(body) + 16).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"),
        F.lit("rows").alias("law"),
        F.col(shard).alias("shard"),
        F.col(slot).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
