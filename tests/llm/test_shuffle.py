"""Shards of a two-pass shuffle: whole, even, in order, repeatable and without order of their own."""

import glob
import zlib
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from millrace.llm import external_shuffle
from tests.llm.conftest import DOCS


def write(spark, docs, path, n_shards=7, **more):
    shard, slot = external_shuffle.write_shards(docs, str(path), n_shards, **more)
    return external_shuffle.read_shards(spark, str(path), docs.schema, shard, slot), shard, slot


def check(rows, docs, n_shards, shard="shard", slot="slot"):
    assert Counter(r[: len(docs[0])] for r in rows) == Counter(docs)
    sizes = Counter(r[-1] for r in rows)
    assert all(0 <= s < n_shards for s in sizes)
    counts = [sizes.get(s, 0) for s in range(n_shards)]
    assert max(counts) - min(counts) <= 1
    for s in sizes:
        assert sorted(r[-2] for r in rows if r[-1] == s) == list(range(sizes[s]))


@pytest.mark.parametrize("bucket_bytes", [1 << 27, 4_000])
def test_shards_are_whole_and_even(spark, odd, odd_rows, tmp_path, bucket_bytes):
    found, shard, slot = write(spark, odd, tmp_path / "s", 5, bucket_bytes=bucket_bytes)
    check([tuple(r) for r in found.collect()], odd_rows, 5)


def test_files_hold_slots_in_order(spark, docs_of, tmp_path):
    docs = docs_of([f"text {n} " * (n % 9) for n in range(3_000)])
    write(spark, docs, tmp_path / "s", 4, bucket_bytes=1_000)
    for s in range(4):
        names = sorted(glob.glob(f"{tmp_path}/s/shard={s}/*.parquet"))
        slots = [v for name in names for v in pq.ParquetFile(name).read(["slot"])["slot"].to_pylist()]
        assert slots == list(range(750))


def test_result_does_not_hang_on_the_input_layout(spark, docs_of, tmp_path):
    docs = docs_of([f"text {n}" for n in range(2_000)])
    a, *_ = write(spark, docs.repartition(3), tmp_path / "a", bucket_bytes=20_000)
    b, *_ = write(spark, docs.repartition(11, "text"), tmp_path / "b", bucket_bytes=20_000)
    other, *_ = write(spark, docs, tmp_path / "c", seed=1)
    places = [{r["doc_id"]: (r["shard"], r["slot"]) for r in df.collect()} for df in (a, b, other)]
    assert places[0] == places[1]
    same = sum(places[0][d] == places[2][d] for d in places[0])
    assert same < 20


def test_order_is_random(spark, docs_of, tmp_path):
    docs = docs_of([f"text {n}" for n in range(8_000)])
    rows, place, n = external_shuffle.shuffled(docs, bucket_bytes=40_000)
    got = np.array([r["doc_id"] for r in rows.orderBy(place).collect()])
    assert n == 8_000 and sorted(got) == list(range(n))
    # Neither a trend nor runs: both would be far outside of these for a sorted order.
    assert abs(np.corrcoef(got, np.arange(n))[0, 1]) < 0.05
    assert abs((np.diff(got) > 0).mean() - 0.5) < 0.03
    # Ids of any stretch are spread over all of the table.
    quarters = np.bincount(got[:2_000] // 2_000, minlength=4)
    assert quarters.min() > 400


def test_permutation_is_a_shuffle():
    counts = Counter(tuple(external_shuffle.permutation(4, 3, b)) for b in range(4_800))
    assert len(counts) == 24
    assert max(counts.values()) < 290 and min(counts.values()) > 120


def test_equal_rows_are_divided(spark, tmp_path):
    """A third of all rows are equal in every column; no bucket may hold them all."""
    rows = [(1, "the same text", "en", "a", 13)] * 4_000 + [(n, f"t{n}", "en", "a", 3) for n in range(8_000)]
    docs = spark.createDataFrame(rows, DOCS)
    found, shard, slot = write(spark, docs, tmp_path / "s", 40, bucket_bytes=5_000)
    got = [tuple(r) for r in found.collect()]
    check(got, rows, 40)
    in_shard = Counter(r[-1] for r in got if r[1] == "the same text")
    assert len(in_shard) == 40 and max(in_shard.values()) < 200


def test_clashing_names_and_empty_tables(spark, odd, empty, tmp_path):
    clash = odd.select("*", *[F.lit(0).alias(c) for c in ("shard", "slot", "bucket", "start", "position", "row_hash")])
    found, shard, slot = write(spark, clash, tmp_path / "a", 3)
    assert (shard, slot) == ("shard_", "slot_")
    assert found.count() == odd.count() and found.columns[:-2] == clash.columns
    none, *_ = write(spark, empty, tmp_path / "b", 3)
    assert none.collect() == []


def test_digests(spark, odd, odd_rows, tmp_path):
    found, shard, slot = write(spark, odd, tmp_path / "s", 3)
    got = Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in external_shuffle.digests(found, shard, slot).collect())
    want = Counter()
    for doc_id, text, *_ in odd_rows:
        data = (text or "").encode()
        want[doc_id, len(data) + 16, zlib.crc32(data)] += 1
    assert got == want
