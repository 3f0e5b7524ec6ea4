import os

import pytest
from pyspark.sql import functions as F

from millrace.operators import upsert
from millrace.sources import buckets
from millrace.streaming import ingest
from tests.conftest import rows


def frame(spark, data):
    return spark.createDataFrame(data, "k string, v int")


def files_of(path):
    return {
        os.path.join(top, f): os.stat(os.path.join(top, f)).st_mtime_ns
        for top, _, names in os.walk(path)
        for f in names
        if f.endswith(".parquet")
    }


def bucket_of(file):
    return file.split("_bucket=")[1].split("/")[0]


def test_a_merge_writes_the_touched_buckets_only(spark, tmp_path):
    path = str(tmp_path / "t")
    data = [(f"k{n}", n) for n in range(400)]
    assert buckets.seed(spark, path, frame(spark, data), "k", n_buckets=16)
    assert not buckets.seed(spark, path, frame(spark, data[:1]), "k")
    before = files_of(path)
    counts = buckets.merge(spark, path, frame(spark, [("k7", -7)]))
    after = files_of(path)
    written = {bucket_of(f) for f in set(after) - set(before)}
    assert len(written) == 1
    # All others are the very same files.
    untouched = {f: t for f, t in before.items() if "_bucket=" not in f or bucket_of(f) not in written}
    assert len(untouched) >= 15 and after.items() >= untouched.items()
    assert counts["n_updated"] == 1 and counts["n_inserted"] == 0 and 0 < counts["n_kept"] < 60
    assert rows(buckets.read(spark, path)) == sorted((k, -7 if k == "k7" else v) for k, v in data)


@pytest.mark.parametrize("small", [True, False])
def test_merges_do_not_shuffle_the_table(spark, tmp_path, monkeypatch, small):
    path = str(tmp_path / "t")
    buckets.seed(spark, path, frame(spark, [(f"k{n}", n) for n in range(2_000)]), "k", n_buckets=8)
    if not small:
        monkeypatch.setattr(upsert, "SMALL_SOURCE_BYTES", -1)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        found = buckets.layout(spark, path)
        target = buckets.scan(spark, found, set(range(8))).select("k", "v")
        source = frame(spark, [(f"k{n}", -n) for n in range(1_990, 2_010)])
        merged = upsert.merge(target, source, "k")
        plan = merged.result()._jdf.queryExecution().executedPlan().toString()
        # Whatever is exchanged comes from the source: the table's scan stands below no exchange.
        lines = plan.splitlines()
        for n, line in enumerate(lines):
            if "FileScan parquet spark_catalog" in line:
                depth, above = line.index("FileScan"), []
                for before in reversed(lines[:n]):
                    at = len(before) - len(before.lstrip(" :+-"))
                    if at < depth:
                        depth = at
                        above.append(before)
                assert not any(" Exchange " in a for a in above), plan
        if not small:
            assert plan.count("Bucketed: true") == 2
            merged = buckets.merge(spark, path, source)
            assert merged == {"n_updated": 10, "n_inserted": 10, "n_kept": 1_990}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_null_keys_are_spread_and_match_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    buckets.seed(spark, path, frame(spark, [(None, n) for n in range(50)]), "k", n_buckets=8)
    lying = buckets.numbers(spark, buckets.layout(spark, path))
    assert len(lying) > 4 and all(b < 0 for b in lying)
    counts = buckets.merge(spark, path, frame(spark, [(None, 99), ("a", 1)]))
    assert counts["n_inserted"] == 2 and counts["n_updated"] == 0
    want = [*((None, n) for n in range(50)), (None, 99), ("a", 1)]
    assert rows(buckets.read(spark, path)) == sorted(want, key=repr)
    with pytest.raises(buckets.MissingKey):
        buckets.merge(spark, path, frame(spark, [(None, 1)]), need_keys=True)


def test_empty_tables_and_sources(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        buckets.read(spark, path)
    with pytest.raises(FileNotFoundError):
        buckets.merge(spark, path, frame(spark, []))
    buckets.seed(spark, path, frame(spark, []), "k")
    assert buckets.read(spark, path).collect() == []
    assert buckets.merge(spark, path, frame(spark, []))["n_inserted"] == 0
    assert buckets.merge(spark, path, frame(spark, [("a", 1)]))["n_inserted"] == 1
    assert rows(buckets.read(spark, path)) == [("a", 1)]


def test_the_number_of_buckets_follows_the_size(spark, tmp_path):
    path = str(tmp_path / "t")
    many = [(f"key number {n}", n) for n in range(6_000)]
    buckets.seed(spark, path, frame(spark, many[:2_000]), "k", bucket_bytes=4_000)
    first = buckets.layout(spark, path)
    assert first.n_buckets == 32  # of some 92 kB
    buckets.merge(spark, path, frame(spark, many), bucket_bytes=1_000)
    grown = buckets.layout(spark, path)
    assert grown.n_buckets > first.n_buckets and not os.path.exists(first.root)
    assert rows(buckets.read(spark, path)) == sorted(many)
    # It merges as before, and a small table has the least number.
    buckets.merge(spark, path, frame(spark, [("key number 5", -5)]))
    assert buckets.read(spark, path).where("v = -5").count() == 1
    buckets.seed(spark, f"{path}2", frame(spark, many), "k")
    assert buckets.layout(spark, f"{path}2").n_buckets == buckets.MIN_BUCKETS


def test_an_attempt_that_was_stopped_is_no_table(spark, tmp_path):
    path = str(tmp_path / "t")
    buckets.seed(spark, path, frame(spark, [("a", 1), ("b", 2)]), "k")
    os.remove(f"{path}/by8/_schema/_SUCCESS")
    assert buckets.layout(spark, path) is None
    assert buckets.seed(spark, path, frame(spark, [("c", 3)]), "k")
    assert rows(buckets.read(spark, path)) == [("c", 3)]


def test_a_table_is_entered_in_the_catalog_anew(spark, tmp_path):
    path = str(tmp_path / "t")
    buckets.seed(spark, path, frame(spark, [(f"k{n}", n) for n in range(100)]), "k")
    spark.sql(f"DROP TABLE {buckets.layout(spark, path).name}")
    assert buckets.merge(spark, path, frame(spark, [("k1", -1)]))["n_updated"] == 1
    assert buckets.read(spark, path).count() == 100


def test_a_merge_run_again_gives_the_same(spark, tmp_path):
    path = str(tmp_path / "t")
    buckets.seed(spark, path, frame(spark, [("a", 1), ("b", 2)]), "k")
    more = frame(spark, [("b", 3), ("c", 4)])
    for updated, inserted in ((1, 1), (2, 0)):
        counts = buckets.merge(spark, path, more)
        assert (counts["n_updated"], counts["n_inserted"]) == (updated, inserted)
        assert rows(buckets.read(spark, path)) == [("a", 1), ("b", 3), ("c", 4)]


def test_batches_of_a_stream_are_merged_once(spark, tmp_path):
    assert not ingest.is_merged(spark, f"{tmp_path}/s", 0)
    ingest.mark_merged(spark, f"{tmp_path}/s", 0)
    assert ingest.is_merged(spark, f"{tmp_path}/s", 0)
    assert not ingest.is_merged(spark, f"{tmp_path}/other", 0)
    assert not ingest.is_merged(spark, f"{tmp_path}/s", 1)


def test_types_and_names_are_kept(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame(
        [(1, ("x", [1.5]), "é"), (2, None, None)], "`a key` long, nested struct<s:string,d:array<double>>, `odd name` string"
    )
    buckets.seed(spark, path, df, "a key")
    got = buckets.read(spark, path)
    assert [f.dataType for f in got.schema] == [f.dataType for f in df.schema] and got.columns == df.columns
    assert buckets.merge(spark, path, df.where(F.col("a key") == 2))["n_updated"] == 1
    assert rows(buckets.read(spark, path)) == rows(df)


def test_a_large_source_finds_enough_buckets(spark, tmp_path):
    """An empty table grows before the merge, so that no task gets more than a bucket's share."""
    path = str(tmp_path / "t")
    buckets.seed(spark, path, frame(spark, []), "k")
    asked = []
    many = [(f"key number {n}", n) for n in range(500)]
    buckets.merge(spark, path, frame(spark, many), before_write=asked.append, bucket_bytes=2_000)
    assert buckets.layout(spark, path).n_buckets > 8
    assert max(asked[0]) >= 8
    assert rows(buckets.read(spark, path)) == sorted(many)


def test_a_large_source_is_shuffled_once(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    buckets.seed(spark, path, frame(spark, [(f"k{n}", n) for n in range(200)]), "k", n_buckets=4)
    frame(spark, [(f"k{n}", -n) for n in range(190, 210)]).write.parquet(f"{path}-source")
    monkeypatch.setattr(upsert, "SMALL_SOURCE_BYTES", -1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        target = buckets.scan(spark, buckets.layout(spark, path), set(range(4))).select("k", "v")
        result = upsert.merge(target, spark.read.parquet(f"{path}-source"), "k").result()
        result.collect()
        assert "ReusedExchange" in result._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
