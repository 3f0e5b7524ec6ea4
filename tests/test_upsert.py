import pytest
from pyspark.sql import functions as F

from millrace.operators import upsert
from tests.conftest import rows

SCHEMA = "k string, v int, w string"


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def outcome(merged):
    """Counts that were taken while the result was written."""
    result, counts = merged.observed()
    result.write.format("noop").mode("overwrite").save()
    return tuple(counts.get[n] for n in ("n_updated", "n_inserted", "n_kept"))


TARGET = [("a", 1, "o"), ("b", 2, "o"), ("b", 3, "o2"), (None, 4, "o")]
SOURCE = [("b", 9, None), ("c", 5, "n"), (None, 6, "n")]
MERGED = [
    ("a", 1, "o"),
    ("b", 9, None),
    ("b", 9, None),
    ("c", 5, "n"),
    (None, 4, "o"),
    (None, 6, "n"),
]


def test_edge_rows(spark):
    merged = upsert.merge(frame(spark, TARGET), frame(spark, SOURCE), "k")
    assert rows(merged.result()) == sorted(MERGED, key=repr)
    assert merged.result().columns == ["k", "v", "w"]
    assert outcome(merged) == (2, 2, 2)


def test_large_source(spark, monkeypatch):
    monkeypatch.setattr(upsert, "SMALL_SOURCE_BYTES", 1)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        merged = upsert.merge(frame(spark, TARGET), frame(spark, SOURCE), "k")
        assert "Broadcast" not in merged.result()._jdf.queryExecution().toString()
        assert rows(merged.result()) == sorted(MERGED, key=repr)
        assert outcome(merged) == (2, 2, 2)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_small_source_leaves_the_target_unshuffled(spark, tmp_path):
    path = str(tmp_path / "t")
    frame(spark, TARGET).write.parquet(path)
    merged = upsert.merge(spark.read.parquet(path), frame(spark, SOURCE), "k")
    plan = merged.kept_and_updated._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_applying_again_changes_nothing(spark):
    source = frame(spark, [r for r in SOURCE if r[0]])
    once = upsert.merge(frame(spark, TARGET), source, "k").result()
    twice = upsert.merge(once, source, "k")
    assert rows(twice.result()) == rows(once)
    assert outcome(twice)[1] == 0


def test_source_columns_in_other_order(spark):
    source = frame(spark, SOURCE).select("w", "k", "v")
    merged = upsert.merge(frame(spark, TARGET), source, "k").result()
    assert rows(merged) == sorted(MERGED, key=repr)


def test_repeated_source_key_that_matches_is_an_error(spark):
    source = frame(spark, [("b", 1, "x"), ("b", 2, "y")])
    with pytest.raises(upsert.AmbiguousSource, match="'b'"):
        upsert.merge(frame(spark, TARGET), source, "k")


def test_repeated_source_key_without_match_is_inserted(spark):
    source = frame(spark, [("z", 1, "x"), ("z", 2, "y"), (None, 1, "x"), (None, 1, "x")])
    merged = upsert.merge(frame(spark, TARGET), source, "k")
    assert rows(merged.result()) == sorted(
        TARGET + [("z", 1, "x"), ("z", 2, "y"), (None, 1, "x"), (None, 1, "x")], key=repr
    )


def test_latest_source_row_counts(spark):
    source = frame(spark, [("b", 1, "x"), ("b", 7, "y"), ("n", 3, "p"), ("n", None, "q")])
    merged = upsert.merge(frame(spark, TARGET), source, "k", latest_by=F.col("v")).result()
    want = [("a", 1, "o"), ("b", 7, "y"), ("b", 7, "y"), (None, 4, "o"), ("n", 3, "p")]
    assert rows(merged) == sorted(want, key=repr)
    # Rows whose order is unknown come first, so they lose; alone they count.
    source = frame(spark, [("n", None, "p"), ("n", None, "q")])
    merged = upsert.merge(frame(spark, []), source, "k", latest_by=F.col("v")).result()
    assert rows(merged) == [("n", None, "q")]


def test_empty_sides(spark):
    none = frame(spark, [])
    assert rows(upsert.merge(none, frame(spark, SOURCE), "k").result()) == sorted(SOURCE, key=repr)
    assert rows(upsert.merge(frame(spark, TARGET), none, "k").result()) == sorted(TARGET, key=repr)
    assert outcome(upsert.merge(none, frame(spark, SOURCE), "k")) == (0, 3, 0)


def test_one_key_with_a_third_of_all_rows(spark):
    """A hot key in target and source, and the plan Spark can split it in."""
    n = 30_000
    target = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"),
        F.lit(0).alias("v"),
    )
    source = spark.createDataFrame([("hot", 1), ("1", 2), ("new", 3)], "k string, v int")
    merged = upsert.merge(target, source, "k")
    assert outcome(merged) == (n // 3 + 1, 1, n - n // 3 - 1)
    plan = merged.result()._jdf.queryExecution().toString()
    assert "FullOuter" not in plan and "CartesianProduct" not in plan
    hot = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id").cast("int").alias("v"),
    )
    merged = upsert.merge(source, hot, "k", latest_by=F.col("v")).result()
    assert merged.where("k = 'hot'").first()["v"] == n - 3


def test_wide_rows_are_measured_in_bytes(spark):
    """Few rows can be too much to send to every task."""
    wide = spark.range(40).select(
        F.col("id").cast("string").alias("k"), F.lit(0).alias("v"), F.repeat(F.lit("x"), 1 << 20).alias("w")
    )
    assert "Broadcast" not in upsert.merge(
        wide.limit(1), wide, "k"
    ).kept_and_updated._jdf.queryExecution().optimizedPlan().toString()
    narrow = wide.withColumn("w", F.lit("x"))
    assert "strategy=broadcast" in upsert.merge(
        narrow, narrow, "k"
    ).kept_and_updated._jdf.queryExecution().optimizedPlan().toString()
