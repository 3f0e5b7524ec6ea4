import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from millrace.functions.contract import ORDER_SCHEMA
from millrace.sources import feeds, files, tables
from tests.conftest import rows
from tests.samples import BRONZE


def test_append_keeps_repeated_batches(spark, orders, tmp_path):
    path = str(tmp_path / "bronze")
    for _ in range(2):
        tables.append(orders(BRONZE), path, ORDER_SCHEMA)
    assert rows(tables.read_appended(spark, path, ORDER_SCHEMA)) == sorted(BRONZE * 2, key=repr)


def test_numbered_batches(spark, orders, tmp_path):
    path = str(tmp_path / "bronze")
    tables.put_batch(orders(BRONZE), path, ORDER_SCHEMA, 0)
    tables.put_batch(orders(BRONZE[:1]), path, ORDER_SCHEMA, 1)
    tables.put_batch(orders(BRONZE[1:3]), path, ORDER_SCHEMA, 1)
    assert rows(tables.read_appended(spark, path, ORDER_SCHEMA)) == sorted(
        BRONZE + BRONZE[1:3], key=repr
    )
    assert rows(tables.add_batch(orders(BRONZE[:1]), path, ORDER_SCHEMA)) == BRONZE[:1]
    assert sorted(os.listdir(path)) == ["batch_id=0", "batch_id=1", "batch_id=2"]


@pytest.mark.parametrize(
    "change, problem",
    [
        (lambda d: d.withColumn("unexpected_column", F.lit("x")), "unexpected column"),
        (lambda d: d.select("order_id", F.lit("x").alias("unexpected_column")), "unexpected"),
        (lambda d: d.drop("order_id"), "missing required column order_id"),
        (lambda d: d.withColumn("price", F.col("price").cast("string")), "price is string"),
        (lambda d: d.withColumn("quantity", F.col("quantity").cast("bigint")), "quantity is"),
    ],
)
def test_append_refuses_other_schemas(spark, orders, tmp_path, change, problem):
    path = str(tmp_path / "bronze")
    tables.append(orders(BRONZE), path, ORDER_SCHEMA)
    with pytest.raises(tables.SchemaMismatch, match=problem):
        tables.append(change(orders(BRONZE)), path, ORDER_SCHEMA)
    assert tables.read_appended(spark, path, ORDER_SCHEMA).count() == len(BRONZE)


def test_append_fills_missing_and_reorders(spark, orders, tmp_path):
    path = str(tmp_path / "bronze")
    tables.append(orders(BRONZE).select("product", "order_id"), path, ORDER_SCHEMA)
    got = rows(tables.read_appended(spark, path, ORDER_SCHEMA))
    assert got == sorted([(o, None, p, None, None) for o, _, p, _, _ in BRONZE], key=repr)


def test_append_refuses_null_in_required_column(spark, tmp_path):
    path = str(tmp_path / "bronze")
    bad = spark.createDataFrame([(None, "p")], "order_id string, product string")
    with pytest.raises(PySparkException, match="null in required column order_id"):
        tables.append(bad, path, ORDER_SCHEMA)


def test_snapshots(spark, orders, tmp_path):
    path = str(tmp_path / "silver")
    assert tables.current_snapshot(spark, path) is None
    with pytest.raises(FileNotFoundError):
        tables.read_snapshot(spark, path)
    assert tables.seed(spark, path, orders(BRONZE))
    assert not tables.seed(spark, path, orders(BRONZE[:1]))
    assert rows(tables.read_snapshot(spark, path)) == BRONZE
    # The new table is computed from the one it replaces.
    current = tables.read_snapshot(spark, path)
    tables.publish(current.where("quantity > 1"), path)
    assert rows(tables.read_snapshot(spark, path).select("order_id")) == [("ORD002",), ("ORD007",)]
    # A write that did not finish has no number.
    os.makedirs(f"{path}/_staged-x")
    assert tables.current_snapshot(spark, path).endswith("v00000002")
    assert tables.publish(orders(BRONZE[:1]), path).endswith("v00000003")
    assert rows(tables.read_snapshot(spark, path)) == BRONZE[:1]


def test_second_of_two_writers_is_refused(spark, orders, tmp_path):
    """Both have read the same snapshot; neither's rows may be lost."""
    path = str(tmp_path / "silver")
    tables.publish(orders(BRONZE[:1]), path)
    read = tables.newest(spark, path)
    tables.publish(orders(BRONZE[:2]), path, replaces=read)
    with pytest.raises(tables.ConcurrentPublish):
        tables.publish(orders(BRONZE[2:3]), path, replaces=read)
    assert rows(tables.read_snapshot(spark, path)) == BRONZE[:2]
    assert not [n for n in os.listdir(path) if n.startswith("_staged")]


def test_failed_publish_leaves_the_table(spark, orders, tmp_path):
    path = str(tmp_path / "silver")
    tables.publish(orders(BRONZE), path)
    failing = orders(BRONZE).withColumn("price", F.raise_error(F.lit("boom")).cast("double"))
    with pytest.raises(PySparkException, match="boom"):
        tables.publish(failing, path)
    assert rows(tables.read_snapshot(spark, path)) == BRONZE


def test_shared_dir_is_the_named_one(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    folder = files.run_dir(spark, "x")
    assert folder != files.run_dir(spark, "x")
    if named:
        assert folder.startswith(named)


def test_no_local_folder_on_a_cluster():
    class Context:
        master, applicationId = "spark://host:7077", "app"

    class Conf:
        @staticmethod
        def get(key, default=None):
            return default

    class Session:
        conf, sparkContext = Conf, Context

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        files.shared_dir(Session)
    Context.master = "local[2]"
    assert os.path.isdir(files.shared_dir(Session))


def test_spread_only_small_inputs(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).coalesce(1).write.parquet(path)
    assert files.spread(spark.read.parquet(path)).rdd.getNumPartitions() == 8
    many = str(tmp_path / "many")
    spark.range(1000).repartition(20).write.parquet(many)
    plan = files.spread(spark.read.parquet(many))._jdf.queryExecution().toString()
    assert "RoundRobin" not in plan


def test_text_files(spark, tmp_path):
    (tmp_path / "b.txt").write_text("línea 1\nline 2\n", encoding="utf-8")
    (tmp_path / "a.txt").write_text("", encoding="utf-8")
    (tmp_path / "c.md").write_text("no", encoding="utf-8")
    got = rows(feeds.text_files(spark, f"{tmp_path}/*.txt"))
    assert ("b.txt", "línea 1\nline 2\n") in got
    assert all(name != "c.md" for name, _ in got)


def test_quarantine_is_appended(spark, tmp_path):
    path = str(tmp_path / "q")
    bad = spark.createDataFrame([("{}", "r")], "raw string, rejection_reason string")
    feeds.append_quarantine(bad, path)
    feeds.append_quarantine(bad, path)
    assert rows(feeds.read_quarantine(spark, path, bad.schema)) == [("{}", "r")] * 2
