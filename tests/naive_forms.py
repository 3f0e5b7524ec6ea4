"""Time the naive forms of three steps against the ones that are used.

    python tests/naive_forms.py /root/testdata/sf0.1
"""

from __future__ import annotations

import sys
import time

from pyspark.sql import SparkSession, Window
from pyspark.sql import functions as F

sys.path.insert(0, ".")

from millrace.operators import bm25, dense, upsert
from millrace.plans import queries as q
from millrace.sources import buckets, feeds, files, tables


def timed(run) -> float:
    begun = time.perf_counter()
    run()
    return round(time.perf_counter() - begun, 2)


def done(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def keyword(spark, sf_dir):
    """An index for each of three questions, against one for all questions."""
    asked = feeds.query_feed(spark, sf_dir)
    some = [r[0] for r in asked.select("query_id").limit(3).collect()]

    def naive():
        for query in some:
            index = bm25.build_index(q._chunks(spark, sf_dir))
            done(bm25.keyword_topk(index, asked.where(F.col("query_id") == query), 10))

    def used():
        done(bm25.keyword_topk(bm25.build_index(q._chunks(spark, sf_dir)), asked, 10))

    return "BM25, index per question (3 questions) / one index (all questions)", naive, used


def ranking(spark, sf_dir):
    """All pairs scored, sorted and numbered, against the running best of each task."""
    vectors, asked = q._embeddings(spark, sf_dir), q._query_vectors(spark, sf_dir)
    asked = asked.where("embedding IS NOT NULL")

    def naive():
        pairs = vectors.crossJoin(F.broadcast(asked.select("query_id", F.col("embedding").alias("other"))))
        product = F.aggregate(
            F.zip_with("embedding", "other", lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x
        )
        window = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        scored = pairs.select("query_id", "vec_id", product.alias("score"))
        done(scored.withColumn("rk", F.rank().over(window)).withColumn("of", F.count("*").over(
            Window.partitionBy("query_id"))).where("rk <= 10"))

    def used():
        done(dense.vector_topk(vectors, asked, ["vec_id"], 10))

    return "vector search, all pairs sorted / best of each task", naive, used


def merging(spark, sf_dir):
    """A hundred rows into a table, which is rewritten whole or by buckets."""
    orders = feeds.table(spark, sf_dir, "lineitem").withColumn(
        "k", F.concat_ws("-", "l_orderkey", "l_linenumber")
    )
    whole, parts = files.run_dir(spark, "whole"), files.run_dir(spark, "parts")
    tables.publish(orders, whole)
    buckets.seed(spark, parts, orders, "k", n_buckets=512)
    few = files.materialize(orders.limit(100).withColumn("l_quantity", F.lit(0.0).cast(
        orders.schema["l_quantity"].dataType)), "few")

    def naive():
        tables.publish(upsert.merge(tables.read_snapshot(spark, whole), few, "k").result(), whole)

    def used():
        buckets.merge(spark, parts, few)

    return "merge of 100 rows into lineitem, whole table / 512 buckets", naive, used


if __name__ == "__main__":
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    for make in (keyword, ranking, merging):
        name, naive, used = make(session, sys.argv[1])
        timed(used)
        print(f"| {name} | {timed(naive)} | {timed(used)} |", flush=True)
