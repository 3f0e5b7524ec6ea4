"""Pruned search against the scan of all units; segments against an index built anew."""

import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import bm25, postings
from millrace.sources import feeds
from tests.conftest import rows
from tests.test_buckets import files_of


def chunks(spark, texts, first=0):
    data = [(f"d{first + n:04d}", 0, f"d{first + n:04d}_chunk0", t) for n, t in enumerate(texts)]
    return spark.createDataFrame(data, "source_doc string, chunk_idx int, chunk_id string, text string")


def prose(n, seed, vocabulary=300):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(vocabulary)]

    def text():
        topic = rng.randrange(10) * vocabulary // 10
        near = [words[topic + rng.randrange(vocabulary // 10)] for _ in range(rng.randint(2, 12))]
        common = [words[min(int(rng.expovariate(0.1)), vocabulary - 1)] for _ in range(rng.randint(1, 30))]
        return " ".join(near + common)

    return [text() for _ in range(n)]


QUESTIONS = [
    (1, "w3 w40 w41 w41"), (2, "w299"), (3, "w0 w1 w2"), (4, "nothing known"), (5, ""), (6, "w150 w151 w152 w153 w1 w0"),
    (7, "only-here w0"),
]


@pytest.fixture(scope="module")
def corpus(spark):
    texts = prose(900, 1) + ["w3 w40 w41 again"] * 300 + ["only here"]
    return chunks(spark, texts)


@pytest.fixture(scope="module")
def questions(spark):
    return spark.createDataFrame(QUESTIONS, "query_id long, text string")


@pytest.fixture(scope="module")
def built(spark, corpus, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("postings") / "i")
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(postings, "RANGE_BITS", 5)
        postings.add(spark, path, corpus)
    return path


@pytest.mark.parametrize("k, digits", [(3, None), (10, 6), (40, 6)])
def test_pruned_search_equals_the_scan(spark, built, corpus, questions, k, digits):
    index = postings.open_index(spark, built)
    found = postings.keyword_topk(spark, index, questions, k, digits)
    want = bm25.keyword_topk(bm25.build_index(corpus), questions, k, digits)
    assert found.columns == want.columns
    strip = lambda df: rows(df.withColumn("score", F.round("score", 9)))
    assert strip(found) == strip(want)


def test_search_in_several_passes(spark, built, questions):
    index = postings.open_index(spark, built)
    whole = postings.keyword_topk(spark, index, questions, 5, 6)
    parts = postings.keyword_topk(spark, index, questions, 5, 6, max_entries=6)
    assert rows(parts) == rows(whole)


def _read_by_scans(df, table):
    """Rows and files that the scans of a table read, by Spark's own count, after the frame has run."""
    df._jdf.queryExecution().toRdd().count()
    plan = df._jdf.queryExecution().executedPlan()
    n_rows = n_files = 0

    def walk(node):
        nonlocal n_rows, n_files
        if "AdaptiveSparkPlan" in node.nodeName():
            return walk(node.executedPlan())
        if "QueryStage" in node.getClass().getSimpleName():
            walk(node.plan())
        if "Scan parquet" in node.nodeName() and table in node.toString():
            n_rows += node.metrics().apply("numOutputRows").value()
            n_files += node.metrics().apply("numFiles").value()
        for n in range(node.children().size()):
            walk(node.children().apply(n))

    walk(plan)
    return n_rows, n_files


def test_only_partitions_of_asked_terms_are_read(spark, built):
    index = postings.open_index(spark, built)
    asked = postings.frequencies(spark, built, index.segments).where(F.col("term").isin("w299", "w40"))
    asked = asked.select(F.lit(1).alias("query_id"), "term", "term_bucket", F.lit(1.0).alias("weight"))
    wanted = {r["term_bucket"] for r in asked.collect()}
    found = postings.asked_blocks(spark, index, asked, "postings")
    there = index.table(spark, "blocks")
    inside = there.where(F.col("term_bucket").isin(sorted(wanted))).count()
    n_rows, n_files = _read_by_scans(found, "blocks")
    assert 0 < n_rows == inside < there.count() / 4
    lying = [f for f in files_of(f"{built}/blocks") if int(f.split("term_bucket=")[1].split("/")[0]) in wanted]
    assert n_files == len(lying) < len(files_of(f"{built}/blocks")) / 4


def test_ranges_are_skipped(spark, built, questions):
    """Many ranges of a question are left out, though two of its words are everywhere."""
    index = postings.open_index(spark, built)
    words = bm25.query_words(questions.where("query_id = 6"))
    known = postings.frequencies(spark, built, index.segments).join(words, "term")
    idf = postings.weights(spark, index).select("term", "idf")
    asked = known.join(idf, "term").withColumn("weight", F.col("n") * F.col("idf")).drop("idf").cache()
    first = postings._first_ranges(spark, index, asked, 3)
    seeds = postings._scored(spark, index, asked, first, None, 3).orderBy(F.desc("score")).limit(3).collect()
    floors = spark.createDataFrame([(6, seeds[-1]["score"])], "query_id long, floor double")
    left = postings._candidate_ranges(spark, index, asked, floors).count()
    every = postings.asked_blocks(spark, index, asked).select("segment", "range").distinct().count()
    assert 0 < left < every * 2 / 3


def test_bounds_hold_for_every_posting(spark, built):
    index = postings.open_index(spark, built)
    blocks = index.table(spark, "blocks").withColumn("weight", F.lit(1.0)).withColumn("bound", postings._bound(index))
    each = blocks.select("bound", F.inline("postings"))
    over = each.where(postings._share(index, F.col("tf"), F.col("n_words")) > F.col("bound"))
    assert over.count() == 0


def test_segments_equal_an_index_built_anew(spark, questions, tmp_path):
    path = str(tmp_path / "i")
    old, new = prose(200, 2), prose(80, 3)
    assert postings.add(spark, path, chunks(spark, old)) == 0
    before = files_of(path)
    # 150 to 199 get new texts and 200 to 229 come on top.
    assert postings.add(spark, path, chunks(spark, new, first=150)) == 1
    assert files_of(path).items() >= before.items()
    # Some of the replaced ones are replaced again, and one goes.
    gone = spark.createDataFrame([("d0003",)], "source_doc string")
    assert postings.add(spark, path, chunks(spark, prose(20, 4), first=190), replaced=gone) == 2
    texts = {f"d{n:04d}": t for n, t in enumerate(old)}
    texts |= {f"d{150 + n:04d}": t for n, t in enumerate(new)}
    texts |= {f"d{190 + n:04d}": t for n, t in enumerate(prose(20, 4))}
    del texts["d0003"]
    whole = spark.createDataFrame([(d, 0, f"{d}_chunk0", t) for d, t in texts.items()], chunks(spark, []).schema)
    fresh = bm25.build_index(whole)
    index = postings.open_index(spark, path)
    assert (index.n_units, round(index.mean_words, 9)) == (fresh.n_units, round(fresh.mean_words, 9))
    strip = lambda df: rows(df.select("term", "df", F.round("idf", 9)))
    assert strip(postings.weights(spark, index)) == strip(bm25.term_weights(fresh.terms, fresh.n_units, fresh.mean_raw_idf))
    for k in (3, 12):
        assert rows(postings.keyword_topk(spark, index, questions, k, 6)) == rows(bm25.keyword_topk(fresh, questions, k, 6))


def test_a_stopped_segment_is_not_there(spark, tmp_path):
    path = str(tmp_path / "i")
    postings.add(spark, path, chunks(spark, ["one two", "two three"]))
    chunks(spark, ["lost"]).select("source_doc").write.parquet(f"{path}/units/segment=1")
    assert postings.open_index(spark, path).segments == (0,)
    assert postings.add(spark, path, chunks(spark, ["four"], first=7)) == 2
    assert postings.open_index(spark, path).n_units == 3


def test_empty_indexes_and_questions(spark, questions, tmp_path):
    path = str(tmp_path / "i")
    with pytest.raises(FileNotFoundError):
        postings.open_index(spark, path)
    postings.add(spark, path, chunks(spark, []))
    index = postings.open_index(spark, path)
    assert index.n_units == 0 and postings.keyword_topk(spark, index, questions, 3).collect() == []
    postings.add(spark, path, chunks(spark, ["one two", ""]))
    index = postings.open_index(spark, path)
    asked = spark.createDataFrame([(1, "two"), (2, None)], "query_id long, text string")
    found = postings.keyword_topk(spark, index, asked, 3, 6).select("query_id", "source_doc", "rk")
    assert rows(found) == [(1, "d0000", 1), (1, "d0001", 2), (2, "d0000", 1), (2, "d0001", 2)]
    assert postings.keyword_topk(spark, index, asked.limit(0), 3).collect() == []


def test_blocks_are_written_where_they_are_made(spark, tmp_path):
    """All terms of a range are written by one task, so no posting went through a shuffle."""
    path = str(tmp_path / "i")
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(postings, "TASK_BYTES", 1)
        patch.setattr(postings, "RANGE_BITS", 5)
        postings.add(spark, path, chunks(spark, prose(600, 5)).repartition(6))
    task = F.regexp_extract(F.col("_metadata.file_name"), r"^part-(\d+)-", 1)
    blocks = spark.read.parquet(f"{path}/blocks/segment=0").select("range", task.alias("task"))
    each = blocks.groupBy("range").agg(F.count_distinct("task").alias("tasks"))
    assert blocks.select("task").distinct().count() > 1
    assert each.where("tasks > 1").count() == 0
    # Numbers follow the keys within a range.
    units = spark.read.parquet(f"{path}/units/segment=0").orderBy("unit").collect()
    by_range = {}
    for row in units:
        by_range.setdefault(row["unit"] >> 5, []).append(row["source_doc"])
    assert all(docs == sorted(docs) for docs in by_range.values()) and sum(map(len, by_range.values())) == 600


def test_languages_of_repeated_documents(spark, tmp_path):
    data = [(1, "a", "fr"), (1, "b", "de"), (1, "b", None), (2, "c", "en"), (None, "d", "fr"), (3, None, None)]
    documents = spark.createDataFrame(data, "doc_id long, text string, lang string")
    want = sorted(((str(i), t, other) for i, t, _ in data for j, _, other in data if i is not None and i == j), key=repr)
    documents.write.parquet(str(tmp_path / "documents.parquet"))
    assert rows(feeds.document_languages(spark, str(tmp_path))) == want
    once = documents.where("doc_id > 1")
    once.write.parquet(str(tmp_path / "once" / "documents.parquet"))
    found = feeds.document_languages(spark, str(tmp_path / "once"))
    assert rows(found) == [("2", "c", "en"), ("3", None, None)]
    assert "Join" not in found._jdf.queryExecution().optimizedPlan().toString()
