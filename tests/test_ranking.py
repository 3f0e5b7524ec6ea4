"""Fusion, reranking and prompts."""

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from millrace.operators import bm25, chunking, embed, fusion, prompts, rerank
from millrace.plans import retrieval
from tests.conftest import rows
from tests.samples import DOCUMENTS, KEYWORD_RANKING


def ranking(spark, names, query=1):
    return spark.createDataFrame(
        [(query, name, rk) for rk, name in enumerate(names, 1)],
        "query_id int, chunk_id string, rk int",
    )


def fused(df):
    return [(r["chunk_id"], round(r["score"], 6)) for r in df.orderBy("query_id", "rk").collect()]


def by_dict(lists, k=60):
    """Scores gathered list by list; a stable sort keeps the order of meeting."""
    scores = {}
    for names in lists:
        for rk, name in enumerate(names, 1):
            scores[name] = scores.get(name, 0.0) + 1 / (k + rk)
    return [(n, round(s, 6)) for n, s in sorted(scores.items(), key=lambda e: -e[1])]


def test_tied_lists(spark):
    df = fusion.fuse([ranking(spark, "xyp"), ranking(spark, "yxq")], ["chunk_id"])
    assert fused(df) == [("x", 0.032522), ("y", 0.032522), ("p", 0.015873), ("q", 0.015873)]


@pytest.mark.parametrize(
    "lists",
    [["abc"], ["abc", "cba"], ["abcdefghij", "jihgfedcba"], ["ab", "cd", "ba"], ["abc", "", "b"]],
)
def test_fusion_equals_the_dictionary_form(spark, lists):
    df = fusion.fuse([ranking(spark, names) for names in lists], ["chunk_id"])
    assert fused(df) == by_dict(lists)


def test_fusion_keeps_queries_apart_and_limits(spark):
    a = ranking(spark, "xy", 1).unionByName(ranking(spark, "yx", 2))
    df = fusion.fuse([a, a], ["chunk_id"], top_k=1)
    assert rows(df.select("query_id", "chunk_id", "rk")) == [(1, "x", 1), (2, "y", 1)]


UNITS = [("d", 0, "d_chunk0", "red green"), ("d", 1, "d_chunk1", "Red, red"), ("e", 0, "e_chunk0", "x")]


@pytest.fixture
def units(spark):
    return spark.createDataFrame(
        UNITS, "source_doc string, chunk_idx int, chunk_id string, text string"
    )


@pytest.fixture
def candidates(spark):
    return spark.createDataFrame(
        [(1, "e", 0, 0.5, 1), (1, "d", 1, 0.4, 2), (1, "d", 0, 0.3, 3), (2, "d", 1, 0.3, 1)],
        "query_id int, source_doc string, chunk_idx int, score double, rk int",
    )


def test_built_in_scorer(spark, units, candidates):
    weights = spark.createDataFrame(
        [(1, "red", 1.0), (1, "green", 3.0), (1, "other", None), (2, None, None)],
        "query_id int, term string, weight double",
    )
    got = rerank.term_share(candidates, units, weights, bm25.KEYS, 2)
    found = got.orderBy("query_id", "rk").select("query_id", "chunk_id", "score", "rk").collect()
    assert [tuple(r) for r in found] == [
        (1, "d_chunk0", 1.0, 1),
        (1, "d_chunk1", 0.25, 2),
        (2, "d_chunk1", 0.0, 1),
    ]


def test_any_scorer(spark, units, candidates):
    queries = spark.createDataFrame([(1, "red"), (2, "x")], "query_id int, text string")

    @pandas_udf("double")
    def model(question: pd.Series, text: pd.Series) -> pd.Series:
        return pd.Series([float(t.lower().count(q)) for q, t in zip(question, text, strict=True)])

    for scorer in (model, lambda q, t: F.size(F.split(F.lower(t), q)) - 1):
        got = rerank.rerank(candidates, units, queries, bm25.KEYS, scorer, 3)
        assert rows(got.select("query_id", "rk", "chunk_id")) == [
            (1, 1, "d_chunk1"), (1, 2, "d_chunk0"), (1, 3, "e_chunk0"), (2, 1, "d_chunk1"),
        ]


def test_units_are_not_shuffled_for_their_texts(spark, units, candidates, tmp_path):
    units.write.parquet(str(tmp_path / "units"))
    stored = spark.read.parquet(str(tmp_path / "units"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        found = rerank.with_text(rerank.settled(candidates), stored, bm25.KEYS)
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
    assert found.count() == candidates.count()


def test_missing_units_are_found(spark, units, candidates):
    lost = units.where("chunk_idx = 0")
    missing = rerank.missing_units(candidates, lost, bm25.KEYS)
    assert rows(missing.select("query_id", "source_doc", "chunk_idx")) == [(1, "d", 1), (2, "d", 1)]
    assert rerank.missing_units(candidates, units, bm25.KEYS).count() == 0


def test_context_and_prompt(spark):
    kept = spark.createDataFrame(
        [(1, 2, "b_chunk0", "two\nlines"), (1, 1, "a_chunk3", "one"), (2, 1, "a_chunk3", "one")],
        "query_id int, rk int, chunk_id string, text string",
    ).repartition(3)
    context = prompts.context_blocks(kept)
    assert dict(rows(context)) == {
        1: "[Source: a_chunk3]\none\n\n[Source: b_chunk0]\ntwo\nlines",
        2: "[Source: a_chunk3]\none",
    }
    queries = spark.createDataFrame([(1, "Why?"), (2, "How?")], "query_id int, text string")
    got = {r["query_id"]: r for r in prompts.prompts(context, queries, "rules").collect()}
    assert got[2]["user_prompt"] == "Context:\n[Source: a_chunk3]\none\n\nQuestion: How?"
    assert got[1]["system_prompt"] == "rules"


def test_from_questions_to_prompts(spark):
    documents = spark.createDataFrame(list(DOCUMENTS.items()), "source_doc string, text string")
    index = bm25.build_index(chunking.drop_tiny(chunking.chunk_documents(documents)))
    encoder = embed.HashedTfIdf.fit(index.units)
    vectors = encoder.transform(index.units.select(*bm25.KEYS, "text"))
    asked = spark.createDataFrame(list(enumerate(KEYWORD_RANKING)), "query_id long, text string")
    queries = encoder.transform(asked)
    best = retrieval.reranked_topk(index, vectors, queries, 1)
    first = dict(rows(best.select("query_id", "chunk_id")))
    assert first[0].startswith("doc4.txt") and first[1] == "doc2.txt_chunk0"
    made = retrieval.answer_prompts(index, vectors, queries, "Cite.").orderBy("query_id").collect()
    assert [r["query_id"] for r in made] == list(range(len(KEYWORD_RANKING)))
    for r, question in zip(made, KEYWORD_RANKING, strict=True):
        assert r["user_prompt"].startswith("Context:\n[Source: doc")
        assert r["user_prompt"].endswith(f"\n\nQuestion: {question}")
        assert r["user_prompt"].count("[Source: ") == 2
