import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import bm25, chunking
from tests.conftest import rows
from tests.samples import DOCUMENTS, KEYWORD_RANKING


def words(text):
    return re.findall(r"\w+", text.lower())


def okapi(units, query):
    """Scores of (key, text) units for a query, straight from the formula."""
    tokens = [words(t) for _, t in units]
    n = len(units)
    df = Counter(w for t in tokens for w in set(t))
    raw = {w: math.log(n - d + 0.5) - math.log(d + 0.5) for w, d in df.items()}
    floor = 0.25 * sum(raw.values()) / len(raw) if raw else 0.0
    mean = sum(map(len, tokens)) / n
    found = []
    for (key, _), t in zip(units, tokens, strict=True):
        tf, score = Counter(t), 0.0
        for w in words(query):
            if tf[w]:
                idf = raw[w] if raw[w] >= 0 else floor
                score += idf * tf[w] * 2.5 / (tf[w] + 1.5 * (0.25 + 0.75 * len(t) / mean))
        found.append((key, score))
    return found


def best(units, query, k):
    scored = [(-round(s, 6) + 0.0, key) for key, s in okapi(units, query)]
    return [(key, -s + 0.0) for s, key in sorted(scored)[:k]]


def unit_frame(spark, units):
    return spark.createDataFrame(
        [(doc, idx, f"{doc}_chunk{idx}", text) for (doc, idx), text in units],
        "source_doc string, chunk_idx int, chunk_id string, text string",
    )


def search(spark, chunks, queries, k, **options):
    index = bm25.build_index(chunks)
    asked = spark.createDataFrame(list(enumerate(queries)), "query_id long, text string")
    got = {i: [] for i in range(len(queries))}
    for r in bm25.keyword_topk(index, asked, k, **options).orderBy("query_id", "rk").collect():
        got[r["query_id"]].append(((r["source_doc"], r["chunk_idx"]), r["score"]))
        assert r["rk"] == len(got[r["query_id"]])
    return got


def test_sample_rankings(spark):
    documents = spark.createDataFrame(list(DOCUMENTS.items()), "source_doc string, text string")
    chunks = chunking.drop_tiny(chunking.chunk_documents(documents))
    keys = sorted((r["source_doc"], r["chunk_idx"]) for r in chunks.collect())
    got = search(spark, chunks, list(KEYWORD_RANKING), 8)
    for i, ranking in enumerate(KEYWORD_RANKING.values()):
        hits = [(f"{d}_chunk{c}", s) for (d, c), s in got[i][: len(ranking)]]
        assert [name for name, _ in hits] == [name for name, _ in ranking]
        assert [s for _, s in hits] == pytest.approx([s for _, s in ranking], abs=1e-6)
        # Units without a word of the query follow in corpus order, with score 0.
        rest = [k for k in keys if f"{k[0]}_chunk{k[1]}" not in dict(ranking)]
        assert got[i][len(ranking) :] == [(k, 0.0) for k in rest]


def test_sample_index(spark):
    documents = spark.createDataFrame(list(DOCUMENTS.items()), "source_doc string, text string")
    index = bm25.build_index(chunking.drop_tiny(chunking.chunk_documents(documents)))
    assert (index.n_units, index.mean_words) == (8, 27.0)
    weights = bm25.term_weights(index.terms, index.n_units, index.mean_raw_idf)
    floored = weights.where("df > 4").collect()
    assert {r["term"]: r["df"] for r in floored} == {"are": 5, "days": 5}
    assert all(round(r["idf"], 6) == 0.330526 for r in floored)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(7)
    vocabulary = [f"w{i}" for i in range(60)] + ["Straße", "ñandú", "naïve", "中文"]
    units = []
    for doc in range(60):
        for idx in range(rng.randint(1, 4)):
            # "hot" is found in most units, and many units are copies.
            text = " ".join(rng.choices(vocabulary, k=rng.randint(0, 12)))
            text = "hot hot " + text if rng.random() < 0.7 else text
            copied = units and rng.random() < 0.3
            units.append(((f"d{doc:02}", idx), units[-1][1] if copied else text))
    return units


QUERIES = [
    "hot w1 w2", "w3 W3 w3 w4", "STRASSE Straße 中文", "nothing known", "", "hot", "w5, w6; ñandú"
]


@pytest.mark.parametrize("options", [{}, {"max_entries": 3}])
def test_equals_brute_force(spark, corpus, options):
    got = search(spark, unit_frame(spark, corpus).repartition(5), QUERIES, 10, **options)
    for i, query in enumerate(QUERIES):
        assert [k for k, _ in got[i]] == [k for k, _ in best(corpus, query, 10)], query
        assert [s for _, s in got[i]] == pytest.approx(
            [s for _, s in best(corpus, query, 10)], abs=2e-6
        )


def test_exact_scores_without_rounding(spark, corpus):
    got = search(spark, unit_frame(spark, corpus), ["hot w1 w2"], 5, digits=None)
    want = sorted((s for _, s in okapi(corpus, "hot w1 w2")), reverse=True)[:5]
    assert [s for _, s in got[0]] == pytest.approx(want, rel=1e-12)


def test_small_batches_and_query_blocks(spark, corpus, monkeypatch):
    monkeypatch.setattr(bm25, "QUERY_BLOCK", 2)
    monkeypatch.setattr(bm25, "MAX_SCORED", 5)
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        got = search(spark, unit_frame(spark, corpus).coalesce(2), QUERIES, 4)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    for i, query in enumerate(QUERIES):
        assert [k for k, _ in got[i]] == [k for k, _ in best(corpus, query, 4)], query


@pytest.mark.parametrize("limit", [1, 3, 10, 10**6])
def test_unit_ranges(limit):
    rng = np.random.default_rng(limit)
    unit = np.sort(rng.integers(0, 12, 40))
    count = rng.integers(0, 5, 40)
    ranges = list(bm25._unit_ranges(unit, count, limit))
    assert [first for first, _ in ranges] == [0, *[last for _, last in ranges[:-1]]]
    assert ranges[-1][1] == 40
    for first, last in ranges:
        assert first == 0 or unit[first - 1] != unit[first]
        assert count[first:last].sum() <= limit or len(set(unit[first:last])) == 1
    assert list(bm25._unit_ranges(unit[:0], count[:0], limit)) == []


def test_fewer_units_than_asked_for(spark):
    units = [(("a", 0), "one"), (("a", 1), "two"), (("b", 0), "")]
    got = search(spark, unit_frame(spark, units), ["two"], 10)
    assert [k for k, _ in got[0]] == [("a", 1), ("a", 0), ("b", 0)]


def test_no_units_and_no_queries(spark, corpus):
    assert search(spark, unit_frame(spark, corpus).where("false"), ["x"], 3) == {0: []}
    assert search(spark, unit_frame(spark, corpus), [], 3) == {}


def test_index_tables(spark, corpus, tmp_path):
    path = str(tmp_path / "index")
    built = bm25.build_index(unit_frame(spark, corpus), path)
    opened = bm25.open_index(spark, path)
    assert opened.n_units == built.n_units == len(corpus)
    want = Counter(w for _, t in corpus for w in set(words(t)))
    assert dict(rows(opened.terms.select("term", "df"))) == want
    postings = bm25.term_frequencies(opened.units)
    got = {((r["source_doc"], r["chunk_idx"]), r["term"]): (r["tf"], r["n_words"])
           for r in postings.collect()}
    assert got == {
        (key, w): (n, len(words(t))) for key, t in corpus for w, n in Counter(words(t)).items()
    }
    totals = bm25.corpus_totals(opened.units).first()
    assert totals["n_words"] == sum(len(words(t)) for _, t in corpus)
    assert totals["mean_words"] == pytest.approx(totals["n_words"] / len(corpus))


def test_units_are_not_shuffled_for_scoring(spark, corpus):
    index = bm25.build_index(unit_frame(spark, corpus))
    asked = spark.createDataFrame([(1, "hot w1")], "query_id long, text string")
    plan = bm25.keyword_topk(index, asked, 3)._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("MapInArrow") :]
    assert "Exchange" not in below and "Join" not in plan
    # Texts are left on disk.
    assert "text" not in below.split("ReadSchema")[1]
    assert bm25.term_frequencies(index.units).select(F.sum("tf")).first()[0] == sum(
        len(words(t)) for _, t in corpus
    )


def test_a_batch_is_scored_in_slices(spark, corpus, monkeypatch):
    import pyarrow as pa

    words = [["a"] * n for n in (3, 0, 9, 2, 2)]
    batch = pa.RecordBatch.from_pydict({"words": pa.array(words, pa.list_(pa.string()))})
    monkeypatch.setattr(bm25, "MAX_WORDS", 4)
    parts = list(bm25._slices([batch, batch.slice(0, 0)]))
    assert [p.num_rows for p in parts] == [2, 1, 2]
    assert pa.Table.from_batches(parts).to_pydict() == {"words": words}
