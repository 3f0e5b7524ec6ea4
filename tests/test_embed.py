import hashlib
import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.functions import text as tx
from millrace.operators import bm25, dense, embed
from millrace.plans import queries
from tests.conftest import rows
from tests.samples import DOCUMENTS


def test_hashed_tf_idf_equals_the_formula(spark):
    texts = [*DOCUMENTS.values(), "", "a A a b", "!!!"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    encoder = embed.HashedTfIdf.fit(df, dims=32)
    got = {r["i"]: r["embedding"] for r in encoder.transform(df).collect()}

    def place(word):
        return int(hashlib.md5(word.encode()).hexdigest()[:8], 16) % 32

    counts = [Counter(place(w) for w in re.findall(r"\w+", t.lower())) for t in texts]
    df_of = Counter(p for c in counts for p in c)
    for i, c in enumerate(counts):
        want = np.zeros(32)
        for p, n in c.items():
            want[p] = n * math.log((len(texts) + 1) / (df_of[p] + 1))
        length = np.linalg.norm(want)
        assert got[i] == pytest.approx(want / length if length else want, abs=1e-6)


def test_encoder_hook(spark):
    class Lengths:
        def __init__(self):
            self.loaded = True

        def __call__(self, texts):
            return [[len(t), t.count("a"), 1.5] for t in texts]

    df = spark.createDataFrame([("x", "banana"), ("y", "")], "chunk_id string, text string")
    got = embed.encode(df, Lengths)
    assert got.columns == ["chunk_id", "text", "embedding"]
    assert rows(got.select("chunk_id", "embedding")) == [("x", [6.0, 3.0, 1.5]), ("y", [0.0, 0.0, 1.5])]
    assert embed.encode(df.where("false"), Lengths).count() == 0


def test_placed_texts_are_not_cut_into_words_again(spark):
    texts = [*DOCUMENTS.values(), "", "a A a b", "!!!", "Straße straße ÉTÉ", None]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    placed = embed.placed(df, 32)
    stored = spark.createDataFrame(placed.toPandas(), placed.schema)
    encoder = embed.HashedTfIdf.fit(stored, 32)
    assert np.allclose(encoder.idf, embed.HashedTfIdf.fit(df, 32).idf)
    found = encoder.transform(stored)
    assert found.columns == ["i", "text", "embedding"]
    assert rows(found) == rows(encoder.transform(df))
    assert "regexp_extract_all" not in found._jdf.queryExecution().toString()


def test_number_sums(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0, 4.0]), (2, []), (3, None)], "i int, embedding array<float>")
    got = embed.number_sums(df).drop("embedding")
    assert rows(got) == [(1, 3, 7.0, 17.0), (2, 0, 0.0, 0.0), (3, None, None, None)]


def test_packed_vectors_are_the_same_numbers(spark):
    df = spark.createDataFrame([(str(n), 0, t) for n, t in enumerate([*DOCUMENTS.values(), "", "!!!"])], "source_doc string, chunk_idx int, text string")
    encoder = embed.HashedTfIdf.fit(df, dims=16)
    plain, packed = encoder.transform(df), encoder.transform(df, packed=True)
    assert packed.schema["embedding"].dataType.typeName() == "binary"
    found = {r["source_doc"]: np.frombuffer(r["embedding"], "<f4").tolist() for r in packed.collect()}
    assert found == {r["source_doc"]: r["embedding"] for r in plain.collect()}
    assert rows(embed.number_sums(packed).drop("embedding")) == rows(embed.number_sums(plain).drop("embedding"))
    asked = plain.select(F.col("source_doc").alias("query_id"), "embedding")
    nearest = [rows(dense.vector_topk(v, asked, ["source_doc"], 3)) for v in (plain, packed)]
    assert nearest[0] == nearest[1] and nearest[0]
    empty = spark.createDataFrame([(1, None), (2, bytearray())], "i int, embedding binary")
    assert rows(embed.number_sums(empty).drop("embedding")) == [(1, None, None, None), (2, 0, 0.0, 0.0)]


def test_units_of_an_index_are_not_cut_into_words_again(spark):
    texts = [*DOCUMENTS.values(), "", "a A a b", None]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    cut = bm25.tokenized(df)
    stored = spark.createDataFrame(cut.collect(), cut.schema)
    placed = embed.placed(stored, 32)
    assert placed.columns == ["i", "text", embed.PLACES]
    assert "regexp_extract_all" not in placed._jdf.queryExecution().toString()
    assert rows(placed) == rows(embed.placed(df, 32))


def test_chunk_search_cuts_texts_into_words_once(spark, tmp_path, monkeypatch):
    """Chunks of documents and the questions, but not the vector table's texts again."""
    docs = [(n, text) for n, text in enumerate(DOCUMENTS.values())]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(docs, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    cut, real = [], tx.words
    monkeypatch.setattr(tx, "words", lambda text: (cut.append(1), real(text))[1])
    index, store, queries_ = queries._chunk_search(spark, str(tmp_path))
    assert len(cut) == 2
    assert store.schema["embedding"].dataType.typeName() == "binary"
    assert rows(store.drop("embedding")) == rows(index.units.drop("words"))
    assert queries_.schema["embedding"].dataType.typeName() == "array"
