"""BM25 keyword search, many queries at once."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

from millrace.functions import scores as sc
from millrace.functions import text as tx
from millrace.operators.topk import (
    QUERY_BLOCK,
    RunningBest,
    blocks,
    in_passes,
    query_passes,
    ranked,
    unit_order,
)
from millrace.sources import files, tables

KEYS = ["source_doc", "chunk_idx"]

# Scores of single words worked out at a time, some 100 MB of arrays. A word that is
# in many units and many queries would fill the memory of a task otherwise.
MAX_SCORED = 2_000_000

# Words of the units that are looked up and scored at a time, some 50 MB of arrays.
MAX_WORDS = 500_000

# (query, term) entries sent to every task in one pass; about 100 MB at most.
MAX_ENTRIES = 1_000_000


@dataclass(frozen=True)
class Bm25Index:
    """Tokenized units, document frequencies and corpus totals."""

    units: DataFrame
    terms: DataFrame
    n_units: int
    mean_words: float
    mean_raw_idf: float


def tokenized(chunks: DataFrame) -> DataFrame:
    return chunks.withColumn("words", tx.words(F.col("text")))


def _runs(words: Column) -> Column:
    """(term, tf) of a list of words: sorted, each term is a run of equal words."""

    def counted(ordered: Column, starts: Column) -> Column:
        def run(start: Column, n: Column) -> Column:
            stop = F.coalesce(F.get(starts, n + 1), F.size(ordered))
            return F.struct(F.get(ordered, start).alias("term"), (stop - start).alias("tf"))

        return F.transform(starts, run)

    def starts(ordered: Column) -> Column:
        def first(word: Column, n: Column) -> Column:
            return F.when((n == 0) | (word != F.get(ordered, n - 1)), n)

        return F.filter(F.transform(ordered, first), lambda n: n.isNotNull())

    # As arguments of a lambda, lists are worked out once.
    def whole(ordered: Column) -> Column:
        return F.transform(F.array(starts(ordered)), lambda s: counted(ordered, s))[0]

    return F.transform(F.array(F.array_sort(words)), whole)[0]


def term_frequencies(units: DataFrame) -> DataFrame:
    """(unit, term, tf, n_words).

    A unit's words are counted inside its own row: all of them are there, so
    nothing has to be shuffled.
    """
    return units.select(*KEYS, F.size("words").alias("n_words"), F.inline(_runs(F.col("words"))))


def document_frequencies(units: DataFrame) -> DataFrame:
    """(term, df), combined per task first: a word found everywhere is one row each."""
    return (
        units.select(F.explode(F.array_distinct("words")).alias("term"))
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("df"))
    )


def corpus_totals(units: DataFrame) -> DataFrame:
    """One row: number of units, words in all, mean words per unit."""
    return units.agg(
        F.count(F.lit(1)).alias("n_units"),
        F.sum(F.size("words").cast("bigint")).alias("n_words"),
        F.avg(F.size("words")).alias("mean_words"),
    )


def term_weights(terms: DataFrame, n_units: int, mean_raw: float) -> DataFrame:
    """(term, df, idf) with the floor for very common terms."""
    return terms.withColumn("idf", sc.floored_idf(sc.raw_idf(n_units, F.col("df")), mean_raw))


def _opened(units: DataFrame, terms: DataFrame) -> Bm25Index:
    totals = corpus_totals(units).first()
    n_units = totals["n_units"]
    mean_raw = terms.agg(F.avg(sc.raw_idf(n_units, F.col("df")))).first()[0]
    return Bm25Index(units, terms, n_units, totals["mean_words"] or 0.0, mean_raw or 0.0)


def build_index(chunks: DataFrame, path: str | None = None) -> Bm25Index:
    """Write the index tables once; every search reads them.

    Both are one snapshot: an index that was built before at this path is read
    until the new one is complete, and a build that failed leaves nothing.
    """
    spark = chunks.sparkSession
    path = path or files.run_dir(spark, "bm25")
    replaces = tables.newest(spark, path)
    staged = f"{path}/_staged-{uuid.uuid4().hex}"
    tokenized(chunks).write.mode("errorifexists").parquet(f"{staged}/units")
    units = spark.read.parquet(f"{staged}/units")
    document_frequencies(units).write.mode("errorifexists").parquet(f"{staged}/terms")
    tables.put_snapshot(spark, staged, path, replaces)
    return open_index(spark, path)


def open_index(spark: SparkSession, path: str) -> Bm25Index:
    current = tables.current_snapshot(spark, path)
    if current is None:
        raise FileNotFoundError(f"no index under {path}")
    return _opened(spark.read.parquet(f"{current}/units"), spark.read.parquet(f"{current}/terms"))


def query_words(queries: DataFrame) -> DataFrame:
    """(query_id, term, n): words of each query and how often it has them.

    A query without words keeps one row without a term.
    """
    return (
        queries.select("query_id", F.explode_outer(tx.words(F.col("text"))).alias("term"))
        .groupBy("query_id", "term")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _weighted(index: Bm25Index, asked: DataFrame) -> DataFrame:
    """Weights of words that the corpus has. ``asked`` must be of a measured size:
    it is sent to the tasks that read the terms, which are not shuffled."""
    idf = term_weights(index.terms, index.n_units, index.mean_raw_idf)
    known = idf.join(F.broadcast(asked), "term")
    return known.select("query_id", "term", (F.col("n") * F.col("idf")).alias("weight"))


def query_weights(
    index: Bm25Index, queries: DataFrame, max_entries: int = MAX_ENTRIES
) -> DataFrame:
    """(query_id, term, weight): idf times the number of times the query has the term."""
    asked = query_words(queries)
    parts = [_weighted(index, part) for part in query_passes(asked, "query_id", max_entries)]
    return reduce(DataFrame.unionByName, parts) if parts else _weighted(index, asked)


def _result_schema(queries: DataFrame) -> StructType:
    return StructType(
        [
            StructField("query_id", queries.schema["query_id"].dataType),
            StructField("source_doc", StringType()),
            StructField("chunk_idx", IntegerType()),
            StructField("score", DoubleType()),
        ]
    )


def _unit_ranges(unit: np.ndarray, count: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Divide postings, sorted by unit, where their counts add up to about the limit.

    A unit is never divided: its score is added up in one go, always in the same
    order, so copies of a text get the very same score.
    """
    total, first = np.cumsum(count), 0
    while first < len(unit):
        done = total[first - 1] if first else 0
        last = int(np.searchsorted(total, done + limit, side="right"))
        if last < len(unit):
            last = int(np.searchsorted(unit, unit[last]))
        if last <= first:
            last = int(np.searchsorted(unit, unit[first], side="right"))
        yield first, last
        first = last


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in parts of about ``MAX_WORDS`` words, and of one unit at least."""
    for batch in batches:
        total = np.cumsum(pc.fill_null(pc.list_value_length(batch.column("words")), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        first = 0
        while first < batch.num_rows:
            done = total[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(total, done + MAX_WORDS, side="right")))
            yield batch.slice(first, last - first)
            first = last


def _score_pass(
    index: Bm25Index, asked: pa.Table, schema: StructType, k: int, digits: int | None
) -> tuple[DataFrame, Broadcast]:
    """Score all units against one part of the queries, which is sent to the tasks."""
    asked = index.units.sparkSession.createDataFrame(asked)
    # A query none of whose words is in the corpus still gets its k units.
    nothing = {"term": F.lit(None).cast("string"), "weight": F.lit(None).cast("double")}
    everyone = asked.select("query_id").distinct().withColumns(nothing)
    weights = _weighted(index, asked).unionByName(everyone).toArrow()
    query_ids = pc.unique(weights["query_id"].combine_chunks())
    known = weights.filter(pc.is_valid(weights["weight"]))
    known = known.sort_by([("term", "ascending")])
    vocabulary = pc.unique(known["term"].combine_chunks())
    entry_term = pc.index_in(known["term"], value_set=vocabulary).to_numpy()
    entry_query = pc.index_in(known["query_id"], value_set=query_ids).to_numpy()
    entry_weight = known["weight"].to_numpy()
    n_queries, mean_words = len(query_ids), index.mean_words
    shared = index.units.sparkSession.sparkContext.broadcast(
        (query_ids, vocabulary, entry_term, entry_query, entry_weight)
    )

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, vocab, e_term, e_query, e_weight = shared.value
        parts = []
        for block in blocks(np.arange(len(ids)), QUERY_BLOCK):
            inside = (e_query >= block[0]) & (e_query <= block[-1])
            start = np.searchsorted(e_term[inside], np.arange(len(vocab) + 1))
            parts.append((block, start, e_query[inside] - block[0], e_weight[inside]))
        best = RunningBest(n_queries, k)
        for batch in _slices(batches):
            batch = batch.sort_by([(c, "ascending") for c in KEYS])
            n_units = batch.num_rows
            words = batch.column("words")
            n_words = pc.list_value_length(words).to_numpy(zero_copy_only=False)
            found = pc.index_in(words.flatten(), value_set=vocab)
            found = pc.fill_null(found, -1).to_numpy(zero_copy_only=False)
            unit = np.repeat(np.arange(n_units), n_words)[found >= 0]
            pair, tf = np.unique(unit * len(vocab) + found[found >= 0], return_counts=True)
            unit, term = np.divmod(pair, max(len(vocab), 1))
            length = 1 - sc.BM25_B + sc.BM25_B * n_words[unit] / mean_words if mean_words else 1.0
            part = tf * (sc.BM25_K1 + 1) / (tf + sc.BM25_K1 * length)
            for block, start, e_q, e_w in parts:
                scores = np.zeros((len(block), n_units))
                count = start[term + 1] - start[term]
                for first, last in _unit_ranges(unit, count, MAX_SCORED):
                    many = count[first:last]
                    posting = np.repeat(np.arange(first, last), many)
                    entry = np.arange(len(posting)) - np.repeat(np.cumsum(many) - many, many)
                    entry += start[term[posting]]
                    lowest, width = unit[first], unit[last - 1] - unit[first] + 1
                    scores[:, lowest : lowest + width] = np.bincount(
                        e_q[entry] * width + unit[posting] - lowest,
                        weights=part[posting] * e_w[entry],
                        minlength=len(block) * width,
                    ).reshape(-1, width)
                if digits is not None:
                    scores = np.round(scores, digits)
                query, row = best.keep(block, scores)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array(block[query])),
                        batch.column("source_doc").take(pa.array(row)),
                        batch.column("chunk_idx").take(pa.array(row)),
                        pa.array(scores[query, row]),
                    ],
                    names=["query_id", *KEYS, "score"],
                )

    return index.units.select(*KEYS, "words").mapInArrow(score, schema), shared


def keyword_topk(
    index: Bm25Index,
    queries: DataFrame,
    k: int,
    digits: int | None = None,
    max_entries: int = MAX_ENTRIES,
) -> DataFrame:
    """The k best units per query: (query_id, source_doc, chunk_idx, score, rk).

    With ``digits`` scores equal to that many decimals are ties, so that a ranking
    does not hang on the order of floating-point additions.

    Every unit is scored for every query, those without a common word with 0, so
    a query always gets k units if there are as many; ties come in corpus order.
    Joining query words with postings would send a row per pair of query and
    unit through a shuffle, and one word found in a third of all units makes
    that nearly all pairs; here the units are scanned once per part of the query
    side and a task hands on about k rows per query.
    """
    schema = _result_schema(queries)
    asked = files.materialize(query_words(queries), "asked")
    return in_passes(
        asked,
        "query_id",
        max_entries,
        k,
        lambda part: _score_pass(index, part, schema, k, digits),
        lambda scored: ranked(scored, ["query_id"], unit_order(KEYS), k),
        schema,
    )
