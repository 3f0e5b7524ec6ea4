"""BM25 postings by term, searched by bounds, in segments that are added and replaced.

An index is four Parquet tables, each partitioned by ``segment``; adding documents writes
one more segment and reads nothing but what it replaces.

* ``units``: key, number in the segment, words. Each writing task numbers its units in the
  order of their keys, from a start of its own, so numbers have gaps between tasks;
* ``blocks``, also partitioned by ``term_bucket``: one row per term and range of
  ``2^RANGE_BITS`` unit numbers, with the postings there, their number, the largest term
  frequency and the shortest length. A task writes the blocks of its units where they are
  made, so nothing is shuffled, and a file holds all terms of its bucket over some ranges;
* ``terms``, also by ``term_bucket``: per term the change of its document frequency that the
  segment makes, and the same two bounds over all of its blocks;
* ``dead``: units of earlier segments that the segment replaces.
* ``totals``, written last: the changes of the numbers of units and words. A segment without
  it is not there.

Counts of the corpus are sums over segments; weights are worked out from them when read, so
old units are never tokenized again.

A search reads the partitions of the asked terms only. Scores are bounded by what the
largest frequency and the shortest length of a block would give, whatever the mean length:

1. Each query's rarest terms lead to some ranges with high bounds. All of their units are
   scored, and the k-th best score there is a lower bound of the final one.
2. Terms whose bounds together stay below it cannot lift a unit into the result alone. Only
   ranges with blocks of the other, essential terms are looked at, from the bounds alone,
   and those whose bounds add up to less are skipped (MaxScore, by blocks).
3. Units of the ranges that are left are scored in full, range by range, for all queries
   that look at it at once, and ranked; ties go by unit key.

Nothing is cut off: a range is skipped only if no unit of it can be among the best k. A
query with fewer than k units above 0 gets units without its words, in corpus order.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType

from millrace.functions import scores as sc
from millrace.operators import bm25
from millrace.operators.bm25 import KEYS
from millrace.operators.topk import query_passes, ranked, unit_order
from millrace.sources import files

#: At most 64 - 2 * 27.
RANGE_BITS = 10
#: Partitions of the terms; so many that one is a few hundred megabytes.
TERM_BUCKETS = 16
#: Bytes of a row group of blocks, of which a task holds one for each bucket.
BLOCK_BYTES = 16 << 20
#: Bytes of stored units that a task makes blocks of, at least.
TASK_BYTES = 1 << 20
#: Scores of single words that are worked out at a time, some 100 MB of arrays.
MAX_SCORED = 2_000_000
#: Ranges that each query scores first.
FIRST_RANGES = 8
_SLACK = 1e-9
#: A posting is one number: the unit's place in its range, the frequency and the length, of so
#: many bits each; Spark holds no list of 2^27 words.
_COUNT_BITS = 27
_COUNT = (1 << _COUNT_BITS) - 1
#: Stands for the number of a term in the row of a range's replaced units.
_DEAD = -1
_UNIT = ["segment", "unit"]
_RANGE = ["segment", "range"]


@dataclass(frozen=True)
class PostingIndex:
    """An opened index: its path, its segments and the counts over all of them."""

    path: str
    segments: tuple[int, ...]
    term_buckets: int
    n_units: int
    n_words: int
    mean_raw_idf: float

    @property
    def mean_words(self) -> float:
        return self.n_words / self.n_units if self.n_units else 0.0

    def table(self, spark: SparkSession, name: str) -> DataFrame:
        """A table; blocks with ``postings``, rows of unit, tf and n_words, beside their packed form."""
        found = _table(spark, self.path, name, self.segments)
        return found.withColumn("postings", _unpacked()) if name == "blocks" else found


_SCHEMAS = {
    "units": "source_doc string, chunk_idx int, unit long, words array<string>, segment int",
    "blocks": (
        "term string, range long, start long, n long, max_tf int, min_words int, "
        "packed array<long>, segment int, term_bucket int"
    ),
    "terms": "term string, df long, max_tf int, min_words int, segment int, term_bucket int",
    "dead": "of_segment int, unit long, segment int",
    "totals": "n_units long, n_words long, term_buckets int, segment int",
}


def _table(spark: SparkSession, path: str, name: str, segments: tuple[int, ...]) -> DataFrame:
    places = [f"{path}/{name}/segment={s}" for s in segments]
    places = [p for p in places if files.exists(spark, p)]
    if not places:
        return spark.createDataFrame([], _SCHEMAS[name])
    return spark.read.schema(_SCHEMAS[name]).option("basePath", f"{path}/{name}").parquet(*places)


def _numbers(spark: SparkSession, path: str, name: str) -> list[int]:
    names = files.child_dirs(spark, f"{path}/{name}")
    return sorted(int(n.split("=")[1]) for n in names if n.startswith("segment="))


def _unpacked() -> Column:
    def posting(packed: Column) -> Column:
        place = F.shiftrightunsigned(packed, 2 * _COUNT_BITS)
        tf = F.shiftrightunsigned(packed, _COUNT_BITS).bitwiseAND(F.lit(_COUNT)).cast("int")
        n_words = packed.bitwiseAND(F.lit(_COUNT)).cast("int")
        return F.struct((F.col("start") + place).alias("unit"), tf.alias("tf"), n_words.alias("n_words"))

    return F.transform("packed", posting)


def _bucket(term: Column, buckets: int) -> Column:
    return F.pmod(F.crc32(term.cast("binary")), F.lit(buckets)).cast("int")


# Building


def _numbered(units: DataFrame) -> DataFrame:
    """Units with their words and numbers, in the order of keys within each task.

    Units of equal scores in a range are told apart by their numbers, and a range never
    reaches over two tasks, so no order over all units is needed and nothing is shuffled.
    """
    ordered = units.select(*KEYS, "text").sortWithinPartitions(*KEYS)
    return bm25.tokenized(ordered).select(*KEYS, F.monotonically_increasing_id().alias("unit"), "words")


def _blocks(units: DataFrame, buckets: int) -> DataFrame:
    """Rows of ``term, range, start, n, max_tf, min_words, packed, term_bucket`` from units in their order.

    Nothing is shuffled: a batch of units gives the blocks of its ranges, bucket by bucket,
    and a range that two batches share gets two blocks of a term, which count as any two.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column("words")
            sizes = pc.list_value_length(words).to_numpy(zero_copy_only=False)
            if not sizes.sum():
                continue
            coded = words.flatten().dictionary_encode()
            # As ``_bucket`` has it.
            bucket = np.array([crc32(t) % buckets for t in coded.dictionary.cast(pa.binary()).to_pylist()], np.int32)
            by_bucket = np.argsort(bucket, kind="stable")
            bucket, place = bucket[by_bucket], np.argsort(by_bucket)
            dictionary = coded.dictionary.take(pa.array(by_bucket))
            pair = place[coded.indices.to_numpy(zero_copy_only=False)] * batch.num_rows
            pair, tf = np.unique(pair + np.repeat(np.arange(batch.num_rows), sizes), return_counts=True)
            code, row = np.divmod(pair, batch.num_rows)
            unit = batch.column("unit").to_numpy(zero_copy_only=False)[row]
            n_words, ranges = sizes[row].astype(np.int32), unit >> bits
            new = np.r_[True, (code[1:] != code[:-1]) | (ranges[1:] != ranges[:-1])]
            starts = np.flatnonzero(new)
            tf = tf.astype(np.int32)
            start = ranges << bits
            packed = ((unit - start) << 2 * _COUNT_BITS) | (tf.astype(np.int64) << _COUNT_BITS) | n_words
            ends = np.r_[starts, len(pair)].astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    dictionary.take(pa.array(code[starts])),
                    pa.array(ranges[starts]),
                    pa.array(start[starts]),
                    pa.array(np.diff(ends).astype(np.int64)),
                    pa.array(np.maximum.reduceat(tf, starts)),
                    pa.array(np.minimum.reduceat(n_words, starts)),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(packed)),
                    pa.array(bucket[code[starts]]),
                ],
                names=["term", "range", "start", "n", "max_tf", "min_words", "packed", "term_bucket"],
            )

    bits = RANGE_BITS
    schema = (
        "term string, range long, start long, n long, max_tf int, min_words int, packed array<long>, term_bucket int"
    )
    return units.select("unit", "words").mapInArrow(run, schema)


def _put(df: DataFrame, path: str, name: str, segment: int, *by: str) -> None:
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*by) if by else writer).parquet(f"{path}/{name}/segment={segment}")


def _put_blocks(blocks: DataFrame, path: str, segment: int, term_buckets: int) -> None:
    """Blocks as they are made: a task keeps a file open for each bucket, instead of sorting."""
    writer = blocks.write.mode("overwrite").partitionBy("term_bucket").option("parquet.block.size", BLOCK_BYTES)
    with files.open_writers(blocks.sparkSession, term_buckets):
        writer.parquet(f"{path}/blocks/segment={segment}")


def add(
    spark: SparkSession,
    path: str,
    chunks: DataFrame,
    replaced: DataFrame | None = None,
    term_buckets: int = TERM_BUCKETS,
) -> int:
    """Add units as a new segment; its number.

    Units of earlier segments that belong to the same documents, or to those of ``replaced``
    (``source_doc``), which may have no units any more, are replaced.
    """
    there = _numbers(spark, path, "totals")
    taken = [n for name in _SCHEMAS for n in _numbers(spark, path, name)]
    segment = max(taken, default=-1) + 1
    if there:
        term_buckets = _table(spark, path, "totals", tuple(there)).agg(F.max("term_buckets")).first()[0]
    _put(_numbered(chunks), path, "units", segment)
    units = _table(spark, path, "units", (segment,))
    # A small segment is written by few tasks, as each of them leaves a file per bucket.
    tasks = 1 + files.stored_bytes(spark, f"{path}/units/segment={segment}") // TASK_BYTES
    _put_blocks(_blocks(units.coalesce(tasks), term_buckets), path, segment, term_buckets)
    new = _table(spark, path, "blocks", (segment,)).select(
        "term", "term_bucket", F.col("n").alias("df"), "max_tf", "min_words"
    )
    size = F.size("words").cast("long")
    totals = units.agg(F.count("*").alias("n_units"), F.sum(size).alias("n_words"))
    if there:
        gone = units.select("source_doc")
        gone = (gone if replaced is None else gone.unionByName(replaced.select("source_doc"))).distinct()
        # Words have no blanks. As one text the different ones take a third of the room that
        # a list has in a shuffle.
        old = _table(spark, path, "units", tuple(there)).select(
            "source_doc", *_UNIT, F.size("words").alias("n_words"), F.concat_ws(" ", F.array_distinct("words")).alias("words")
        )
        old = _living(spark, path, tuple(there), old.join(gone, "source_doc", "left_semi"))
        old = files.materialize(old.select(*_UNIT, "n_words", "words"), "replaced-units")
        _put(old.select(F.col("segment").alias("of_segment"), "unit"), path, "dead", segment)
        # Their words are in the earlier segments, so what they counted for is taken back.
        lost = F.split(F.when(F.col("words") != "", F.col("words")), " ")
        taken_back = old.select(F.explode(lost).alias("term"), F.lit(-1).cast("long").alias("df"))
        new = new.unionByName(
            taken_back.groupBy("term").agg(F.sum("df").alias("df")).select(
                "term", _bucket(F.col("term"), term_buckets).alias("term_bucket"), "df",
                F.lit(0).alias("max_tf"), F.lit(2**31 - 1).alias("min_words"),
            )
        )
        totals = totals.unionByName(
            old.agg((-F.count("*")).alias("n_units"), (-F.sum(F.col("n_words").cast("long"))).alias("n_words"))
        )
    terms = new.groupBy("term_bucket", "term").agg(
        F.sum("df").alias("df"), F.max("max_tf").alias("max_tf"), F.min("min_words").alias("min_words")
    )
    _put(terms.repartition("term_bucket"), path, "terms", segment, "term_bucket")
    last = totals.agg(
        F.sum("n_units").alias("n_units"), F.coalesce(F.sum("n_words"), F.lit(0)).cast("long").alias("n_words")
    )
    _put(last.withColumn("term_buckets", F.lit(term_buckets)), path, "totals", segment)
    return segment


def live_units(spark: SparkSession, path: str, segments: tuple[int, ...]) -> DataFrame:
    """Units of these segments that none of them has replaced."""
    return _living(spark, path, segments, _table(spark, path, "units", segments))


def _living(spark: SparkSession, path: str, segments: tuple[int, ...], units: DataFrame) -> DataFrame:
    """Those of the units that none of the segments has replaced."""
    if not files.exists(spark, f"{path}/dead"):
        return units
    dead = _table(spark, path, "dead", segments).select(F.col("of_segment").alias("segment"), "unit")
    return units.join(dead, _UNIT, "left_anti")


def frequencies(spark: SparkSession, path: str, segments: tuple[int, ...]) -> DataFrame:
    """``term, term_bucket, df, max_tf, min_words`` of terms that a live unit has."""
    found = _table(spark, path, "terms", segments).groupBy("term_bucket", "term").agg(
        F.sum("df").alias("df"), F.max("max_tf").alias("max_tf"), F.min("min_words").alias("min_words")
    )
    return found.where(F.col("df") > 0)


def open_index(spark: SparkSession, path: str) -> PostingIndex:
    segments = tuple(_numbers(spark, path, "totals"))
    if not segments:
        raise FileNotFoundError(f"no index under {path}")
    row = _table(spark, path, "totals", segments).agg(
        F.sum("n_units").alias("n_units"), F.sum("n_words").alias("n_words"), F.max("term_buckets").alias("buckets")
    ).first()
    n_units = row["n_units"] or 0
    mean = frequencies(spark, path, segments).agg(F.avg(sc.raw_idf(n_units, F.col("df")))).first()[0]
    return PostingIndex(path, segments, row["buckets"], n_units, row["n_words"] or 0, mean or 0.0)


def weights(spark: SparkSession, index: PostingIndex) -> DataFrame:
    """``term, df, idf`` of the whole corpus."""
    found = frequencies(spark, index.path, index.segments)
    return bm25.term_weights(found.select("term", "df"), index.n_units, index.mean_raw_idf)


# Searching


def _share(index: PostingIndex, tf: Column, n_words: Column) -> Column:
    """What a posting gives per unit of its term's weight; grows with tf, falls with length."""
    mean = index.mean_words
    length = (1 - sc.BM25_B) + sc.BM25_B * n_words / mean if mean else F.lit(1.0)
    return tf * (sc.BM25_K1 + 1) / (tf + sc.BM25_K1 * length)


def _bound(index: PostingIndex) -> Column:
    """The most that a block, or a term, can add to a score."""
    most = F.col("weight") * _share(index, F.col("max_tf"), F.col("min_words"))
    return F.greatest(most, F.lit(0.0))


def asked_blocks(spark: SparkSession, index: PostingIndex, asked: DataFrame, *columns: str) -> DataFrame:
    """Blocks of asked terms, from their partitions only, per query that asks. ``asked`` has
    ``query_id, term, term_bucket, weight`` and is of a measured size."""
    wanted = sorted(r[0] for r in asked.select("term_bucket").distinct().collect())
    blocks = index.table(spark, "blocks").where(F.col("term_bucket").isin(wanted))
    return blocks.select("term", *_RANGE, *columns).join(
        F.broadcast(asked.select("query_id", "term", "weight")), "term"
    )


def _entries(asked: DataFrame) -> tuple[pa.Array, pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """Ids of the queries, the asked terms in order, and the query, term number and weight of
    each entry, by term."""
    held = asked.select("query_id", "term", "weight").toArrow()
    ids = pc.unique(held["query_id"].combine_chunks())
    terms = pc.unique(held.select(["term"]).sort_by("term")["term"].combine_chunks())
    query = pc.index_in(held["query_id"], value_set=ids, skip_nulls=False).to_numpy()
    term = pc.index_in(held["term"], value_set=terms).to_numpy()
    order = np.argsort(term, kind="stable")
    return ids, terms, query[order], term[order], held["weight"].to_numpy()[order]


def _scored(
    spark: SparkSession,
    index: PostingIndex,
    asked: DataFrame,
    ranges: DataFrame,
    digits: int | None,
    k: int,
    floors: DataFrame | None = None,
) -> DataFrame:
    """``query_id, segment, unit, score`` of live units with an asked term in these ranges.

    Of a range, at most the first k are given that reach a query's floor. With ``floors``,
    all are given for queries that have none.
    """
    ids, terms, query, term, weight = _entries(asked)
    known = {r["query_id"]: r["floor"] for r in floors.collect()} if floors is not None else {}
    lowest = np.array([known.get(i, -np.inf) for i in ids.to_pylist()])
    shared = spark.sparkContext.broadcast((ids, len(terms), query, term, weight, lowest))
    whole, mean = floors is not None, index.mean_words
    schema = StructType(
        [
            StructField("query_id", asked.schema["query_id"].dataType),
            StructField("segment", IntegerType()),
            StructField("unit", LongType()),
            StructField("score", DoubleType()),
        ]
    )

    def score(key: tuple, blocks: pa.Table, wanted: pa.Table) -> pa.Table:
        ids, n_terms, e_query, e_term, e_weight, lowest = shared.value
        asking = pc.index_in(wanted["query_id"], value_set=ids, skip_nulls=False).to_numpy()
        blocks = blocks.sort_by("number")
        lists = blocks["packed"].combine_chunks()
        number = np.repeat(blocks["number"].to_numpy(), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
        packed = lists.flatten().to_numpy(zero_copy_only=False)
        # Replaced units have a row of their own, which lists their numbers.
        posted = number != _DEAD
        gone, packed, number = packed[~posted], packed[posted], number[posted]
        unit = blocks["start"][-1].as_py() + (packed.view(np.uint64) >> np.uint64(2 * _COUNT_BITS)).astype(np.int64)
        tf, n_words = (packed >> _COUNT_BITS) & _COUNT, packed & _COUNT
        if len(gone):
            live = np.isin(unit, gone, invert=True)
            unit, number, tf, n_words = unit[live], number[live], tf[live], n_words[live]
        length = 1 - sc.BM25_B + sc.BM25_B * n_words / mean if mean else 1.0
        part = tf * (sc.BM25_K1 + 1) / (tf + sc.BM25_K1 * length)
        units, place = np.unique(unit, return_inverse=True)
        # Entries of the queries that ask here, by term.
        row_of = np.full(len(ids), -1)
        row_of[asking] = np.arange(len(asking))
        here = row_of[e_query] >= 0
        at_row, weight = row_of[e_query[here]] * len(units), e_weight[here]
        first_of = np.searchsorted(e_term[here], np.arange(n_terms + 1))
        count = first_of[number + 1] - first_of[number]
        scores = np.zeros(len(asking) * len(units))
        # A share is above 0, so a sum of such with weights above 0 is, too.
        positive = bool((weight > 0).all())
        matched = None if positive else np.zeros(len(scores), bool)
        total, first = np.cumsum(count), 0
        while first < len(unit):
            done = total[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(total, done + MAX_SCORED, side="right")))
            many = count[first:last]
            posting = np.repeat(np.arange(first, last), many)
            entry = np.arange(len(posting)) + np.repeat(first_of[number[first:last]] - (np.cumsum(many) - many), many)
            at = at_row[entry] + place[posting]
            # One by one in the order of terms, so that copies of a text get the very same score.
            np.add.at(scores, at, weight[entry] * part[posting])
            if not positive:
                matched[at] = True
            first = last
        matched = (scores > 0 if positive else matched).reshape(len(asking), -1)
        scores = scores.reshape(len(asking), -1)
        if digits is not None:
            scores = np.round(scores, digits)
        kept = matched & (scores >= lowest[asking][:, None])
        for row in np.flatnonzero(kept.sum(axis=1) > k):
            if whole and lowest[asking[row]] == -np.inf:
                continue
            found = np.flatnonzero(kept[row])
            # Units of a range are numbered in the order of keys, so of equal scores the first ones stay.
            kept[row] = False
            kept[row, found[np.argsort(-scores[row, found], kind="stable")[:k]]] = True
        query, at = np.nonzero(kept)
        return pa.table(
            {
                "query_id": ids.take(pa.array(asking[query])),
                "segment": pa.array(np.full(len(at), key[0].as_py(), np.int32)),
                "unit": pa.array(units[at]),
                "score": pa.array(scores[query, at]),
            }
        )

    numbers = spark.createDataFrame(pa.table({"term": terms, "number": pa.array(np.arange(len(terms), dtype=np.int32))}))
    wanted = sorted(r[0] for r in asked.select("term_bucket").distinct().collect())
    blocks = index.table(spark, "blocks").where(F.col("term_bucket").isin(wanted)).join(F.broadcast(numbers), "term")
    listed = blocks.select("number", *_RANGE, "start", "packed")
    if files.exists(spark, f"{index.path}/dead"):
        dead = index.table(spark, "dead").groupBy(
            F.col("of_segment").alias("segment"), F.shiftright("unit", RANGE_BITS).alias("range")
        )
        listed = listed.unionByName(
            dead.agg(F.collect_list("unit").alias("packed")).select(
                F.lit(_DEAD).alias("number"), *_RANGE, F.lit(0).cast("long").alias("start"), "packed"
            )
        )
    listed = listed.join(ranges.select(*_RANGE).distinct(), _RANGE, "left_semi")
    return listed.groupBy(*_RANGE).cogroup(ranges.groupBy(*_RANGE)).applyInArrow(score, schema)


def _first_ranges(spark: SparkSession, index: PostingIndex, asked: DataFrame, k: int) -> DataFrame:
    """Some ranges per query where its rarest terms have high bounds."""
    before = Window.partitionBy("query_id").orderBy("df", "term").rowsBetween(Window.unboundedPreceding, -1)
    rare = asked.withColumn("before", F.coalesce(F.sum("df").over(before), F.lit(0))).where(F.col("before") < 4 * k)
    blocks = asked_blocks(spark, index, rare, "max_tf", "min_words").withColumn("bound", _bound(index))
    summed = blocks.groupBy("query_id", *_RANGE).agg(F.sum("bound").alias("bound"))
    return ranked(summed, ["query_id"], [F.desc("bound"), *map(F.col, _RANGE)], FIRST_RANGES).select("query_id", *_RANGE)


def _candidate_ranges(spark: SparkSession, index: PostingIndex, asked: DataFrame, floors: DataFrame) -> DataFrame:
    """Ranges that may hold a unit which reaches its query's floor."""
    low = Window.partitionBy("query_id").orderBy("bound", "term")
    bounded = asked.join(F.broadcast(floors), "query_id", "left").withColumn("bound", _bound(index))
    # Bounds of the least terms together, each with those before it.
    bounded = bounded.withColumn("upto", F.sum("bound").over(low.rowsBetween(Window.unboundedPreceding, 0)))
    below = F.col("floor").isNotNull() & (F.col("upto") < F.col("floor") - _SLACK)
    bounded = files.materialize(bounded.withColumn("essential", ~below), "asked-bounds")
    rest = bounded.groupBy("query_id").agg(
        F.first("floor").alias("floor"), F.coalesce(F.sum(F.when(~F.col("essential"), F.col("bound"))), F.lit(0.0)).alias("rest")
    )
    blocks = asked_blocks(spark, index, bounded.where("essential"), "max_tf", "min_words")
    summed = blocks.groupBy("query_id", *_RANGE).agg(F.sum(_bound(index)).alias("bound"))
    reaches = F.col("floor").isNull() | (F.col("bound") + F.col("rest") >= F.col("floor") - _SLACK)
    return summed.join(F.broadcast(rest), "query_id").where(reaches).select("query_id", *_RANGE)


def _with_keys(spark: SparkSession, index: PostingIndex, found: DataFrame) -> DataFrame:
    return found.join(index.table(spark, "units").select(*_UNIT, *KEYS), _UNIT)


def _filled(spark: SparkSession, index: PostingIndex, scored: DataFrame, short: DataFrame, k: int) -> DataFrame:
    """Units without the words of queries that have fewer than k units above 0."""
    ids = [r for r in short.collect()]
    if not ids:
        return _with_keys(spark, index, scored).where(F.lit(False))
    schema = short.schema["query_id"].dataType
    wanted = F.array(*[F.lit(r["query_id"]).cast(schema) for r in ids])
    most = max(r["n_matched"] for r in ids)
    # Of the first k and as many units as a query has matched, k at least are unmatched.
    first = live_units(spark, index.path, index.segments).select(*_UNIT, *KEYS).orderBy(*KEYS).limit(k + most)
    each = first.select(F.explode(wanted).alias("query_id"), *_UNIT, F.lit(0.0).alias("score"), *KEYS)
    return each.join(scored.select("query_id", *_UNIT), ["query_id", *_UNIT], "left_anti")


def _search_part(
    spark: SparkSession, index: PostingIndex, part: pa.Table, k: int, digits: int | None
) -> DataFrame:
    """The best k units of one part of the queries, written."""
    words = spark.createDataFrame(part)
    wanted = F.broadcast(words.where(F.col("term").isNotNull()))
    known = frequencies(spark, index.path, index.segments)
    buckets = sorted(r[0] for r in words.select(_bucket(F.col("term"), index.term_buckets)).distinct().collect() if r[0] is not None)
    known = known.where(F.col("term_bucket").isin(buckets))
    idf = sc.floored_idf(sc.raw_idf(index.n_units, F.col("df")), index.mean_raw_idf)
    asked = known.join(wanted, "term").withColumn("weight", F.col("n") * idf)
    asked = files.materialize(asked, "asked-terms")
    first = files.materialize(_first_ranges(spark, index, asked, k), "first-ranges")
    seeds = ranked(_scored(spark, index, asked, first, digits, k), ["query_id"], [F.desc("score")], k)
    # One row per query of this part at most.
    floors = seeds.where(F.col("rk") == k).select("query_id", F.col("score").alias("floor"))
    floors = files.materialize(floors.where(F.col("floor") > 0), "floors")
    ranges = files.materialize(_candidate_ranges(spark, index, asked, floors), "ranges")
    scored = files.materialize(_scored(spark, index, asked, ranges, digits, k, floors), "scored")
    everyone = words.select("query_id").distinct()
    counted = scored.groupBy("query_id").agg(
        F.count("*").alias("n_matched"), F.count_if(F.col("score") > 0).alias("n_above")
    )
    short = everyone.join(counted, "query_id", "left").na.fill(0, ["n_matched", "n_above"]).where(F.col("n_above") < k)
    # Ties of the k-th score are kept until keys decide.
    window = Window.partitionBy("query_id").orderBy(F.desc("score"))
    best = scored.withColumn("place", F.rank().over(window)).where(F.col("place") <= k).drop("place")
    # Written, so that Spark knows its size and need not shuffle all units for their keys.
    best = files.materialize(best, "best")
    columns = ["query_id", *KEYS, "score"]
    found = _with_keys(spark, index, best).select(columns).unionByName(
        _filled(spark, index, scored, short.select("query_id", "n_matched"), k).select(columns)
    )
    return ranked(found, ["query_id"], unit_order(KEYS), k)


def keyword_topk(
    spark: SparkSession,
    index: PostingIndex,
    queries: DataFrame,
    k: int,
    digits: int | None = None,
    max_entries: int = bm25.MAX_ENTRIES,
) -> DataFrame:
    """The k best units per query, as ``bm25.keyword_topk`` has them: (query_id, *keys, score, rk)."""
    asked = files.materialize(bm25.query_words(queries), "asked")
    parts = [
        _search_part(spark, index, held, k, digits)
        for held in (p.toArrow() for p in query_passes(asked, "query_id", max_entries))
        if held.num_rows
    ]
    if not parts:
        schema = bm25._result_schema(queries)
        return ranked(spark.createDataFrame([], schema), ["query_id"], unit_order(KEYS), k)
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found
