"""Exact ranked search of all documents for many items at once by a dual-tree traversal.

1. Terms are cut from the whole texts. One pass over the documents writes, of each, its
   number of terms and how often it has each term that any item has, which is all that a
   score can depend on. The same pass counts documents, terms and document frequencies per
   task, which are added up afterwards.
2. Items and documents are points with a coordinate per term: a term's weight for an item
   that has it, a term's share for a document. Both stand in hierarchies whose nodes hold
   the largest value of each coordinate below them; so the product of two nodes' maxima
   bounds the score of every pair below them.
3. A task walks pairs of nodes, best bound first. A pair whose bound does not reach the
   weakest k-th score of its items is left out with all of its documents and items at
   once; other pairs are opened, and pairs of leaves are scored. Whether a document at
   exactly the k-th score can still enter is decided by the smallest id below its node.
   So nothing is lost: pruning leaves out only what cannot be among the best k.
4. Before that, one slice of the documents (``1 / SLICES`` of them by a hash of the id) is
   searched in the same way. The k-th scores found there are true lower bounds of the
   final ones and start every task of the whole search; they only save work.
5. A task hands on at most k rows per item; Spark ranks these.

All scores are integers. Products of nodes are taken in doubles, where integers below 2^53
are exact, and in 64-bit integers for items whose scores could be larger.

The item side is sent to the tasks in parts of at most ``MAX_ENTRIES`` (item, term)
entries, one pass over the documents for each; the documents are neither joined nor
shuffled, so a term that a third of all documents have costs no more than others.

Defined results: documents without terms, null or not, match nothing; an item without
terms has no rows; rows of ``items`` with the same id are one item with the terms of all;
repeated documents are ranked each; a null doc_id ranks last among equal scores; empty
tables give no rows.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StructField, StructType

from millrace.llm.common import or_empty
from millrace.operators.topk import in_passes, ranked
from millrace.sources import files

K = 50
#: (item, term) entries sent to every task in one pass; some tens of megabytes.
MAX_ENTRIES = 500_000
#: One of so many documents is searched first, for starting bounds.
SLICES = 64
#: Items of one tree, items and documents of a leaf, children of a node.
TREE_ITEMS, LEAF_ITEMS, LEAF_DOCS, FAN = 64, 4, 16, 8
#: Numbers in the coordinates of one batch of documents (32 MB), and documents at most.
MAX_NUMBERS, MAX_DOCS = 4_000_000, 1024
#: Bytes of a text that are cut into terms at a time.
PIECE = 4 << 20
_NO_ID = np.iinfo(np.int64).max

# A term is a run of ASCII letters, digits and bytes of other characters.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
_SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def terms(text: Column) -> Column:
    """The terms of a text, as a column."""
    words = F.split(F.translate(or_empty(text), _UPPER, _LOWER), _SEPARATORS)
    return F.filter(words, lambda w: w != "")


def cut(data: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in UTF-8, a few megabytes of it at a time."""
    folded = data.translate(_FOLD)
    first = 0
    while first < len(folded):
        last = folded.find(b" ", first + PIECE)
        last = len(folded) if last < 0 else last
        yield folded[first:last].split()
        first = last


# Item trees


@dataclass
class ItemTree:
    """Items of one tree, with their terms as columns of their own.

    ``weights`` has a row per item. ``levels`` hold, from the root down, the maxima of each
    node and the range of its items; a node's children are the ``FAN`` next ones below.
    """

    items: np.ndarray
    columns: np.ndarray
    weights: np.ndarray
    levels: list[tuple[np.ndarray, np.ndarray]]


def _levels(points: np.ndarray, leaf: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Maxima and bounds of the nodes over ordered points, from the root down."""
    n = len(points)
    starts = np.arange(0, n, leaf)
    found = [(np.maximum.reduceat(points, starts, axis=0), np.r_[starts, n])]
    while len(found[0][0]) > 1:
        below, bounds = found[0]
        firsts = np.arange(0, len(below), FAN)
        found.insert(0, (np.maximum.reduceat(below, firsts, axis=0), np.r_[bounds[firsts], n]))
    return found


def _bisected(points: np.ndarray, members: np.ndarray) -> list[int]:
    """The members in an order in which like ones are neighbours: halves about two unlike
    ones, divided again down to leaves."""
    if len(members) <= LEAF_ITEMS:
        return members.tolist()
    rows = points[members].astype(float)
    rows /= np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-300)
    one = int((rows @ rows[0]).argmin())
    near = rows @ rows[one]
    order = np.argsort(rows @ rows[near.argmin()] - near, kind="stable")
    half = -(-len(members) // (2 * LEAF_ITEMS)) * LEAF_ITEMS
    return [i for part in (order[:half], order[half:]) for i in _bisected(points, members[part])]


def item_trees(item_terms: list[np.ndarray], weights: np.ndarray) -> list[ItemTree]:
    """Trees over items, given the term numbers of each; items of like terms lie together."""
    # The heaviest term first: items that share rare terms are neighbours.
    order = sorted(
        range(len(item_terms)),
        key=lambda i: sorted(((-int(weights[t]), int(t)) for t in item_terms[i]))[:4],
    )
    trees = []
    for first in range(0, len(order), TREE_ITEMS):
        members = np.array(order[first : first + TREE_ITEMS])
        columns = np.unique(np.concatenate([item_terms[i] for i in members]))
        # No share of a document is over 10^6.
        largest = max(int(weights[item_terms[i]].sum()) for i in members) * 10**6
        kind = np.float64 if largest < 2**53 else np.int64
        rows = np.zeros((len(members), len(columns)), kind)
        for row, i in enumerate(members):
            rows[row, np.searchsorted(columns, item_terms[i])] = weights[item_terms[i]]
        near = _bisected(rows, np.arange(len(members)))
        trees.append(ItemTree(members[near], columns, rows[near], _levels(rows[near], LEAF_ITEMS)))
    return trees


@dataclass
class Best:
    """Of every item the k best rows so far, and what a row has to reach."""

    k: int
    floor: np.ndarray
    floor_id: np.ndarray
    rows: list[np.ndarray] = field(default_factory=list)

    @classmethod
    def start(cls, n_items: int, k: int, bounds: dict[int, tuple[int, int]]) -> Best:
        # A score of 0 counts for nothing; 1 is the least, with any id.
        best = cls(k, np.ones(n_items, np.int64), np.full(n_items, _NO_ID), [np.zeros((0, 2), np.int64)] * n_items)
        for item, (score, doc_id) in bounds.items():
            best.floor[item], best.floor_id[item] = score, doc_id
        return best

    def may_enter(self, items: np.ndarray, bound: np.ndarray | int, least_id: np.ndarray | int) -> np.ndarray:
        floor = self.floor[items]
        return (bound > floor) | ((bound == floor) & (least_id <= self.floor_id[items]))

    def add(self, item: int, scores: np.ndarray, ids: np.ndarray) -> None:
        rows = np.concatenate([self.rows[item], np.stack([scores, ids], axis=1)])
        rows = rows[np.lexsort((rows[:, 1], -rows[:, 0]))][: self.k]
        self.rows[item] = rows
        if len(rows) == self.k:
            score, doc_id = int(rows[-1, 0]), int(rows[-1, 1])
            if (score, -doc_id) > (int(self.floor[item]), -int(self.floor_id[item])):
                self.floor[item], self.floor_id[item] = score, doc_id


# Documents


def shares(tf: np.ndarray, length: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """What each (document, term) adds per unit of the term's weight; lengths are per entry."""
    if len(tf) and max(int(length.max()) * n_docs * 50, int(tf.max()) * 10**9) >= 2**63:
        tf, length = tf.astype(object), length.astype(object)
    m = 100 - 50 + (50 * length * n_docs) // max(n_terms, 1)
    return ((10**9 * tf) // (1000 * tf + 20 * m)).astype(np.int64)


def dual_search(
    tree: ItemTree, docs: np.ndarray, ids: np.ndarray, best: Best, opened: Counter | None = None
) -> None:
    """Add to ``best`` what the documents, rows of shares by the tree's columns, have for its items."""
    # Documents that have most for the same items lie together, so nodes are tight.
    close = docs @ tree.levels[-1][0].T
    most = close.argmax(axis=1)
    order = np.lexsort((-close[np.arange(len(docs)), most], most))
    docs, ids = docs[order], ids[order]
    levels = _levels(docs, LEAF_DOCS)
    least = [np.minimum.reduceat(ids, bounds[:-1]) for _, bounds in levels]

    def alive(a: int, i: int, b: int, j: int, bound: int) -> bool:
        bounds = tree.levels[a][1]
        items = tree.items[bounds[i] : bounds[i + 1]]
        return bool(best.may_enter(items, bound, least[b][j]).any())

    root = int(tree.levels[0][0][0] @ levels[0][0][0])
    queue = [(-root, 0, 0, 0, 0)]
    while queue:
        bound, a, i, b, j = heapq.heappop(queue)
        if not alive(a, i, b, j, -bound):
            continue
        if opened is not None:
            opened["nodes"] += 1
        last_a, last_b = a == len(tree.levels) - 1, b == len(levels) - 1
        if last_a and last_b:
            rows, held = tree.levels[a][1], levels[b][1]
            doc_ids = ids[held[j] : held[j + 1]]
            scores = (tree.weights[rows[i] : rows[i + 1]] @ docs[held[j] : held[j + 1]].T).astype(np.int64)
            if opened is not None:
                opened["pairs"] += scores.size
            for row, item in enumerate(tree.items[rows[i] : rows[i + 1]]):
                enter = best.may_enter(np.full(len(doc_ids), item), scores[row], doc_ids)
                if enter.any():
                    best.add(int(item), scores[row][enter], doc_ids[enter])
            continue
        # The children of both sides; a leaf stands for itself.
        na, ia = (a, np.array([i])) if last_a else (a + 1, np.arange(i * FAN, min((i + 1) * FAN, len(tree.levels[a + 1][0]))))
        nb, jb = (b, np.array([j])) if last_b else (b + 1, np.arange(j * FAN, min((j + 1) * FAN, len(levels[b + 1][0]))))
        bounds = tree.levels[na][0][ia] @ levels[nb][0][jb].T
        for x, child in enumerate(ia):
            for y, other in enumerate(jb):
                value = int(bounds[x, y])
                if value > 0 and alive(na, int(child), nb, int(other), value):
                    heapq.heappush(queue, (-value, na, int(child), nb, int(other)))


_INDEX = StructType(
    [
        StructField("doc_id", LongType()),
        StructField("is_total", BooleanType()),
        StructField("length", LongType()),
        StructField("n_docs", LongType()),
        StructField("terms", ArrayType(IntegerType())),
        StructField("counts", ArrayType(LongType())),
    ]
)
_ARROW = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("is_total", pa.bool_()),
        ("length", pa.int64()),
        ("n_docs", pa.int64()),
        ("terms", pa.list_(pa.int32())),
        ("counts", pa.list_(pa.int64())),
    ]
)


def term_vectors(docs: DataFrame, vocabulary: Broadcast, doc_id: str, text: str) -> DataFrame:
    """Of each document that has a term of the vocabulary, its length and these terms; and
    per task one row of totals over all its documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {term: n for n, term in enumerate(vocabulary.value)}
        n_docs = n_terms = 0
        frequency = np.zeros(len(number), np.int64)
        for batch in batches:
            ids, lengths, found, counts = [], [], [], []
            for key, data in zip(batch.column(0), batch.column(1)):
                seen: Counter = Counter()
                for words in cut(data.as_py() or b""):
                    seen.update(words)
                n = seen.total()
                n_docs, n_terms = n_docs + (n > 0), n_terms + n
                hits = number.keys() & seen.keys()
                if hits:
                    places = sorted((number[w], seen[w]) for w in hits)
                    ids.append(key.as_py())
                    lengths.append(n)
                    found.append([p for p, _ in places])
                    counts.append([c for _, c in places])
                    frequency[found[-1]] += 1
            columns = [ids, [False] * len(ids), lengths, [1] * len(ids), found, counts]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ARROW)], schema=_ARROW)
        had = np.flatnonzero(frequency)
        total = [[None], [True], [n_terms], [n_docs], [had.tolist()], [frequency[had].tolist()]]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(total, _ARROW)], schema=_ARROW)

    body = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("body"))
    return files.spread(body).mapInArrow(run, _INDEX)


def _totals(index: DataFrame, n_terms: int) -> tuple[int, int, np.ndarray]:
    """Documents with a term, terms in all, and documents of each term of the vocabulary."""
    totals = index.where("is_total")
    row = totals.agg(F.sum("n_docs").alias("n_docs"), F.sum("length").alias("length")).first()
    each = totals.select(F.explode(F.arrays_zip("terms", "counts")).alias("e"))
    # At most one row per term of the vocabulary, whose size is bounded.
    found = each.groupBy(F.col("e.terms").alias("term")).agg(F.sum("e.counts").alias("df")).collect()
    frequency = np.zeros(n_terms, np.int64)
    for r in found:
        frequency[r["term"]] = r["df"]
    return row["n_docs"] or 0, row["length"] or 0, frequency


def term_weights(frequency: np.ndarray, n_docs: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(df) + 1))) for df in frequency], np.int64)


def _scored(
    index: DataFrame, shared: Broadcast, n_items: int, totals: tuple[int, int], k: int, bounds: dict, schema: StructType
) -> DataFrame:
    """At most k rows per item and task: ``number, doc_id, score``."""
    n_docs, n_terms = totals

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = shared.value
        best = Best.start(n_items, k, bounds)
        widest = max((len(t.columns) for t in trees), default=1)
        step = max(LEAF_DOCS, min(MAX_DOCS, MAX_NUMBERS // widest))
        for batch in batches:
            for first in range(0, batch.num_rows, step):
                part = batch.slice(first, step)
                ids = pc.fill_null(part.column("doc_id"), _NO_ID).to_numpy(zero_copy_only=False)
                sizes = pc.list_value_length(part.column("terms")).to_numpy(zero_copy_only=False)
                found = part.column("terms").flatten().to_numpy(zero_copy_only=False)
                tf = part.column("counts").flatten().to_numpy(zero_copy_only=False)
                length = np.repeat(part.column("length").to_numpy(zero_copy_only=False), sizes)
                row = np.repeat(np.arange(part.num_rows), sizes)
                share = shares(tf, length, n_docs, n_terms)
                for tree in trees:
                    place = np.minimum(np.searchsorted(tree.columns, found), len(tree.columns) - 1)
                    here = tree.columns[place] == found
                    points = np.zeros((part.num_rows, len(tree.columns)), tree.weights.dtype)
                    points[row[here], place[here]] = share[here]
                    dual_search(tree, points, ids, best)
        for item, rows in enumerate(best.rows):
            if len(rows):
                ids = pa.array(rows[:, 1], mask=rows[:, 1] == _NO_ID)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(rows), item, np.int32)), ids, pa.array(rows[:, 0])], names=schema.names
                )

    return index.where(~F.col("is_total")).select("doc_id", "length", "terms", "counts").mapInArrow(run, schema)


_FOUND = StructType(
    [StructField("number", IntegerType()), StructField("doc_id", LongType()), StructField("score", LongType())]
)


def _order() -> list[Column]:
    return [F.desc("score"), F.asc_nulls_last("doc_id")]


def _search_part(
    spark: SparkSession, docs: DataFrame, part: pa.Table, k: int, doc_id: str, text: str
) -> tuple[pa.Array, DataFrame, Broadcast]:
    """Search for one part of the items; their ids by number, and the rows by number."""
    ids = pc.unique(part["query_id"].combine_chunks())
    vocabulary = sorted({t.encode("utf-8") for t in part["term"].to_pylist()})
    place = {t: n for n, t in enumerate(vocabulary)}
    item = pc.index_in(part["query_id"], value_set=ids, skip_nulls=False).to_numpy()
    term = np.array([place[t.encode("utf-8")] for t in part["term"].to_pylist()], np.int64)
    item_terms = [np.sort(term[item == n]) for n in range(len(ids))]
    words = spark.sparkContext.broadcast(vocabulary)
    index = files.materialize(term_vectors(docs, words, doc_id, text), "dual-vectors")
    words.destroy()
    n_docs, n_terms, frequency = _totals(index, len(vocabulary))
    trees = item_trees(item_terms, term_weights(frequency, n_docs))
    shared = spark.sparkContext.broadcast(trees)
    slice_ = index.where(F.pmod(F.xxhash64("doc_id"), F.lit(SLICES)) == 0)
    first = ranked(_scored(slice_, shared, len(ids), (n_docs, n_terms), k, {}, _FOUND), ["number"], _order(), k)
    # One row per item of this part at most.
    bounds = {
        r["number"]: (r["score"], _NO_ID if r["doc_id"] is None else r["doc_id"])
        for r in first.where(F.col("rk") == k).collect()
    }
    return ids, _scored(index, shared, len(ids), (n_docs, n_terms), k, bounds, _FOUND), shared


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = K,
    item_id: str = "item_id",
    doc_id: str = "doc_id",
    text: str = "text",
    max_entries: int = MAX_ENTRIES,
) -> DataFrame:
    """``item_id, rank, doc_id, score``: of each item the k best documents with a score above 0."""
    spark = docs.sparkSession
    asked = items.select(F.col(item_id).alias("query_id"), F.explode(terms(F.col(text))).alias("term")).distinct()
    asked = files.materialize(asked, "dual-items")
    schema = StructType([StructField("query_id", asked.schema["query_id"].dataType), *_FOUND.fields[1:]])

    def score(part: pa.Table) -> tuple[DataFrame, Broadcast]:
        ids, found, shared = _search_part(spark, docs, part, k, doc_id, text)
        names = pa.table({"number": pa.array(range(len(ids)), pa.int32()), "query_id": ids})
        # As many rows as the part has items, which is bounded.
        return found.join(F.broadcast(spark.createDataFrame(names)), "number").select(schema.names), shared

    found = in_passes(
        asked, "query_id", max_entries, k, score, lambda rows: ranked(rows, ["query_id"], _order(), k), schema
    )
    return found.select(F.col("query_id").alias("item_id"), F.col("rk").alias("rank"), "doc_id", "score")
