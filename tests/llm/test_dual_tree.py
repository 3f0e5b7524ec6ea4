"""Dual-tree search against scoring every pair, with ties, hot terms and long items."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import dual_tree

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text):
    folded = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return TERM.findall(folded)


def by_hand(docs, items, k):
    """All pairs, in Python's own integers."""
    bags = [(i, Counter(words(t))) for i, t in docs]
    n_docs = sum(bool(b) for _, b in bags)
    n_terms = sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(words(t))
    out = []
    for item, terms in asked.items():
        rows = []
        for doc_id, bag in bags:
            n = sum(bag.values())
            m = 50 + (50 * n * n_docs) // n_terms if n_terms else 0
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * bag[t]) // (1000 * bag[t] + 20 * m))
                for t in terms if t in bag
            )
            if score > 0:
                rows.append((-score, doc_id is None, doc_id or 0, doc_id))
        rows.sort(key=lambda r: r[:3])
        out += [(item, rank, r[3], -r[0]) for rank, r in enumerate(rows[:k], 1)]
    return sorted(out, key=repr)


def found(spark, docs, items, k, **more):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    i = spark.createDataFrame(items, "item_id long, text string")
    return sorted((tuple(r) for r in dual_tree.search(d, i, k, **more).collect()), key=repr)


def corpus(n_docs, n_items, seed=3):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdeéñ中01") for _ in range(rng.randint(1, 5))) for _ in range(400)]

    def text(n):
        return " ".join(vocabulary[min(int(rng.expovariate(0.02)), 399)] for _ in range(n))

    docs = [(n, text(rng.choice((3, 20, 60, 200)))) for n in range(n_docs)]
    items = [(n, text(rng.randint(1, 40))) for n in range(n_items)]
    # Whole items inside of documents, and a group of copies of a third of all.
    docs += [(n_docs + n, f"The {items[n % n_items][1]}, and MORE.") for n in range(n_docs // 8)]
    docs += [(2 * n_docs + n, docs[0][1]) for n in range(n_docs // 2)]
    rng.shuffle(docs)
    return docs, items


@pytest.mark.parametrize("k", [1, 7, 50])
def test_search_equals_all_pairs(spark, k):
    docs, items = corpus(400, 30)
    assert found(spark, docs, items, k) == by_hand(docs, items, k)


def test_search_in_several_passes(spark):
    docs, items = corpus(150, 90, seed=4)
    assert found(spark, docs, items, 5, max_entries=900) == by_hand(docs, items, 5)


def test_odd_rows(spark, odd, odd_rows, empty):
    items = [(1, odd_rows[0][1][:300]), (1, "one"), (2, "é 中文 OTHER"), (3, None), (4, " -- "), (None, "end token"), (5, "a")]
    df = spark.createDataFrame(items, "item_id long, text string")
    clash = odd.select("*", *[F.lit(0).alias(c) for c in ("query_id", "term", "score", "rank", "number", "terms")])
    got = sorted((tuple(r) for r in dual_tree.search(clash, df, 4).collect()), key=repr)
    want = by_hand([(r[0], r[1]) for r in odd_rows], items, 4)
    assert got == want and got
    assert dual_tree.search(empty, df).collect() == []
    assert dual_tree.search(odd, df.limit(0)).collect() == []


def test_long_texts_are_cut_whole(monkeypatch):
    text = "Ab-cd é1_ " * 1_000
    want = [w.encode() for w in words(text)]
    for piece in (1, 7, 64, 1 << 20):
        monkeypatch.setattr(dual_tree, "PIECE", piece)
        assert [w for part in dual_tree.cut(text.encode()) for w in part] == want


def _random_points(rng, n, columns, topics=10):
    """Shares of documents that are each mostly about one stretch of the terms."""
    topic = rng.integers(0, topics, n)
    near = np.arange(columns)[None, :] * topics // columns == topic[:, None]
    points = rng.integers(0, 900_000, (n, columns)) * (rng.random((n, columns)) < np.where(near, 0.3, 0.005))
    return points.astype(float)


@pytest.mark.parametrize("seed", range(5))
def test_traversal_keeps_the_best_and_prunes(seed):
    rng = np.random.default_rng(seed)
    weights = rng.integers(1, 9_000, 300)
    items = [30 * (n % 10) + np.sort(rng.choice(30, rng.integers(1, 20), replace=False)) for n in range(40)]
    (tree,) = dual_tree.item_trees(items, weights)
    best = dual_tree.Best.start(40, 10, {})
    docs = _random_points(rng, 900, 300)
    docs[300:600] = docs[0]  # ties
    ids = rng.permutation(900)
    opened = Counter()
    local = docs[:, tree.columns]
    for first in range(0, 900, 250):
        dual_tree.dual_search(tree, local[first : first + 250], ids[first : first + 250], best, opened)
    for n, terms in enumerate(items):
        scores = (docs[:, terms] @ weights[terms]).astype(np.int64)
        order = [i for i in np.lexsort((ids, -scores)) if scores[i] > 0][:10]
        assert best.rows[n].tolist() == [[scores[i], ids[i]] for i in order]
    assert opened["pairs"] < 0.6 * 900 * 40


def test_bounds_hold_for_every_pair():
    rng = np.random.default_rng(0)
    weights = rng.integers(1, 9_000, 200)
    items = [np.sort(rng.choice(200, 12, replace=False)) for _ in range(30)]
    (tree,) = dual_tree.item_trees(items, weights)
    docs = _random_points(rng, 130, 200)[:, tree.columns]
    levels = dual_tree._levels(docs, dual_tree.LEAF_DOCS)
    scores = tree.weights @ docs.T
    for rows, row_bounds in tree.levels:
        for cols, col_bounds in levels:
            bound = rows @ cols.T
            for i in range(len(rows)):
                for j in range(len(cols)):
                    inside = scores[row_bounds[i] : row_bounds[i + 1], col_bounds[j] : col_bounds[j + 1]]
                    assert inside.max() <= bound[i, j]


def test_starting_bounds_change_no_result():
    rng = np.random.default_rng(1)
    weights = rng.integers(1, 9_000, 100)
    items = [np.sort(rng.choice(100, 8, replace=False)) for _ in range(12)]
    (tree,) = dual_tree.item_trees(items, weights)
    docs, ids = _random_points(rng, 400, 100)[:, tree.columns], np.arange(400)
    plain = dual_tree.Best.start(12, 5, {})
    dual_tree.dual_search(tree, docs, ids, plain)
    part = dual_tree.Best.start(12, 5, {})
    dual_tree.dual_search(tree, docs[:100], ids[:100], part)
    bounds = {n: (int(r[-1, 0]), int(r[-1, 1])) for n, r in enumerate(part.rows) if len(r) == 5}
    started, opened, before = dual_tree.Best.start(12, 5, bounds), Counter(), Counter()
    dual_tree.dual_search(tree, docs, ids, started, opened)
    dual_tree.dual_search(tree, docs, ids, dual_tree.Best.start(12, 5, {}), before)
    assert [r.tolist() for r in started.rows] == [r.tolist() for r in plain.rows]
    assert opened["pairs"] <= before["pairs"]


def test_large_numbers_stay_exact():
    weights = np.array([2**34, 2**34 + 1])
    (tree,) = dual_tree.item_trees([np.array([0, 1])], weights)
    assert tree.weights.dtype == np.int64
    best = dual_tree.Best.start(1, 2, {})
    dual_tree.dual_search(tree, np.array([[999_999, 1], [999_998, 2]], np.int64), np.array([5, 6]), best)
    assert best.rows[0].tolist() == [[999_998 * 2**34 + 2 * (2**34 + 1), 6], [999_999 * 2**34 + 2**34 + 1, 5]]
    tf, length = np.array([10**10]), np.array([10**10])
    m = 50 + (50 * 10**10 * 10**9) // 10**12
    assert dual_tree.shares(tf, length, 10**9, 10**12).tolist() == [(10**19) // (10**13 + 20 * m)]
