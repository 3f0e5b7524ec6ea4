"""Divide and conquer against the library's eigenvectors; whitening against plain numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import whitening


def _symmetric(values, seed):
    rng = np.random.default_rng(seed)
    q = np.linalg.qr(rng.standard_normal((len(values), len(values))))[0]
    return (q * np.asarray(values, float)) @ q.T


CASES = {
    "spread": np.linspace(1, 50, 40),
    "steep": 10.0 ** np.arange(6, -9, -1),
    "few": [5.0],
    "two": [3.0, 1.0],
    "equal": [4.0] * 12,
    "clusters": [9.0] * 5 + [9.0 - 1e-9] * 5 + [1.0] * 10 + [0.0] * 4,
    "zeros": [0.0] * 7,
    "rank": [7.0, 3.0] + [0.0] * 20,
    "signs": [4.0, 1.0, 0.0, -2.0, -2.0],
    "large": np.random.default_rng(1).lognormal(0, 2, 120),
}


@pytest.mark.parametrize("name", list(CASES))
def test_components_equal_the_library(name):
    a = _symmetric(CASES[name], 3)
    want = np.sort(np.linalg.eigvalsh(a))[::-1]
    for wanted in (len(a), max(1, len(a) // 2)):
        values, vectors = whitening.components((a + a.T) / 2, wanted)
        scale = np.abs(want).max() or 1
        assert np.allclose(values, want[:wanted], rtol=0, atol=1e-12 * scale)
        assert np.allclose(vectors.T @ vectors, np.eye(wanted), atol=1e-12)
        assert np.abs(a @ vectors - vectors * values).max() <= 2e-12 * scale


def test_diagonal_and_permuted_matrices():
    for a in (np.diag([1.0, 3.0, 2.0]), np.array([[0.0, 1.0], [1.0, 0.0]]), np.ones((6, 6))):
        values, vectors = whitening.components(a, len(a))
        assert np.allclose(values, np.sort(np.linalg.eigvalsh(a))[::-1], atol=1e-13)
        assert np.allclose(a @ vectors, vectors * values, atol=1e-13)


def test_polar_factor_is_the_sign():
    for seed, values in enumerate(([3, 1e-6, -2, -1e-9], [1, -1, 1], [1e5, -1e-5, 2])):
        a = _symmetric(values, seed)
        w, v = np.linalg.eigh(a)
        assert np.allclose(whitening.polar((a + a.T) / 2), (v * np.sign(w)) @ v.T, atol=1e-6)


def _rows(seed=0, n=700, dims=9):
    rng = np.random.default_rng(seed)
    data = rng.standard_normal((n, dims)) @ rng.standard_normal((dims, dims)) * 0.3 + 2
    return [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(data)]


def _odd(rows):
    bad = [(9001, None), (9002, []), (9003, [None] + [1.0] * 8), (9004, [float("nan")] * 9), (9005, [float("inf")] * 9)]
    return rows + bad + [(9006, [1.0, 2.0]), (None, rows[3][1]), (5, rows[5][1])] + [(8000, rows[7][1])] * 350


def _by_hand(rows, wanted):
    good = [(i, v) for i, v in rows if v and len(v) == 9 and all(c is not None and np.isfinite(c) for c in v)]
    x = np.array([[int(np.floor(64 * c)) + 1_000_000 for c in v] for _, v in good], dtype=object)
    n, sums = len(x), x.sum(axis=0)
    deviation = [sum(int(d) ** 2 for d in n * row - sums) for row in x]
    y = ((n * x - sums) / n).astype(float)
    covariance = y.T @ y / n
    e, v = np.linalg.eigh(covariance)
    order = np.argsort(-e)[:wanted]
    return good, n, deviation, y @ v[:, order] / np.sqrt(e[order]), e[order] / e.sum()


@pytest.mark.parametrize("wanted", [4, 32])
def test_whitening_equals_numpy(spark, wanted):
    rows = _odd(_rows())
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    df = df.select("*", *[F.lit(0).alias(c) for c in ("vector", "n", "whitened", "component", "at", "pair", "explained")])
    out = whitening.whitened(df, wanted)
    got = out.collect()
    good, n, deviation, z, share = _by_hand(rows, wanted)
    assert len(got) == n == len(good)
    key = lambda i, d, w: (repr(i), d, round(abs(w), 6))
    mine = sorted((key(r["vec_id"], r["deviation"], r["whitened"][0]), [abs(c) for c in r["whitened"]]) for r in got)
    theirs = sorted((key(i, d, w[0]), [abs(c) for c in w]) for (i, _), d, w in zip(good, deviation, z))
    assert [m[0][:2] for m in mine] == [t[0][:2] for t in theirs]
    assert np.allclose([m[1] for m in mine], [t[1] for t in theirs], atol=1e-7)
    assert {r["n"] for r in got} == {n}
    assert np.allclose(got[0]["explained"], share, rtol=1e-9)
    # One sign for all rows: the whitened vectors have unit covariance.
    w = np.array([r["whitened"] for r in got])
    assert np.abs(w.T @ w / n - np.eye(w.shape[1])).max() < 1e-9
    assert len({r["identity_error"] for r in got}) == 1 and got[0]["identity_error"] < 1e-9
    flat = whitening.by_component(out)
    assert flat.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert flat.count() == n * min(wanted, 9)
    assert sorted({r["component"] for r in flat.select("component").distinct().collect()}) == list(range(1, min(wanted, 9) + 1))


def test_tables_without_variance(spark):
    schema = "vec_id long, embedding array<double>"
    assert whitening.whitened(spark.createDataFrame([], schema)).collect() == []
    assert whitening.whitened(spark.createDataFrame([(1, None), (2, [])], schema)).collect() == []
    same = whitening.whitened(spark.createDataFrame([(n, [0.5, 0.25]) for n in range(20)], schema))
    assert {tuple(r["whitened"]) for r in same.collect()} == {()}
    assert whitening.by_component(same).collect() == []
    # One direction only.
    line = whitening.whitened(spark.createDataFrame([(n, [float(n), float(2 * n)]) for n in range(20)], schema))
    assert {len(r["whitened"]) for r in line.collect()} == {1}


def test_too_large_numbers_are_refused(spark):
    df = spark.createDataFrame([(1, [1e300]), (2, [1.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="too large"):
        whitening.whitened(df).collect()
