"""Whitening of vectors by QDWH spectral divide and conquer.

1. Every entry ``c`` becomes the integer ``floor(64 c) + 10^6``. Counts and sums per
   dimension are exact integers, added per task and then over the tasks.
2. The covariance is added up in a second pass from vectors centred before they are
   multiplied; a task hands on one matrix.
3. The covariance, whose size is the square of the dimension and does not grow with the
   rows, is split on the driver. The polar factor of ``A - sigma I``, found by the dynamically
   weighted Halley iteration (QR steps first, Cholesky steps once it is well conditioned),
   is the matrix sign, so ``(U + I) / 2`` projects on the invariant subspace of the
   eigenvalues above ``sigma``. Orthonormal bases of both subspaces split ``A`` into two
   smaller blocks, and so on down to single components. Subspaces that lie wholly below
   the wanted components are not split further.
4. Components over the root of their eigenvalues are sent to the tasks, which whiten the
   vectors where they lie. A pass before the last adds up the covariance of the whitened
   vectors and reports its distance from the identity.

Defined results: rows whose vector is null, empty, or holds null, NaN or infinite entries
are dropped; of vectors of several lengths the length that most rows have counts (the
longer one of two), the others are dropped; repeated rows count each; components of no
variance, that is below ``FLAT`` of the largest, are left out, so vectors that are all
equal give no rows; no rows give no rows. Entries whose integer form or deviation would
not fit 64 bits raise an error.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType

from millrace.llm.common import fresh
from millrace.sources import files

COMPONENTS = 32
SCALE, SHIFT = 64, 1_000_000
#: Variances below this share of the largest count as none.
FLAT = 1e-12
#: Tasks that hand on a matrix, at most; each reads many splits of a large table.
PARTIALS = 4096
#: Numbers held at a time in a task.
BLOCK = 4_000_000
_EPS = np.finfo(float).eps


# Spectral divide and conquer


def polar(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix that is not singular."""
    n = len(a)
    x = a / np.linalg.norm(a)
    # A lower bound of the smallest singular value.
    low = max(_EPS, 0.9 / (np.linalg.norm(np.linalg.inv(x)) or np.inf))
    for _ in range(30):
        low2 = low * low
        d = (4 * (1 - low2) / (low2 * low2)) ** (1 / 3) if low < 1 else 0.0
        root = np.sqrt(1 + d)
        p = root + 0.5 * np.sqrt(8 - 4 * d + 8 * (2 - low2) / (low2 * root))
        q = (p - 1) ** 2 / 4
        r = p + q - 1
        before = x
        if r > 100:
            both = np.linalg.qr(np.vstack([np.sqrt(r) * x, np.eye(n)]))[0]
            x = (q / r) * x + (p - q / r) / np.sqrt(r) * both[:n] @ both[n:].T
        else:
            lower = np.linalg.cholesky(np.eye(n) + r * x.T @ x)
            part = np.linalg.solve(lower, x.T)
            x = (q / r) * x + (p - q / r) * np.linalg.solve(lower.T, part).T
        x = (x + x.T) / 2
        low = min(1.0, low * (p + q * low2) / (1 + r * low2))
        if np.linalg.norm(x - before) <= (4 * _EPS) ** (1 / 3) and 1 - low <= 10 * _EPS:
            break
    return x


def _basis(projector: np.ndarray, size: int, rng: np.random.Generator) -> np.ndarray:
    """Orthonormal columns that span what a projector of this rank keeps."""
    basis = np.linalg.qr(projector @ rng.standard_normal((len(projector), size)))[0]
    return np.linalg.qr(projector @ basis)[0]


def _split(a: np.ndarray, scale: float, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray] | None:
    """Bases of the invariant subspaces above and below a shift; None if none parts them."""
    n, diagonal = len(a), np.diag(a)
    shifts = [np.median(diagonal), diagonal.mean(), (diagonal.max() + diagonal.min()) / 2]
    shifts += [s + t * (np.ptp(diagonal) + scale * _EPS) for s in shifts[:1] for t in (0.013, -0.013, 0.11, -0.11)]
    for shift in shifts:
        try:
            sign = polar(a - shift * np.eye(n))
        except np.linalg.LinAlgError:  # the shift is an eigenvalue
            continue
        above = (sign + np.eye(n)) / 2
        size = int(round(np.trace(above)))
        if not 0 < size < n:
            continue
        high = _basis(above, size, rng)
        low = np.linalg.qr((np.eye(n) - above) @ rng.standard_normal((n, n - size)))[0]
        low = np.linalg.qr(low - high @ (high.T @ low))[0]
        if np.linalg.norm(low.T @ a @ high) <= 100 * n * _EPS * scale:
            return high, low
    return None


def components(a: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues of a symmetric matrix, falling, and their unit vectors as columns."""
    scale, rng = np.linalg.norm(a), np.random.default_rng(0)
    done: list[tuple[float, np.ndarray]] = []
    # Blocks in order of their eigenvalues, the largest on top of the stack.
    stack = [(a, np.eye(len(a)))]
    while stack and len(done) < wanted:
        block, basis = stack.pop()
        off = block - np.diag(np.diag(block))
        parts = None if np.linalg.norm(off) <= 4 * len(a) * _EPS * scale else _split(block, scale, rng)
        if parts is None:
            # One component, or eigenvalues that are equal as far as can be told.
            for n in np.argsort(-np.diag(block), kind="stable"):
                done.append((float(block[n, n]), basis[:, n]))
            continue
        for part in reversed(parts):
            inner = part.T @ block @ part
            stack.append(((inner + inner.T) / 2, basis @ part))
    done = done[:wanted]
    if not done:
        return np.zeros(0), np.zeros((len(a), 0))
    vectors = np.linalg.qr(np.stack([v for _, v in done], axis=1))[0]
    values = np.einsum("ij,ij->j", vectors, a @ vectors)
    order = np.argsort(-values, kind="stable")
    vectors = vectors[:, order]
    top = np.abs(vectors).argmax(axis=0)
    return values[order], vectors * np.sign(vectors[top, np.arange(vectors.shape[1])])


# Passes over the vectors


def usable(vectors: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """``vec_id, vector`` of rows with finite numbers only."""
    entry = F.col(vector)
    bad = F.exists(entry, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf")))
    return vectors.where(entry.isNotNull() & (F.size(entry) > 0) & ~F.coalesce(bad, F.lit(True))).select(
        F.col(vec_id).alias("vec_id"), F.transform(entry, lambda c: c.cast("double")).alias("vector")
    )


def _integers(column: pa.Array, dims: int) -> np.ndarray:
    rows = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
    x = np.floor(SCALE * rows)
    if len(x) and np.abs(x).max() >= 2**53:
        raise OverflowError("an entry is too large for an exact integer")
    return x.astype(np.int64) + SHIFT


def _blocks(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    step = max(1, BLOCK // dims)
    for batch in batches:
        for first in range(0, batch.num_rows, step):
            part = batch.slice(first, step)
            yield part, _integers(part.column("vector"), dims)


def _added(vectors: DataFrame, value: Callable[[Iterator[pa.RecordBatch]], np.ndarray], whole: bool) -> np.ndarray:
    """The sum over all tasks of what each makes of its rows, a matrix.

    Its rows are added apart, so no task holds more than some thousand rows of it.
    """
    kind = "long" if whole else "double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = value(batches)
        if total is not None:
            rows = pa.array(list(total), pa.list_(pa.int64() if whole else pa.float64()))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), rows], names=["i", "part"])

    def add(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"i": group["i"][:1], "part": [np.stack(group["part"].to_list()).sum(axis=0)]})

    schema = f"i long, part array<{kind}>"
    parts = vectors.coalesce(PARTIALS).mapInArrow(run, schema)
    found = sorted(parts.groupBy("i").applyInPandas(add, schema).collect(), key=lambda r: r["i"])
    return np.array([r["part"] for r in found], np.int64 if whole else float)


@dataclass(frozen=True)
class Whitening:
    """What was fitted: the sums of the integer vectors, and the map to whitened ones."""

    n: int
    sums: np.ndarray
    variance: float
    values: np.ndarray
    weights: np.ndarray

    @property
    def dims(self) -> int:
        return len(self.sums)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """``n x - S``, exact."""
        if self.n * (int(np.abs(x).max(initial=0)) + int(np.abs(self.sums).max(initial=0)) // max(self.n, 1) + 1) >= 2**63:
            raise OverflowError("deviations do not fit 64 bits")
        return self.n * x - self.sums

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return (self.centred(x) / self.n) @ self.weights

    def deviation(self, x: np.ndarray) -> np.ndarray:
        d = self.centred(x)
        if len(d) and np.square(d.astype(float)).sum(axis=1).max() >= 9.2e18:
            raise OverflowError("deviations do not fit 64 bits")
        return np.square(d).sum(axis=1)


def _dims(found: DataFrame) -> int:
    row = found.groupBy(F.size("vector").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).first()
    return row["dims"] if row else 0


def fit(found: DataFrame, dims: int, wanted: int = COMPONENTS) -> Whitening:
    """Fit on all rows of ``found``, which have ``dims`` entries each."""

    def sums(batches: Iterator[pa.RecordBatch]) -> np.ndarray | None:
        total = None
        for _, x in _blocks(batches, dims):
            part = np.concatenate([[len(x)], x.sum(axis=0)])[None, :]
            total = part if total is None else total + part
        return total

    added = _added(found, sums, True)[0]
    n, total = int(added[0]), added[1:]
    plain = Whitening(n, total, 0.0, np.zeros(0), np.eye(dims))

    def products(batches: Iterator[pa.RecordBatch]) -> np.ndarray | None:
        matrix = None
        for _, x in _blocks(batches, dims):
            y = plain.centred(x) / n
            matrix = y.T @ y if matrix is None else matrix + y.T @ y
        return matrix

    covariance = _added(found, products, False) / n
    covariance = (covariance + covariance.T) / 2
    values, vectors = components(covariance, min(wanted, dims))
    kept = (values > 0) & (values > FLAT * values.max(initial=0))
    values, vectors = values[kept], vectors[:, kept]
    return Whitening(n, total, float(np.trace(covariance)), values, vectors / np.sqrt(values))


def identity_error(found: DataFrame, fitted: Whitening) -> float:
    """Largest entry of the whitened vectors' covariance minus the identity."""
    size = len(fitted.values)
    if not size:
        return 0.0

    def products(batches: Iterator[pa.RecordBatch]) -> np.ndarray | None:
        matrix = None
        for _, x in _blocks(batches, fitted.dims):
            z = fitted.whiten(x)
            # The sums come along as one more row; they are those of centred vectors.
            part = np.vstack([z.T @ z, z.sum(axis=0)])
            matrix = part if matrix is None else matrix + part
        return matrix

    added = _added(found, products, False) / fitted.n
    covariance = added[:-1] - np.outer(added[-1], added[-1])
    return float(np.abs(covariance - np.eye(size)).max())


def whitened(
    vectors: DataFrame, wanted: int = COMPONENTS, vec_id: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """``vec_id, n, deviation, whitened, explained, identity_error``: arrays by component."""
    found = usable(vectors, vec_id, vector)
    schema = StructType(
        [
            StructField("vec_id", found.schema["vec_id"].dataType),
            StructField("n", LongType()),
            StructField("deviation", LongType()),
            StructField("whitened", found.schema["vector"].dataType),
            StructField("explained", found.schema["vector"].dataType),
            StructField("identity_error", DoubleType()),
        ]
    )
    dims = _dims(found)
    if not dims:
        return vectors.sparkSession.createDataFrame([], schema)
    found = files.spread(found.where(F.size("vector") == dims))
    fitted = fit(found, dims, wanted)
    error = identity_error(found, fitted)
    share = fitted.values / fitted.variance if fitted.variance else fitted.values

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in _blocks(batches, dims):
            n, size = len(x), len(share)
            offsets = pa.array(np.arange(0, n * size + 1, size) if size else np.zeros(n + 1, int), pa.int32())
            flat = pa.array(fitted.whiten(x).ravel())
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("vec_id"),
                    pa.array(np.full(n, fitted.n)),
                    pa.array(fitted.deviation(x)),
                    pa.ListArray.from_arrays(offsets, flat),
                    pa.ListArray.from_arrays(offsets, pa.array(np.tile(share, n))),
                    pa.array(np.full(n, error)),
                ],
                names=schema.names,
            )

    return found.mapInArrow(run, schema)


def by_component(rows: DataFrame) -> DataFrame:
    """One row per vector and component, numbered from 1."""
    at, pair = fresh(rows, "at", "pair")
    each = rows.select("*", F.posexplode(F.arrays_zip("whitened", "explained")).alias(at, pair))
    return each.select(
        "vec_id",
        (F.col(at) + 1).cast(IntegerType()).alias("component"),
        "n",
        "deviation",
        F.col(f"{pair}.whitened").alias("whitened"),
        F.col(f"{pair}.explained").alias("explained"),
        "identity_error",
    )
