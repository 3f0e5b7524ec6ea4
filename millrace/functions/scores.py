"""Score formulas as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Okapi BM25 parameters, the fusion constant, and list depths.
BM25_K1 = 1.5
BM25_B = 0.75
BM25_EPSILON = 0.25
RRF_K = 60


def raw_idf(n_units: int, df: Column) -> Column:
    """ln of the odds that a unit lacks the term; negative for very common terms."""
    return F.log(F.lit(float(n_units)) - df + 0.5) - F.log(df + 0.5)


def floored_idf(raw: Column, mean_raw: float, epsilon: float = BM25_EPSILON) -> Column:
    """Replace negative idf by a share of the mean idf over all terms."""
    return F.when(raw < 0, F.lit(epsilon * mean_raw)).otherwise(raw)


def reciprocal_rank(rank: Column, k: int = RRF_K) -> Column:
    return F.lit(1.0) / (F.lit(k) + rank)
