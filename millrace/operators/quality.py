"""Column checks on clean orders, and the verdict that stops a run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The names under which check results are reported.
NOT_NULL = "ExpectColumnValuesToNotBeNull"
UNIQUE = "ExpectColumnValuesToBeUnique"
BETWEEN = "ExpectColumnValuesToBeBetween"


class GateFailed(RuntimeError):
    """A check failed; later stages must not run."""


_COUNTS = ("no_key", "repeated", "price", "quantity", "product")
COUNTS = ", ".join(f"{name} long" for name in _COUNTS)


def unexpected(orders: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Counts of unexpected rows of each check, one row (or one for each ``by``).

    Rows are counted per key first, which the uniqueness check needs, and a key with very
    many rows arrives as one partial count per task. Where ``by`` is the bucket of a table
    that is dealt out by the key, nothing is shuffled for that. Equal keys must share it.
    """
    per_key = orders.groupBy(*by, "order_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(~(F.col("price") > 0)).alias("price"),
        F.count_if(~(F.col("quantity") > 0)).alias("quantity"),
        F.count_if(F.col("product").isNull()).alias("product"),
    )
    missing_key = F.col("order_id").isNull()
    counts = {
        "no_key": F.sum(F.when(missing_key, F.col("n"))),
        "repeated": F.sum(F.when(~missing_key & (F.col("n") > 1), F.col("n"))),
        "price": F.sum("price"),
        "quantity": F.sum("quantity"),
        "product": F.sum("product"),
    }
    return per_key.groupBy(*by).agg(*[counts[name].alias(name) for name in _COUNTS])


def check_results(orders: DataFrame) -> DataFrame:
    """One row per check: check, column, success, unexpected_count.

    All five come from one scan and one shuffle. Nulls are ignored by all but the null
    checks, every row of a repeated key counts as unexpected, and empty input passes.
    """
    return results_of(unexpected(orders))


def results_of(counts: DataFrame) -> DataFrame:
    """The same from counts of parts of the orders that share no key."""
    totals = counts.agg(*[F.sum(name).alias(name) for name in _COUNTS])
    checks = [
        (1, NOT_NULL, "order_id", "no_key"),
        (2, UNIQUE, "order_id", "repeated"),
        (3, BETWEEN, "price", "price"),
        (4, BETWEEN, "quantity", "quantity"),
        (5, NOT_NULL, "product", "product"),
    ]
    rows = F.array(
        *[
            F.struct(
                F.lit(number).alias("check_no"),
                F.lit(check).alias("check"),
                F.lit(column).alias("column"),
                F.coalesce(F.col(total), F.lit(0).cast("bigint")).alias("unexpected_count"),
            )
            for number, check, column, total in checks
        ]
    )
    return totals.select(F.inline(rows)).withColumn("success", F.col("unexpected_count") == 0)


def passed(results: DataFrame) -> bool:
    """True if every check passed. The input is one row per check."""
    return bool(results.agg(F.bool_and("success")).first()[0])
