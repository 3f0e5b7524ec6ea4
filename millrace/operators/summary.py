"""Product summary of clean orders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Column names of the published summary.
ORDERS, UNITS, REVENUE, PRICE = "total_orders", "total_units_sold", "total_revenue", "avg_price"


# Sums that add up over parts of the orders. ``value`` is the price, in cents or as it is.
PARTS = "product string, n_orders long, units long, n_prices long, value {kind}, revenue {kind}"


def parts_schema(whole_cents: bool = False) -> str:
    return PARTS.format(kind="long" if whole_cents else "double")


def partial_sums(orders: DataFrame, whole_cents: bool = False, by: tuple[str, ...] = ()) -> DataFrame:
    """Sums per product (and ``by``), of which sums of parts are sums of the whole."""
    price, quantity = F.col("price"), F.col("quantity")
    value = F.round(price * 100).cast("bigint") if whole_cents else price
    return orders.groupBy(*by, "product").agg(
        F.count("order_id").alias("n_orders"),
        F.sum("quantity").alias("units"),
        F.count("price").alias("n_prices"),
        F.sum(value).alias("value"),
        F.sum(value * quantity).alias("revenue"),
    )


def summed_up(parts: DataFrame, whole_cents: bool = False) -> DataFrame:
    """The product summary from partial sums."""
    total, n = F.sum("value"), F.sum("n_prices")
    if whole_cents:
        revenue = F.sum("revenue") / 100
        # The mean plus one half, cut to a whole number of cents.
        mean = F.call_function("div", 2 * total + n, F.nullif(2 * n, F.lit(0))) / 100
    else:
        revenue = F.round(F.sum("revenue"), 2)
        mean = F.round(total / F.nullif(n, F.lit(0)), 2)
    return parts.groupBy("product").agg(
        F.sum("n_orders").alias(ORDERS),
        F.sum("units").alias(UNITS),
        revenue.alias(REVENUE),
        mean.alias(PRICE),
    )


def product_summary(orders: DataFrame, whole_cents: bool = False) -> DataFrame:
    """Orders, units, revenue and mean price per product.

    The mean is over orders and not weighted by quantity. Sums are combined
    before the shuffle, so one product with most of the orders is no problem.

    A sum of doubles depends on the order of its terms, which can tip a rounding
    at half a cent. Where all prices are positive and in whole cents,
    ``whole_cents`` adds integers: the same result however the rows lie.
    """
    price, quantity = F.col("price"), F.col("quantity")
    if whole_cents:
        cents = F.round(price * 100).cast("bigint")
        revenue = F.sum(cents * quantity) / 100
        # The mean plus one half, cut to a whole number of cents.
        total, n = F.sum(cents), F.count("price")
        mean = F.call_function("div", 2 * total + n, F.nullif(2 * n, F.lit(0))) / 100
    else:
        revenue = F.round(F.sum(price * quantity), 2)
        mean = F.round(F.avg("price"), 2)
    return orders.groupBy("product").agg(
        F.count("order_id").alias(ORDERS),
        F.sum("quantity").alias(UNITS),
        revenue.alias(REVENUE),
        mean.alias(PRICE),
    )


def by_revenue(summary: DataFrame) -> DataFrame:
    """Report order: highest revenue first. Applied when read, files keep no order."""
    return summary.orderBy(F.desc(REVENUE), "product")
