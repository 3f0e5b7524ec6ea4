"""Check records against the order contract and split them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import contract as rules

FIELDS = rules.ORDER_SCHEMA.fieldNames()


def check_typed(orders: DataFrame) -> DataFrame:
    """Add ``reason`` to typed records: null for accepted ones."""
    return orders.withColumn("reason", rules.typed_reason())


def check_json(raw: DataFrame, value: str = "value") -> DataFrame:
    """Decode JSON text into the five typed columns plus ``reason``.

    Other columns of ``raw`` are kept, the text itself included, so that a
    rejected record can be stored as it came. The text is parsed once and every
    field is looked at once: each step is used several times by the next, so
    Spark keeps the steps apart. The generated row at the end keeps a filter on
    the reason from being moved below the steps, which would do them twice.
    """
    kept = [F.col(c) for c in raw.columns]
    parts = raw.select(*kept, rules.parsed(F.col(value).cast("string")))
    parts = parts.select(*kept, "_wrapped", *rules.record_parts())
    kinds = parts.select("*", *rules.field_kinds())
    values = kinds.select("*", rules.price_value(), rules.quantity_value())
    checked = F.struct(*FIELDS, rules.json_reason())
    return values.select(*kept, F.inline(F.array(checked)))


def accepted(checked: DataFrame) -> DataFrame:
    return checked.where(F.col("reason").isNull()).select(*FIELDS)


def quarantined(checked: DataFrame, raw_value: str | None = None) -> DataFrame:
    """Rejected records with reason and time of rejection.

    With ``raw_value`` the JSON text is kept as well: a price sent as ``-10``
    is ``-10.0`` once it is a double.
    """
    raw = [F.col(raw_value).cast("string").alias("raw")] if raw_value else []
    return checked.where(F.col("reason").isNotNull()).select(
        F.struct(*FIELDS).alias("record"),
        *raw,
        F.col("reason").alias("rejection_reason"),
        F.current_timestamp().alias("quarantined_at"),
    )


def outcome(checked: DataFrame) -> DataFrame:
    """Number of records per outcome; accepted ones have no reason."""
    return checked.groupBy(
        F.col("reason").isNull().alias("accepted"), F.col("reason").alias("reason")
    ).agg(F.count(F.lit(1)).alias("n_records"))
