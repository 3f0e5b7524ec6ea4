"""The order contract as columns: one reason per record, null when it passes.

Rules are tried in field order and the first failure is reported. Two forms
share the rules: typed columns, and JSON text whose values keep the type they
were sent with, so that the number 5 is not taken for the string "5".
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

# The order fields, the price limit and the rejection messages.
ORDER_SCHEMA = StructType(
    [
        StructField("order_id", StringType(), False),
        StructField("user_id", StringType(), True),
        StructField("product", StringType(), True),
        StructField("price", DoubleType(), True),
        StructField("quantity", IntegerType(), True),
    ]
)
TEXT_FIELDS = ("order_id", "user_id", "product")
MAX_PRICE = 1_000_000.0

MISSING = "Field required"
NOT_TEXT = "Input should be a valid string"
EMPTY_TEXT = "String should have at least 1 character"
NOT_NUMBER = "Input should be a valid number"
NOT_NUMBER_TEXT = "Input should be a valid number, unable to parse string as a number"
NOT_INTEGER = "Input should be a valid integer"
NOT_INTEGER_TEXT = "Input should be a valid integer, unable to parse string as an integer"
FRACTION = "Input should be a valid integer, got a number with a fractional part"
NOT_FINITE = "Input should be a finite number"
TOO_LONG = "Unable to parse input string as an integer, exceeded maximum size"
NOT_POSITIVE = "Input should be greater than 0"
TOO_EXPENSIVE = "Value error, price exceeds reasonable maximum"
NOT_OBJECT = "Input should be an object"
INVALID_JSON = "invalid JSON"

# Blanks allowed around numbers sent as text, and the number texts.
NUMBER_BLANKS = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
_DIGITS = r"[0-9]+(?:_[0-9]+)*"
INTEGER_TEXT = rf"^[+-]?{_DIGITS}(?:\.0+)?$"
DECIMAL_TEXT = r"^[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?$"
STRAY_UNDERSCORE = r"^_|__|_$"
INFINITE_TEXT = r"^[+-]?inf(?:inity)?$"
NAN_TEXT = r"^[+-]?nan$"


def _text_reason(value: Column) -> Column:
    return F.when(value.isNull(), F.lit(NOT_TEXT)).when(F.length(value) < 1, F.lit(EMPTY_TEXT))


def _positive_reason(value: Column) -> Column:
    return F.when(~(value > 0), F.lit(NOT_POSITIVE))


def _price_range_reason(value: Column) -> Column:
    """NaN compares as the greatest number in Spark, so it is named apart."""
    return F.when(~(value > 0) | F.isnan(value), F.lit(NOT_POSITIVE)).when(
        value > MAX_PRICE, F.lit(TOO_EXPENSIVE)
    )


def typed_reason() -> Column:
    """Reason for a record that already has the five typed columns."""
    price, quantity = F.col("price"), F.col("quantity")
    return F.coalesce(
        *[_text_reason(F.col(name)) for name in TEXT_FIELDS],
        F.when(price.isNull(), F.lit(NOT_NUMBER)).otherwise(_price_range_reason(price)),
        F.when(quantity.isNull(), F.lit(NOT_INTEGER)).otherwise(_positive_reason(quantity)),
    )


# JSON form. Each value is looked at several times, so it is worked out in steps,
# every step a projection of its own: see ``operators.contract.check_json``. Names
# of helper columns start with an underscore.

# The record is parsed within a list, with an end mark behind it: the parser stops
# after one value, so text that follows a record would go unseen otherwise.
_END = "end of record"


def parsed(json_text: Column) -> Column:
    wrapped = F.concat(F.lit("["), json_text, F.lit(f',"{_END}"]'))
    return F.try_parse_json(wrapped).alias("_wrapped")


def record_parts() -> list[Column]:
    """The fields as variants: null if absent, a variant null if sent as null."""
    wrapped = F.col("_wrapped")
    return [
        F.try_variant_get(wrapped, "$[1]", "string").eqNullSafe(_END).alias("_closed"),
        *[
            F.try_variant_get(wrapped, f"$[0].{name}", "variant").alias(f"_{name}")
            for name in ORDER_SCHEMA.fieldNames()
        ],
    ]


def field_kinds() -> list[Column]:
    """What each field was sent as: its type, its text, its number."""
    columns = [
        F.when(
            F.schema_of_variant(F.col(f"_{name}")) == "STRING",
            F.try_variant_get(F.col(f"_{name}"), "$", "string"),
        ).alias(name)
        for name in TEXT_FIELDS
    ]
    for name in ("price", "quantity"):
        part = F.col(f"_{name}")
        kind = F.schema_of_variant(part)
        text = F.when(kind == "STRING", F.try_variant_get(part, "$", "string"))
        number = F.when(
            kind.isin("BIGINT", "DOUBLE", "FLOAT", "BOOLEAN") | kind.startswith("DECIMAL"),
            F.try_variant_get(part, "$", "double"),
        )
        columns += [
            F.btrim(text, F.lit(NUMBER_BLANKS)).alias(f"_{name}_text"),
            number.alias(f"_{name}_number"),
        ]
    return columns


# Doubles from here on have no fractional part.
_ALL_WHOLE = float(2**53)


def _plain(text: Column) -> Column:
    return F.replace(text, F.lit("_"), F.lit(""))


def price_value() -> Column:
    """The price as a double, null if it is no number."""
    text = F.col("_price_text")
    plain = F.when(~text.rlike(STRAY_UNDERSCORE), _plain(text))
    sign = F.when(plain.startswith("-"), F.lit(-1.0)).otherwise(F.lit(1.0))
    return F.coalesce(
        F.col("_price_number"),
        F.when(plain.rlike(DECIMAL_TEXT), plain.try_cast("double")),
        F.when(F.lower(plain).rlike(INFINITE_TEXT), sign * F.lit(float("inf"))),
        F.when(F.lower(plain).rlike(NAN_TEXT), F.lit(float("nan"))),
    ).alias("price")


def quantity_value() -> Column:
    """The quantity as an int, null if it is none or does not fit."""
    text, number = F.col("_quantity_text"), F.col("_quantity_number")
    digits = F.regexp_replace(_plain(text), r"\.0+$", "")
    whole = (F.abs(number) < _ALL_WHOLE) & (number == F.floor(number))
    return F.coalesce(
        F.when(whole, number.try_cast("int")),
        F.when(text.rlike(INTEGER_TEXT), digits.try_cast("int")),
    ).alias("quantity")


def _root_reason() -> Column:
    root = F.schema_of_variant(F.try_variant_get("_wrapped", "$[0]", "variant"))
    no_object = ~F.coalesce(root.startswith("OBJECT"), F.lit(False))
    return F.when(~F.col("_closed"), F.lit(INVALID_JSON)).when(
        F.col("_order_id").isNull() & no_object, F.lit(NOT_OBJECT)
    )


def _sent(name: str, reason: Column) -> Column:
    return F.when(F.col(f"_{name}").isNull(), F.lit(MISSING)).otherwise(reason)


def _price_reason() -> Column:
    price = F.col("price")
    return (
        F.when(price.isNotNull(), _price_range_reason(price))
        .when(F.col("_price_text").isNotNull(), F.lit(NOT_NUMBER_TEXT))
        .otherwise(F.lit(NOT_NUMBER))
    )


def _quantity_reason() -> Column:
    quantity, number = F.col("quantity"), F.col("_quantity_number")
    text = F.col("_quantity_text")
    # A whole number that Spark's int cannot hold is refused, as too long unless
    # it is negative anyway.
    return (
        F.when(quantity.isNotNull(), _positive_reason(quantity))
        .when(F.abs(number) == float("inf"), F.lit(NOT_FINITE))
        .when((F.abs(number) < _ALL_WHOLE) & (number != F.floor(number)), F.lit(FRACTION))
        .when(
            number.isNotNull() | text.rlike(INTEGER_TEXT),
            F.when((number < 0) | text.startswith("-"), F.lit(NOT_POSITIVE)).otherwise(
                F.lit(TOO_LONG)
            ),
        )
        .when(text.isNotNull(), F.lit(NOT_INTEGER_TEXT))
        .otherwise(F.lit(NOT_INTEGER))
    )


def json_reason() -> Column:
    """Reason for a decoded record, null if it passes."""
    return F.coalesce(
        _root_reason(),
        *[_sent(name, _text_reason(F.col(name))) for name in TEXT_FIELDS],
        _sent("price", _price_reason()),
        _sent("quantity", _quantity_reason()),
    ).alias("reason")
