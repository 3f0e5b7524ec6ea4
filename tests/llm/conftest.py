import random

import pytest
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

DOCS = StructType(
    [
        StructField("doc_id", LongType()),
        StructField("text", StringType()),
        StructField("lang", StringType()),
        StructField("source", StringType()),
        StructField("n_chars", LongType()),
    ]
)
LABELS = StructType(
    [StructField("doc_id", LongType()), StructField("quality", IntegerType()), StructField("toxic", IntegerType())]
)
# Names that the operators use themselves.
CLASHING = (
    "kept keep_id group_size norm node key row lines gone kept_ hashed body text_hash of_doc of_hash cuts host path "
    "bins evidence score length piece start chunk nth before tie size shares root class_id n_lines n_removed "
    "repository owner base extra live no_id an_id"
).split()


@pytest.fixture(scope="session")
def prose():
    """Text of n words drawn from a fixed vocabulary."""

    def make(n: int, seed: int, per_line: int = 12) -> str:
        rng = random.Random(seed)
        words = ["".join(rng.choice("abdeilnorstu") for _ in range(rng.randint(2, 8))) for _ in range(n)]
        lines = [" ".join(words[i : i + per_line]) for i in range(0, n, per_line)]
        return "\n".join(line.capitalize() + "." for line in lines)

    return make


@pytest.fixture(scope="session")
def odd_rows(prose):
    """Nulls in any column, empty and long texts, ties and repeated rows."""
    page = prose(120, 1)
    return [
        (1, page, "en", "a", 10),
        (1, page, "en", "a", 10),
        (2, page, "en", "a", 10),
        (3, page.replace(" ", "  "), "en", "b", 10),
        (None, page, "en", "a", 10),
        (4, None, "en", "a", None),
        (5, "", "en", None, 0),
        (6, " \t\r\n\x0b\x0c ", None, "a", 7),
        (7, "one", None, None, 3),
        (7, "other", "en", "a", 5),
        (8, "x" * 60_000, "en", "b", 60_000),
        (9, prose(9_000, 2), "en", "b", 1),
        (10, "a\n" * 3_000, "en", "b", 1),
        (11, "é 中文 😀   <|endoftext|> token = 'abcdef123456' \x1c end", "en", "b", 1),
        (None, None, None, None, None),
        (None, None, None, None, None),
    ]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, DOCS)


@pytest.fixture(scope="session")
def clashing(odd):
    from pyspark.sql import functions as F

    return odd.select("*", *(F.lit(n).alias(name) for n, name in enumerate(CLASHING)))


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from texts, numbered from 0."""
    return lambda texts: spark.createDataFrame(
        [(n, t, "en", f"s{n % 3}", len(t or "")) for n, t in enumerate(texts)], DOCS
    )
