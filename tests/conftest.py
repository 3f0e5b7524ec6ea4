import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

ORDER_FIELDS = ["order_id", "user_id", "product", "price", "quantity"]


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def orders(spark):
    """Make an order frame from rows of five values."""
    from millrace.functions.contract import ORDER_SCHEMA

    return lambda rows: spark.createDataFrame(rows, ORDER_SCHEMA)


def rows(df, *order):
    """Rows as tuples, ordered by the given columns or by all of them."""
    found = [tuple(r) for r in df.collect()]
    if order:
        places = [df.columns.index(c) for c in order]
        return sorted(found, key=lambda r: repr([r[i] for i in places]))
    return sorted(found, key=repr)
