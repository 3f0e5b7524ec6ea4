"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.sources import files

#: White space of the contracts: blank, tab, line feed, vertical tab, form feed, carriage return.
SPACES = r"[\x20\x09-\x0D]"
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
_BATCH_ROWS = "500"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def batched(df: DataFrame) -> DataFrame:
    """Rows for Python tasks: spread over the cores, a few hundred to an Arrow batch.

    The default batch of 10,000 rows would hold gigabytes where texts are long.
    A setting that the user made is kept.
    """
    conf = df.sparkSession.conf
    if conf.get(_BATCH, "10000") == "10000":
        conf.set(_BATCH, _BATCH_ROWS)
    return files.spread(df)


def or_empty(column: Column) -> Column:
    return F.coalesce(column, F.lit(""))


def fresh(df: DataFrame, *wanted: str) -> list[str]:
    """Column names like the wanted ones that the frame has not yet, in any case."""
    taken = {c.lower() for c in df.columns}
    names = []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        names.append(name)
    return names
