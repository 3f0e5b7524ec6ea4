"""Results kept per bucket of a keyed table, and brought up to date by its touched buckets.

For each bucket a result of its rows is stored: partial sums, or counts of a check. After a
merge the results of the touched buckets are worked out anew, which takes the old ones back
and adds the new ones; those of the other buckets stay as they are. The whole result is then
the sum over the stored ones, which are small, and the table is not read again.

Results are a Parquet table partitioned by the bucket and written with dynamic overwrite.
Before a merge, the results of the buckets it will touch are dropped, and a refresh works
out every bucket that has none, so a run that was stopped between a merge and its refresh
leaves nothing stale. A table that got more buckets has results of its new ones only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.sources import buckets, files


def _root(path: str, found: buckets.Layout) -> str:
    return f"{path}/by{found.n_buckets}"


def _folder(root: str, bucket: int) -> str:
    return f"{root}/{buckets.BUCKET}={bucket}"


def _there(spark: SparkSession, root: str) -> set[int]:
    names = files.child_dirs(spark, root)
    return {int(n.split("=")[1]) for n in names if n.startswith(f"{buckets.BUCKET}=")}


def forget(spark: SparkSession, table: str, path: str, touched: set[int]) -> None:
    """Drop the results of buckets that are about to change."""
    found = buckets.layout(spark, table)
    if found is not None:
        for bucket in touched & _there(spark, _root(path, found)):
            files.delete(spark, _folder(_root(path, found), bucket))


def stale(spark: SparkSession, table: str, path: str) -> set[int]:
    """Buckets of the table that have no stored result."""
    found = buckets.layout(spark, table)
    return buckets.numbers(spark, found) - _there(spark, _root(path, found)) if found else set()


def refresh(
    spark: SparkSession, table: str, path: str, partial: Callable[[DataFrame], DataFrame]
) -> set[int]:
    """Work out the results of all buckets that have none; their numbers.

    ``partial`` gets rows with ``_bucket``, dealt out by the table's key, and returns the
    result's rows with the ``_bucket`` that they belong to, at least one for each.
    """
    missing = stale(spark, table, path)
    if missing:
        found = buckets.layout(spark, table)
        result = partial(buckets.scan(spark, found, missing))
        writer = result.write.partitionBy(buckets.BUCKET).mode("overwrite")
        writer.option("partitionOverwriteMode", "dynamic").parquet(_root(path, found))
    return missing


def read(spark: SparkSession, table: str, path: str, schema: str) -> DataFrame:
    """The stored results of all buckets; none of an empty table."""
    found = buckets.layout(spark, table)
    if found is None or not _there(spark, _root(path, found)):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(_root(path, found))
