"""Keyed tables in Spark's own bucket layout.

A table is an external Spark table under ``<path>/by<n>``: partitioned by ``_bucket`` and
clustered by the key into the same number of buckets, so a partition folder holds one
bucket of Spark's hash of the key. Spark then knows how a scan is dealt out: joins and
groupings by the key shuffle the other side only, and a merge writes its result over the
touched partitions with ``partitionOverwriteMode=dynamic`` and leaves the others alone.

The number of buckets follows the stored size: a table that has outgrown its buckets is
written anew with more of them, under the folder of that number, before the old folder
goes. Column types and the key are read from an empty Parquet file, ``_schema``, which is
written last, so a table is there when that file is. There is one writer at a time; a merge
that was stopped midway is completed by running it again, as it gives the same rows, but for
rows without a key, which it inserts again.

Rows without a key match nothing. They lie in partitions of negative numbers, spread by a
hash of all columns, and take no part in joins.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from millrace.operators import upsert
from millrace.sources import files

BUCKET = "_bucket"
#: A bucket's stored bytes when it is made; at twice that the table gets more buckets.
BUCKET_BYTES = 256 << 20
MIN_BUCKETS = 8
_IS_KEY = "bucket_key"
_SCHEMA = "_schema"
_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


class MissingKey(ValueError):
    """Rows without a key where each needs one."""


@dataclass(frozen=True)
class Layout:
    """Where a table lies and how it is divided."""

    path: str
    n_buckets: int
    key: str
    schema: StructType

    @property
    def root(self) -> str:
        return f"{self.path}/by{self.n_buckets}"

    @property
    def name(self) -> str:
        """Its name in Spark's catalog."""
        return f"millrace_{hashlib.md5(self.root.encode()).hexdigest()}"

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    def bucket(self) -> Column:
        """The partition of a row; of rows with a key, the bucket that Spark deals it to."""
        places = F.lit(self.n_buckets)
        keyless = F.lit(-1) - F.pmod(F.hash(*[F.col(f"`{c}`") for c in self.columns]), places)
        key = F.col(f"`{self.key}`")
        return F.when(key.isNotNull(), F.pmod(F.hash(key), places)).otherwise(keyless)


def layout(spark: SparkSession, path: str) -> Layout | None:
    """How the table under ``path`` is laid out, or None if there is none."""
    found = [int(n[2:]) for n in files.child_dirs(spark, path) if n.startswith("by") and n[2:].isdigit()]
    for n in sorted(found, reverse=True):
        marker = f"{path}/by{n}/{_SCHEMA}"
        if files.exists(spark, f"{marker}/_SUCCESS"):
            schema = spark.read.parquet(marker).schema
            (key,) = [f.name for f in schema.fields if f.metadata.get(_IS_KEY)]
            return Layout(path, n, key, schema)
    return None


def _needed(spark: SparkSession, path: str) -> Layout:
    found = layout(spark, path)
    if found is None:
        raise FileNotFoundError(f"no table under {path}")
    return found


def _registered(spark: SparkSession, found: Layout) -> str:
    """The table's name in the catalog, where it is entered if this session lacks it."""
    if not spark.catalog.tableExists(found.name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in found.schema.fields)
        location = found.root.replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE {found.name} ({columns}, {BUCKET} INT) USING parquet "
            f"OPTIONS (partitionOverwriteMode 'dynamic', compression '{files.CODEC}') PARTITIONED BY ({BUCKET}) "
            f"CLUSTERED BY (`{found.key}`) INTO {found.n_buckets} BUCKETS LOCATION '{location}'"
        )
        if files.exists(spark, found.root):
            spark.sql(f"ALTER TABLE {found.name} RECOVER PARTITIONS")
    return found.name


def numbers(spark: SparkSession, found: Layout) -> set[int]:
    """Partitions that hold rows."""
    names = files.child_dirs(spark, found.root)
    return {int(n.split("=")[1]) for n in names if n.startswith(f"{BUCKET}=")}


def _files(spark: SparkSession, found: Layout) -> DataFrame:
    """The table by its files, with the bucket number."""
    schema = StructType([*found.schema.fields]).add(BUCKET, IntegerType())
    return spark.read.schema(schema).parquet(found.root)


def read(spark: SparkSession, path: str) -> DataFrame:
    found = _needed(spark, path)
    return _files(spark, found).select(*[f"`{c}`" for c in found.columns])


def scan(spark: SparkSession, found: Layout, wanted: set[int]) -> DataFrame:
    """Rows of some partitions, with ``_bucket``. Those with a key come dealt out by it."""
    keyed = sorted(b for b in wanted if b >= 0)
    rows = spark.table(_registered(spark, found)).where(F.col(BUCKET).isin(keyed))
    keyless = sorted(b for b in wanted if b < 0)
    if keyless:
        rows = rows.unionByName(_files(spark, found).where(F.col(BUCKET).isin(keyless)))
    return rows


def _fitting(stored: int, bucket_bytes: int) -> int:
    wanted = max(1, -(-stored // bucket_bytes))
    return max(MIN_BUCKETS, 1 << (wanted - 1).bit_length())


def _insert(rows: DataFrame, name: str) -> None:
    """Write rows over the partitions they belong to.

    A task has the rows of a few buckets, each of which gets a writer of its own; Spark
    sorts the rows of a task that has more of them.
    """
    conf = rows.sparkSession.conf
    before = conf.get(_WRITERS)
    conf.set(_WRITERS, "8")
    try:
        rows.write.mode("overwrite").insertInto(name)
    finally:
        conf.set(_WRITERS, before)


def _write_new(spark: SparkSession, rows: DataFrame, found: Layout) -> None:
    """A whole table; what a stopped attempt left under its folder goes first."""
    if files.exists(spark, found.root):
        files.delete(spark, found.root)
    spark.sql(f"DROP TABLE IF EXISTS {found.name}")
    columns = [F.col(f"`{c}`") for c in found.columns]
    placed = rows.select(*columns, found.bucket().alias(BUCKET)).repartition(found.n_buckets, BUCKET)
    _insert(placed, _registered(spark, found))
    marked = [c.alias(n, metadata={_IS_KEY: n == found.key}) for c, n in zip(columns, found.columns)]
    rows.select(*marked).limit(0).coalesce(1).write.mode("overwrite").parquet(f"{found.root}/{_SCHEMA}")


def seed(
    spark: SparkSession,
    path: str,
    initial: DataFrame,
    key: str,
    n_buckets: int | None = None,
    bucket_bytes: int = BUCKET_BYTES,
) -> bool:
    """Write ``initial`` if the table does not exist yet; says whether it did.

    Without ``n_buckets`` their number comes from the counted size of the rows, which is
    read twice then.
    """
    if layout(spark, path) is not None:
        return False
    if n_buckets is None:
        n_buckets = _fitting(files.measured_bytes(initial)[1], bucket_bytes)
    _write_new(spark, initial, Layout(path, n_buckets, key, initial.schema))
    return True


def merge(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    latest_by: Column | None = None,
    before_write: Callable[[set[int]], None] | None = None,
    need_keys: bool = False,
    bucket_bytes: int = BUCKET_BYTES,
) -> dict[str, int]:
    """Merge ``source`` into the table by its key; counts of the rows of touched partitions.

    ``source`` is read several times, so it should be stored. ``before_write`` gets the
    numbers of the partitions that will be written. With ``need_keys`` rows without a key
    are refused, as running such a merge again would insert them again.
    """
    found = _needed(spark, path)
    source_bytes = files.measured_bytes(source)[1]
    if source_bytes > bucket_bytes * found.n_buckets:
        # Else a bucket's share of the source, which one task sorts, would have no bound.
        found = _grow(spark, found, _fitting(source_bytes, bucket_bytes))
    # At most two numbers per bucket.
    touched = {r[0] for r in source.select(found.bucket().alias(BUCKET)).distinct().collect()}
    if need_keys and any(b < 0 for b in touched):
        raise MissingKey(f"rows without {found.key}")
    if not touched:
        return dict.fromkeys(("n_updated", "n_inserted", "n_kept"), 0)
    if before_write is not None:
        before_write(touched)
    columns = [f"`{c}`" for c in found.columns]
    target = scan(spark, found, {b for b in touched if b >= 0}).select(*columns)
    merged = upsert.merge(target, source, found.key, latest_by, source_bytes)
    keyless = {b for b in touched if b < 0}
    if keyless:
        merged = merged.with_kept(scan(spark, found, keyless).select(*columns))
    if merged.small:
        # A few megabytes: one file per bucket instead of one from every task.
        merged = replace(merged, inserted=merged.inserted.coalesce(1))
    result, counts = merged.observed()
    name = _registered(spark, found)
    _insert(result.select(*columns, found.bucket().alias(BUCKET)), name)
    stored = files.stored_bytes(spark, found.root)
    if stored > 2 * bucket_bytes * found.n_buckets:
        _grow(spark, found, _fitting(stored, bucket_bytes))
    return {name: counts.get.get(name, 0) for name in ("n_updated", "n_inserted", "n_kept")}


def _grow(spark: SparkSession, found: Layout, n_buckets: int) -> Layout:
    """The same rows in more buckets. Readers of the old folder must be done."""
    after = Layout(found.path, n_buckets, found.key, found.schema)
    _write_new(spark, read(spark, found.path), after)
    spark.sql(f"DROP TABLE IF EXISTS {found.name}")
    files.delete(spark, found.root)
    return after
