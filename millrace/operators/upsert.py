"""Keyed upsert: update all columns of matched rows, insert the others."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from millrace.sources import files

_MATCHED = "_matched"
_WHAT = "_what"
_HASH = "_hash"

# A source of up to this many measured bytes is sent to every task.
SMALL_SOURCE_BYTES = 32 << 20


class AmbiguousSource(ValueError):
    """Several source rows would update the same target row."""


@dataclass(frozen=True)
class Merge:
    """The two disjoint parts of a merge result, still lazy."""

    kept_and_updated: DataFrame
    inserted: DataFrame
    columns: list[str]
    small: bool = False

    def with_kept(self, rows: DataFrame) -> Merge:
        """The same with further target rows, which nothing matches."""
        none = F.lit(None).cast(self.kept_and_updated.schema[_MATCHED].dataType)
        return replace(self, kept_and_updated=self.kept_and_updated.unionByName(rows.withColumn(_MATCHED, none)))

    def result(self) -> DataFrame:
        return self.kept_and_updated.select(*self.columns).unionByName(self.inserted)

    def observed(self) -> tuple[DataFrame, Observation]:
        """The result, and its counts once it has been written: ``n_updated``,
        ``n_inserted`` and ``n_kept`` rows."""
        updated = F.col(_MATCHED).isNotNull()
        flagged = self.kept_and_updated.select(
            *self.columns, F.when(updated, "u").otherwise("k").alias(_WHAT)
        ).unionByName(self.inserted.withColumn(_WHAT, F.lit("i")))
        counts = Observation()
        seen = flagged.observe(
            counts,
            *[
                F.count_if(F.col(_WHAT) == what).alias(name)
                for what, name in (("u", "n_updated"), ("i", "n_inserted"), ("k", "n_kept"))
            ],
        )
        return seen.drop(_WHAT), counts


def latest(source: DataFrame, key: str, order: Column) -> DataFrame:
    """The last row of each key; rows without a key are kept, as they match nothing.

    A maximum combines before the shuffle, so a key that makes up much of the
    source costs one partial row per task and not one huge sorted group. Equal
    order values are settled by the other columns, so the choice is repeatable.
    """
    row = F.struct(order.alias("at"), F.struct(*source.columns).alias("row"))
    best = (
        source.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.max(row).alias("_last"))
        .select("_last.row.*")
    )
    return best.unionByName(source.where(F.col(key).isNull()))


def _refuse_repeats(target: DataFrame, source: DataFrame, key: str) -> None:
    """Raise if several source rows would update the same target row."""
    keyed = source.where(F.col(key).isNotNull())
    # Eight bytes of each key are shuffled. Where no hash repeats, no key does; else the keys
    # of the repeated hashes are looked at.
    hashes = keyed.groupBy(F.xxhash64(key).alias(_HASH)).count().where("count > 1").select(_HASH)
    if not hashes.take(1):
        return
    suspect = keyed.withColumn(_HASH, F.xxhash64(key)).join(hashes, _HASH, "left_semi")
    repeated = suspect.groupBy(key).count().where("count > 1")
    if repeated.take(1):
        hit = repeated.join(target.select(key), key, "left_semi").take(1)
        if hit:
            raise AmbiguousSource(f"several source rows have the key {hit[0][0]!r}")


def merge(
    target: DataFrame,
    source: DataFrame,
    key: str,
    latest_by: Column | None = None,
    source_bytes: int | None = None,
) -> Merge:
    """Merge ``source`` into ``target`` on equal keys.

    Matched target rows take every column from the source, nulls included; a
    key that occurs several times in the target is updated each time; null keys
    match nothing. A key given several times by the source is an error if it
    matches, unless ``latest_by`` says which row counts.

    It is written as a left join for the target rows and an anti join for the
    inserts, not as one full outer join: Spark splits the skewed keys of a left
    join, and a source measured to be small is broadcast, leaving the target
    unshuffled. A full outer join allows neither. Both joins take the same columns of
    the source, so that Spark shuffles it once for the two. ``source_bytes`` is its size
    as ``files.measured_bytes`` has it, if that is known.
    """
    if latest_by is not None:
        source, source_bytes = latest(source, key, latest_by), None
    else:
        _refuse_repeats(target, source, key)
    if source_bytes is None:
        source_bytes = files.measured_bytes(source)[1]
    small = source_bytes <= SMALL_SOURCE_BYTES
    columns = target.columns
    has_key = F.col(key).isNotNull()
    # The target's columns are renamed and not the source's, whose rows both joins then
    # take as they are.
    old_of = {c: f"_old_{c}" for c in columns}
    old = target.select(*[F.col(c).alias(name) for c, name in old_of.items()])
    old_key = F.col(old_of[key])
    same_key = old_key == F.col(key)
    flagged = source.where(has_key).select(*columns)
    if small:
        flagged = F.broadcast(flagged)
        joined = old.join(flagged, same_key, "left")
        # Only target keys that the source has are left to be made distinct.
        keys = old.select(old_key).join(F.broadcast(flagged.select(key)), same_key, "left_semi")
    else:
        # Rows without a key would all meet in one task of the shuffle.
        unkeyed = old.where(old_key.isNull()).withColumns(
            {c: F.lit(None).cast(flagged.schema[c].dataType) for c in columns}
        )
        joined = old.where(old_key.isNotNull()).join(flagged, same_key, "left").unionByName(unkeyed)
        keys = old.where(old_key.isNotNull()).select(old_key)
    updated = joined.select(
        *[
            old_key.alias(c) if c == key else F.when(has_key, F.col(c)).otherwise(F.col(name)).alias(c)
            for c, name in old_of.items()
        ],
        F.when(has_key, F.lit(True)).alias(_MATCHED),
    )
    # Distinct keys are combined per task, so a key with very many target rows
    # reaches the anti join as one row per task.
    new = flagged.join(keys.distinct(), same_key, "left_anti").select(*columns)
    inserted = new.unionByName(source.where(~has_key).select(*columns))
    return Merge(updated, inserted, columns, small)
