"""Drain a topic into Bronze and quarantine, and merge order updates as they come."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.functions.contract import ORDER_SCHEMA
from millrace.operators import contract
from millrace.sources import buckets, feeds, files, tables


def drain(
    messages: DataFrame,
    bronze_path: str,
    quarantine_path: str,
    checkpoint: str,
    then: Callable[[DataFrame, int, int], None] | None = None,
    counts_path: str | None = None,
) -> StreamingQuery:
    """Check every message that is there now, store it, and stop.

    With a new checkpoint the topic is read from its start; with a kept one,
    only what came since. Each micro-batch is decoded once and written to two
    places under its number, so a batch that is run again after a failure
    replaces what it had written. ``then`` gets the stored accepted rows of a
    batch, its number, and how many rows there are, before the batch counts as
    done; it may see a batch again. Rows are counted as they are written.
    ``counts_path`` keeps the number of messages of every batch, for
    :func:`consumed`; Spark's own progress remembers the latest ones only.
    """
    spark: SparkSession = messages.sparkSession

    def route(batch: DataFrame, batch_id: int) -> None:
        checked = _held(contract.check_json(batch.select("value"))).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            good = contract.accepted(checked)
            bad = contract.quarantined(checked, raw_value="value")
            kept, refused = Observation(), Observation()
            rows = F.count(F.lit(1)).alias("rows")
            tables.put_batch(good.observe(kept, rows), bronze_path, ORDER_SCHEMA, batch_id)
            feeds.put_quarantine_batch(bad.observe(refused, rows), quarantine_path, batch_id)
            n_kept = kept.get.get("rows", 0)
            if counts_path is not None:
                n_messages = n_kept + refused.get.get("rows", 0)
                line = json.dumps({"batch_id": batch_id, "n_messages": n_messages})
                files.put_text(spark, f"{counts_path}/{batch_id}.json", line + "\n", replace=True)
        finally:
            checked.unpersist()
        if then is not None:
            then(tables.read_batch(spark, bronze_path, ORDER_SCHEMA, batch_id), batch_id, n_kept)

    return (
        messages.writeStream.foreachBatch(route)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _held(checked: DataFrame) -> DataFrame:
    """What the two writes of a batch need: the text of rejected messages only."""
    rejected = F.col("reason").isNotNull()
    return checked.select(F.when(rejected, F.col("value").cast("string")).alias("value"), *contract.FIELDS, "reason")


def consumed(spark: SparkSession, counts_path: str) -> DataFrame:
    """``batch_id, n_messages`` of every batch that was drained."""
    if not files.exists(spark, counts_path):
        return spark.createDataFrame([], "batch_id long, n_messages long")
    return spark.read.schema("batch_id long, n_messages long").json(counts_path)


def is_merged(spark: SparkSession, checkpoint: str, batch_id: int) -> bool:
    """Whether a stream has merged a batch: a mark beside its checkpoint says so."""
    return files.exists(spark, f"{checkpoint}-merged/{batch_id}")


def mark_merged(spark: SparkSession, checkpoint: str, batch_id: int) -> None:
    files.put_text(spark, f"{checkpoint}-merged/{batch_id}", "", replace=True)


def merge_stream(
    updates: DataFrame,
    table_path: str,
    checkpoint: str,
    latest_by: Column | None = None,
) -> StreamingQuery:
    """Merge a stream of rows into a keyed table, one micro-batch after another.

    A batch whose merge was completed is left out if it comes again. One that was stopped
    midway is merged again, which gives the same rows, as each of them needs a key. The
    table has to be seeded.
    """
    spark: SparkSession = updates.sparkSession

    def apply(batch: DataFrame, batch_id: int) -> None:
        if is_merged(spark, checkpoint, batch_id):
            return
        kept = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            buckets.merge(spark, table_path, kept, latest_by, need_keys=True)
        finally:
            kept.unpersist()
        mark_merged(spark, checkpoint, batch_id)

    return (
        updates.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
