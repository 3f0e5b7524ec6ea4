"""The gated run: Bronze, Silver, checks, Gold."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession

from millrace.functions.contract import ORDER_SCHEMA
from millrace.operators import quality, rollup, summary
from millrace.operators.lineage import track_stage
from millrace.sources import buckets, files, tables
from millrace.streaming import ingest

KEY = "order_id"
#: The first batch gets buckets for so many times its size, else Silver would be written
#: anew for each of the next batches that outgrows them.
SEED_ROOM = 4


@dataclass(frozen=True)
class Layout:
    """Where a run keeps its tables."""

    bronze: str
    silver: str
    gold: str
    events: str

    @classmethod
    def under(cls, root: str) -> Layout:
        return cls(f"{root}/bronze", f"{root}/silver", f"{root}/gold", f"{root}/events")

    def sums(self, whole_cents: bool) -> str:
        """Partial sums of Gold for each bucket of Silver."""
        return f"{self.silver}-{'cents' if whole_cents else 'sums'}"

    @property
    def checks(self) -> str:
        """Counts of the checks for each bucket of Silver."""
        return f"{self.silver}-checks"

    def forget(self, spark: SparkSession) -> Callable[[set[int]], None]:
        """Drops what is known of buckets that a merge is about to write."""

        def drop(touched: set[int]) -> None:
            for path in (self.sums(True), self.sums(False), self.checks):
                rollup.forget(spark, self.silver, path, touched)

        return drop


def run(
    spark: SparkSession,
    batch: DataFrame,
    layout: Layout,
    incoming: DataFrame | None = None,
    whole_cents: bool = False,
) -> DataFrame:
    """Append a batch, bring Silver up to date, check it, and publish Gold.

    The first run seeds Silver with all of Bronze, later ones merge the batch
    that they appended; then ``incoming`` is merged if it is given. A failed
    check raises ``GateFailed`` and leaves Gold as it was; every stage leaves
    its events. Returns the check results. Checks and Gold read the buckets of
    Silver that have changed since they last did, and what they keep of the others.
    """
    with track_stage(spark, layout.events, "bronze_layer") as stage:
        stored = tables.add_batch(stage.observe(batch), layout.bronze, ORDER_SCHEMA)

    with track_stage(spark, layout.events, "silver_layer") as stage:
        sources = []
        if buckets.layout(spark, layout.silver) is not None:
            sources.append(stored)
        else:
            bronze = tables.read_appended(spark, layout.bronze, ORDER_SCHEMA)
            room = buckets.BUCKET_BYTES // SEED_ROOM
            buckets.seed(spark, layout.silver, stage.observe(bronze), KEY, bucket_bytes=room)
        if incoming is not None:
            sources.append(files.materialize(tables.conform(incoming, ORDER_SCHEMA), "incoming"))
        for source in sources:
            counts = buckets.merge(spark, layout.silver, source, before_write=layout.forget(spark))
            stage.count(counts["n_updated"] + counts["n_inserted"])

    return _check_and_publish(spark, layout, whole_cents)


def run_stream(
    spark: SparkSession,
    messages: DataFrame,
    layout: Layout,
    quarantine_path: str,
    checkpoint: str,
    whole_cents: bool = False,
    latest_by: Column | None = None,
) -> DataFrame:
    """Drain a topic through the same stages.

    Every micro-batch is checked against the contract, stored in Bronze or
    quarantine, and merged into Silver before it counts as done; a batch that
    is run again finds itself in Silver and is left out. Both stages leave
    events per batch, under its number. The checks and Gold follow when the
    topic is drained; a topic without messages gives an empty Gold.
    """
    empty = spark.createDataFrame([], ORDER_SCHEMA)
    buckets.seed(spark, layout.silver, empty, KEY)

    def merge_batch(stored: DataFrame, batch_id: int, n_stored: int) -> None:
        mark = f"batch-{batch_id}"
        with track_stage(spark, layout.events, "bronze_layer", once=mark) as stage:
            stage.count(n_stored)
        # The counts of a batch that is in Silver already stay as they were recorded.
        if ingest.is_merged(spark, checkpoint, batch_id):
            return
        with track_stage(spark, layout.events, "silver_layer", once=mark) as stage:
            counts = buckets.merge(
                spark, layout.silver, stored, latest_by, layout.forget(spark), need_keys=True
            )
            stage.count(counts["n_updated"] + counts["n_inserted"])
        ingest.mark_merged(spark, checkpoint, batch_id)

    with track_stage(spark, layout.events, "stream_layer"):
        ingest.drain(
            messages, layout.bronze, quarantine_path, checkpoint, merge_batch
        ).awaitTermination()
    return _check_and_publish(spark, layout, whole_cents)


def _check_and_publish(spark: SparkSession, layout: Layout, whole_cents: bool) -> DataFrame:
    by = (buckets.BUCKET,)
    with track_stage(spark, layout.events, "quality_gate"):
        rollup.refresh(spark, layout.silver, layout.checks, lambda rows: quality.unexpected(rows, by))
        counts = rollup.read(spark, layout.silver, layout.checks, quality.COUNTS)
        # Five rows, whatever the size of the table.
        results = quality.results_of(counts)
        found = spark.createDataFrame(results.collect(), results.schema)
        if not quality.passed(found):
            failed = found.where("not success").collect()
            raise quality.GateFailed("; ".join(f"{r['check']}({r['column']})" for r in failed))

    with track_stage(spark, layout.events, "gold_layer") as stage:
        kept, schema = layout.sums(whole_cents), summary.parts_schema(whole_cents)
        rollup.refresh(spark, layout.silver, kept, lambda rows: summary.partial_sums(rows, whole_cents, by))
        gold = summary.summed_up(rollup.read(spark, layout.silver, kept, schema), whole_cents)
        tables.publish(stage.observe(gold), layout.gold)
    return found
