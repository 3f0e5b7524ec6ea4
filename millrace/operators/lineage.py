"""Run events of stages, kept as an append-only table."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

from millrace.sources import files

EVENT_SCHEMA = StructType(
    [
        StructField("eventType", StringType(), False),
        StructField("eventTime", TimestampType(), False),
        StructField("run", StructType([StructField("runId", StringType(), False)]), False),
        StructField(
            "job",
            StructType(
                [
                    StructField("namespace", StringType(), False),
                    StructField("name", StringType(), False),
                ]
            ),
            False,
        ),
        StructField("producer", StringType(), True),
        StructField("rows_out", LongType(), True),
    ]
)


@dataclass
class Stage:
    """A running stage. Frames passed through ``observe`` are counted as written."""

    run_id: str
    _seen: list[Observation] = field(default_factory=list)
    _counted: list[int] = field(default_factory=list)

    def count(self, rows: int) -> None:
        """Add rows that were counted elsewhere."""
        self._counted.append(rows)

    def observe(self, df: DataFrame) -> DataFrame:
        seen = Observation()
        self._seen.append(seen)
        return df.observe(seen, F.count(F.lit(1)).alias("rows"))

    def rows_out(self) -> int | None:
        if not self._seen and not self._counted:
            return None
        return sum(o.get.get("rows", 0) for o in self._seen) + sum(self._counted)


@contextmanager
def track_stage(
    spark: SparkSession,
    log_path: str,
    name: str,
    namespace: str = "millrace",
    producer: str = "millrace",
    once: str | None = None,
) -> Iterator[Stage]:
    """Record START, then COMPLETE, or FAIL while the exception goes on.

    With ``once``, events of a later stage of that name and mark take the place of
    the earlier ones, as for a batch that is run again.
    """
    stage = Stage(str(uuid.uuid4()))

    def emit(event: str, rows_out: int | None = None) -> None:
        row = {
            "eventType": event,
            "eventTime": datetime.now(timezone.utc).isoformat(),
            "run": {"runId": stage.run_id},
            "job": {"namespace": namespace, "name": name},
            "producer": producer,
            "rows_out": rows_out,
        }
        # One line in a file of its own: events of several runs never collide.
        name_of = uuid.uuid4().hex if once is None else f"{name}-{once}-{event}"
        files.put_text(
            spark, f"{log_path}/{name_of}.json", json.dumps(row) + "\n", replace=once is not None
        )

    emit("START")
    try:
        yield stage
    except Exception:
        emit("FAIL")
        raise
    emit("COMPLETE", stage.rows_out())


def read_events(spark: SparkSession, log_path: str) -> DataFrame:
    return spark.read.schema(EVENT_SCHEMA).json(log_path)


def stage_report(events: DataFrame) -> DataFrame:
    """Per stage: runs started, completed and failed, and rows written."""
    return events.groupBy(F.col("job.name").alias("stage")).agg(
        *[
            F.count_if(F.col("eventType") == state).alias(column)
            for state, column in (
                ("START", "n_started"),
                ("COMPLETE", "n_completed"),
                ("FAIL", "n_failed"),
            )
        ],
        F.sum("rows_out").alias("rows_out"),
    )
