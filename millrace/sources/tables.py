"""Strict appends, and tables published as whole snapshots."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from millrace.sources import files


class SchemaMismatch(ValueError):
    """A batch does not fit the table it should be written to."""


def schema_problems(batch: StructType, table: StructType) -> list[str]:
    """Why a batch may not be appended; empty when it may.

    Extra columns, changed types and missing required columns are refused.
    Missing optional columns are no problem: they are filled with null.
    """
    have = {f.name: f.dataType for f in batch.fields}
    want = {f.name: f for f in table.fields}
    problems = [f"unexpected column {name}" for name in have if name not in want]
    for name, field in want.items():
        if name not in have:
            if not field.nullable:
                problems.append(f"missing required column {name}")
        elif have[name] != field.dataType:
            problems.append(
                f"column {name} is {have[name].simpleString()}, "
                f"not {field.dataType.simpleString()}"
            )
    return problems


def _fitted(field: StructField, present: bool):
    if not present:
        return F.lit(None).cast(field.dataType).alias(field.name)
    column = F.col(field.name)
    if not field.nullable:
        refusal = F.raise_error(F.lit(f"null in required column {field.name}"))
        column = F.coalesce(column, refusal.cast(field.dataType))
    return column.alias(field.name)


def conform(df: DataFrame, table: StructType) -> DataFrame:
    """The batch in the table's column order, or ``SchemaMismatch``.

    A Parquet append takes any schema, so the check has to come first. Nulls in
    required columns are seen only while rows are read, and fail the write.
    """
    problems = schema_problems(df.schema, table)
    if problems:
        raise SchemaMismatch("; ".join(problems))
    return df.select(*[_fitted(f, f.name in df.columns) for f in table.fields])


def _stored(df: DataFrame, table: StructType, mode: str) -> DataFrameWriter:
    return conform(df, table).write.mode(mode).option("compression", files.CODEC)


def append(df: DataFrame, path: str, table: StructType) -> None:
    """Add a batch to an append-only table; repeated batches are kept."""
    _stored(df, table, "append").parquet(path)


def put_batch(df: DataFrame, path: str, table: StructType, batch_id: int) -> None:
    """Add a numbered batch; a replay of the same number replaces it."""
    _stored(df, table, "overwrite").parquet(f"{path}/batch_id={batch_id}")


def add_batch(df: DataFrame, path: str, table: StructType) -> DataFrame:
    """Add a batch under the next free number and read it back.

    Later steps then use the stored rows and do not work them out again.
    """
    spark = df.sparkSession
    taken = [int(n.split("=")[1]) for n in files.child_dirs(spark, path) if "=" in n]
    batch_id = max(taken, default=-1) + 1
    _stored(df, table, "errorifexists").parquet(f"{path}/batch_id={batch_id}")
    return read_batch(spark, path, table, batch_id)


def read_batch(spark: SparkSession, path: str, table: StructType, batch_id: int) -> DataFrame:
    return spark.read.schema(table).parquet(f"{path}/batch_id={batch_id}")


def read_appended(spark: SparkSession, path: str, table: StructType) -> DataFrame:
    """An append-only table, numbered batches or not, in the declared columns."""
    return spark.read.schema(table).parquet(path).select(*table.fieldNames())


class ConcurrentPublish(RuntimeError):
    """Another writer published first; the plan has to be made anew from its snapshot."""


def numbers(spark: SparkSession, path: str) -> list[int]:
    """Numbers of all snapshots."""
    names = files.child_dirs(spark, path)
    return [int(n[1:]) for n in names if n.startswith("v") and n[1:].isdigit()]


def newest(spark: SparkSession, path: str) -> int:
    """Number of the newest snapshot, 0 before the first publish."""
    return max(numbers(spark, path), default=0)


def folder(path: str, number: int) -> str:
    return f"{path}/v{number:08d}"


def current_snapshot(spark: SparkSession, path: str) -> str | None:
    """Folder of the newest snapshot, or None before the first publish."""
    number = newest(spark, path)
    return folder(path, number) if number else None


def put_snapshot(spark: SparkSession, staged: str, path: str, replaces: int) -> str:
    """Give a written folder the number after ``replaces``, or refuse if that is taken."""
    target = folder(path, replaces + 1)
    if not files.move(spark, staged, target):
        files.delete(spark, staged)
        raise ConcurrentPublish(f"{target} was published meanwhile")
    return target


def publish(df: DataFrame, path: str, replaces: int | None = None) -> str:
    """Write the whole table as its next snapshot.

    The plan may read the snapshot it replaces, because that one is not
    touched. Files are written aside and renamed when all are there, so readers
    never see half a table and a failed write leaves no snapshot. ``replaces``
    is the number of the snapshot that the plan has read (the newest, if not
    given): of two writers that read the same one only the first succeeds, and
    the other has to start again from what the first has written.
    """
    spark = df.sparkSession
    if replaces is None:
        replaces = newest(spark, path)
    staged = f"{path}/_staged-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(staged)
    return put_snapshot(spark, staged, path, replaces)


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    current = current_snapshot(spark, path)
    if current is None:
        raise FileNotFoundError(f"no published snapshot under {path}")
    return spark.read.parquet(current)


def seed(spark: SparkSession, path: str, initial: DataFrame) -> bool:
    """Publish ``initial`` if the table does not exist yet; says whether it did."""
    if current_snapshot(spark, path) is not None:
        return False
    publish(initial, path, replaces=0)
    return True
