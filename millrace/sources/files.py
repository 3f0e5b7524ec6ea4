"""File-system helpers and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType

_LOCAL_DIRS: dict[str, str] = {}
_SPLIT_BYTES = 128 * 1024 * 1024
_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
#: Codec of tables that are large beside their input: a third smaller than Spark's default.
CODEC = "zstd"


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it.

    Only a local session may fall back to a temporary folder of this machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = context.applicationId
    if app not in _LOCAL_DIRS:
        _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="millrace-")
    return _LOCAL_DIRS[app]


def run_dir(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder; nothing is created yet."""
    return f"{shared_dir(spark).rstrip('/')}/millrace/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str, **options) -> DataFrame:
    """Write a result that several later steps read, and read it back.

    A written table survives the loss of executors and cuts the lineage. The options are
    those of the writer.
    """
    path = run_dir(df.sparkSession, label)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def open_writers(spark: SparkSession, number: int) -> Iterator[None]:
    """Writes within may keep so many files open in a task; beyond, Spark sorts its rows."""
    before = spark.conf.get(_WRITERS)
    spark.conf.set(_WRITERS, str(number))
    try:
        yield
    finally:
        spark.conf.set(_WRITERS, before)


def _hadoop(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _hadoop(spark, path)
    return fs.exists(hadoop_path)


def child_dirs(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly under ``path``; none if it does not exist."""
    fs, hadoop_path = _hadoop(spark, path)
    if not fs.exists(hadoop_path):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(hadoop_path) if s.isDirectory())


def put_text(spark: SparkSession, path: str, text: str, replace: bool = False) -> None:
    """Write a small file, without a job."""
    fs, hadoop_path = _hadoop(spark, path)
    out = fs.create(hadoop_path, replace)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def get_text(spark: SparkSession, path: str) -> str:
    """Read a small file, without a job."""
    fs, hadoop_path = _hadoop(spark, path)
    source = fs.open(hadoop_path)
    try:
        return bytes(source.readAllBytes()).decode("utf-8")
    finally:
        source.close()


def make_dir(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _hadoop(spark, path)
    fs.mkdirs(hadoop_path)


def delete(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _hadoop(spark, path)
    fs.delete(hadoop_path, True)


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files under a folder, as its file system counts them."""
    fs, hadoop_path = _hadoop(spark, path)
    return fs.getContentSummary(hadoop_path).getLength()


def move(spark: SparkSession, source: str, target: str) -> bool:
    """Rename a folder or file to a name that is not taken; False if it is."""
    jvm = spark._jvm
    hadoop = jvm.org.apache.hadoop
    conf = spark._jsc.hadoopConfiguration()
    fs, goal = _hadoop(spark, target)
    context = hadoop.fs.FileContext.getFileContext(fs.getUri(), conf)
    no_options = spark.sparkContext._gateway.new_array(getattr(hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(hadoop.fs.Path(source), goal, no_options)
    except Py4JJavaError as error:
        if "FileAlreadyExists" in error.java_exception.getClass().getName():
            return False
        raise
    return True


def measured_bytes(df: DataFrame) -> tuple[int, int]:
    """Rows and about how many bytes they hold, counted, not estimated from files."""
    sizes = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (StringType, BinaryType)):
            sizes.append(F.coalesce(F.octet_length(column), F.lit(0)) + 16)
        elif isinstance(field.dataType, (ArrayType, MapType, StructType)):
            sizes.append(F.coalesce(F.octet_length(F.to_json(F.struct(column))), F.lit(0)) + 16)
        else:
            sizes.append(F.lit(16))
    row = df.agg(F.count(F.lit(1)), F.sum(sum(sizes, F.lit(0).cast("long")))).first()
    return row[0], row[1] or 0


def spread(df: DataFrame) -> DataFrame:
    """Use every core on a small input that lies in too few files.

    One file with one row group is one task however many cores wait. The
    shuffle is only added when the input is measured to be less than one
    ordinary split per core; larger inputs keep the splits of their scan, and
    their files are not even listed.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() > 4 * cores:
        return df
    paths = df.inputFiles()
    if len(paths) >= cores:
        return df
    size = 0
    for path in paths:
        fs, hadoop_path = _hadoop(spark, path)
        size += fs.getFileStatus(hadoop_path).getLen()
    return df.repartition(cores) if size < cores * _SPLIT_BYTES else df
