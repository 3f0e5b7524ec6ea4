"""Inputs: text files, JSON topics, and the benchmark tables in the shapes used here."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamReader
from pyspark.sql.types import StringType, StructField, StructType

from millrace.sources import files

#: Folder of rows whose partition value is null.
_NO_PARTITION = "__HIVE_DEFAULT_PARTITION__"
_GZIP = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}
#: For topics of text files that are large: files that are compressed, and hold so many
#: messages at most, as one task reads a compressed file from its start to its end.
PACKED = {**_GZIP, "maxRecordsPerFile": 500_000}
TOPIC_FILE_SCHEMA = StructType([StructField("value", StringType(), True)])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Documents and queries


def text_files(spark: SparkSession, glob: str) -> DataFrame:
    """(source_doc, text): one row per UTF-8 text file, named by the file."""
    return spark.read.text(glob, wholetext=True).select(
        F.col("_metadata.file_name").alias("source_doc"), F.col("value").alias("text")
    )


def document_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(source_doc, text) of the documents table."""
    documents = files.spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return documents.select(F.col("doc_id").cast("string").alias("source_doc"), "text")


def document_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(source_doc, text, lang): every text of a document with every language that it has.

    A document is one row as a rule, which has both, so only rows whose number is there
    several times are joined; texts of the others are not shuffled.
    """
    documents = table(spark, sf_dir, "documents").where(F.col("doc_id").isNotNull())
    several = files.materialize(documents.groupBy("doc_id").count().where("count > 1").select("doc_id"), "several")
    spread = files.spread(documents.select("doc_id", "text", "lang"))
    found = spread
    if several.take(1):
        again = spread.drop("lang").join(several, "doc_id", "left_semi")
        languages = documents.select("doc_id", "lang").join(several, "doc_id", "left_semi")
        found = spread.join(several, "doc_id", "left_anti").unionByName(again.join(languages, "doc_id"))
    return found.select(F.col("doc_id").cast("string").alias("source_doc"), "text", "lang")


def query_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(query_id, text): every benchmark passage is a query."""
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), "text")


# Orders

#: What the id of an event is made of.
_ID = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")


def _lines(
    spark: SparkSession, sf_dir: str, with_user: bool = True, with_status: bool = False
) -> DataFrame:
    """The order feed and the number of the order that an event belongs to.

    ``with_status`` adds ``finished``: whether an order of the number that ``order_id``
    begins with is finished.
    """
    lines = files.spread(
        table(spark, sf_dir, "lineitem").select(
            "l_orderkey",
            "l_partkey",
            "l_suppkey",
            "l_linenumber",
            "l_quantity",
            "l_extendedprice",
        )
    )
    products = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    events = lines.join(products, lines["l_partkey"] == products["p_partkey"], "left")
    status = []
    if with_status:
        # A line without an order has no user, and begins with the next number that it has.
        first = F.coalesce(*[F.col(c).cast("bigint") for c in _ID])
        buyers = _orders_with_status(spark, sf_dir)
        own = F.col("l_orderkey").isNotNull()
        events = events.join(buyers, (first == F.col("o_orderkey")) & (own | (F.col("nth") == 1)), "left")
        events = events.withColumn("o_custkey", F.when(own, F.col("o_custkey")))
        status = [F.coalesce("finished", F.lit(False)).alias("finished")]
    elif with_user:
        buyers = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
        events = events.join(buyers, lines["l_orderkey"] == buyers["o_orderkey"], "left")
    else:
        events = events.withColumn("o_custkey", F.lit(None).cast("bigint"))
    return events.select(
        F.concat_ws("-", *_ID).alias("order_id"),
        F.col("o_custkey").cast("string").alias("user_id"),
        F.col("p_name").alias("product"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_orderkey").alias("order_no"),
        *status,
    )


def _orders_with_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(o_orderkey, o_custkey, nth, finished): ``nth`` counts the orders of a number,
    ``finished`` says whether one of them is."""
    orders = table(spark, sf_dir, "orders").where(F.col("o_orderkey").isNotNull())
    same = Window.partitionBy("o_orderkey")
    is_finished = F.coalesce(F.col("o_orderstatus") == "F", F.lit(False))
    return orders.select(
        "o_orderkey",
        "o_custkey",
        F.row_number().over(same.orderBy("o_orderkey")).alias("nth"),
        F.max(is_finished).over(same).alias("finished"),
    )


def stored_lines(spark: SparkSession, sf_dir: str, with_status: bool = False) -> DataFrame:
    """The lines that both order feeds are made of, worked out once for who reads both."""
    lines = _lines(spark, sf_dir, with_status=with_status)
    return files.materialize(lines, "lines", compression=files.CODEC)


def order_feed(
    spark: SparkSession, sf_dir: str, with_user: bool = True, lines: DataFrame | None = None
) -> DataFrame:
    """The order event table: one event per line item.

    The user comes from a join of the two largest tables, which a caller that
    has no use for it should not pay for: without it, ``user_id`` is null. ``lines`` are
    stored ones, if there are any, of which a status stays with the events.
    """
    return (_lines(spark, sf_dir, with_user) if lines is None else lines).drop("order_no")


def _fault(divisor: int) -> Column:
    return F.col("order_no") % divisor == 0


def faulty_order_feed(
    spark: SparkSession, sf_dir: str, with_user: bool = True, lines: DataFrame | None = None
) -> DataFrame:
    """The whole order feed with faults put into the records of some orders."""
    price, quantity = F.col("price"), F.col("quantity")
    return (_lines(spark, sf_dir, with_user) if lines is None else lines).select(
        "order_id",
        "user_id",
        F.when(_fault(89), F.lit("")).otherwise(F.col("product")).alias("product"),
        F.when(_fault(97), -price)
        .when(_fault(79), price + 2_000_000)
        .otherwise(price)
        .alias("price"),
        F.when(_fault(83), -quantity).otherwise(quantity).alias("quantity"),
    )


def untyped_order_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole order feed as JSON text, some of it with values of other types."""

    def number(column: str) -> Column:
        return F.col(column).cast("string")

    def quoted(text: Column) -> Column:
        return F.concat(F.lit('"'), text, F.lit('"'))

    price = (
        F.when(_fault(97), F.concat(F.lit("-"), number("price")))
        .when(_fault(79), quoted(F.concat(F.lit(" "), number("price"), F.lit(" "))))
        .when(_fault(73), F.lit('"n/a"'))
        .when(_fault(71), F.lit("null"))
        .otherwise(number("price"))
    )
    quantity = (
        F.when(_fault(83), F.concat(number("quantity"), F.lit(".5")))
        .when(_fault(67), quoted(F.concat(number("quantity"), F.lit(".0"))))
        .when(_fault(61), F.lit("true"))
        .otherwise(number("quantity"))
    )
    product = F.when(_fault(89), F.lit("")).otherwise(
        F.concat(F.lit('"product":'), quoted(F.col("product")), F.lit(","))
    )
    user = F.when(_fault(59), F.col("user_id")).otherwise(quoted(F.col("user_id")))
    text = F.concat(
        F.lit('{"order_id":'),
        quoted(F.col("order_id")),
        F.lit(',"user_id":'),
        user,
        F.lit(","),
        product,
        F.lit('"price":'),
        price,
        F.lit(',"quantity":'),
        quantity,
        F.when(_fault(53), F.lit("")).otherwise(F.lit("}")),
    )
    return _lines(spark, sf_dir).select("order_id", text.alias("value"))


# Topics


def as_messages(records: DataFrame) -> DataFrame:
    """Records as one JSON text column, the value of a message."""
    return records.select(F.to_json(F.struct(*records.columns)).alias("value"))


def write_topic(messages: DataFrame, location: str, format: str = "text", **options) -> None:
    """Append messages to a topic: text files under a folder, or a Kafka topic.

    For ``format="kafka"`` the location is the topic, and the options hold
    ``kafka.bootstrap.servers``; the connector has to be on the class path. Text files take
    the options of Spark's writer, of which ``PACKED`` makes them small.
    """
    writer = messages.select("value").write.format(format).mode("append").options(**options)
    if format == "kafka":
        writer.option("topic", location).save()
    else:
        writer.save(location)


def append_log(
    messages: DataFrame, location: str, partition: Column, n_partitions: int, order: list[Column]
) -> None:
    """Append messages to a log of Parquet files whose messages have positions.

    A message goes to the partition that ``partition`` (from 0) names, behind those that are
    there, in the given order. Each append adds one segment to a partition: a file under the
    folder of the offset that its first message has, so a message's offset is that base plus
    its row in the file, and nothing has to be counted to read it. One producer at a time.

    An append is sorted by ranges of partition and order, so a partition is many tasks and
    segments: the files are written aside, their rows counted, and each is then put under
    the offset that it begins with, the lowest first.
    """
    spark = messages.sparkSession
    begins = {}
    if files.exists(spark, location):
        # One row per partition.
        after = _log(spark.read, location).groupBy("partition").agg(F.max("offset").alias("last")).collect()
        begins = {r["partition"]: r["last"] + 1 for r in after}
    known = F.array(*[F.lit(p) for p in range(n_partitions)])
    placed = messages.withColumn("partition", known[partition.cast("int")])
    staged = f"{location}/_staged-{uuid.uuid4().hex}"
    (
        placed.repartitionByRange("partition", *order)
        .sortWithinPartitions("partition", *order)
        .select("value", "partition")
        .write.options(maxRecordsPerFile=0, compression=files.CODEC)
        .partitionBy("partition")
        .parquet(staged)
    )
    # One row per file; files are numbered in the order of their ranges.
    written = spark.read.schema("value string, partition int").parquet(staged)
    name = F.col("_metadata.file_path").alias("file")
    counts = written.groupBy("partition", name, F.col("_metadata.file_name").alias("name")).count().collect()
    for row in sorted(counts, key=lambda r: (r["partition"] is not None, r["partition"], int(r["name"].split("-")[1]))):
        p = row["partition"]
        base = _NO_PARTITION if p is None else begins.get(p, 0)
        folder = f"{location}/partition={_NO_PARTITION if p is None else p}/base={base}"
        files.make_dir(spark, folder)
        files.move(spark, row["file"], f"{folder}/{row['name']}")
        if p is not None:
            begins[p] = base + row["count"]
    files.delete(spark, staged)


def _log(reader: DataFrameReader | DataStreamReader, location: str) -> DataFrame:
    stored = reader.schema("value string, partition int, base long").format("parquet").load(location)
    return stored.select(
        "value",
        "partition",
        (F.col("base") + F.col("_metadata.row_index")).alias("offset"),
        F.col("_metadata.file_path").alias("source_file"),
    )


def read_topic(
    spark: SparkSession, location: str, format: str = "text", **options
) -> DataFrame:
    """A topic as a stream of (value, partition, offset, source_file), from its start.

    Text files know no partition or offset; a log of Parquet files (``append_log``) knows
    all; Kafka messages know no file.
    """
    reader: DataStreamReader = spark.readStream.format(format).options(**options)
    if format == "parquet":
        return _log(reader, location)
    if format == "kafka":
        messages = reader.option("subscribe", location).option("startingOffsets", "earliest")
        return messages.load().select(
            F.col("value").cast("string").alias("value"),
            "partition",
            "offset",
            F.lit(None).cast("string").alias("source_file"),
        )
    return (
        reader.schema(TOPIC_FILE_SCHEMA)
        .load(location)
        .select(
            "value",
            F.lit(None).cast("int").alias("partition"),
            F.lit(None).cast("bigint").alias("offset"),
            F.col("_metadata.file_path").alias("source_file"),
        )
    )


# Quarantine


def append_quarantine(rejected: DataFrame, path: str) -> None:
    """Append rejected records as JSON lines."""
    rejected.write.mode("append").json(path)


def put_quarantine_batch(rejected: DataFrame, path: str, batch_id: int) -> None:
    """The same for a numbered batch, compressed; a replay replaces it."""
    rejected.write.mode("overwrite").options(**_GZIP).json(f"{path}/batch_id={batch_id}")


def read_quarantine(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).json(path).select(*schema.fieldNames())
