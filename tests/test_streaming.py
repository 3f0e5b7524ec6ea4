import json
import os

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.functions.contract import ORDER_SCHEMA
from millrace.operators import contract, lineage
from millrace.plans import refinery
from millrace.sources import buckets, feeds, tables
from millrace.streaming import ingest
from tests.conftest import rows
from tests.samples import BRONZE, RAW_ORDERS, REASONS, UPDATES

QUARANTINE = "raw string, rejection_reason string"


def drain(spark, root, checkpoint="checkpoint", out="", **options):
    stream = feeds.read_topic(spark, f"{root}/topic", **options)
    query = ingest.drain(
        stream, f"{root}/bronze{out}", f"{root}/quarantine{out}", f"{root}/{checkpoint}"
    )
    query.awaitTermination()
    return query


def stored(spark, root, out=""):
    from pyspark.sql.types import StructType

    schema = StructType.fromDDL(QUARANTINE)
    return (
        rows(tables.read_appended(spark, f"{root}/bronze{out}", ORDER_SCHEMA)),
        rows(feeds.read_quarantine(spark, f"{root}/quarantine{out}", schema)),
    )


def test_topic_is_drained_resumed_and_replayed(spark, tmp_path):
    root = str(tmp_path)
    raw = spark.createDataFrame([(json.dumps(r),) for r in RAW_ORDERS], "value string")
    feeds.write_topic(raw.repartition(5), f"{root}/topic")
    feeds.write_topic(spark.createDataFrame([("not json",)], "value string"), f"{root}/topic")
    drain(spark, root, maxFilesPerTrigger=2)
    good, bad = stored(spark, root)
    checked = contract.check_json(raw)
    assert good == rows(contract.accepted(checked))
    reasons = {json.loads(r)["order_id"]: why for r, why in bad if r != "not json"}
    assert reasons == REASONS and ("not json", "invalid JSON") in bad
    # Several micro-batches were needed, each stored under its number.
    assert sum("batch_id=" in d for d in os.listdir(f"{root}/bronze")) > 1

    # A kept checkpoint adds nothing, and then only what is new.
    drain(spark, root, maxFilesPerTrigger=2)
    assert stored(spark, root) == (good, bad)
    more = {**RAW_ORDERS[0], "order_id": "ORD100"}
    feeds.write_topic(spark.createDataFrame([(json.dumps(more),)], "value string"), f"{root}/topic")
    drain(spark, root, maxFilesPerTrigger=2)
    assert len(stored(spark, root)[0]) == len(good) + 1

    # A new checkpoint reads the topic from its start.
    drain(spark, root, checkpoint="other", out="2")
    assert stored(spark, root, "2") == stored(spark, root)


def test_repeated_batch_replaces_what_it_wrote(spark, tmp_path):
    """The commit of the last batch is lost, as after a crash between write and commit."""
    root = str(tmp_path)
    raw = spark.createDataFrame([(json.dumps(r),) for r in RAW_ORDERS], "value string")
    feeds.write_topic(raw.coalesce(1), f"{root}/topic")
    drain(spark, root)
    before = stored(spark, root)
    for name in ("0", ".0.crc"):
        os.remove(f"{root}/checkpoint/commits/{name}")
    drain(spark, root)
    assert stored(spark, root) == before


def test_messages_know_where_they_came_from(spark, tmp_path):
    root = str(tmp_path)
    feeds.write_topic(spark.createDataFrame([("{}",)], "value string"), f"{root}/topic")
    seen = []
    query = (
        feeds.read_topic(spark, f"{root}/topic")
        .writeStream.foreachBatch(lambda df, _: seen.extend(df.collect()))
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    assert [r["value"] for r in seen] == ["{}"]
    assert seen[0]["source_file"].endswith(".txt") and "/topic/" in seen[0]["source_file"]


def test_encoded_records_decode_to_themselves(spark, orders):
    messages = feeds.as_messages(orders(BRONZE))
    assert json.loads(messages.orderBy("value").first()["value"]) == dict(
        zip(ORDER_SCHEMA.fieldNames(), BRONZE[0], strict=True)
    )
    assert rows(contract.accepted(contract.check_json(messages))) == BRONZE


def test_topic_to_gold(spark, tmp_path):
    root = str(tmp_path)
    layout = refinery.Layout.under(root)

    def arrive(records):
        raw = spark.createDataFrame([(json.dumps(r),) for r in records], "value string")
        feeds.write_topic(raw.coalesce(1), f"{root}/topic")
        stream = feeds.read_topic(spark, f"{root}/topic")
        refinery.run_stream(spark, stream, layout, f"{root}/quarantine", f"{root}/checkpoint")
        return rows(tables.read_snapshot(spark, layout.gold).select("product", "total_units_sold"))

    assert arrive(RAW_ORDERS) == [("Laptop", 1), ("Mouse", 2)]
    # A late correction of one order, and one that was refused before.
    late = {**RAW_ORDERS[0], "quantity": 3}
    assert arrive([late, {**RAW_ORDERS[2], "product": "Cable"}]) == [
        ("Cable", 1), ("Laptop", 3), ("Mouse", 2),
    ]
    for name in ("1", ".1.crc"):
        os.remove(f"{root}/checkpoint/commits/{name}")
    assert arrive([]) == [("Cable", 1), ("Laptop", 3), ("Mouse", 2)]


def lose_commit(root, batch_id):
    for name in (f"{batch_id}", f".{batch_id}.crc"):
        os.remove(f"{root}/checkpoint/commits/{name}")


def test_updates_are_merged_as_they_come(spark, orders, tmp_path):
    root = str(tmp_path)
    buckets.seed(spark, f"{root}/silver", orders(BRONZE), "order_id")

    def arrive(data):
        orders(data).coalesce(1).write.mode("append").parquet(f"{root}/updates")
        stream = spark.readStream.schema(ORDER_SCHEMA).parquet(f"{root}/updates")
        ingest.merge_stream(
            stream, f"{root}/silver", f"{root}/checkpoint", F.col("quantity")
        ).awaitTermination()
        return rows(buckets.read(spark, f"{root}/silver"))

    want = sorted([*UPDATES, *BRONZE[1:]], key=repr)
    assert arrive(UPDATES) == want
    # The batch comes again after its commit was lost, and is left out.
    lose_commit(root, 0)
    later = ("ORD001", "U_A", "Laptop", 1200.0, 8)
    assert arrive([later, UPDATES[0]]) == sorted([later, UPDATES[1], *BRONZE[1:]], key=repr)


def test_replay_of_a_batch_with_a_new_key_twice(spark, orders, tmp_path):
    root = str(tmp_path)
    buckets.seed(spark, f"{root}/silver", orders([]), "order_id")
    twice = [BRONZE[0], (*BRONZE[0][:4], 9)]
    orders(twice).coalesce(1).write.parquet(f"{root}/updates")
    for _ in range(2):
        stream = spark.readStream.schema(ORDER_SCHEMA).parquet(f"{root}/updates")
        ingest.merge_stream(stream, f"{root}/silver", f"{root}/checkpoint").awaitTermination()
        assert rows(buckets.read(spark, f"{root}/silver")) == sorted(twice, key=repr)
        lose_commit(root, 0)


def test_counts_outlast_the_progress_that_spark_keeps(spark, tmp_path):
    root = str(tmp_path)
    key = "spark.sql.streaming.numRecentProgressUpdates"
    spark.conf.set(key, 3)
    try:
        for _ in range(12):
            feeds.write_topic(spark.createDataFrame([("{}",)], "value string").coalesce(1), f"{root}/topic")
        stream = feeds.read_topic(spark, f"{root}/topic", maxFilesPerTrigger=1)
        ingest.drain(
            stream, f"{root}/bronze", f"{root}/quarantine", f"{root}/checkpoint", counts_path=f"{root}/counts"
        ).awaitTermination()
    finally:
        spark.conf.unset(key)
    found = ingest.consumed(spark, f"{root}/counts").collect()
    assert len(found) == 12 and sum(r["n_messages"] for r in found) == 12


def test_empty_topic(spark, tmp_path):
    root = str(tmp_path)
    layout = refinery.Layout.under(root)
    os.makedirs(f"{root}/topic")
    stream = feeds.read_topic(spark, f"{root}/topic")
    results = refinery.run_stream(spark, stream, layout, f"{root}/quarantine", f"{root}/checkpoint")
    assert results.count() == 5
    assert tables.read_snapshot(spark, layout.gold).count() == 0


def test_stream_events_once_per_batch(spark, tmp_path):
    root = str(tmp_path)
    layout = refinery.Layout.under(root)
    raw = spark.createDataFrame([(json.dumps(r),) for r in RAW_ORDERS], "value string")
    feeds.write_topic(raw.coalesce(1), f"{root}/topic")
    for _ in range(2):
        stream = feeds.read_topic(spark, f"{root}/topic")
        refinery.run_stream(spark, stream, layout, f"{root}/quarantine", f"{root}/checkpoint")
        lose_commit(root, 0)
    report = {r["stage"]: r for r in lineage.stage_report(lineage.read_events(spark, layout.events)).collect()}
    assert report["bronze_layer"]["rows_out"] == report["silver_layer"]["rows_out"] == 2
    assert report["bronze_layer"]["n_completed"] == report["silver_layer"]["n_completed"] == 1
    assert report["stream_layer"]["n_completed"] == 2


def test_positions_of_a_log(spark, tmp_path):
    """Offsets go on without gaps over several appends; a stream and its resumption see them."""
    log = f"{tmp_path}/log"
    value = F.col("value").cast("int")

    def append(numbers):
        df = spark.createDataFrame([(str(n),) for n in numbers], "value string").repartition(4)
        feeds.append_log(df, log, value % 3, 3, [value])

    def seen():
        stream = feeds.read_topic(spark, log, format="parquet").writeStream.format("parquet")
        stream.option("path", f"{tmp_path}/seen").option("checkpointLocation", f"{tmp_path}/c").trigger(
            availableNow=True
        ).start().awaitTermination()
        found = spark.read.parquet(f"{tmp_path}/seen")
        assert found.where("source_file IS NULL OR source_file NOT LIKE '%/log/%'").count() == 0
        return sorted((r["partition"], r["offset"], int(r["value"])) for r in found.collect())

    append([9, 3, 1, 7, 0])
    want = [(0, 0, 0), (0, 1, 3), (0, 2, 9), (1, 0, 1), (1, 1, 7)]
    assert seen() == want
    append([6, 2])
    append([5, 12, 4])
    want += [(0, 3, 6), (0, 4, 12), (1, 2, 4), (2, 0, 2), (2, 1, 5)]
    assert seen() == sorted(want)


def test_a_partition_of_a_log_is_appended_by_several_tasks(spark, tmp_path):
    log = f"{tmp_path}/log"
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for first in (0, 500):
            df = spark.range(first, first + 500, 1, 4).select(F.format_string("%05d", "id").alias("value"))
            feeds.append_log(df, log, F.lit(1), 2, [F.col("value")])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    found = feeds._log(spark.read, log)
    assert found.select("source_file").distinct().count() > 4
    assert sorted((r["partition"], r["offset"], r["value"]) for r in found.collect()) == [(1, n, f"{n:05d}") for n in range(1_000)]


def test_a_batch_is_held_without_what_nothing_reads(spark, tmp_path, monkeypatch):
    """Texts of accepted messages and their places are not kept between the two writes."""
    held = []
    accepted = contract.accepted
    monkeypatch.setattr(contract, "accepted", lambda checked: (held.append((checked.columns, rows(checked))), accepted(checked))[1])
    root = str(tmp_path)
    raw = spark.createDataFrame([(json.dumps(r),) for r in RAW_ORDERS] + [("not json",)], "value string")
    feeds.write_topic(raw.coalesce(1), f"{root}/topic")
    drain(spark, root)
    ((columns, found),) = held
    assert columns == ["value", *ORDER_SCHEMA.fieldNames(), "reason"]
    assert len(found) == len(RAW_ORDERS) + 1
    assert all((r[0] is None) == (r[-1] is None) for r in found)
    assert {r["raw"] for r in feeds.read_quarantine(spark, f"{root}/quarantine", StructType.fromDDL(QUARANTINE)).collect()} == {
        r[0] for r in found if r[-1] is not None
    }
