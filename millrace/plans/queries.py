"""Registered queries: each reads whole tables under a folder and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from millrace.functions.contract import ORDER_SCHEMA
from millrace.operators import (
    bm25,
    chunking,
    contract,
    dense,
    embed,
    fusion,
    lineage,
    postings,
    quality,
    quantised,
    rerank,
    rollup,
    summary,
    upsert,
)
from millrace.plans import refinery, retrieval
from millrace.sources import buckets, feeds, files, tables
from millrace.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]

_ROUNDED = 6
_SYSTEM = "Use the given context only, and name its sources."


# Bronze and the contract


def bronze_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed appended by two runs: an append-only table keeps both."""
    path = files.run_dir(spark, "bronze")
    for _ in range(2):
        tables.append(feeds.order_feed(spark, sf_dir), path, ORDER_SCHEMA)
    return tables.read_appended(spark, path, ORDER_SCHEMA)


def schema_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which variants of the feed an append accepts, and how many rows it wrote."""
    feed = feeds.order_feed(spark, sf_dir)
    batches = {
        "same": feed,
        "reordered": feed.select(*reversed(feed.columns)),
        "without_quantity": feed.drop("quantity"),
        "without_order_id": feed.drop("order_id"),
        "extra_column": feed.withColumn("unexpected_column", F.col("product")),
        "text_price": feed.withColumn("price", F.col("price").cast("string")),
    }
    parts = []
    for name, batch in batches.items():
        path = files.run_dir(spark, "schema-check")
        try:
            tables.append(batch, path, ORDER_SCHEMA)
            problem = None
            written = tables.read_appended(spark, path, ORDER_SCHEMA)
        except tables.SchemaMismatch as mismatch:
            problem = str(mismatch)[:300]
            written = spark.createDataFrame([], ORDER_SCHEMA)
        parts.append(
            written.agg(
                F.count(F.lit(1)).alias("n_written"), F.count("quantity").alias("n_quantity")
            )
            .withColumn("batch", F.lit(name))
            .withColumn("problem", F.lit(problem).cast("string"))
        )
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def contract_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contract.accepted(contract.check_typed(feeds.faulty_order_feed(spark, sf_dir)))


def contract_quarantined(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = contract.check_typed(feeds.faulty_order_feed(spark, sf_dir))
    return contract.quarantined(checked).select("record.*", "rejection_reason")


def contract_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contract.outcome(contract.check_typed(feeds.faulty_order_feed(spark, sf_dir)))


def contract_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract on JSON text: decoded fields where accepted, reason where not."""
    raw = feeds.untyped_order_feed(spark, sf_dir).select("value")
    checked = contract.check_json(raw)
    good = F.col("reason").isNull()
    return checked.select(
        "value",
        *[F.when(good, F.col(name)).alias(name) for name in contract.FIELDS],
        "reason",
    )


def json_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.as_messages(feeds.order_feed(spark, sf_dir))


def json_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = feeds.table(spark, sf_dir, "events")
    props = F.try_parse_json("props")
    return events.select("event_id", F.try_variant_get(props, "$.k", "int").alias("k"))


# Silver


def _silver_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders that are finished or in progress: what Silver holds at first."""
    return feeds.table(spark, sf_dir, "orders").where(F.col("o_orderstatus") != "O")


def _silver_updates(rows: DataFrame, wave: int = 1) -> DataFrame:
    """Orders in progress with a new price and no priority, and open orders as new ones."""
    return rows.where(F.col("o_orderstatus") != "F").select(
        "o_orderkey",
        "o_custkey",
        F.lit("U").alias("o_orderstatus"),
        (F.col("o_totalprice") + 100 * wave).alias("o_totalprice"),
        "o_orderdate",
        F.lit(None).cast("string").alias("o_orderpriority"),
    )


def _seeded(spark: SparkSession, sf_dir: str) -> str:
    path = files.run_dir(spark, "silver")
    buckets.seed(spark, path, _silver_rows(spark, sf_dir), "o_orderkey")
    return path


def silver_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seeding publishes the first table; a second attempt leaves it alone."""
    path = files.run_dir(spark, "silver")
    orders = feeds.table(spark, sf_dir, "orders")
    buckets.seed(spark, path, orders, "o_orderkey")
    buckets.seed(spark, path, orders.withColumn("o_totalprice", F.lit(0.0)), "o_orderkey")
    return buckets.read(spark, path)


def silver_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _seeded(spark, sf_dir)
    buckets.merge(spark, path, _silver_updates(feeds.table(spark, sf_dir, "orders")))
    return buckets.read(spark, path)


def upsert_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows updated, inserted and left, as counted while the merge was written."""
    updates = _silver_updates(feeds.table(spark, sf_dir, "orders"))
    counts = buckets.merge(spark, _seeded(spark, sf_dir), updates)
    return spark.createDataFrame(
        [tuple(counts.values())], ", ".join(f"{name} long" for name in counts)
    )


def upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events merged by user: the newest event of a user replaces the first one."""
    events = feeds.table(spark, sf_dir, "events").drop("props")
    first = events.groupBy("user_id").agg(F.min("event_id").alias("event_id"))
    target = events.join(first, ["user_id", "event_id"], "left_semi")
    return upsert.merge(target, events, "user_id", latest_by=F.col("event_id")).result()


def upsert_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines, many to a key and returned ones without one, merged with orders
    and one row without a key: each line of a key is updated, no key matches nothing."""
    key = F.when(F.col("l_returnflag") != "R", F.col("l_orderkey")).alias("k")
    lines = feeds.table(spark, sf_dir, "lineitem").select(
        key, F.col("l_linestatus").alias("v"), F.col("l_linenumber").cast("long").alias("n")
    )
    orders = feeds.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("k"), F.col("o_orderpriority").alias("v"), F.lit(0).cast("long").alias("n")
    )
    unkeyed = spark.createDataFrame([(None, "no key", -1)], "k long, v string, n long")
    return upsert.merge(lines, orders.unionByName(unkeyed), "k").result()


# Checks, Gold and lineage


def quality_gate_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.check_results(feeds.order_feed(spark, sf_dir, with_user=False))


def quality_gate_bad(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faulty rows whose id is cut to order and line number, which repeats."""
    parts = F.split("order_id", "-")
    bad = feeds.faulty_order_feed(spark, sf_dir, with_user=False).select(
        F.concat_ws("-", parts[0], parts[3]).alias("order_id"),
        F.when(F.col("product") != "", F.col("product")).alias("product"),
        "price",
        "quantity",
    )
    return quality.check_results(bad)


def gold_product_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = feeds.order_feed(spark, sf_dir, with_user=False)
    return summary.by_revenue(summary.product_summary(feed, whole_cents=True))


def gate_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the two check runs above come to."""
    gates = {"clean": quality_gate_clean(spark, sf_dir), "bad": quality_gate_bad(spark, sf_dir)}
    found = [(name, quality.passed(results)) for name, results in gates.items()]
    return spark.createDataFrame(found, "rows_checked string, passed boolean")


def gold_in_doubles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The default summary, which adds doubles, against the one in whole cents."""
    feed = feeds.order_feed(spark, sf_dir, with_user=False)
    exact = summary.product_summary(feed, whole_cents=True).select(
        "product", F.col("total_revenue").alias("revenue"), F.col("avg_price").alias("price")
    )
    cent = F.lit(0.0101)
    return summary.product_summary(feed).join(exact, "product").select(
        "product",
        "total_orders",
        "total_units_sold",
        (F.abs(F.col("total_revenue") - F.col("revenue")) < cent).alias("revenue_within_a_cent"),
        (F.abs(F.col("avg_price") - F.col("price")) < cent).alias("price_within_a_cent"),
    )


def gold_gated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold after one good run and one that the checks stopped: that of the good run."""
    layout = _two_runs(spark, sf_dir)
    return tables.read_snapshot(spark, layout.gold)


def _three_waves(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> refinery.Layout:
    """Orders that are finished, then all others, then the finished ones again with one
    unit more and without their cents: each wave is merged, checked and summed up."""
    layout = refinery.Layout.under(files.run_dir(spark, "waves"))
    # Worked out once: two of the waves are of the same orders.
    if lines is None:
        lines = feeds.stored_lines(spark, sf_dir, with_status=True)
    stored = feeds.order_feed(spark, sf_dir, lines=lines)
    first = stored.where("finished").drop("finished")
    corrected = first.withColumns({"quantity": F.col("quantity") + 1, "price": F.ceil("price").cast("double")})
    for wave in (first, stored.where("not finished").drop("finished"), corrected):
        refinery.run(spark, wave, layout, whole_cents=True)
    return layout


def gold_waves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold after three waves, from partial sums of the buckets that each of them changed."""
    return tables.read_snapshot(spark, _three_waves(spark, sf_dir).gold)


def gate_waves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Check results from the counts kept per bucket, after the same waves and a merge of
    faulty rows on top."""
    lines = feeds.stored_lines(spark, sf_dir, with_status=True)
    layout = _three_waves(spark, sf_dir, lines)
    try:
        refinery.run(spark, feeds.faulty_order_feed(spark, sf_dir, lines=lines), layout, whole_cents=True)
    except quality.GateFailed:
        counts = rollup.read(spark, layout.silver, layout.checks, quality.COUNTS)
        return quality.results_of(counts)
    raise AssertionError("the checks let faulty orders through")


def lineage_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stage events of the same two runs."""
    layout = _two_runs(spark, sf_dir)
    return lineage.stage_report(lineage.read_events(spark, layout.events))


def _two_runs(spark: SparkSession, sf_dir: str) -> refinery.Layout:
    layout = refinery.Layout.under(files.run_dir(spark, "refinery"))
    lines = feeds.stored_lines(spark, sf_dir)
    refinery.run(spark, feeds.order_feed(spark, sf_dir, lines=lines), layout, whole_cents=True)
    try:
        refinery.run(spark, feeds.faulty_order_feed(spark, sf_dir, lines=lines), layout, whole_cents=True)
    except quality.GateFailed:
        return layout
    raise AssertionError("the checks let faulty orders through")


# Streams


def _drained(spark: SparkSession, sf_dir: str, messages: DataFrame | None = None) -> str:
    """A topic filled from the feed (or from what is stored of it) and drained; the folder
    of what came of it."""
    root = files.run_dir(spark, "topic")
    if messages is None:
        messages = feeds.untyped_order_feed(spark, sf_dir)
    feeds.write_topic(messages, f"{root}/topic", **feeds.PACKED)
    _drain(spark, root, "checkpoint", "counts")
    return root


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The messages of the feed, worked out once for those who send them twice."""
    messages = feeds.untyped_order_feed(spark, sf_dir).select("value")
    return files.materialize(messages, "messages", compression=files.CODEC)


def _drain(spark: SparkSession, root: str, checkpoint: str, counts: str) -> int:
    """Messages that a run with this checkpoint, new or kept, has consumed so far."""
    stream = feeds.read_topic(spark, f"{root}/topic", maxFilesPerTrigger=64)
    ingest.drain(
        stream,
        f"{root}/bronze",
        f"{root}/quarantine",
        f"{root}/{checkpoint}",
        counts_path=f"{root}/{counts}",
    ).awaitTermination()
    found = ingest.consumed(spark, f"{root}/{counts}").agg(F.sum("n_messages")).first()[0]
    return found or 0


_QUARANTINE = StructType(
    [StructField("raw", StringType()), StructField("rejection_reason", StringType())]
)


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.read_appended(spark, f"{_drained(spark, sf_dir)}/bronze", ORDER_SCHEMA)


def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.read_quarantine(spark, f"{_drained(spark, sf_dir)}/quarantine", _QUARANTINE)


def stream_consumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages consumed, accepted and rejected."""
    root = _drained(spark, sf_dir)
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    parts = (
        ingest.consumed(spark, f"{root}/counts")
        .select(F.col("n_messages").alias("c"), none.alias("a"), none.alias("r"))
        .unionAll(
            tables.read_appended(spark, f"{root}/bronze", ORDER_SCHEMA).select(none, one, none)
        )
        .unionAll(
            feeds.read_quarantine(spark, f"{root}/quarantine", _QUARANTINE).select(none, none, one)
        )
    )
    return parts.agg(
        F.sum("c").alias("n_consumed"), F.sum("a").alias("n_accepted"), F.sum("r").alias("n_rejected")
    )


def stream_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages consumed by a first run, by one that goes on after more have come, and
    by one that starts anew."""
    messages = _messages(spark, sf_dir)
    root = _drained(spark, sf_dir, messages)
    first = _drain(spark, root, "checkpoint", "counts")
    feeds.write_topic(messages, f"{root}/topic", **feeds.PACKED)
    resumed = _drain(spark, root, "checkpoint", "counts") - first
    anew = _drain(spark, root, "other-checkpoint", "other-counts")
    return spark.createDataFrame(
        [(first, resumed, anew)], "n_first long, n_resumed long, n_anew long"
    )


def stream_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages that come with the file they lay in, and rejects with a time."""
    root = _drained(spark, sf_dir)
    seen = f"{root}/seen"
    stream = feeds.read_topic(spark, f"{root}/topic").writeStream.format("parquet")
    stream.option("path", seen).option("checkpointLocation", f"{root}/seen-checkpoint").trigger(
        availableNow=True
    ).start().awaitTermination()
    named = F.col("source_file").contains("/topic/")
    with_time = StructType([*_QUARANTINE.fields, StructField("quarantined_at", StringType())])
    rejects = feeds.read_quarantine(spark, f"{root}/quarantine", with_time)
    return (
        spark.read.parquet(seen)
        .select(named.cast("bigint").alias("f"), F.lit(0).cast("bigint").alias("t"))
        .unionAll(
            rejects.select(
                F.lit(0).cast("bigint"),
                F.col("quarantined_at").cast("timestamp").isNotNull().cast("bigint"),
            )
        )
        .agg(F.sum("f").alias("n_with_file"), F.sum("t").alias("n_with_time"))
    )


def stream_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of two appends to a log of eight partitions, with partition and offset."""
    root = files.run_dir(spark, "log")
    # Some messages are not JSON.
    number = F.regexp_extract("value", r'"order_id":"(\d+)-', 1).cast("bigint")
    messages = _messages(spark, sf_dir)
    for _ in range(2):
        feeds.append_log(messages, f"{root}/log", F.pmod(number, F.lit(8)), 8, [F.col("value")])
    stream = feeds.read_topic(spark, f"{root}/log", format="parquet")
    writer = stream.writeStream.format("parquet").option("path", f"{root}/seen")
    writer.option("compression", files.CODEC).option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{root}/seen").select("partition", "offset", "value")


def _refined(spark: SparkSession, sf_dir: str) -> refinery.Layout:
    root = files.run_dir(spark, "refinery")
    feeds.write_topic(feeds.untyped_order_feed(spark, sf_dir), f"{root}/topic", **feeds.PACKED)
    layout = refinery.Layout.under(root)
    stream = feeds.read_topic(spark, f"{root}/topic")
    refinery.run_stream(
        spark, stream, layout, f"{root}/quarantine", f"{root}/checkpoint", whole_cents=True
    )
    return layout


def stream_refined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold from a topic: messages checked, stored, merged, checked again, summed up."""
    return tables.read_snapshot(spark, _refined(spark, sf_dir).gold)


def lineage_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stage events of the same run, with the number of runs that they name."""
    log = lineage.read_events(spark, _refined(spark, sf_dir).events)
    runs = log.groupBy(F.col("job.name").alias("stage")).agg(
        F.count_distinct("run.runId").alias("n_runs")
    )
    return lineage.stage_report(log).join(runs, "stage")


def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The Silver updates arriving as a stream of files, three times with new prices."""
    path, root = _seeded(spark, sf_dir), files.run_dir(spark, "silver-stream")
    orders = feeds.table(spark, sf_dir, "orders")
    for wave in (1, 2, 3):
        updates = _silver_updates(orders, wave)
        updates.write.mode("append").parquet(f"{root}/updates")
        arriving = spark.readStream.schema(updates.schema).parquet(f"{root}/updates")
        ingest.merge_stream(arriving, path, f"{root}/checkpoint").awaitTermination()
    return buckets.read(spark, path)


# Chunks and keyword search


def _chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunking.drop_tiny(chunking.chunk_documents(feeds.document_feed(spark, sf_dir)))


def chunk_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _chunks(spark, sf_dir).select(
        "source_doc",
        "chunk_idx",
        "chunk_id",
        "text",
        F.length("text").alias("n_chars"),
        chunking.snippet().alias("snippet"),
    )


def bm25_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = bm25.corpus_totals(bm25.tokenized(_chunks(spark, sf_dir)))
    return totals.withColumn("mean_words", F.round("mean_words", _ROUNDED))


def bm25_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bm25.term_frequencies(bm25.tokenized(_chunks(spark, sf_dir)))


def bm25_idf(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = bm25.build_index(_chunks(spark, sf_dir))
    weights = bm25.term_weights(index.terms, index.n_units, index.mean_raw_idf)
    return weights.select("term", "df", F.round("idf", _ROUNDED).alias("idf"))


def bm25_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = bm25.build_index(_chunks(spark, sf_dir))
    queries = feeds.query_feed(spark, sf_dir)
    return bm25.keyword_topk(index, queries, retrieval.LIST_DEPTH, _ROUNDED)


def bm25_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from postings of the asked terms, skipping ranges by their bounds."""
    path = files.run_dir(spark, "postings")
    postings.add(spark, path, _chunks(spark, sf_dir))
    index = postings.open_index(spark, path)
    return postings.keyword_topk(spark, index, feeds.query_feed(spark, sf_dir), retrieval.LIST_DEPTH, _ROUNDED)


def _segments(spark: SparkSession, sf_dir: str) -> postings.PostingIndex:
    """All documents but the German ones, the French ones in an older and longer form; then
    a segment with both as they are."""
    docs = feeds.document_languages(spark, sf_dir)
    older = F.when(F.col("lang") == "fr", F.concat("text", F.lit(" older "), "text")).otherwise(F.col("text"))
    waves = (
        docs.where("lang <> 'de' OR lang IS NULL").withColumn("text", older),
        docs.where("lang IN ('de', 'fr')"),
    )
    path = files.run_dir(spark, "segments")
    for wave in waves:
        chunks = chunking.drop_tiny(chunking.chunk_documents(wave.drop("lang")))
        # A document may be left without chunks in its new form.
        postings.add(spark, path, chunks, replaced=wave)
    return postings.open_index(spark, path)


def bm25_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from an index of two segments, of which the second replaces documents."""
    index = _segments(spark, sf_dir)
    return postings.keyword_topk(spark, index, feeds.query_feed(spark, sf_dir), retrieval.LIST_DEPTH, _ROUNDED)


def bm25_segment_idf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights of all terms from the sums over the same segments."""
    found = postings.weights(spark, _segments(spark, sf_dir))
    return found.select("term", "df", F.round("idf", _ROUNDED).alias("idf"))


# Vectors


def _embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.table(spark, sf_dir, "embeddings")


def _query_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark passage with the vector of the same number."""
    vectors = _embeddings(spark, sf_dir).select(F.col("vec_id").alias("query_id"), "embedding")
    # A question without a vector still has its keyword results.
    return feeds.query_feed(spark, sf_dir).join(vectors, "query_id", "left")


def dense_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    queries = _query_vectors(spark, sf_dir)
    vectors = _embeddings(spark, sf_dir)
    found = dense.vector_topk(vectors, queries, ["vec_id"], retrieval.LIST_DEPTH, _ROUNDED)
    distance = F.round(1 - F.col("score"), _ROUNDED)
    return found.withColumn("distance", distance)


def dense_quantised(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from 8-bit codes, of which the bounds leave few vectors to score in full."""
    path = quantised.build(_embeddings(spark, sf_dir), ["vec_id"])
    queries = _query_vectors(spark, sf_dir)
    found = quantised.vector_topk(path, queries, ["vec_id"], retrieval.LIST_DEPTH, _ROUNDED)
    return found.withColumn("distance", F.round(1 - F.col("score"), _ROUNDED))


def dense_cells_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of the exact results, how many a search in half of the cells finds."""
    queries, vectors = _query_vectors(spark, sf_dir), _embeddings(spark, sf_dir)
    exact = dense.vector_topk(vectors, queries, ["vec_id"], retrieval.LIST_DEPTH)
    cells = dense.build_cells(vectors, ["vec_id"], 16)
    near = dense.cell_topk(cells, queries, ["vec_id"], retrieval.LIST_DEPTH, n_probe=8)
    return dense.recall(exact, near, ["vec_id"])


def _vector_store(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, embed.HashedTfIdf]:
    return _vectors_of(spark, files.materialize(embed.placed(_chunks(spark, sf_dir)), "chunks"))


def _vectors_of(spark: SparkSession, chunks: DataFrame) -> tuple[DataFrame, embed.HashedTfIdf]:
    """The vector table of stored chunks, and the encoder that was fitted on them."""
    encoder = embed.HashedTfIdf.fit(chunks)
    path = files.run_dir(spark, "vectors")
    tables.publish(embed.vector_table(encoder.transform(chunks, packed=True)), path)
    return tables.read_snapshot(spark, path), encoder


def embed_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vector table of all chunks; of each vector its size and two sums."""
    store, _ = _vector_store(spark, sf_dir)
    summed = embed.number_sums(store).drop("embedding")
    return summed.withColumns({name: F.round(name, 3) for name in ("total", "weighted")})


def vector_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table after it was built anew over an older one of other texts."""
    path = files.run_dir(spark, "vectors")
    for cut in (10, None):
        chunks = _chunks(spark, sf_dir)
        if cut is not None:
            chunks = chunks.withColumn("text", F.substring("text", 1, cut))
        chunks = files.materialize(embed.placed(chunks), "chunks")
        encoder = embed.HashedTfIdf.fit(chunks)
        tables.publish(embed.vector_table(encoder.transform(chunks, packed=True)), path)
    return tables.read_snapshot(spark, path).select(
        "source_doc", "chunk_idx", F.length("text").alias("n_chars")
    )


def semantic_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text questions against the vector table, both through the same encoder."""
    store, encoder = _vector_store(spark, sf_dir)
    queries = encoder.transform(feeds.query_feed(spark, sf_dir))
    return dense.vector_topk(store, queries, retrieval.KEYS, retrieval.LIST_DEPTH, _ROUNDED)


def semantic_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same results with ids, texts and distances."""
    store, encoder = _vector_store(spark, sf_dir)
    queries = encoder.transform(feeds.query_feed(spark, sf_dir))
    return retrieval.nearest_texts(store, queries, digits=_ROUNDED)


def keyword_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyword matches with ids and texts."""
    index = bm25.build_index(_chunks(spark, sf_dir))
    queries = feeds.query_feed(spark, sf_dir)
    return retrieval.matching_texts(index, queries, digits=_ROUNDED)


def _chunk_search(spark: SparkSession, sf_dir: str) -> tuple[bm25.Bm25Index, DataFrame, DataFrame]:
    """Index, vectors and questions of the real chunks, all of one encoder."""
    # Texts are cut into chunks and words once: the units of the index are what is encoded.
    index = bm25.build_index(_chunks(spark, sf_dir))
    store, encoder = _vectors_of(spark, files.materialize(embed.placed(index.units), "chunks"))
    return index, store, encoder.transform(feeds.query_feed(spark, sf_dir))


def hybrid_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fused results with the chunks' ids, texts and sources."""
    index, vectors, queries = _chunk_search(spark, sf_dir)
    found = rerank.settled(retrieval.hybrid_topk(index, vectors, queries, digits=_ROUNDED))
    return _rounded(rerank.with_text(found, vectors, retrieval.KEYS))


def prompt_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prompts that cite the best chunks."""
    return retrieval.answer_prompts(
        *_chunk_search(spark, sf_dir), _SYSTEM, digits=_ROUNDED
    ).select("query_id", "user_prompt")


# Fusion, reranking, prompts. Keyword and vector search need one set of ids: a
# document and the vector of the same number are taken for one unit.


def _linked_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.document_feed(spark, sf_dir).select(
        "source_doc",
        F.lit(0).alias("chunk_idx"),
        F.concat("source_doc", F.lit("_chunk0")).alias("chunk_id"),
        "text",
    )


def _linked_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _embeddings(spark, sf_dir).select(
        F.col("vec_id").cast("string").alias("source_doc"),
        F.lit(0).alias("chunk_idx"),
        "embedding",
    )


def _linked(spark: SparkSession, sf_dir: str) -> tuple[bm25.Bm25Index, DataFrame, DataFrame]:
    index = bm25.build_index(_linked_units(spark, sf_dir))
    return index, _linked_vectors(spark, sf_dir), _query_vectors(spark, sf_dir)


def candidate_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nearest vectors of each question, and how many of them no document belongs to."""
    vectors, queries = _linked_vectors(spark, sf_dir), _query_vectors(spark, sf_dir)
    units = _linked_units(spark, sf_dir)
    nearest = rerank.settled(
        dense.vector_topk(vectors, queries, retrieval.KEYS, retrieval.LIST_DEPTH, _ROUNDED)
    )
    found = rerank.with_text(nearest, units, retrieval.KEYS).select("query_id", F.lit(0).alias("m"))
    missing = rerank.missing_units(nearest, units, retrieval.KEYS)
    both = found.unionByName(missing.select("query_id", F.lit(1).alias("m")))
    return both.groupBy("query_id").agg(
        F.count(F.lit(1)).alias("n_candidates"), F.sum("m").alias("n_missing")
    )


def rrf_fusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All units of both lists with their fused score."""
    index, vectors, queries = _linked(spark, sf_dir)
    nearest = dense.vector_topk(vectors, queries, retrieval.KEYS, retrieval.LIST_DEPTH, _ROUNDED)
    matches = bm25.keyword_topk(index, queries, retrieval.LIST_DEPTH, _ROUNDED)
    return _rounded(fusion.fuse([nearest, matches], retrieval.KEYS))


def hybrid_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(retrieval.hybrid_topk(*_linked(spark, sf_dir), digits=_ROUNDED))


def rerank_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = retrieval.reranked_topk(*_linked(spark, sf_dir), digits=_ROUNDED)
    return _rounded(found).drop("text")


def prompt_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrieval.answer_prompts(*_linked(spark, sf_dir), _SYSTEM, digits=_ROUNDED).select(
        "query_id", "user_prompt"
    )


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumn("score", F.round("score", _ROUNDED))


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        bronze_append,
        schema_check,
        contract_accepted,
        contract_quarantined,
        contract_summary,
        contract_json,
        json_encode,
        json_decode,
        silver_seed,
        silver_upsert,
        upsert_outcome,
        upsert_latest,
        upsert_repeats,
        quality_gate_clean,
        quality_gate_bad,
        gate_verdicts,
        gold_product_summary,
        gold_in_doubles,
        gold_gated,
        gold_waves,
        gate_waves,
        lineage_report,
        stream_ingest,
        stream_quarantine,
        stream_consumed,
        stream_resume,
        stream_metadata,
        stream_positions,
        stream_refined,
        lineage_stream,
        stream_upsert,
        chunk_documents,
        bm25_stats,
        bm25_postings,
        bm25_idf,
        bm25_topk,
        bm25_pruned,
        bm25_segments,
        bm25_segment_idf,
        dense_topk,
        dense_quantised,
        dense_cells_recall,
        embed_chunks,
        vector_rebuild,
        semantic_topk,
        semantic_results,
        keyword_results,
        hybrid_chunks,
        prompt_chunks,
        candidate_texts,
        rrf_fusion,
        hybrid_topk,
        rerank_topk,
        prompt_context,
    )
}
