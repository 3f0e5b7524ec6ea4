"""Queries that apply each operator to its whole table, and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from millrace.llm import (
    bayes,
    dual_tree,
    exact_dedup,
    external_shuffle,
    host_rules,
    html_extract,
    line_dedup,
    order_minhash,
    packing,
    pieces,
    secrets,
    token_files,
    tokens,
    whitening,
)
from millrace.llm.common import table
from millrace.sources import files

WORD_VOCABULARY = "word_bpe_49k.json"
BYTE_VOCABULARY = "byte_bpe_50k.json"
BYTE_VOCABULARY_SIZE = 50_257
PIECE_MODEL = "piece_bpe_32k.model"
N_SHARDS = 40


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the row of its text that stays."""
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents")).drop("n_points")


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece with its place in a sequence of at most 2048 tokens."""
    vocabulary = tokens.read_vocabulary(public_tokenizers.path(WORD_VOCABULARY))
    return packing.pack_documents(table(spark, sf_dir, "documents"), vocabulary)


def op4_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document. The tables have one column of origin; it stands for the
    owner, and with the language for the repository."""
    docs = table(spark, sf_dir, "documents").withColumn("repository", F.struct("source", "lang").cast("string"))
    return secrets.digests(secrets.find_secrets(docs, repository="repository", owner="source"))


def op5_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its class of near duplicates."""
    return order_minhash.near_duplicates(table(spark, sf_dir, "documents")).drop("node")


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document, and whether decoding them gives the text again."""
    model = pieces.read_model(public_tokenizers.path(PIECE_MODEL))
    encoded = pieces.encode(table(spark, sf_dir, "documents"), model)
    back = pieces.decode(encoded, model)
    return back.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_ids"),
        F.aggregate("ids", F.lit(0).cast("long"), lambda a, n: (a * 31 + n) % 2147483647).alias("ids_sum"),
        "text_sha256",
        (F.sha2("text", 256) == F.col("text_sha256")).alias("round_trip"),
    )


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that repeat earlier windows."""
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "n_lines", "n_removed")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures of every document, and whether its rules and its host's keep it."""
    return host_rules.judge(table(spark, sf_dir, "documents")).drop("host_rate", "host_rejected")


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as it is read back from the written files."""
    vocabulary = tokens.read_vocabulary(public_tokenizers.path(BYTE_VOCABULARY))
    return token_files.round_trip(spark, table(spark, sf_dir, "documents"), vocabulary, BYTE_VOCABULARY_SIZE)


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its posterior probability of being good."""
    return bayes.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_external_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its shard and slot, read back from the written shards."""
    docs = table(spark, sf_dir, "documents")
    path = files.run_dir(spark, "shards")
    shard, slot = external_shuffle.write_shards(docs, path, N_SHARDS)
    return external_shuffle.digests(external_shuffle.read_shards(spark, path, docs.schema, shard, slot), shard, slot)


def op12_dual_tree_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best 50 documents of every benchmark item."""
    return dual_tree.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_qdwh_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every usable vector along its first 32 whitened components."""
    return whitening.by_component(whitening.whitened(table(spark, sf_dir, "embeddings")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_html_extraction,
        op2_exact_dedup,
        op3_best_fit_packing,
        op4_secret_scans,
        op5_order_minhash,
        op6_sentencepiece,
        op7_line_dedup,
        op8_quality_rules,
        op9_token_files,
        op10_quality_classifier,
        op11_external_shuffle,
        op12_dual_tree_search,
        op13_qdwh_whitening,
    )
}

# White space of the contracts, as DuckDB writes it.
_SPACE = r"[\x20\x09-\x0D]"
# Terms of the ranked search.
_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

ORACLES: dict[str, str] = {
    "op2_exact_dedup": rf"""
        WITH d AS (
            SELECT doc_id, coalesce(text, '') AS t,
                   regexp_replace(coalesce(text, ''), '{_SPACE}+', '', 'g') AS norm
            FROM documents),
        r AS (
            SELECT *, row_number() OVER (PARTITION BY norm ORDER BY length(t) DESC, doc_id) AS nth,
                   count(*) OVER (PARTITION BY norm) AS n,
                   first_value(doc_id) OVER (PARTITION BY norm ORDER BY length(t) DESC, doc_id) AS keep_id
            FROM d)
        SELECT doc_id, keep_id, n AS group_size, nth = 1 AS kept, sha256(norm) AS text_sha256 FROM r""",
    "op8_quality_rules": rf"""
        WITH d AS (
            SELECT doc_id, source, coalesce(text, '') AS t,
                   regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
                   list_filter(string_split(coalesce(text, ''), chr(10)),
                               lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
            FROM documents),
        windows AS (
            SELECT doc_id, p, count(*) OVER (
                       PARTITION BY doc_id, words[p], words[p + 1], words[p + 2]) AS times
            FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS p FROM d)),
        repeats AS (
            SELECT doc_id, count(DISTINCT p + k) AS n
            FROM windows, (VALUES (0), (1), (2)) v(k) WHERE times > 1 GROUP BY doc_id),
        m AS (
            SELECT doc_id, source, len(words) AS n_words,
                   coalesce(CAST(list_sum(list_transform(words, lambda x: length(x))) AS BIGINT), 0)
                       AS word_chars,
                   length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
                   len(lines) - len(list_distinct(lines)) AS n_dup_lines,
                   coalesce(n, 0) AS n_repeat_words
            FROM d LEFT JOIN repeats USING (doc_id)),
        b AS (
            SELECT *, n_words < {host_rules.MIN_WORDS}
                      OR 100 * n_repeat_words > {host_rules.REPEAT_PERCENT} * n_words AS base_failed
            FROM m),
        hosts AS (
            SELECT source, CAST(count(*) AS DOUBLE) AS n,
                   CAST(count(*) FILTER (base_failed) AS DOUBLE) AS f
            FROM b GROUP BY source),
        sums AS (
            SELECT sum(f) / sum(n) AS mean, sum(n) AS n, count(*) AS hosts,
                   sum(f * f / n) AS squares, sum(n * n) AS n_squares
            FROM hosts),
        spread AS (
            SELECT *, mean * (1 - mean) AS noise,
                   CASE WHEN n > n_squares / n
                        THEN (squares - n * mean * mean - (hosts - 1) * mean * (1 - mean))
                             / (n - n_squares / n) ELSE 0 END AS s
            FROM sums),
        prior AS (
            SELECT mean, CASE WHEN s <= 0 OR noise <= 0
                              THEN greatest(1, CASE WHEN hosts > 1 THEN n ELSE 1 END)
                              ELSE greatest(1, noise / s - 1) END AS weight
            FROM spread),
        rates AS (
            SELECT source, (f + mean * weight) / (n + weight) AS rate FROM hosts, prior)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
               NOT base_failed AND NOT rate > {host_rules.HOST_RATE} AS kept
        FROM b JOIN rates ON b.source IS NOT DISTINCT FROM rates.source""",
    "op7_line_dedup": rf"""
        WITH l AS (
            SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                   generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS n
            FROM documents),
        s AS (
            SELECT doc_id, n, regexp_replace(line, '^{_SPACE}+|{_SPACE}+$', '', 'g') AS line
            FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
        w AS (
            SELECT doc_id, n AS first_line, lead(n, 2) OVER o AS last_line,
                   line || chr(10) || lead(line) OVER o || chr(10) || lead(line, 2) OVER o AS k
            FROM s WINDOW o AS (PARTITION BY doc_id ORDER BY n)),
        r AS (
            SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id, first_line) AS nth
            FROM w WHERE k IS NOT NULL),
        gone AS (
            SELECT DISTINCT doc_id, unnest(range(first_line, last_line + 1)) AS n FROM r WHERE nth > 1)
        SELECT l.doc_id,
               coalesce(string_agg(l.line, chr(10) ORDER BY l.n) FILTER (WHERE gone.n IS NULL), '') AS text,
               count(*) FILTER (WHERE regexp_matches(l.line, '[^\x20\x09-\x0D]')) AS n_lines,
               count(*) FILTER (WHERE regexp_matches(l.line, '[^\x20\x09-\x0D]') AND gone.n IS NOT NULL) AS n_removed
        FROM l LEFT JOIN gone ON l.doc_id = gone.doc_id AND l.n = gone.n
        GROUP BY l.doc_id""",
    "op12_dual_tree_search": rf"""
        WITH d AS MATERIALIZED (
            SELECT doc_id, regexp_extract_all(
                       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '{_TERM}') AS words
            FROM documents),
        asked AS MATERIALIZED (
            SELECT DISTINCT item_id, unnest(regexp_extract_all(
                       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '{_TERM}')) AS term
            FROM benchmark),
        totals AS (SELECT count(*) FILTER (len(words) > 0) AS n_docs, sum(len(words))::BIGINT AS n_terms FROM d),
        tf AS MATERIALIZED (
            SELECT doc_id, term, length, count(*) AS tf
            FROM (SELECT doc_id, len(words) AS length, unnest(words) AS term FROM d)
            WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
        weights AS (
            SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w
            FROM tf, totals GROUP BY term, n_docs),
        scores AS (
            SELECT item_id, doc_id,
                   sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * length * n_docs) // n_terms))))::BIGINT
                       AS score
            FROM asked JOIN tf USING (term) JOIN weights USING (term), totals GROUP BY item_id, doc_id),
        r AS (
            SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
            FROM scores WHERE score > 0)
        SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM r WHERE rank <= {dual_tree.K}""",
}
