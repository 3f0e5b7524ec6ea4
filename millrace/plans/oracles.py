"""The registered queries as SQL for a second engine, to compare results with."""

from __future__ import annotations

from millrace.functions import contract as rules
from millrace.functions.text import STRIP_CHARS, WORD_PATTERN

_STRIP = " || ".join(f"chr({ord(c)})" for c in STRIP_CHARS)
_BLANKS = " || ".join(f"chr({ord(c)})" for c in rules.NUMBER_BLANKS)


def _with(*ctes: str, select: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + select


# Orders

_FEED = """feed AS (
  SELECT concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber) AS order_id,
         CAST(o_custkey AS VARCHAR) AS user_id, p_name AS product,
         l_extendedprice AS price, CAST(l_quantity AS INTEGER) AS quantity,
         l_orderkey, l_linenumber
  FROM lineitem LEFT JOIN part ON l_partkey = p_partkey
                LEFT JOIN orders ON l_orderkey = o_orderkey)"""

# The feed after its finished orders were corrected.
_WAVES = """waves AS (
  SELECT order_id, product,
         CASE WHEN o_orderstatus = 'F' THEN ceil(price) ELSE price END AS price,
         CASE WHEN o_orderstatus = 'F' THEN quantity + 1 ELSE quantity END AS quantity
  FROM feed LEFT JOIN orders ON l_orderkey = o_orderkey)"""

_FAULTY = """faulty AS (
  SELECT order_id, user_id, l_orderkey, l_linenumber,
         CASE WHEN l_orderkey % 89 = 0 THEN '' ELSE product END AS product,
         CASE WHEN l_orderkey % 97 = 0 THEN -price
              WHEN l_orderkey % 79 = 0 THEN price + 2000000 ELSE price END AS price,
         CASE WHEN l_orderkey % 83 = 0 THEN -quantity ELSE quantity END AS quantity
  FROM feed)"""

_CHECKED = f"""checked AS (
  SELECT *, CASE
    WHEN length(order_id) = 0 OR length(user_id) = 0 OR length(product) = 0
      THEN '{rules.EMPTY_TEXT}'
    WHEN NOT price > 0 OR isnan(price) THEN '{rules.NOT_POSITIVE}'
    WHEN price > 1000000 THEN '{rules.TOO_EXPENSIVE}'
    WHEN NOT quantity > 0 THEN '{rules.NOT_POSITIVE}'
  END AS reason FROM faulty)"""

_FIELDS = "order_id, user_id, product, price, quantity"

_MESSAGES = """messages AS (
  SELECT '{"order_id":"' || order_id || '","user_id":'
    || CASE WHEN l_orderkey % 59 = 0 THEN user_id ELSE '"' || user_id || '"' END || ','
    || CASE WHEN l_orderkey % 89 = 0 THEN '' ELSE '"product":"' || product || '",' END
    || '"price":'
    || CASE WHEN l_orderkey % 97 = 0 THEN '-' || CAST(price AS VARCHAR)
            WHEN l_orderkey % 79 = 0 THEN '" ' || CAST(price AS VARCHAR) || ' "'
            WHEN l_orderkey % 73 = 0 THEN '"n/a"'
            WHEN l_orderkey % 71 = 0 THEN 'null'
            ELSE CAST(price AS VARCHAR) END
    || ',"quantity":'
    || CASE WHEN l_orderkey % 83 = 0 THEN CAST(quantity AS VARCHAR) || '.5'
            WHEN l_orderkey % 67 = 0 THEN '"' || CAST(quantity AS VARCHAR) || '.0"'
            WHEN l_orderkey % 61 = 0 THEN 'true'
            ELSE CAST(quantity AS VARCHAR) END
    || CASE WHEN l_orderkey % 53 = 0 THEN '' ELSE '}' END AS value
  FROM feed)"""


def _text_case(name: str) -> str:
    return f"""
    WHEN t_{name} IS NULL THEN '{rules.MISSING}'
    WHEN t_{name} <> 'VARCHAR' THEN '{rules.NOT_TEXT}'
    WHEN length(s_{name}) = 0 THEN '{rules.EMPTY_TEXT}'"""


_DECODED = (
    """typed AS (
  SELECT value, json_valid(value) AS ok, CASE WHEN json_valid(value) THEN value END AS j
  FROM messages),
parts AS (
  SELECT value, ok, """
    + ", ".join(
        f"json_type(j, '$.{n}') AS t_{n}, json_extract_string(j, '$.{n}') AS s_{n}"
        for n in rules.ORDER_SCHEMA.fieldNames()
    )
    + f"""
  FROM typed),
numbers AS (
  SELECT *,
    CASE WHEN t_price = 'VARCHAR' THEN TRY_CAST(trim(s_price, {_BLANKS}) AS DOUBLE)
         WHEN t_price = 'BOOLEAN' THEN CAST(s_price = 'true' AS DOUBLE)
         WHEN t_price <> 'NULL' THEN CAST(s_price AS DOUBLE) END AS v_price,
    CASE WHEN t_quantity = 'VARCHAR' THEN TRY_CAST(trim(s_quantity, {_BLANKS}) AS DOUBLE)
         WHEN t_quantity = 'BOOLEAN' THEN CAST(s_quantity = 'true' AS DOUBLE)
         WHEN t_quantity <> 'NULL' THEN CAST(s_quantity AS DOUBLE) END AS v_quantity
  FROM parts),
decoded AS (
  SELECT *, CASE
    WHEN NOT ok THEN '{rules.INVALID_JSON}'"""
    + "".join(_text_case(n) for n in rules.TEXT_FIELDS)
    + f"""
    WHEN t_price IS NULL THEN '{rules.MISSING}'
    WHEN v_price IS NULL AND t_price = 'VARCHAR' THEN '{rules.NOT_NUMBER_TEXT}'
    WHEN v_price IS NULL THEN '{rules.NOT_NUMBER}'
    WHEN NOT v_price > 0 THEN '{rules.NOT_POSITIVE}'
    WHEN v_price > 1000000 THEN '{rules.TOO_EXPENSIVE}'
    WHEN t_quantity IS NULL THEN '{rules.MISSING}'
    WHEN v_quantity IS NULL AND t_quantity = 'VARCHAR' THEN '{rules.NOT_INTEGER_TEXT}'
    WHEN v_quantity IS NULL THEN '{rules.NOT_INTEGER}'
    WHEN v_quantity <> floor(v_quantity) THEN '{rules.FRACTION}'
    WHEN NOT v_quantity > 0 THEN '{rules.NOT_POSITIVE}'
  END AS reason FROM numbers)"""
)

_DECODED_FIELDS = """s_order_id AS order_id, s_user_id AS user_id, s_product AS product,
  v_price AS price, CAST(v_quantity AS INTEGER) AS quantity"""

def _summary(rows: str) -> str:
    """Revenue and mean price in whole cents, so that rounding is exact."""
    return f"""
SELECT product, count(order_id) AS total_orders,
       CAST(sum(quantity) AS BIGINT) AS total_units_sold,
       CAST(sum(CAST(round(price * 100) AS BIGINT) * quantity) AS DOUBLE) / 100 AS total_revenue,
       CAST((2 * sum(CAST(round(price * 100) AS BIGINT)) + count(price)) // (2 * count(price))
            AS DOUBLE) / 100 AS avg_price
FROM {rows} GROUP BY product"""

def _updates(more: int) -> str:
    return f"""updates AS (
  SELECT o_orderkey, o_custkey, 'U' AS o_orderstatus, o_totalprice + {more} AS o_totalprice,
         o_orderdate, CAST(NULL AS VARCHAR) AS o_orderpriority
  FROM orders WHERE o_orderstatus <> 'F'),
silver AS (SELECT * FROM orders WHERE o_orderstatus <> 'O')"""


def _merged(more: int) -> str:
    return _with(
        _updates(more),
        select="""
SELECT * FROM silver WHERE o_orderkey NOT IN (SELECT o_orderkey FROM updates)
UNION ALL SELECT * FROM updates""",
    )


def _gate(rows: str, *ctes: str) -> str:
    return _with(
        *ctes,
        f"""rows_in AS ({rows}),
repeated AS (
  SELECT coalesce(sum(n), 0) AS n FROM (
    SELECT count(*) AS n FROM rows_in WHERE order_id IS NOT NULL
    GROUP BY order_id HAVING count(*) > 1)),
counts AS (
  SELECT 1 AS check_no, 'ExpectColumnValuesToNotBeNull' AS "check", 'order_id' AS "column",
         count(*) FILTER (order_id IS NULL) AS n FROM rows_in
  UNION ALL SELECT 2, 'ExpectColumnValuesToBeUnique', 'order_id', n FROM repeated
  UNION ALL SELECT 3, 'ExpectColumnValuesToBeBetween', 'price',
         count(*) FILTER (price <= 0) FROM rows_in
  UNION ALL SELECT 4, 'ExpectColumnValuesToBeBetween', 'quantity',
         count(*) FILTER (quantity <= 0) FROM rows_in
  UNION ALL SELECT 5, 'ExpectColumnValuesToNotBeNull', 'product',
         count(*) FILTER (product IS NULL) FROM rows_in)""",
        select="""
SELECT check_no, "check", "column", CAST(n AS BIGINT) AS unexpected_count, n = 0 AS success
FROM counts""",
    )


# Documents

_CHUNKS = f"""cut AS (
  SELECT CAST(doc_id AS VARCHAR) AS source_doc,
         list_filter(
           list_transform(range(0, length(text), 160),
                          lambda s: trim(substring(text, CAST(s AS BIGINT) + 1, 200), {_STRIP})),
           lambda p: length(p) > 0) AS pieces
  FROM documents),
numbered AS (
  SELECT source_doc, unnest(pieces) AS text, unnest(range(0, len(pieces))) AS i FROM cut),
units AS (
  SELECT source_doc, CAST(i AS INTEGER) AS chunk_idx,
         source_doc || '_chunk' || CAST(i AS VARCHAR) AS chunk_id, text
  FROM numbered WHERE length(text) >= 20)"""

_LINKED_UNITS = """units AS (
  SELECT CAST(doc_id AS VARCHAR) AS source_doc, 0 AS chunk_idx,
         CAST(doc_id AS VARCHAR) || '_chunk0' AS chunk_id, text
  FROM documents)"""


def _words(column: str) -> str:
    return f"regexp_extract_all(lower({column}), '{WORD_PATTERN}')"


_TOKENIZED = f"""tokenized AS MATERIALIZED (
  SELECT source_doc, chunk_idx, {_words("text")} AS words FROM units)"""

_INDEX = """stats AS MATERIALIZED (
  SELECT count(*) AS n_units, avg(len(words)) AS mean_words FROM tokenized),
postings AS MATERIALIZED (
  SELECT source_doc, chunk_idx, term, count(*) AS tf, any_value(n_words) AS n_words
  FROM (SELECT source_doc, chunk_idx, len(words) AS n_words, unnest(words) AS term FROM tokenized)
  GROUP BY source_doc, chunk_idx, term),
terms AS MATERIALIZED (SELECT term, count(*) AS df FROM postings GROUP BY term),
raw_idf AS MATERIALIZED (
  SELECT term, df, ln(n_units - df + 0.5) - ln(df + 0.5) AS raw FROM terms, stats),
idf AS MATERIALIZED (
  SELECT term, df, CASE WHEN raw < 0 THEN 0.25 * mean_raw ELSE raw END AS idf
  FROM raw_idf, (SELECT avg(raw) AS mean_raw FROM raw_idf))"""

_MATCHES = f"""asked AS (
  SELECT item_id AS query_id, term, count(*) AS n
  FROM (SELECT item_id, unnest({_words("text")}) AS term FROM benchmark)
  GROUP BY item_id, term),
hits AS (
  SELECT query_id, source_doc, chunk_idx,
         sum(n * idf * tf * 2.5
             / (tf + 1.5 * (0.25 + 0.75 * n_words / (SELECT mean_words FROM stats)))) AS score
  FROM asked JOIN postings USING (term) JOIN idf USING (term)
  GROUP BY query_id, source_doc, chunk_idx),
scored AS (
  SELECT b.item_id AS query_id, t.source_doc, t.chunk_idx,
         round(coalesce(h.score, 0), 6) AS score
  FROM benchmark b CROSS JOIN tokenized t
  LEFT JOIN hits h ON h.query_id = b.item_id AND h.source_doc = t.source_doc
                  AND h.chunk_idx = t.chunk_idx),
matches AS (
  SELECT *, row_number() OVER (
    PARTITION BY query_id ORDER BY score DESC, source_doc, chunk_idx) AS rk
  FROM scored QUALIFY rk <= 10)"""


def _nearest(key: str) -> str:
    return f"""sims AS (
  SELECT b.item_id AS query_id, {key} AS unit,
         round(list_cosine_similarity(CAST(q.embedding AS DOUBLE[]),
                                      CAST(v.embedding AS DOUBLE[])), 6) AS score
  FROM benchmark b JOIN embeddings q ON q.vec_id = b.item_id CROSS JOIN embeddings v),
nearest AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, unit) AS rk
  FROM sims QUALIFY rk <= 10)"""


# Vectors of the chunks and questions by the hashed tf-idf encoder.
_ENCODED = f"""counted AS (
  SELECT source_doc, chunk_idx, NULL AS query_id,
         {_words("text")} AS words FROM units
  UNION ALL SELECT NULL, NULL, item_id, {_words("text")} FROM benchmark),
keyed AS (SELECT *, row_number() OVER () AS id FROM counted),
places AS (
  SELECT id, any_value(source_doc) AS source_doc,
         CAST('0x' || substr(md5(word), 1, 8) AS BIGINT) % 256 AS place, count(*) AS tf
  FROM (SELECT id, source_doc, unnest(words) AS word FROM keyed) GROUP BY id, place),
weights_of AS (
  SELECT place, ln(((SELECT count(*) FROM units) + 1.0::DOUBLE) / (count(*) + 1.0::DOUBLE)) AS idf
  FROM places WHERE source_doc IS NOT NULL GROUP BY place),
raw_vectors AS MATERIALIZED (
  SELECT id, map(list(place), list(tf * coalesce(idf, ln((SELECT count(*) FROM units) + 1.0::DOUBLE))))
           AS m,
         sqrt(sum((tf * coalesce(idf, ln((SELECT count(*) FROM units) + 1.0::DOUBLE))) ** 2)) AS norm
  FROM places LEFT JOIN weights_of USING (place) GROUP BY id),
vectors AS MATERIALIZED (
  SELECT source_doc, chunk_idx, query_id,
         list_transform(range(0, 256), lambda p: CAST(CAST(
           CASE WHEN norm > 0 THEN coalesce(m[p], 0) / norm ELSE 0 END AS FLOAT) AS DOUBLE)) AS v
  FROM keyed LEFT JOIN raw_vectors USING (id)),
sims AS (
  SELECT q.query_id, u.source_doc, u.chunk_idx,
         round(coalesce(CASE WHEN isnan(list_cosine_similarity(q.v, u.v)) THEN 0
                             ELSE list_cosine_similarity(q.v, u.v) END, 0), 6) AS score
  FROM vectors q CROSS JOIN vectors u WHERE q.query_id IS NOT NULL AND u.source_doc IS NOT NULL),
nearest AS (
  SELECT *, row_number() OVER (
    PARTITION BY query_id ORDER BY score DESC, source_doc, chunk_idx) AS rk
  FROM sims QUALIFY rk <= 10)"""

_FUSE_CHUNKS = """lists AS (
  SELECT query_id, source_doc, chunk_idx, rk, 0 AS list_no FROM nearest
  UNION ALL SELECT query_id, source_doc, chunk_idx, rk, 1 FROM matches),
summed AS (
  SELECT query_id, source_doc, chunk_idx, sum(1.0::DOUBLE / (60 + rk)) AS score,
         min(list_no * 1000000 + rk) AS first_met
  FROM lists GROUP BY query_id, source_doc, chunk_idx),
fused AS (
  SELECT query_id, source_doc, chunk_idx, score,
         CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, first_met)
              AS INTEGER) AS rk
  FROM summed)"""

_FUSED = """linked AS (
  SELECT query_id, source_doc, chunk_idx, rk FROM matches),
lists AS (
  SELECT query_id, unit AS source_doc, 0 AS chunk_idx, rk, 0 AS list_no FROM nearest
  UNION ALL SELECT query_id, source_doc, chunk_idx, rk, 1 FROM linked),
summed AS (
  SELECT query_id, source_doc, chunk_idx, sum(1.0::DOUBLE / (60 + rk)) AS score,
         min(list_no * 1000000 + rk) AS first_met
  FROM lists GROUP BY query_id, source_doc, chunk_idx),
fused AS (
  SELECT query_id, source_doc, chunk_idx, score,
         CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, first_met)
              AS INTEGER) AS rk
  FROM summed)"""

_RERANKED = f"""weights AS (
  SELECT query_id, term, n * idf AS weight FROM asked JOIN idf USING (term)),
candidates AS (
  SELECT query_id, source_doc, chunk_idx, chunk_id, text, fused.rk AS candidate_rk,
         {_words("text")} AS words
  FROM fused JOIN units USING (source_doc, chunk_idx) WHERE fused.rk <= 5),
shares AS (
  SELECT c.query_id, c.source_doc, c.chunk_idx, c.chunk_id, c.text, c.candidate_rk,
         round(coalesce(sum(CASE WHEN list_contains(c.words, w.term) THEN w.weight ELSE 0 END)
                        / sum(w.weight), 0), 6) AS score
  FROM candidates c LEFT JOIN weights w USING (query_id)
  GROUP BY ALL),
reranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, candidate_rk)
                 AS INTEGER) AS rk
  FROM shares)"""

_LINKED = (
    _LINKED_UNITS,
    _TOKENIZED,
    _INDEX,
    _MATCHES,
    _nearest("CAST(v.vec_id AS VARCHAR)"),
    _FUSED,
)

_CHUNK_SEARCH = (_CHUNKS, _ENCODED, _TOKENIZED, _INDEX, _MATCHES, _FUSE_CHUNKS)

_PROMPTS = """
SELECT r.query_id,
       'Context:' || chr(10)
       || string_agg('[Source: ' || chunk_id || ']' || chr(10) || r.text, chr(10) || chr(10)
                     ORDER BY rk)
       || chr(10) || chr(10) || 'Question: ' || any_value(b.text) AS user_prompt
FROM reranked r JOIN benchmark b ON b.item_id = r.query_id WHERE rk <= 2 GROUP BY r.query_id"""

ORACLES: dict[str, str] = {
    "bronze_append": _with(
        _FEED, select=f"SELECT {_FIELDS} FROM feed UNION ALL SELECT {_FIELDS} FROM feed"
    ),
    "schema_check": _with(
        _FEED,
        select="""
SELECT batch, problem,
       CASE WHEN problem IS NULL THEN n ELSE 0 END AS n_written,
       CASE WHEN problem IS NULL AND batch <> 'without_quantity' THEN n ELSE 0 END AS n_quantity
FROM (VALUES ('same', NULL), ('reordered', NULL), ('without_quantity', NULL),
             ('without_order_id', 'missing required column order_id'),
             ('extra_column', 'unexpected column unexpected_column'),
             ('text_price', 'column price is string, not double')) v(batch, problem),
     (SELECT count(*) AS n FROM feed)""",
    ),
    "contract_accepted": _with(
        _FEED, _FAULTY, _CHECKED, select=f"SELECT {_FIELDS} FROM checked WHERE reason IS NULL"
    ),
    "contract_quarantined": _with(
        _FEED,
        _FAULTY,
        _CHECKED,
        select=f"""SELECT {_FIELDS}, reason AS rejection_reason
FROM checked WHERE reason IS NOT NULL""",
    ),
    "contract_summary": _with(
        _FEED,
        _FAULTY,
        _CHECKED,
        select="""
SELECT reason IS NULL AS accepted, reason, count(*) AS n_records FROM checked GROUP BY ALL""",
    ),
    "contract_json": _with(
        _FEED,
        _MESSAGES,
        _DECODED,
        select=f"""
SELECT value, {_DECODED_FIELDS}, reason FROM decoded WHERE reason IS NULL
UNION ALL SELECT value, NULL, NULL, NULL, NULL, NULL, reason FROM decoded
WHERE reason IS NOT NULL""",
    ),
    "json_encode": _with(
        _FEED,
        select="""
SELECT CAST(to_json({'order_id': order_id, 'user_id': user_id, 'product': product,
                     'price': price, 'quantity': quantity}) AS VARCHAR) AS value FROM feed""",
    ),
    "json_decode": """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events""",
    "silver_seed": "SELECT * FROM orders",
    "silver_upsert": _merged(100),
    "upsert_outcome": _with(
        _updates(100),
        select="""
SELECT count(*) FILTER (s.o_orderkey IS NOT NULL AND u.o_orderkey IS NOT NULL) AS n_updated,
       count(*) FILTER (s.o_orderkey IS NULL) AS n_inserted,
       count(*) FILTER (u.o_orderkey IS NULL) AS n_kept
FROM silver s FULL JOIN updates u ON s.o_orderkey = u.o_orderkey""",
    ),
    "upsert_latest": """
WITH e AS (SELECT event_id, ts, user_id, event_type, value FROM events),
target AS (SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id) = 1),
source AS (SELECT * FROM e
           QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1)
SELECT * FROM target WHERE user_id NOT IN (SELECT user_id FROM source)
UNION ALL SELECT * FROM source""",
    "upsert_repeats": """
WITH t AS (
  SELECT CASE WHEN l_returnflag <> 'R' THEN l_orderkey END AS k, l_linestatus AS v,
         CAST(l_linenumber AS BIGINT) AS n
  FROM lineitem)
SELECT k, coalesce(o_orderpriority, v) AS v, CASE WHEN o_orderkey IS NULL THEN n ELSE 0 END AS n
FROM t LEFT JOIN orders ON k = o_orderkey
UNION ALL SELECT o_orderkey, o_orderpriority, 0 FROM orders
WHERE o_orderkey NOT IN (SELECT k FROM t WHERE k IS NOT NULL)
UNION ALL SELECT NULL, 'no key', -1""",
    "gate_verdicts": """
SELECT * FROM (VALUES ('clean', true), ('bad', false)) v(rows_checked, passed)""",
    "gold_in_doubles": _with(
        _FEED,
        select="""
SELECT product, count(order_id) AS total_orders, CAST(sum(quantity) AS BIGINT) AS total_units_sold,
       true AS revenue_within_a_cent, true AS price_within_a_cent
FROM feed WHERE product IS NOT NULL GROUP BY product""",
    ),
    "quality_gate_clean": _gate("SELECT * FROM feed", _FEED),
    "quality_gate_bad": _gate(
        """SELECT concat_ws('-', l_orderkey, l_linenumber) AS order_id, price, quantity,
                  nullif(product, '') AS product FROM faulty""",
        _FEED,
        _FAULTY,
    ),
    "gold_product_summary": _with(_FEED, select=_summary("feed")),
    "gold_gated": _with(_FEED, select=_summary("feed")),
    "gold_waves": _with(_FEED, _WAVES, select=_summary("waves")),
    "gate_waves": _gate(
        """SELECT order_id, price, quantity, product FROM faulty
           UNION ALL SELECT order_id, price, quantity, product FROM waves
           WHERE order_id NOT IN (SELECT order_id FROM faulty)""",
        _FEED,
        _FAULTY,
        _WAVES,
    ),
    "lineage_report": _with(
        _FEED,
        select="""
SELECT stage, CAST(2 AS BIGINT) AS n_started, CAST(2 - failed AS BIGINT) AS n_completed,
       CAST(failed AS BIGINT) AS n_failed, CAST(rows_out AS BIGINT) AS rows_out
FROM (SELECT 'bronze_layer' AS stage, 0 AS failed, 2 * count(*) AS rows_out FROM feed
      UNION ALL SELECT 'silver_layer', 0, 2 * count(*) FROM feed
      UNION ALL SELECT 'quality_gate', 1, NULL)
UNION ALL
SELECT 'gold_layer', 1, 1, 0, count(DISTINCT product) FROM feed""",
    ),
    "stream_ingest": _with(
        _FEED,
        _MESSAGES,
        _DECODED,
        select=f"SELECT {_DECODED_FIELDS} FROM decoded WHERE reason IS NULL",
    ),
    "stream_quarantine": _with(
        _FEED,
        _MESSAGES,
        _DECODED,
        select="""
SELECT value AS raw, reason AS rejection_reason FROM decoded WHERE reason IS NOT NULL""",
    ),
    "stream_consumed": _with(
        _FEED,
        _MESSAGES,
        _DECODED,
        select="""
SELECT count(*) AS n_consumed, count(*) FILTER (reason IS NULL) AS n_accepted,
       count(*) FILTER (reason IS NOT NULL) AS n_rejected FROM decoded""",
    ),
    "stream_refined": _with(
        _FEED,
        _MESSAGES,
        _DECODED,
        f"good AS (SELECT {_DECODED_FIELDS} FROM decoded WHERE reason IS NULL)",
        select=_summary("good"),
    ),
    "lineage_stream": _with(
        _FEED,
        _MESSAGES,
        _DECODED,
        f"good AS (SELECT {_DECODED_FIELDS} FROM decoded WHERE reason IS NULL)",
        select="""
SELECT stage, 1::BIGINT AS n_started, 1::BIGINT AS n_completed, 0::BIGINT AS n_failed,
       1::BIGINT AS n_runs, CAST(rows_out AS BIGINT) AS rows_out
FROM (SELECT 'stream_layer' AS stage, NULL AS rows_out
      UNION ALL SELECT 'bronze_layer', count(*) FROM good
      UNION ALL SELECT 'silver_layer', count(*) FROM good
      UNION ALL SELECT 'quality_gate', NULL
      UNION ALL SELECT 'gold_layer', count(DISTINCT product) FROM good)""",
    ),
    "stream_resume": """
SELECT count(*) AS n_first, count(*) AS n_resumed, 2 * count(*) AS n_anew FROM lineitem""",
    "stream_metadata": _with(
        _FEED,
        _MESSAGES,
        _DECODED,
        select="""
SELECT count(*) AS n_with_file, count(*) FILTER (reason IS NOT NULL) AS n_with_time FROM decoded""",
    ),
    "stream_positions": _with(
        _FEED,
        _MESSAGES,
        select=r"""
SELECT CAST(p AS INTEGER) AS "partition", row_number() OVER (PARTITION BY p ORDER BY run, value) - 1 AS "offset", value
FROM (SELECT CAST(regexp_extract(value, '"order_id":"(\d+)-', 1) AS BIGINT) % 8 AS p, run, value
      FROM messages, (VALUES (0), (1)) r(run))""",
    ),
    "stream_upsert": _merged(300),
    "chunk_documents": _with(
        _CHUNKS,
        select="""
SELECT source_doc, chunk_idx, chunk_id, text, CAST(length(text) AS INTEGER) AS n_chars,
       substring(text, 1, 100) AS snippet FROM units""",
    ),
    "bm25_stats": _with(
        _CHUNKS,
        _TOKENIZED,
        select="""
SELECT count(*) AS n_units, CAST(sum(len(words)) AS BIGINT) AS n_words,
       round(avg(len(words)), 6) AS mean_words FROM tokenized""",
    ),
    "bm25_postings": _with(
        _CHUNKS,
        _TOKENIZED,
        _INDEX,
        select="""
SELECT source_doc, chunk_idx, CAST(n_words AS INTEGER) AS n_words, term,
       CAST(tf AS INTEGER) AS tf FROM postings""",
    ),
    "bm25_idf": _with(
        _CHUNKS,
        _TOKENIZED,
        _INDEX,
        select="SELECT term, df, round(idf, 6) AS idf FROM idf",
    ),
    "bm25_topk": _with(
        _CHUNKS,
        _TOKENIZED,
        _INDEX,
        _MATCHES,
        select="""
SELECT query_id, source_doc, chunk_idx, score, CAST(rk AS INTEGER) AS rk FROM matches""",
    ),
    "dense_topk": _with(
        _nearest("v.vec_id"),
        select="""
SELECT query_id, unit AS vec_id, score, CAST(rk AS INTEGER) AS rk,
       round(1 - score, 6) AS distance FROM nearest""",
    ),
    "embed_chunks": _with(
        _CHUNKS,
        _ENCODED,
        select="""
SELECT source_doc, chunk_idx, chunk_id, text, 256 AS dims, round(list_sum(v), 3) AS total,
       round(list_sum(list_transform(v, lambda x, i: x * i)), 3) AS weighted
FROM vectors JOIN units USING (source_doc, chunk_idx)""",
    ),
    "vector_rebuild": _with(
        _CHUNKS,
        select="SELECT source_doc, chunk_idx, CAST(length(text) AS INTEGER) AS n_chars FROM units",
    ),
    "semantic_topk": _with(
        _CHUNKS,
        _ENCODED,
        select="""
SELECT query_id, source_doc, chunk_idx, score, CAST(rk AS INTEGER) AS rk FROM nearest""",
    ),
    "semantic_results": _with(
        _CHUNKS,
        _ENCODED,
        select="""
SELECT query_id, source_doc, chunk_idx, chunk_id, text, score, CAST(rk AS INTEGER) AS rk,
       round(1 - score, 6) AS distance
FROM nearest JOIN units USING (source_doc, chunk_idx)""",
    ),
    "keyword_results": _with(
        _CHUNKS,
        _TOKENIZED,
        _INDEX,
        _MATCHES,
        select="""
SELECT query_id, source_doc, chunk_idx, chunk_id, text, score, CAST(rk AS INTEGER) AS rk
FROM matches JOIN units USING (source_doc, chunk_idx)""",
    ),
    "hybrid_chunks": _with(
        *_CHUNK_SEARCH,
        select="""
SELECT query_id, source_doc, chunk_idx, chunk_id, text, round(score, 6) AS score, rk
FROM fused JOIN units USING (source_doc, chunk_idx) WHERE rk <= 3""",
    ),
    "prompt_chunks": _with(*_CHUNK_SEARCH, _RERANKED, select=_PROMPTS),
    "candidate_texts": _with(
        _nearest("CAST(v.vec_id AS VARCHAR)"),
        select="""
SELECT query_id, count(*) AS n_candidates,
       count(*) FILTER (unit NOT IN (SELECT CAST(doc_id AS VARCHAR) FROM documents)) AS n_missing
FROM nearest GROUP BY query_id""",
    ),
    "rrf_fusion": _with(
        *_LINKED,
        select="""
SELECT query_id, source_doc, chunk_idx, round(score, 6) AS score, rk FROM fused""",
    ),
    "hybrid_topk": _with(
        *_LINKED,
        select="""
SELECT query_id, source_doc, chunk_idx, round(score, 6) AS score, rk FROM fused WHERE rk <= 3""",
    ),
    "rerank_topk": _with(
        *_LINKED,
        _RERANKED,
        select="""
SELECT query_id, source_doc, chunk_idx, chunk_id, CAST(candidate_rk AS INTEGER) AS candidate_rk,
       score, rk FROM reranked WHERE rk <= 3""",
    ),
    "prompt_context": _with(
        *_LINKED,
        _RERANKED,
        select=_PROMPTS,
    ),
}

# Other ways to the same results.
ORACLES["bm25_pruned"] = ORACLES["bm25_segments"] = ORACLES["bm25_topk"]
ORACLES["dense_quantised"] = ORACLES["dense_topk"]
ORACLES["bm25_segment_idf"] = ORACLES["bm25_idf"]
