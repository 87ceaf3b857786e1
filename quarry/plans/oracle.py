"""Oracle SQL (DuckDB dialect) for each registered query, over the shared tables as views.

Doubles become decimals and decimals become doubles through VARCHAR, which is what Spark's
casts do (shortest decimal string of the double; one correctly rounded step back). DuckDB's
direct casts scale in binary floating point and can be off in the last digit.

Fixed text rules used below, equal to the Spark side:
  lines(t)  = split on CR LF, CR or LF; a final terminator opens no extra line; '' has no lines
  tokens(l) = Java String.split on one separator: '' -> [''], only separators -> [],
              else split after removing the trailing run of separators
"""

from __future__ import annotations

_EOL = "chr(13) || chr(10) || '|' || chr(13) || '|' || chr(10)"
LINES = f"""
SELECT doc_id, line_no, line FROM (
  SELECT doc_id,
         unnest(arr) AS line,
         CAST(generate_subscripts(arr, 1) - 1 AS INTEGER) AS line_no
  FROM (
    SELECT doc_id,
           CASE WHEN text = '' THEN []::VARCHAR[]
                ELSE regexp_split_to_array(regexp_replace(text, '(' || {_EOL} || ')$', ''), {_EOL})
           END AS arr
    FROM documents))
"""


def _tokens(col: str, sep: str) -> str:
    esc = {"|": "\\|", ".": "\\."}.get(sep, sep)
    stripped = f"regexp_replace({col}, '({esc})+$', '')"
    return (f"CASE WHEN {col} = '' THEN ['']::VARCHAR[] "
            f"WHEN {stripped} = '' THEN []::VARCHAR[] "
            f"ELSE string_split({stripped}, '{sep}') END")


def _token_rows(sep: str, out: str) -> str:
    return f"SELECT unnest({_tokens('line', sep)}) AS {out} FROM ({LINES})"


SQL: dict[str, str] = {}

SQL["text_lines"] = LINES
SQL["word_count"] = f"SELECT word, count(*) AS count FROM ({_token_rows(' ', 'word')}) GROUP BY word"
SQL["csv_token_count"] = f"SELECT token, count(*) AS count FROM ({_token_rows(',', 'token')}) GROUP BY token"
SQL["distinct_words"] = f"SELECT DISTINCT word FROM ({_token_rows(' ', 'word')}) WHERE length(word) > 0"

# --- relational ---------------------------------------------------------------------------
SQL["select_where"] = "SELECT c_name AS name, c_nationkey AS age FROM customer WHERE c_nationkey >= 13"
SQL["typed_records"] = "SELECT c_name AS name, c_nationkey AS age FROM customer"
SQL["dynamic_schema_records"] = "SELECT c_name AS name, CAST(c_nationkey AS VARCHAR) AS age FROM customer"
SQL["string_numeric_filter"] = ("SELECT c_name AS name, CAST(c_nationkey AS VARCHAR) AS age FROM customer "
                                "WHERE TRY_CAST(CAST(c_nationkey AS VARCHAR) AS DOUBLE) >= 13")
SQL["row_format"] = ("SELECT 'Name[get by index]=' || c_name AS by_index, 'Name[get by fieldName]=' || c_name AS by_name "
                     "FROM customer WHERE c_nationkey >= 13")
SQL["from_first"] = "FROM nation SELECT n_nationkey AS key, n_name AS value"
SQL["view_query"] = """
SELECT l_returnflag, l_linestatus, count(*) AS n,
       CAST(CAST(sum(CAST(CAST(l_quantity AS VARCHAR) AS DECIMAL(38,10))) AS VARCHAR) AS DOUBLE) AS qty
FROM lineitem GROUP BY l_returnflag, l_linestatus"""
SQL["join_sum_count"] = """
SELECT o_custkey,
       CAST(CAST(sum(CAST(CAST(o_totalprice AS VARCHAR) AS DECIMAL(38,10))) AS VARCHAR) AS DOUBLE) AS order_sum,
       count(*) AS order_cnt,
       CAST(CAST(sum(CAST(CAST(o_totalprice AS VARCHAR) AS DECIMAL(38,10))) AS VARCHAR) AS DOUBLE) / count(*) AS order_avg
FROM orders GROUP BY o_custkey"""
SQL["sum_count_one_pass"] = SQL["join_sum_count"]
SQL["cartesian"] = "SELECT * FROM region CROSS JOIN nation"
SQL["subtract"] = """
SELECT o_custkey AS custkey FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM customer c
                  WHERE c.c_acctbal > 0 AND c.c_custkey IS NOT DISTINCT FROM o.o_custkey)"""
SQL["intersection"] = ("SELECT DISTINCT o_custkey AS custkey FROM orders "
                       "INTERSECT SELECT DISTINCT c_custkey FROM customer WHERE c_acctbal > 0")
SQL["union_all"] = ("SELECT c_custkey AS id, c_name AS info FROM customer "
                    "UNION ALL SELECT s_suppkey, s_name FROM supplier")
_SCORE = ("CAST(CAST(l_quantity AS VARCHAR) AS DECIMAL(24,10)) * 0.8 + CAST(CAST(l_discount AS VARCHAR) AS DECIMAL(24,10)) * 0.8 "
          "+ CAST(CAST(l_tax AS VARCHAR) AS DECIMAL(24,10)) * 1.0")
SQL["top_pages"] = f"""
SELECT l_partkey AS page, CAST(CAST(sum({_SCORE}) AS VARCHAR) AS DOUBLE) AS pop
FROM lineitem GROUP BY l_partkey ORDER BY pop DESC, page ASC LIMIT 10"""
SQL["weighted_score"] = f"SELECT l_orderkey, l_linenumber, CAST(CAST({_SCORE} AS VARCHAR) AS DOUBLE) AS score FROM lineitem"
SQL["take_n"] = "SELECT * FROM orders ORDER BY o_orderkey LIMIT 10"
_PURCHASES = "SELECT user_id, value, ts FROM events WHERE event_type = 'purchase'"
SQL["payment_sum"] = (f"SELECT user_id, CAST(CAST(sum(CAST(CAST(value AS VARCHAR) AS DECIMAL(38,10))) AS VARCHAR) AS DOUBLE) AS total "
                      f"FROM ({_PURCHASES}) GROUP BY user_id")
SQL["payment_count"] = f"SELECT user_id, count(*) AS cnt FROM ({_PURCHASES}) GROUP BY user_id"
SQL["payment_avg"] = (f"SELECT user_id, CAST(CAST(sum(CAST(CAST(value AS VARCHAR) AS DECIMAL(38,10))) AS VARCHAR) AS DOUBLE) / count(*) AS avg "
                      f"FROM ({_PURCHASES}) GROUP BY user_id")
SQL["observed_sum"] = "SELECT CAST(sum(l_linenumber * 2) AS BIGINT) AS total, count(*) AS n FROM lineitem"
SQL["row_count"] = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS n FROM {t}"
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
              "documents", "embeddings", "pages", "benchmark", "labels", "conversations"))
# --- windows: window start = bucket(ts, slide) - k * slide, k in [0, duration / slide) -------
# sums are exact: decimal(38,10) per value, summed, then double
_P = "(SELECT user_id, value, ts FROM events WHERE event_type = 'purchase')"


def _windowed(dur_s: int, slide_s: int) -> str:
    n = dur_s // slide_s
    slide_us = slide_s * 1_000_000
    return f"""
SELECT user_id, ws AS window_start, ws + INTERVAL {dur_s} SECOND AS window_end,
       CAST(CAST(sum(CAST(CAST(value AS VARCHAR) AS DECIMAL(38,10))) AS VARCHAR) AS DOUBLE) AS sum, count(*) AS cnt,
       CAST(CAST(sum(CAST(CAST(value AS VARCHAR) AS DECIMAL(38,10))) AS VARCHAR) AS DOUBLE) / count(*) AS avg
FROM (SELECT user_id, value,
             make_timestamp(epoch_us(ts) - epoch_us(ts) % {slide_us} - k * {slide_us}) AS ws
      FROM {_P}, range(0, {n}) r(k))
GROUP BY user_id, ws"""


SQL["win_tumbling"] = _windowed(5, 5)
SQL["win_sliding_30"] = _windowed(30, 5)
SQL["win_sliding_60"] = _windowed(60, 5)
SQL["win_composed"] = f"""
WITH s30 AS ({_windowed(30, 5)}),
inner_t AS (SELECT user_id, sum, cnt, epoch_us(window_end) - 1 AS t FROM s30)
SELECT user_id, ws AS window_start, ws + INTERVAL 10 SECOND AS window_end,
       CAST(CAST(sum(CAST(CAST(sum AS VARCHAR) AS DECIMAL(38,10))) AS VARCHAR) AS DOUBLE) AS sum, CAST(sum(cnt) AS BIGINT) AS cnt,
       CAST(CAST(sum(CAST(CAST(sum AS VARCHAR) AS DECIMAL(38,10))) AS VARCHAR) AS DOUBLE) / sum(cnt) AS avg
FROM (SELECT user_id, sum, cnt, make_timestamp(t - t % 5000000 - k * 5000000) AS ws
      FROM inner_t, range(0, 2) r(k))
GROUP BY user_id, ws"""

# --- graph ---------------------------------------------------------------------------------
_EDGES = "(SELECT l_suppkey * 2 AS src, l_partkey * 2 + 1 AS dst FROM lineitem)"
SQL["graph_load"] = f"SELECT src, dst FROM {_EDGES}"
SQL["graph_out_degree"] = f"""
SELECT v.id, coalesce(d.degree, 0) AS degree
FROM (SELECT src AS id FROM {_EDGES} UNION SELECT dst FROM {_EDGES}) v
LEFT JOIN (SELECT src AS id, count(*) AS degree FROM {_EDGES} GROUP BY src) d ON v.id = d.id"""

SQL["graph_vertex_join"] = SQL["graph_out_degree"].replace("AS degree\nFROM (SELECT src AS id", "AS attr\nFROM (SELECT src AS id", 1)

# --- id sets: bucket = bitmap bucket of an id (ids here are >= 0) ---------------------------
_BKT = "CASE WHEN id > 0 THEN (id - 1) // 32768 + 1 ELSE 0 END"
_ITEMS = "(SELECT DISTINCT l_orderkey AS id FROM lineitem)"
_ORDERS = "(SELECT DISTINCT o_orderkey AS id FROM orders)"
SQL["bitmap_cardinality"] = "SELECT count(DISTINCT l_orderkey) AS cardinality FROM lineitem"
SQL["bitmap_or"] = (f"SELECT {_BKT} AS bucket, count(*) AS cardinality FROM "
                    f"(SELECT id FROM {_ITEMS} UNION SELECT id FROM {_ORDERS}) GROUP BY 1")
SQL["bitmap_and"] = (f"SELECT {_BKT} AS bucket, count(*) AS cardinality FROM "
                     f"(SELECT id FROM {_ITEMS} INTERSECT SELECT id FROM {_ORDERS}) GROUP BY 1")
SQL["id_contains"] = (f"SELECT o_orderkey AS id, o_orderkey IN (SELECT id FROM {_ITEMS}) AS contained FROM orders")
SQL["id_rank"] = f"""
SELECT x, CAST(rank AS BIGINT) AS rank FROM (
  SELECT v AS x, is_m, sum(is_m) OVER (ORDER BY v, is_m DESC ROWS UNBOUNDED PRECEDING) AS rank
  FROM (SELECT id AS v, 1 AS is_m FROM {_ITEMS} UNION ALL SELECT id, 0 FROM {_ORDERS}))
WHERE is_m = 0"""
SQL["id_select"] = f"SELECT row_number() OVER (ORDER BY id) - 1 AS j, id FROM {_ITEMS}"
SQL["id_set_equal"] = f"""
SELECT 'items_vs_orders' AS pair,
       NOT EXISTS (SELECT id FROM {_ITEMS} EXCEPT SELECT id FROM {_ORDERS})
       AND NOT EXISTS (SELECT id FROM {_ORDERS} EXCEPT SELECT id FROM {_ITEMS}) AS equal
UNION ALL
SELECT 'items_vs_orders_with_items',
       NOT EXISTS (SELECT id FROM {_ITEMS} EXCEPT SELECT id FROM {_ORDERS} WHERE id IN (SELECT id FROM {_ITEMS}))
       AND NOT EXISTS (SELECT id FROM {_ORDERS} WHERE id IN (SELECT id FROM {_ITEMS}) EXCEPT SELECT id FROM {_ITEMS})"""
SQL["bitmap_roundtrip"] = (f"SELECT 'items' AS set_name, count(*) AS cardinality FROM {_ITEMS} "
                           f"UNION ALL SELECT 'orders', count(*) FROM {_ORDERS}")

# --- files, catalog ------------------------------------------------------------------------
SQL["parquet_scan"] = "SELECT * FROM region"
SQL["parquet_roundtrip"] = "SELECT * FROM lineitem"
SQL["schema_merge"] = """
SELECT p_partkey AS single,
       CASE WHEN p_size <= 25 THEN p_partkey * 2 END AS double,
       CASE WHEN p_size > 25 THEN p_partkey * 3 END AS triple,
       CAST(CASE WHEN p_size <= 25 THEN 1 ELSE 2 END AS INTEGER) AS key
FROM part"""
SQL["save_as_table"] = SQL["union_all"]
SQL["load_table"] = "SELECT n_nationkey AS key, n_name AS value FROM nation"
SQL["text_pairs_roundtrip"] = f"SELECT '(' || word || ',' || CAST(count AS VARCHAR) || ')' AS value FROM ({SQL['word_count']})"
SQL["fanout_by_word"] = f"""
WITH t AS ({_token_rows(' ', 'word')}),
lc AS (SELECT lower(word) AS lw, count(*) AS n FROM t WHERE length(word) > 0 GROUP BY 1)
SELECT w.word, lc.n, '1' AS value
FROM (SELECT DISTINCT word FROM t WHERE length(word) > 0) w JOIN lc ON lower(w.word) = lc.lw"""

# --- cells -----------------------------------------------------------------------------------
_CUST_CELLS = """
SELECT lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS row_key, 'cf' AS family, q.qualifier, q.value, 1 AS put
FROM customer, LATERAL (VALUES ('name', c_name),
                               ('acctbal', CAST(CAST(CAST(c_acctbal AS VARCHAR) AS DECIMAL(18,2)) AS VARCHAR)),
                               ('segment', c_mktsegment)) q(qualifier, value)"""
_SUPP_CELLS = """
SELECT lpad(CAST(s_suppkey AS VARCHAR), 10, '0') AS row_key, 'cf' AS family, q.qualifier, q.value, 2 AS put
FROM supplier, LATERAL (VALUES ('name', s_name),
                               ('acctbal', CAST(CAST(CAST(s_acctbal AS VARCHAR) AS DECIMAL(18,2)) AS VARCHAR))) q(qualifier, value)"""
SQL["cells_full_scan"] = """
SELECT lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS row_key, c_name AS name,
       CAST(CAST(CAST(c_acctbal AS VARCHAR) AS DECIMAL(18,2)) AS DOUBLE) AS acctbal, c_mktsegment AS segment
FROM customer"""
SQL["cells_range_scan"] = f"""
SELECT row_key, family, qualifier, value FROM ({_CUST_CELLS})
WHERE (row_key >= '0000000100' AND row_key < '0000000200' AND qualifier IN ('name', 'acctbal'))
   OR row_key = '0000000500'"""
SQL["cells_filter_scan"] = f"""
SELECT row_key, family, qualifier, value FROM ({_CUST_CELLS})
WHERE family = 'cf' AND contains(row_key, '7') AND contains(qualifier, 'a')"""
SQL["cells_put"] = f"""
SELECT row_key, family, qualifier, arg_max(value, put) AS value
FROM ({_CUST_CELLS} UNION ALL {_SUPP_CELLS}) GROUP BY row_key, family, qualifier"""

# --- documents -------------------------------------------------------------------------------
SQL["docs_from_maps"] = """
SELECT CAST(event_id AS VARCHAR) AS id, event_type AS type, CAST(user_id AS VARCHAR) AS "user",
       CAST(CAST(CAST(value AS VARCHAR) AS DECIMAL(18,2)) AS VARCHAR) AS value FROM events"""
SQL["docs_from_json"] = """
SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN CAST(json_extract(props, '$.k') AS INTEGER) END AS k,
       CASE WHEN event_id % 7 = 0 THEN substr(props, 1, length(props) - 1) END AS bad_doc FROM events"""
SQL["docs_routed"] = "SELECT event_id, user_id, value, event_type FROM events"
SQL["docs_upsert"] = """
SELECT event_id AS id, user_id,
       CASE WHEN event_type = 'purchase' THEN value * 2 ELSE value END AS value,
       CAST(CASE WHEN event_type = 'purchase' THEN 2 ELSE 1 END AS BIGINT) AS version
FROM events"""
SQL["docs_bulk"] = """
SELECT CAST(doc_id % 10 AS INTEGER) AS batch, count(*) AS n, count(DISTINCT doc_id) AS ids,
       CAST(sum(length(text)) AS BIGINT) AS chars FROM documents GROUP BY 1"""

# --- streams -------------------------------------------------------------------------------
SQL["stream_batch_word_count"] = SQL["word_count"]
SQL["stream_word_totals"] = SQL["word_count"]
SQL["stream_seeded_totals"] = f"""
SELECT coalesce(w.word, s.word) AS word, CAST(coalesce(w.count, 0) + coalesce(s.seed, 0) AS BIGINT) AS count
FROM ({SQL['word_count']}) w FULL OUTER JOIN (VALUES ('hello', 1), ('world', 1)) s(word, seed) ON w.word = s.word"""
SQL["stream_payment_totals"] = SQL["payment_sum"]
SQL["keyed_state"] = SQL["payment_sum"]
_SCORED = """
  SELECT l_orderkey, CAST(l_partkey AS VARCHAR) AS page,
         CAST(CAST(CAST(CAST(CAST(l_quantity AS VARCHAR) AS FLOAT) AS DOUBLE) * 0.8
                   + CAST(CAST(CAST(l_discount AS VARCHAR) AS FLOAT) AS DOUBLE) * 0.8
                   + CAST(CAST(CAST(l_tax AS VARCHAR) AS FLOAT) AS DOUBLE) * 1.0 AS VARCHAR) AS DECIMAL(38,20)) AS score
  FROM lineitem"""
SQL["stream_top_pages"] = f"""
WITH s AS ({_SCORED}),
t AS (SELECT page, CAST(CAST(sum(score) AS VARCHAR) AS DOUBLE) AS pop FROM s GROUP BY page
      UNION ALL SELECT 'page1', 0.0)
SELECT page, sum(pop) AS pop FROM t GROUP BY page ORDER BY pop DESC, page ASC LIMIT 10"""
SQL["stream_top_pages_by_batch"] = f"""
WITH s AS ({_SCORED}),
b AS (SELECT batch, CASE WHEN batch = 3 THEN hi ELSE lo + (hi - lo) / 4 * (batch + 1) END AS upto
      FROM (SELECT min(l_orderkey) AS lo, max(l_orderkey) AS hi FROM lineitem), range(4) r(batch)),
t AS (SELECT batch, page, CAST(CAST(sum(score) AS VARCHAR) AS DOUBLE) AS pop
      FROM b JOIN s ON l_orderkey <= upto GROUP BY batch, page
      UNION ALL SELECT batch, 'page1', 0.0 FROM b),
u AS (SELECT batch, page, sum(pop) AS pop FROM t GROUP BY batch, page)
SELECT batch, page, pop FROM u QUALIFY row_number() OVER (PARTITION BY batch ORDER BY pop DESC, page ASC) <= 10"""

_LOG = """
SELECT event_type AS topic, CAST(user_id % 3 AS INTEGER) AS partition,
       row_number() OVER (PARTITION BY event_type, user_id % 3 ORDER BY event_id) - 1 AS "offset",
       CAST(user_id AS VARCHAR) AS key,
       CAST(json_object('event_id', event_id, 'user_id', user_id, 'value', value) AS VARCHAR) AS value
FROM events"""
# the older half of the events by id; what a stream committed of it; and the log when the stream comes back
_HALF = """
h AS (SELECT event_type AS topic, CAST(user_id % 3 AS INTEGER) AS partition, event_id, CAST(user_id AS VARCHAR) AS key,
    CAST(json_object('event_id', event_id, 'user_id', user_id, 'value', value) AS VARCHAR) AS value,
    event_id <= (SELECT (min(event_id) + max(event_id)) / 2 FROM events) AS old FROM events)"""
_RESUME = f"""{_HALF},
com AS (SELECT topic, partition, count(*) AS committed FROM h WHERE old AND partition < 2 GROUP BY 1, 2),
now AS (SELECT *, row_number() OVER (PARTITION BY topic, partition ORDER BY event_id) - 1 AS "offset"
  FROM h WHERE partition <> 1 OR NOT old),
bnd AS (SELECT topic, partition, min("offset") AS earliest, max("offset") + 1 AS latest FROM now GROUP BY 1, 2),
clamped AS (SELECT topic, partition, committed, earliest, latest, CASE WHEN committed IS NULL THEN earliest
    WHEN committed >= earliest AND committed <= latest THEN committed ELSE earliest END AS start
  FROM bnd LEFT JOIN com USING (topic, partition))"""
SQL["log_stream_values"] = f"SELECT topic, partition, \"offset\", value FROM ({_LOG})"
SQL["log_stream_kv"] = f"WITH {_HALF} SELECT key, value FROM h WHERE NOT old"
SQL["offset_clamp"] = f"WITH {_RESUME} SELECT * FROM clamped"
SQL["log_resume"] = f"""WITH {_RESUME}
SELECT topic, partition, "offset", key, value FROM now JOIN clamped USING (topic, partition) WHERE "offset" >= start"""
SQL["offset_commit"] = f"SELECT topic, partition, max(\"offset\") + 1 AS next_offset FROM ({_LOG}) GROUP BY topic, partition"
SQL["log_sink"] = """
WITH p AS (SELECT *, CAST(json_object('event_id', event_id, 'user_id', user_id, 'value', value) AS VARCHAR) AS json
  FROM events WHERE event_type = 'purchase')
SELECT 'purchase_out' AS topic, CAST(user_id % 3 AS INTEGER) AS partition,
       row_number() OVER (PARTITION BY user_id % 3 ORDER BY event_id) - 1 AS "offset", CAST(user_id AS VARCHAR) AS key, json AS value FROM p
UNION ALL SELECT 'output', CAST(event_id % 3 AS INTEGER), row_number() OVER (PARTITION BY event_id % 3 ORDER BY event_id) - 1, NULL, json FROM p"""
SQL["record_roundtrip"] = """
SELECT c_custkey, c_name, c_nationkey, n + b AS n_read, b AS n_bad
FROM customer, (SELECT count(*) AS n, count(*) FILTER (WHERE c_custkey % 10 = 0) AS b FROM customer)"""
SQL["dir_stream_filtered"] = f"""
SELECT token, count(*) AS count FROM (
  SELECT unnest({_tokens("line", ",")}) AS token
  FROM (SELECT concat_ws(',', c_name, c_mktsegment, CAST(c_nationkey AS VARCHAR)) AS line FROM customer))
GROUP BY token"""
SQL["stream_win_tumbling"] = SQL["win_tumbling"]
SQL["stream_win_sliding_30"] = SQL["win_sliding_30"]
SQL["stream_win_sliding_60"] = SQL["win_sliding_60"]
# micro-batches of purchases by event_id % 97, and what lies more than ten days behind the batches before
_CUT = """
p AS (SELECT event_id, user_id, value, ts, event_id % 97 AS deal FROM events WHERE event_type = 'purchase'),
e AS (SELECT min(deal) AS lo, max(deal) AS hi FROM p),
b AS (SELECT p.*, CAST((deal > lo + (hi - lo) / 4 * 1) AS INTEGER) + CAST((deal > lo + (hi - lo) / 4 * 2) AS INTEGER)
    + CAST((deal > lo + (hi - lo) / 4 * 3) AS INTEGER) AS batch FROM p, e),
m AS (SELECT batch, max(ts) AS top FROM b GROUP BY 1),
c AS (SELECT b.*, coalesce(ts < (SELECT max(top) FROM m WHERE m.batch < b.batch) - INTERVAL 10 DAY, false) AS late FROM b)"""
SQL["stream_late_rows"] = f"WITH {_CUT} SELECT event_id, batch FROM c WHERE late"
SQL["stream_win_bounded"] = f"WITH {_CUT} " + _windowed(30, 5).replace(_P, "(SELECT user_id, value, ts FROM c WHERE NOT late)")
SQL["stream_win_composed"] = SQL["win_composed"]
SQL["stream_join_sum_count"] = SQL["win_tumbling"]
