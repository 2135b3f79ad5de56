"""The registered queries in SQL, written from the benchmark tables and not from the JSON made of them."""

from __future__ import annotations

# Readable log events: the visitor as text, the time in milliseconds, the number in props.
_EVENTS = r"""
ev AS (
  SELECT event_id AS seq, user_id, CAST(user_id AS VARCHAR) AS mid, event_type AS kind, value, ts,
         epoch_us(ts) // 1000 AS ms, CAST(regexp_extract(props, '(\d+)', 1) AS INTEGER) AS k
  FROM events WHERE event_id % 97 <> 13
),
page AS (
  SELECT *, 'w' || (k % 7) || ' W' || (k % 5) || ' w' || (k % 7) AS phrase
  FROM ev WHERE kind IN ('view', 'click', 'purchase') OR (kind = 'error' AND k % 2 = 0)
),
search AS (
  SELECT * FROM page WHERE k % 2 = 1 AND k % 3 IN (0, 1) AND k % 11 <> 0
),
word AS (
  SELECT seq, ts, unnest(list_distinct(['w' || (k % 7), 'w' || (k % 5)])) AS keyword FROM search
)"""

_VISITS = """
visit AS (
  SELECT mid, CASE WHEN k % 2 = 0 THEN CAST(ts AS DATE) ELSE CAST(ts AS DATE) - 1 END AS first_day
  FROM (SELECT *, row_number() OVER (PARTITION BY mid ORDER BY ms, seq) AS place FROM ev) WHERE place = 1
),
fixed AS (
  SELECT ev.*, CASE WHEN k % 2 = 0 AND CAST(ts AS DATE) = first_day THEN '1' ELSE '0' END AS is_new
  FROM ev JOIN visit USING (mid)
)"""

_CHANGES = """
ch AS (
  SELECT o_orderkey AS seq, o_custkey AS cust, CAST(o_custkey AS VARCHAR) AS id,
         CASE WHEN o_orderkey % 50 = 7 THEN 'other' ELSE 'shop' END AS db,
         CASE o_orderkey % 4 WHEN 0 THEN 'coupon_use' WHEN 1 THEN 'favor_info' WHEN 2 THEN 'user_info'
              ELSE 'comment_info' END AS source_table,
         CASE o_orderstatus WHEN 'F' THEN 'insert' WHEN 'O' THEN 'update' ELSE 'delete' END AS type,
         o_orderkey % 41 = 5 AS is_empty, epoch_us(o_orderdate) // 1000000 AS ts, o_orderdate AS et,
         CASE WHEN o_orderkey % 3 <> 0 THEN 'n' || o_orderkey END AS name, o_orderpriority AS status
  FROM orders
),
fact AS (SELECT * FROM ch WHERE db = 'shop' AND type IN ('insert', 'update') AND NOT is_empty),
dim AS (SELECT * FROM ch WHERE db = 'shop' AND NOT is_empty),
route(source_table, type, sink_table, fields, fields_using) AS (VALUES
  ('coupon_use', 'insert', 'dwd_tool_coupon_get', 'coupon_id,coupon_status,get_time,id,user_id',
   'coupon_id,coupon_status,get_time,id,user_id'),
  ('coupon_use', 'update', 'dwd_tool_coupon_use', 'coupon_id,coupon_status,id,order_id,user_id',
   'coupon_id,coupon_status,id,order_id,user_id,using_time'),
  ('favor_info', 'insert', 'dwd_interaction_favor_add', 'create_time,id,sku_id,user_id',
   'create_time,id,sku_id,user_id'),
  ('user_info', 'insert', 'dwd_user_register', 'create_time,id', 'create_time,id')
)"""

def _users(dim: str = "dim") -> str:
    return f"""
gone AS (SELECT id, max(seq) FILTER (type = 'delete') AS deleted_at, max(seq) FILTER (type <> 'delete') AS put_at
         FROM {dim} WHERE source_table = 'user_info' GROUP BY id),
put AS (SELECT dim.*, row_number() OVER (PARTITION BY id ORDER BY seq DESC) AS place
        FROM {dim} JOIN gone USING (id)
        WHERE source_table = 'user_info' AND type <> 'delete' AND seq > coalesce(deleted_at, -1)),
usr AS (SELECT id, any_value('u' || id) AS login_name,
               arg_max(name, seq) FILTER (name IS NOT NULL) AS name, max(name) FILTER (place = 1) AS last_name
        FROM put GROUP BY id)"""

_CONFIG = """
cfg AS (
  SELECT o_orderkey AS seq, o_orderstatus AS status, 's' || o_custkey AS sink_table,
         't' || ((o_custkey + o_orderkey) % 700) AS source_table,
         CASE WHEN o_orderkey % 2 = 0 THEN 'insert' ELSE 'update' END AS source_type,
         'id,c' || (o_orderkey % 10) AS sink_columns
  FROM orders
),
live AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY sink_table ORDER BY seq DESC) AS place FROM cfg)
  WHERE place = 1 AND status <> 'P'
),
current AS (
  SELECT * FROM (
    SELECT * EXCLUDE (place), row_number() OVER (PARTITION BY source_table, source_type ORDER BY seq DESC) AS place
    FROM live)
  WHERE place = 1
)"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts)


def _bounds(start: str, size: str) -> str:
    return (
        f"strftime({start}, '%Y-%m-%d %H:%M:%S') AS stt, "
        f"strftime({start} + INTERVAL {size}, '%Y-%m-%d %H:%M:%S') AS edt, strftime({start}, '%Y%m%d') AS cur_date"
    )


def _keyword_windows(size: str, rows: str = "word", closed: str = "true") -> str:
    return f"""
    SELECT {_bounds("start", size)}, keyword, n AS keyword_count
    FROM (SELECT time_bucket(INTERVAL {size}, ts) AS start, keyword, count(*) AS n FROM {rows} GROUP BY ALL)
    WHERE {closed}"""


_VIEWS = """
view_rows AS (
  SELECT seq, ms AS ts, mid, mid || '-' || strftime(ts, '%Y%m%d') AS sid, 'v' || (user_id % 3) AS vc,
         'ch' || (user_id % 4) AS ch, CAST(user_id % 5 AS VARCHAR) AS ar, is_new,
         CAST(round(value * 100) AS BIGINT) AS dur, ts AS tm
  FROM fixed WHERE kind IN ('view', 'click', 'purchase') OR (kind = 'error' AND k % 2 = 0)
),
flagged AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY mid, CAST(tm AS DATE) ORDER BY ts, seq) = 1 AS BIGINT) AS uv,
         CAST(row_number() OVER (PARTITION BY sid ORDER BY ts, seq) = 1 AS BIGINT) AS sv
  FROM view_rows
)"""


def _traffic_windows(size: str) -> str:
    return f"""
    SELECT {_bounds("start", size)}, vc, ch, ar, is_new, uv_ct, sv_ct, pv_ct, dur_sum
    FROM (SELECT time_bucket(INTERVAL {size}, tm) AS start, vc, ch, ar, is_new, CAST(sum(uv) AS BIGINT) AS uv_ct,
                 CAST(sum(sv) AS BIGINT) AS sv_ct, count(*) AS pv_ct, CAST(sum(dur) AS BIGINT) AS dur_sum
          FROM flagged GROUP BY ALL)"""


# Number: the display's place, the error's code, or the page's time.
_FAN_OUT = """,
shown AS (
  SELECT *, CASE WHEN k % 11 <> 0 THEN 'w' || (k % 7) || ' W' || (k % 5) || ' w' || (k % 7) END AS phrase FROM fixed
)
SELECT seq, 'dwd_traffic_start' AS topic, mid, is_new, ms AS ts, NULL AS item, CAST(NULL AS BIGINT) AS number
FROM shown WHERE kind = 'signup'
UNION ALL
SELECT seq, 'dwd_traffic_err', mid, is_new, ms, CASE WHEN k % 2 = 0 THEN phrase END, k FROM shown WHERE kind = 'error'
UNION ALL
SELECT seq, 'dwd_traffic_display', mid, is_new, ms, CAST(k AS VARCHAR), unnest(range(k % 3)) FROM shown WHERE kind = 'click'
UNION ALL
SELECT seq, 'dwd_traffic_action', mid, is_new, ms + unnest(range(1 + k % 2)), CAST(k AS VARCHAR), NULL
FROM shown WHERE kind = 'purchase'
UNION ALL
SELECT seq, 'dwd_traffic_page', mid, is_new, ms, phrase, CAST(round(value * 100) AS BIGINT)
FROM shown WHERE kind IN ('view', 'click', 'purchase') OR (kind = 'error' AND k % 2 = 0)"""

# Letters as Han characters; an alternation that tries long words first finds the longest match at each place.
_LETTERS = "abcdefghijklmnopqrstuvwxyz"
_HAN = "".join(chr(0x4E00 + 37 * i) for i in range(26))
_SEGMENTS = rf"""
WITH entry AS (
  SELECT DISTINCT translate(w, '{_LETTERS}', '{_HAN}') AS w
  FROM (SELECT unnest(string_split_regex(lower(text), '[^a-z]+')) AS w FROM benchmark) WHERE length(w) >= 2
),
pattern AS (
  SELECT string_agg(w, '|' ORDER BY length(w) DESC, w) || '|\p{{Han}}|(?:\p{{N}}|[^\p{{Han}}\P{{L}}])+' AS p FROM entry
)
SELECT keyword, count(*) AS n_documents FROM (
  SELECT doc_id, unnest(list_distinct(regexp_extract_all(
    replace(translate(lower(text), '{_LETTERS}', '{_HAN}'), ' ', ''), p))) AS keyword
  FROM documents, pattern)
GROUP BY 1"""

_BY_TABLE = "SELECT seq, source_table, type, id FROM {}"

# A routed fact's values, where its topic has the field.
_FACT_FIELDS = """id, CASE WHEN contains(fields, 'user_id') THEN id END AS user_id,
           CASE WHEN contains(fields, 'coupon_id') THEN CAST(seq % 9 AS VARCHAR) END AS coupon_id,
           CASE WHEN contains(fields, 'coupon_status') THEN status END AS coupon_status,
           CASE WHEN contains(fields, 'create_time') THEN strftime(et, '%Y-%m-%d') END AS create_time"""

_CLOSED = "start + INTERVAL {} <= (SELECT max(ts) FROM {}) - INTERVAL 5 SECOND"

ORACLES = {
    "q_topic_source": r"""
    SELECT event_id AS seq, CASE WHEN event_id % 97 <> 13 THEN epoch_us(ts) // 1000 END AS ts FROM events""",
    "q_typed_topic": _with(_CHANGES) + """
    SELECT seq, db AS database, source_table, type, ts, CASE WHEN NOT is_empty THEN id END AS id,
           CASE WHEN is_empty THEN 0 ELSE 16 END AS n_fields
    FROM ch WHERE seq % 89 <> 17""",
    "q_change_table": _with(_CHANGES) + """
    SELECT seq, db AS database, source_table, type, CASE WHEN NOT is_empty THEN CAST(seq AS VARCHAR) END AS order_id,
           strftime(et, '%Y-%m-%d %H:%M:%S') AS et, true AS has_pt FROM ch""",
    "q_page_table": _with(_EVENTS) + """
    SELECT seq, 'p' || (k % 5) AS page_id, CASE WHEN k % 11 <> 0 THEN phrase END AS item, ms AS ts,
           strftime(ts, '%Y-%m-%d %H:%M:%S.%g') AS et FROM page""",
    "q_changelog_source": _with(_CHANGES) + """
    SELECT id, op, name FROM (
      SELECT *, row_number() OVER (PARTITION BY id ORDER BY seq DESC) AS place FROM (
        SELECT -1 AS seq, CAST(c_custkey AS VARCHAR) AS id, 'r' AS op, c_name AS name FROM customer
        UNION ALL
        SELECT seq, id, CASE type WHEN 'insert' THEN 'c' WHEN 'update' THEN 'u' ELSE 'd' END, name
        FROM ch WHERE db = 'shop' AND source_table = 'user_info' AND NOT is_empty))
    WHERE place = 1""",
    "q_changelog_chunks": _with(_CHANGES) + """
    SELECT chunk_size, id, CASE WHEN op <> 'delete' THEN name END AS name, op <> 'delete' AS alive FROM (
      SELECT *, row_number() OVER (PARTITION BY id ORDER BY seq DESC) AS place FROM (
        SELECT -1 AS seq, CAST(c_custkey AS VARCHAR) AS id, 'r' AS op, c_name AS name FROM customer
        UNION ALL
        SELECT seq, id, type, name FROM ch WHERE db = 'shop' AND source_table = 'user_info' AND NOT is_empty)),
      (VALUES (100), (1000)) sizes(chunk_size)
    WHERE place = 1""",
    "q_config_snapshot": """
    SELECT c_custkey AS "cCustkey", c_name AS "cName", c_nationkey AS "cNationkey", c_mktsegment AS "cMktsegment"
    FROM customer""",
    "q_topic_sink": _with(_EVENTS, _VISITS) + _FAN_OUT,
    "q_topic_route": _with(_CHANGES) + f"""
    SELECT seq, sink_table AS topic, {_FACT_FIELDS}, CASE WHEN seq % 3 <> 0 THEN fields_using ELSE fields END AS fields
    FROM fact JOIN route USING (source_table, type)""",
    "q_fact_job": _with(_CHANGES) + f""",
    routed AS (
      SELECT *, (seq // 4) % 2 = 1 AS late FROM fact JOIN route USING (source_table, type)
    ),
    moved AS (
      SELECT * REPLACE (
        CASE WHEN late AND source_table = 'favor_info' THEN 'dwd_favor_moved' ELSE sink_table END AS sink_table,
        CASE WHEN late AND source_table = 'favor_info' THEN 'id,user_id'
             WHEN seq % 3 <> 0 THEN fields_using ELSE fields END AS fields)
      FROM routed WHERE NOT late OR source_table <> 'user_info'
    )
    SELECT seq, sink_table AS topic, {_FACT_FIELDS}, fields FROM moved""",
    "q_upsert_latest": """
    SELECT key, value FROM (
      SELECT o_custkey AS key, o_orderkey || ':' || o_orderpriority AS value, o_orderstatus AS status,
             row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS place FROM orders)
    WHERE place = 1 AND status <> 'P'""",
    "q_window_sink": _with(_EVENTS) + _keyword_windows("5 SECOND"),
    "q_dim_upsert": _with(_CHANGES, _users()) + """
    SELECT 'column' AS merge, 'dim_user_info' AS sink_table, id AS row_key, name, login_name,
           CASE WHEN name IS NULL THEN 'create_time,id,login_name,user_level'
                ELSE 'create_time,id,login_name,name,user_level' END AS fields FROM usr
    UNION ALL
    SELECT 'row', 'dim_user_info', id, last_name, login_name,
           CASE WHEN last_name IS NULL THEN 'create_time,id,login_name,user_level'
                ELSE 'create_time,id,login_name,name,user_level' END FROM usr""",
    "q_dim_job": _with(
        _CHANGES,
        """
    counted AS (
      SELECT * REPLACE (CASE WHEN (seq // 4) % 3 <> 1 THEN name END AS name) FROM dim WHERE seq > 400
    )""",
        _users("counted AS dim"),
    ) + """
    SELECT 'dim_user_info' AS sink_table, id AS row_key, name, login_name,
           CASE WHEN name IS NULL THEN 'create_time,id,login_name,user_level'
                ELSE 'create_time,id,login_name,name,user_level' END AS fields FROM usr""",
    "q_dim_delete": _with(_CHANGES, _users()) + """
    SELECT id AS row_key, deleted_at, coalesce(put_at, -1) > coalesce(deleted_at, -1) AS alive FROM gone""",
    "q_dim_lifecycle": _with(_CHANGES) + """
    SELECT 'dim_' || source_table AS sink_table, seq, type, id
    FROM dim WHERE (source_table = 'coupon_use' AND seq > 400) OR (source_table = 'user_info' AND seq > 200)""",
    "q_log_json_filter": _with(_EVENTS) + "SELECT seq, kind AS event_type, ms AS ts FROM ev",
    "q_change_filter_dwd": _with(_CHANGES) + _BY_TABLE.format("fact"),
    "q_change_filter_dim": _with(_CHANGES) + _BY_TABLE.format("dim"),
    "q_config_current": _with(_CONFIG)
    + "SELECT source_table, source_type, sink_table, sink_columns FROM current",
    "q_config_multi_route": _with(_CONFIG)
    + "SELECT source_table, source_type, sink_table, sink_columns FROM live",
    "q_column_prune": _with(_CHANGES) + """
    SELECT seq, sink_table, id, CASE WHEN sink_table = 'dwd_tool_coupon_use' THEN CAST(seq AS VARCHAR) END AS order_id,
           CASE WHEN sink_table = 'dwd_tool_coupon_use'
             THEN 'coupon_id,coupon_status,id,order_id,used_time,user_id,using_time' ELSE fields END AS fields
    FROM fact JOIN route USING (source_table, type)""",
    "q_comment_extract": _with(_CHANGES) + """
    SELECT seq, CASE WHEN NOT is_empty THEN id END AS id, CASE WHEN NOT is_empty THEN id END AS user_id,
           CASE WHEN NOT is_empty THEN CAST(seq % 20 AS VARCHAR) END AS sku_id,
           CASE WHEN NOT is_empty THEN '120' || (1 + seq % 5) END AS appraise,
           CASE WHEN NOT is_empty THEN 'c' || seq END AS comment_txt,
           CASE WHEN NOT is_empty THEN strftime(et, '%Y-%m-%d') END AS comment_time, ts
    FROM ch WHERE db = 'shop' AND source_table = 'comment_info' AND type = 'insert'""",
    "q_kw_filter": _with(_EVENTS) + "SELECT seq, phrase AS kw FROM search",
    "q_traffic_json": _with(_EVENTS, _VISITS, _VIEWS) + f"""
    SELECT stt, cur_date, vc, is_new, CAST(pv_ct AS VARCHAR) AS pv_ct, ar, ch,
           'ar,ch,cur_date,dur_sum,edt,is_new,pv_ct,stt,sv_ct,uv_ct,vc' AS fields
    FROM ({_traffic_windows("1 HOUR")})""",
    "q_debezium_normalize": _with(_CHANGES) + """
    SELECT seq, db AS database, source_table, type, ts, CASE WHEN NOT is_empty THEN id END AS id,
           CASE WHEN NOT is_empty THEN name END AS name, CASE WHEN type = 'update' THEN 'name' END AS changed,
           CASE WHEN type = 'update' THEN 'old' END AS old_name FROM ch""",
    "q_log_start": _with(_EVENTS)
    + "SELECT seq, mid, ms AS ts, 'common,start,ts' AS fields FROM ev WHERE kind = 'signup'",
    "q_log_err": _with(_EVENTS) + """
    SELECT seq, mid, ms AS ts, CASE WHEN k % 2 = 0 THEN 'common,err,page,ts' ELSE 'common,err,ts' END AS fields
    FROM ev WHERE kind = 'error'""",
    "q_log_page": _with(_EVENTS) + "SELECT seq, mid, ms AS ts, 'common,page,ts' AS fields FROM page",
    "q_log_display": _with(_EVENTS) + """
    SELECT seq, mid, CAST(k AS VARCHAR) AS item, pos, 'ch' || (user_id % 4) AS ch, ms AS ts,
           'ar,ch,is_new,item,mid,pos,sid,ts,vc' AS fields
    FROM (SELECT *, unnest(range(k % 3)) AS pos FROM ev WHERE kind = 'click')""",
    "q_log_action": _with(_EVENTS) + """
    SELECT seq, mid, CAST(k AS VARCHAR) AS item, CAST(NULL AS BIGINT) AS pos, 'ch' || (user_id % 4) AS ch, ms + i AS ts,
           'action_id,ar,ch,is_new,item,mid,sid,ts,vc' AS fields
    FROM (SELECT *, unnest(range(1 + k % 2)) AS i FROM ev WHERE kind = 'purchase')""",
    "q_log_fanout": _with(_EVENTS, _VISITS) + _FAN_OUT,
    "q_config_route": _with(_CHANGES) + """
    SELECT seq, sink_table, id, CAST(seq AS VARCHAR) AS order_id FROM fact JOIN route USING (source_table, type)""",
    "q_config_route_large": _with(_CONFIG) + """
    SELECT o_orderkey AS seq, sink_table, sink_columns
    FROM orders JOIN current ON source_table = 't' || (o_custkey % 900)
      AND source_type = CASE WHEN o_orderstatus = 'F' THEN 'insert' ELSE 'update' END""",
    "q_dim_route": _with(_CHANGES) + """
    SELECT seq, 'dim_user_info' AS sink_table, id AS row_key, type AS op_type, CAST(seq AS VARCHAR) AS order_id
    FROM dim WHERE source_table = 'user_info'""",
    "q_comment_lookup": _with(_CHANGES) + """
    SELECT seq, id, id AS user_id, CAST(seq % 20 AS VARCHAR) AS sku_id, code AS appraise, name_of AS appraise_name,
           'c' || seq AS comment_txt, ts
    FROM fact JOIN (VALUES ('1201', 'good'), ('1202', 'medium'), ('1203', 'bad'), ('1204', 'auto')) d(code, name_of)
      ON code = '120' || (1 + seq % 5)
    WHERE source_table = 'comment_info' AND type = 'insert'""",
    "q_comment_lookup_asof": _with(_CHANGES) + """,
    version AS (
      SELECT '120' || (1 + c_custkey % 4) AS code, 788918400 + c_custkey * 100000 AS since, c_name FROM customer
      WHERE c_custkey >= 40
    ),
    comment AS (
      SELECT seq, CASE WHEN NOT is_empty THEN id END AS id, CASE WHEN NOT is_empty THEN '120' || (1 + seq % 5) END AS appraise, ts
      FROM ch WHERE db = 'shop' AND source_table = 'comment_info' AND type = 'insert'
    )
    SELECT seq, id, appraise, ts, c_name AS appraise_name, since
    FROM comment ASOF LEFT JOIN version ON appraise = code AND ts >= since""",
    "q_config_route_late": _with(_CHANGES) + """
    SELECT seq, source_table, type, id, sink_table FROM fact LEFT JOIN route USING (source_table, type)""",
    "q_dead_counts": """
    SELECT CASE WHEN ts < '2024-01-10' THEN 0 WHEN ts < '2024-01-20' THEN 1 ELSE 2 END AS batch_id, count(*) AS n_rows,
           count(*) FILTER (event_id % 97 = 13) AS n_dead, count(*) FILTER (event_id % 97 = 13) AS n_letters
    FROM events GROUP BY 1""",
    "q_dim_enrich": _with(_CHANGES, _users()) + """
    SELECT o_orderkey, login_name, name, id IS NOT NULL AS matched
    FROM orders LEFT JOIN usr ON id = CAST(o_custkey AS VARCHAR)""",
    "q_kw_split": _with(_EVENTS) + "SELECT seq, keyword FROM word",
    "q_kw_split_documents": r"""
    SELECT keyword, count(*) AS n_documents FROM (
      SELECT unnest(list_distinct(string_split_regex(lower(text), '[^\p{L}\p{N}]+'))) AS keyword
      FROM documents)
    WHERE keyword <> '' GROUP BY 1""",
    "q_kw_segment": _SEGMENTS,
    "q_kw_segment_large": _SEGMENTS,
    "q_kw_window": _with(_EVENTS) + _keyword_windows("5 SECOND"),
    "q_kw_window_1h": _with(_EVENTS) + _keyword_windows("1 HOUR"),
    "q_traffic_parse": _with(_EVENTS, _VISITS, _VIEWS)
    + "SELECT seq, ts, mid, sid, vc, ch, ar, is_new, dur FROM view_rows",
    "q_uv_sv_flags": _with(_EVENTS, _VISITS, _VIEWS) + "SELECT seq, uv, sv FROM flagged",
    "q_traffic_window": _with(_EVENTS, _VISITS, _VIEWS) + _traffic_windows("5 SECOND"),
    "q_traffic_window_1h": _with(_EVENTS, _VISITS, _VIEWS) + _traffic_windows("1 HOUR"),
    "q_new_visitor_fix": _with(_EVENTS, _VISITS) + "SELECT seq, mid, is_new, is_new AS record_is_new FROM fixed",
    "q_watermark_late": _with(
        _EVENTS,
        "on_time AS (SELECT * FROM word WHERE ts < TIMESTAMP '2024-01-10' OR ts >= TIMESTAMP '2024-01-12')",
    )
    + _keyword_windows("1 HOUR", "on_time", _CLOSED.format("1 HOUR", "search")),
    "q_visitor_stream": _with(_EVENTS, _VISITS.replace("ORDER BY ms", "ORDER BY seq % 3, ms"))
    + "SELECT seq, mid, is_new FROM fixed",
    "q_restart": _with(_EVENTS, _VISITS) + _FAN_OUT,
    "q_time_funcs": """
    SELECT id, kind, ms, strftime(tm, '%Y-%m-%d') AS day, strftime(tm, '%Y-%m-%d %H:%M:%S') AS date_time,
           strftime(tm, '%Y%m%d') AS cur_date, strftime(tm, '%Y-%m-%d %H:%M:%S.%g') AS et_ms,
           strftime(tm, '%Y-%m-%d %H:%M:%S') AS et_s, ms // 1000 * 1000 - 28800000 AS date_time_ms,
           ms // 86400000 * 86400000 - 28800000 AS day_ms
    FROM (SELECT event_id AS id, 'event' AS kind, ts AS tm, epoch_us(ts) // 1000 AS ms FROM events
          UNION ALL SELECT o_orderkey, 'order', o_orderdate, epoch_us(o_orderdate) // 1000 FROM orders)""",
}

# The same rows by another way.
ORACLES["q_dim_upsert_partitions"] = ORACLES["q_dim_upsert"]
ORACLES["q_dim_enrich_tables"] = ORACLES["q_dim_enrich"]
ORACLES["q_traffic_job"] = ORACLES["q_traffic_window"]
ORACLES["q_comment_job"] = ORACLES["q_comment_lookup"]
ORACLES["q_ods_job"] = ORACLES["q_debezium_normalize"]
