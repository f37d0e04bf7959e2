"""The registered workloads as SQL over the same tables, written from the rules, not from the plans."""

from __future__ import annotations

from tidemark import fixed_values as V

ORACLES: dict[str, str] = {}

# --- inputs -------------------------------------------------------------------
HISTORY = """h AS (
  SELECT CAST(l_partkey AS VARCHAR) AS card_id, l_returnflag AS condition, CAST(l_shipdate AS DATE) AS date,
         CAST(floor(l_extendedprice / l_quantity) AS BIGINT) AS price,
         CASE WHEN l_discount = 0 THEN 0 ELSE CAST(l_quantity AS BIGINT) END AS trade_count,
         l_linestatus, l_orderkey * 8 + l_linenumber AS seq
  FROM lineitem)"""
CODE = "lpad(CAST(p_size AS VARCHAR), 3, '0') || '/' || p_brand"
NAMED = f"""{HISTORY}, n AS (
  SELECT h.*, coalesce({CODE}, '') AS hinban,
         CASE WHEN l_linestatus = 'F' THEN '' ELSE coalesce(p_name, '') END AS card_name
  FROM h LEFT JOIN part ON CAST(p_partkey AS VARCHAR) = card_id)"""
ORDER = "seq DESC"
INDEX = """ix AS (
  SELECT event_type AS index_type, CAST(ts AS DATE) AS date,
         CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) // count(*) AS value
  FROM events GROUP BY 1, 2)"""
USERS = """us AS (
  SELECT user_id, event_type, CAST(ts AS DATE) AS date,
         (CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) // count(*)) // 1000 AS price,
         CAST(NULL AS BIGINT) AS trade_count
  FROM events GROUP BY 1, 2, 3)"""


def daily(source: str, keys: str, order: str | None, out: str = "dd") -> str:
    if order is None:
        return f"{out} AS (SELECT * FROM {source} WHERE date IS NOT NULL AND price IS NOT NULL)"
    return f"""{out} AS (SELECT * FROM {source} WHERE date IS NOT NULL AND price IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY {keys}, date ORDER BY {order}) = 1)"""


def marked(keys: str, source: str = "dd") -> str:
    return f"""fl AS (
  SELECT *, max(CASE WHEN trade_count IS NOT NULL THEN 1 ELSE 0 END) OVER (PARTITION BY {keys}) AS counted,
         lag(price) OVER (PARTITION BY {keys} ORDER BY date) AS before FROM {source}),
mk AS (
  SELECT *, CASE WHEN counted = 1 THEN 'trade_count' ELSE 'price_repeat' END AS imputation_basis,
         CASE WHEN counted = 1 THEN trade_count IS NULL OR trade_count <= 0
              ELSE coalesce(price = before, false) END AS imputed FROM fl)"""


def metrics(keys: str, source: str = "dd") -> str:
    """CTEs up to ``mt``: one row per series."""
    return f"""{marked(keys, source)},
ok AS (
  SELECT *, CAST(price AS DOUBLE) AS p, row_number() OVER (PARTITION BY {keys} ORDER BY date DESC) AS r,
         lag(CAST(price AS DOUBLE)) OVER (PARTITION BY {keys} ORDER BY date) AS pv FROM mk WHERE NOT imputed),
ch AS (SELECT *, (p / nullif(pv, 0) - 1) * 100 AS chg FROM ok),
cc AS (
  SELECT *, count(chg) OVER (PARTITION BY {keys} ORDER BY date DESC
                             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cr FROM ch),
lc AS (SELECT {keys}, max(chg) FILTER (WHERE cr = 1 AND chg IS NOT NULL) AS d1 FROM cc GROUP BY {keys}),
ag AS (
  SELECT {keys}, count(*) AS valid_days, max(date) AS last_date, any_value(d1) AS d1,
         max(p) FILTER (WHERE r = 1) AS p0, max(p) FILTER (WHERE r = 4) AS p3, max(p) FILTER (WHERE r = 7) AS p6,
         avg(p) FILTER (WHERE r <= 5) AS m5, avg(p) FILTER (WHERE r <= 20) AS m20, count(chg) AS nc,
         stddev_pop(chg) FILTER (WHERE chg IS NOT NULL AND cr <= 20) AS sd,
         avg(-chg) FILTER (WHERE chg < 0 AND cr <= 20) AS avg_down,
         min(cr) FILTER (WHERE chg IS NOT NULL AND sign(chg) <> sign(d1)) AS turn
  FROM cc JOIN lc USING ({keys}) GROUP BY {keys}),
al AS (
  SELECT {keys}, count(*) AS record_count, max(date) AS latest_date, any_value(imputation_basis) AS imputation_basis,
         arg_max(price, date) AS latest_price, arg_max(imputed, date) AS latest_imputed FROM mk GROUP BY {keys}),
m0 AS (
  SELECT al.*, coalesce(valid_days, 0) AS valid_days, last_date, d1,
         (p0 / nullif(p3, 0) - 1) * 100 AS d3, (p0 / nullif(p6, 0) - 1) * 100 AS d7,
         CASE WHEN valid_days >= 5 THEN m5 END AS ma5, CASE WHEN valid_days >= 2 THEN m20 END AS ma20,
         CASE WHEN nc >= 2 THEN sd END AS vol20, avg_down,
         CASE WHEN d1 IS NULL OR d1 = 0 THEN 0
              ELSE CAST(sign(d1) AS BIGINT) * (coalesce(turn, nc + 1) - 1) END AS streak
  FROM al LEFT JOIN ag USING ({keys})),
m1 AS (
  SELECT *, CASE
    WHEN valid_days < {V.MIN_VALID_DAYS} OR d3 IS NULL THEN '{V.UNDECIDED}'
    WHEN d3 < {V.DOWN_D3} AND (coalesce(ma5 < ma20, false) OR streak <= {V.DOWN_STREAK}) THEN '{V.DOWN}'
    WHEN d3 > {V.UP_D3} AND coalesce(ma5 > ma20, false) AND streak >= {V.UP_STREAK} THEN '{V.UP}'
    ELSE '{V.FLAT}' END AS trend FROM m0),
mt AS (
  SELECT *, CASE WHEN trend = '{V.DOWN}' AND avg_down > 0 THEN avg_down * {V.BUFFER_MULTIPLIER} END
    AS suggested_buffer_pct FROM m1)"""


ROUNDED = "round(d1, 4) AS d1, round(d3, 4) AS d3, round(d7, 4) AS d7, round(ma5, 4) AS ma5, round(ma20, 4) AS ma20"


def trends(label: str = "key") -> str:
    return f"""SELECT CAST(coalesce(last_date, DATE '1970-01-01') AS VARCHAR) AS date, scope, key, {label} AS label,
  {ROUNDED}, round(vol20, 4) AS vol20, CAST(streak AS BIGINT) AS streak, valid_days, trend,
  round(suggested_buffer_pct, 4) AS suggested_buffer_pct, imputation_basis FROM mt"""


CARD = "s AS (SELECT 'card' AS scope, card_id || '|' || condition AS key, * FROM h)"
CARD_TRENDS = f"WITH {HISTORY}, {CARD}, {daily('s', 'scope, key', ORDER)}, {metrics('scope, key')}"
INDEX_SERIES = "s AS (SELECT 'index' AS scope, index_type AS key, date, value AS price, CAST(NULL AS BIGINT) AS trade_count FROM ix)"
GROUPED = """price IS NOT NULL AND date IS NOT NULL AND (trade_count IS NULL OR trade_count > 0)"""

ORACLES["trend_card"] = f"{CARD_TRENDS} {trends()}"
ORACLES["trend_index"] = f"WITH {INDEX}, {INDEX_SERIES}, {daily('s', '', None)}, {metrics('scope, key')} {trends()}"


def _group(name: str, prefix: str, source: str, ctes: str, out: str = "dd") -> str:
    return f"""{ctes}{out} AS (
  SELECT 'group' AS scope, '{prefix}' || {name} AS key, date, avg(price) AS price,
         CAST(sum(coalesce(trade_count, 1)) AS BIGINT) AS trade_count
  FROM {source} WHERE {GROUPED} AND {name} <> '' GROUP BY {name}, date)"""


ORACLES["trend_group_condition"] = (
    f"WITH {_group('condition', 'condition:', 'h', HISTORY + ', ')}, {metrics('scope, key')} {trends()}")
ORACLES["trend_group_set"] = (
    f"WITH {NAMED}, ns AS (SELECT *, split_part(hinban, '/', -1) AS card_set FROM n), "
    f"{_group('card_set', 'set:', 'ns', '')}, {metrics('scope, key')} {trends()}")

_LAST_NAME = """SELECT {k}, arg_max(card_name, seq) FILTER (WHERE card_name <> '') AS card_name,
    arg_max(hinban, seq) FILTER (WHERE hinban <> '') AS hinban FROM n GROUP BY {k}"""
ORACLES["trend_all_scopes"] = f"""WITH {NAMED}, {INDEX},
ns AS (SELECT *, split_part(hinban, '/', -1) AS card_set FROM n),
{_group('condition', 'condition:', 'n', '', 'g1')}, {_group('card_set', 'set:', 'ns', '', 'g2')},
c0 AS (SELECT 'card' AS scope, card_id || '|' || condition AS key, * FROM n), {daily('c0', 'scope, key', ORDER, 'c1')},
dd AS (
  SELECT scope, key, date, CAST(price AS DOUBLE) AS price, trade_count FROM c1
  UNION ALL SELECT * FROM g1 UNION ALL SELECT * FROM g2
  UNION ALL SELECT 'index', index_type, date, CAST(value AS DOUBLE), NULL FROM ix),
lb AS ({_LAST_NAME.format(k='card_id, condition')}),
{metrics('scope, key')},
lk AS (SELECT 'card' AS scope, card_id || '|' || condition AS key,
         concat_ws(' ', card_name, '[' || hinban || ']', condition) AS text FROM lb)
{trends("coalesce(text, key)")} LEFT JOIN lk USING (scope, key)"""

ORACLES["group_series"] = f"""WITH {HISTORY} SELECT condition, CAST(date AS VARCHAR) AS date,
  round(avg(price), 4) AS price, CAST(sum(coalesce(trade_count, 1)) AS BIGINT) AS trade_count
FROM h WHERE {GROUPED} GROUP BY condition, date"""

CARD_DAILY = f"WITH {HISTORY}, {daily('h', 'card_id, condition', ORDER)}"
ORACLES["dedup_last"] = f"{CARD_DAILY} SELECT card_id, condition, CAST(date AS VARCHAR) AS date, price, trade_count FROM dd"
ORACLES["mark_imputed_count"] = f"""{CARD_DAILY}, {marked('card_id, condition')}
SELECT card_id, condition, CAST(date AS VARCHAR) AS date, price, trade_count, imputation_basis,
  CAST(imputed AS INTEGER) AS imputed FROM mk"""
ORACLES["mark_imputed_repeat"] = f"""WITH {USERS}, {marked('user_id, event_type', 'us')}
SELECT user_id, event_type, CAST(date AS VARCHAR) AS date, price, imputation_basis, CAST(imputed AS INTEGER) AS imputed FROM mk"""
ORACLES["trend_users"] = f"""WITH {USERS}, {metrics('user_id, event_type', 'us')}
SELECT user_id, event_type, {ROUNDED}, round(vol20, 4) AS vol20, CAST(streak AS BIGINT) AS streak, valid_days, trend,
  round(suggested_buffer_pct, 4) AS suggested_buffer_pct, imputation_basis, record_count FROM mt"""
ORACLES["has_trade_count"] = f"""WITH {HISTORY} SELECT card_id, condition,
  CAST(bool_or(trade_count IS NOT NULL) AS INTEGER) AS has_count FROM h GROUP BY 1, 2"""
ORACLES["index_diff"] = f"""WITH {INDEX}, w AS (SELECT *, lag(value) OVER (PARTITION BY index_type ORDER BY date) AS pv FROM ix)
SELECT index_type, CAST(date AS VARCHAR) AS date, value, value - pv AS diff,
  round((CAST(value AS DOUBLE) / nullif(pv, 0) - 1) * 100, 4) AS diff_pct FROM w"""
ORACLES["last_n_days"] = f"""{CARD_DAILY} SELECT card_id, condition, CAST(date AS VARCHAR) AS date, price, trade_count FROM dd
QUALIFY row_number() OVER (PARTITION BY card_id, condition ORDER BY date DESC) <= 5"""
_TRAIL = f"""tr AS (
  SELECT card_id, condition, string_agg(CAST(price AS VARCHAR) || CASE WHEN imputed THEN '*' ELSE '' END, '→' ORDER BY date)
    AS price_trail
  FROM (SELECT * FROM mk QUALIFY row_number() OVER (PARTITION BY card_id, condition ORDER BY date DESC) <= {V.TRAIL_DAYS})
  GROUP BY 1, 2)"""
ORACLES["price_trail"] = f"{CARD_DAILY}, {marked('card_id, condition')}, {_TRAIL} SELECT * FROM tr"
ORACLES["latest_per_key"] = f"""{CARD_DAILY} SELECT card_id, condition, CAST(date AS VARCHAR) AS date, price, trade_count FROM dd
QUALIFY row_number() OVER (PARTITION BY card_id, condition ORDER BY date DESC) = 1"""
ORACLES["carried_names"] = f"WITH {NAMED} {_LAST_NAME.format(k='card_id')}"

_BOARD = f"""{{head}}, {daily('src', 'card_id, condition', ORDER)}, {metrics('card_id, condition')}, {_TRAIL},
nm AS ({_LAST_NAME.format(k='card_id')})
SELECT mt.card_id, coalesce(hinban, '') AS code, coalesce(card_name, '') AS name, condition, trend,
  round(suggested_buffer_pct, 4) AS buffer, latest_price, CAST(latest_date AS VARCHAR) AS latest_date,
  CAST(latest_imputed AS INTEGER) AS latest_imputed, {ROUNDED}, CAST(streak AS BIGINT) AS streak, round(vol20, 4) AS vol20,
  valid_days, record_count, imputation_basis AS basis, price_trail AS trail
FROM mt JOIN tr USING (card_id, condition) JOIN nm USING (card_id)"""
ORACLES["status_board"] = _BOARD.format(head=f"WITH {NAMED}, src AS (SELECT * FROM n)")
ORACLES["status_watched"] = _BOARD.format(head=f"""WITH {NAMED}, src AS (
  SELECT * FROM n WHERE card_id IN (SELECT CAST(p_partkey AS VARCHAR) FROM part WHERE p_type = 'SMALL'))""")
ORACLES["card_report"] = f"""WITH {NAMED}, kc AS (
  SELECT card_id, min(seq) AS seq,
         arg_min(card_name, row(seq, card_name, hinban)) AS card_name FROM n GROUP BY 1),
hit AS (SELECT card_id, CASE WHEN card_name = 'red widget' THEN 80 ELSE 40 END AS score FROM kc
  WHERE contains(card_name, 'red widget') ORDER BY score DESC, card_name, seq LIMIT {V.REPORT_HITS}),
src AS (SELECT n.* FROM n JOIN hit USING (card_id)),
{daily('src', 'card_id, condition', ORDER)}, {metrics('card_id, condition')}, {_TRAIL}
SELECT card_id, condition, score, trend, {ROUNDED}, round(vol20, 4) AS vol20, CAST(streak AS BIGINT) AS streak, valid_days,
  record_count, price_trail FROM mt JOIN hit USING (card_id) JOIN tr USING (card_id, condition)"""
_TWO = "coalesce(regexp_replace(printf('%.2f', {0}), '0$', ''), '') AS {0}"
_ONE = "coalesce(printf('%.1f', {0}), '') AS {0}"
ORACLES["export_trends"] = f"""{CARD_TRENDS} SELECT CAST(coalesce(last_date, DATE '1970-01-01') AS VARCHAR) AS date, scope, key,
  key AS label, {', '.join(_TWO.format(c) for c in ('d1', 'd3', 'd7', 'vol20'))},
  {', '.join(_ONE.format(c) for c in ('ma5', 'ma20', 'suggested_buffer_pct'))},
  CAST(CAST(streak AS BIGINT) AS VARCHAR) AS streak, CAST(valid_days AS VARCHAR) AS valid_days, trend, imputation_basis FROM mt"""
ORACLES["group_by_expression"] = f"""WITH {HISTORY} SELECT 'd' || length(card_id) AS "group", condition, CAST(date AS VARCHAR) AS date,
  round(avg(price), 4) AS price, CAST(sum(coalesce(trade_count, 1)) AS BIGINT) AS trade_count
FROM h WHERE {GROUPED} GROUP BY 1, 2, h.date"""
ORACLES["trend_summary"] = f"""{CARD_TRENDS} SELECT trend, count(*) AS series,
  count(*) FILTER (WHERE imputation_basis = 'price_repeat') AS on_price_repeat,
  string_agg(DISTINCT imputation_basis, ',' ORDER BY imputation_basis) AS bases FROM mt GROUP BY trend"""
ORACLES["worst_falls"] = f"""{CARD_TRENDS} SELECT scope, key, round(d3, 2) AS d3, CAST(streak AS BIGINT) AS streak, valid_days
FROM mt WHERE trend = '{V.DOWN}' ORDER BY round(d3, 2), scope, key LIMIT {V.WORST_FALLS}"""
ORACLES["trend_marks"] = f"""{CARD_TRENDS} SELECT key,
  CASE trend WHEN '下落' THEN '▼下落' WHEN '上昇' THEN '▲上昇' WHEN '横ばい' THEN '→横ばい' ELSE '?判定不可' END AS mark,
  CASE trend WHEN '下落' THEN 0 WHEN '判定不可' THEN 1 WHEN '横ばい' THEN 2 WHEN '上昇' THEN 3 ELSE 9 END AS urgency FROM mt"""

# --- merge --------------------------------------------------------------------
_HALVES = """e AS (SELECT o_custkey, o_orderpriority, o_orderstatus, o_totalprice, 'memo ' || o_orderkey AS memo, o_orderkey AS pos
  FROM orders WHERE CAST(o_orderdate AS DATE) < DATE '1998-01-01'),
b AS (SELECT o_custkey, o_orderpriority, o_orderstatus, o_totalprice, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS seen,
    o_orderkey AS seq FROM orders WHERE CAST(o_orderdate AS DATE) >= DATE '1997-07-01'),
l AS (SELECT o_custkey, o_orderpriority, arg_max(o_orderstatus, seq) AS st, arg_max(o_totalprice, seq) AS tp,
    arg_max(seen, seq) AS seen, min(seq) AS first FROM b GROUP BY 1, 2),
t AS (SELECT o_custkey, o_orderpriority, min(pos) AS pos FROM e GROUP BY 1, 2),
up AS (
  SELECT e.o_custkey, e.o_orderpriority, coalesce(l.st, e.o_orderstatus) AS o_orderstatus,
         coalesce(l.tp, e.o_totalprice) AS o_totalprice, e.memo, l.seen, e.pos,
         CASE WHEN l.st IS NOT NULL THEN 'update' ELSE 'unchanged' END AS action
  FROM e LEFT JOIN t ON t.pos = e.pos AND t.o_custkey = e.o_custkey
  LEFT JOIN l ON l.o_custkey = t.o_custkey AND l.o_orderpriority = t.o_orderpriority
  UNION ALL
  SELECT l.o_custkey, l.o_orderpriority, st, tp, NULL, seen,
         (SELECT max(pos) FROM e) + 1 + first, 'append'
  FROM l LEFT JOIN t USING (o_custkey, o_orderpriority) WHERE t.pos IS NULL)"""
ORACLES["upsert_plan"] = f"WITH {_HALVES} SELECT * FROM up"
ORACLES["upsert_stats"] = f"WITH {_HALVES} SELECT action, count(*) AS rows FROM up GROUP BY action"
ORACLES["upsert_result"] = """SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day, o_orderpriority AS priority,
  arg_max(o_totalprice, o_orderkey) AS total FROM orders GROUP BY 1, 2"""
ORACLES["stream_upsert"] = f"WITH {INDEX} SELECT index_type, CAST(date AS VARCHAR) AS date, value FROM ix"
ORACLES["stream_trends"] = ORACLES["trend_index"]
DAILY_NAMED = f"""{NAMED}, nd AS (
  SELECT * FROM n WHERE date IS NOT NULL QUALIFY row_number() OVER (PARTITION BY card_id, condition, date ORDER BY seq DESC) = 1)"""
ORACLES["stream_card_trends"] = f"""WITH {DAILY_NAMED},
dd AS (SELECT 'card' AS scope, card_id || '|' || condition AS key, date, CAST(price AS DOUBLE) AS price, trade_count FROM nd WHERE price IS NOT NULL),
lb AS (SELECT card_id, condition, arg_max(card_name, date) FILTER (WHERE card_name <> '') AS card_name,
         arg_max(hinban, date) FILTER (WHERE hinban <> '') AS hinban FROM nd GROUP BY card_id, condition),
{metrics('scope, key')},
lk AS (SELECT 'card' AS scope, card_id || '|' || condition AS key,
         concat_ws(' ', card_name, '[' || hinban || ']', condition) AS text FROM lb)
{trends("coalesce(text, key)")} LEFT JOIN lk USING (scope, key)"""
ORACLES["stream_group_trends"] = f"""WITH {DAILY_NAMED},
ns AS (SELECT *, split_part(hinban, '/', -1) AS card_set FROM nd),
{_group('condition', 'condition:', 'nd', '', 'g1')}, {_group('card_set', 'set:', 'ns', '', 'g2')},
dd AS (SELECT * FROM g1 UNION ALL SELECT * FROM g2), {metrics('scope, key')} {trends()}"""
ORACLES["store_index"] = f"""WITH {HISTORY},
ix AS (SELECT condition AS index_type, date, CAST(CAST(sum(price) AS BIGINT) // count(*) AS DOUBLE) AS value FROM h
       WHERE day(date) <> 17 OR year(date) = 1995 GROUP BY 1, 2),
w AS (SELECT *, lag(value) OVER (PARTITION BY index_type ORDER BY date) AS pv FROM ix)
SELECT index_type, CAST(date AS VARCHAR) AS date, value, value - pv AS diff, round((value / nullif(pv, 0) - 1) * 100, 4) AS diff_pct FROM w"""

# --- codes and names -----------------------------------------------------------
_RESOLVE = f"""rr AS (
  SELECT p_partkey AS pos, upper({CODE}) AS code,
    CASE WHEN p_size < 15 THEN p_name || '(高い方)' WHEN p_size < 25 THEN p_name
         WHEN p_size < 30 THEN p_name || ' ' || {CODE} ELSE '' END AS name,
    CASE WHEN p_size < 15 THEN p_name WHEN p_size < 25 THEN p_name
         WHEN p_size < 30 THEN p_name || ' ' || {CODE} ELSE '' END AS plain,
    CASE WHEN p_size = 50 THEN 'https://shop.example/products/1' ELSE '' END AS product_url,
    CASE WHEN p_size < 20 THEN '手動' WHEN p_size < 40 THEN '' ELSE 'a / b' END AS other,
    p_size < 20 AS noted FROM part),
rk AS (
  SELECT *, CASE WHEN plain = '' THEN code WHEN contains(upper(plain), code) THEN plain ELSE code || ' ' || plain END
    AS search_key, count(*) OVER (PARTITION BY code) > 1 AS dup FROM rr),
rn AS (
  SELECT *, CASE WHEN NOT dup THEN other WHEN noted THEN '品番重複（要確認） / 手動'
    WHEN other = '' THEN '品番重複（要確認）' ELSE other || ' / 品番重複（要確認）' END AS note FROM rk)"""
ORACLES["duplicate_codes"] = f"WITH {_RESOLVE} SELECT code, count(*) AS times FROM rr GROUP BY code HAVING count(*) > 1"
ORACLES["flag_duplicates"] = f"WITH {_RESOLVE} SELECT pos, code, name, search_key, note FROM rn"
ORACLES["write_back"] = f"WITH {_RESOLVE} SELECT code, search_key, note, product_url, pos FROM rn"
_QUOTED = "replace(replace(search_key, '#', '%23'), ' ', '%20')"
ORACLES["search_requests"] = f"""WITH {_RESOLVE}, rq AS (SELECT * FROM rn WHERE product_url = '')
SELECT pos, 0 AS template_no, 'https://shop.example/search?keyword=' || {_QUOTED} AS url FROM rq
UNION ALL SELECT pos, 1, 'https://shop.example/search?q=' || {_QUOTED} FROM rq"""
ORACLES["apply_resolution"] = f"""WITH {_RESOLVE}, rs AS (SELECT DISTINCT search_key FROM rn WHERE product_url = '')
SELECT pos, CASE WHEN product_url = '' AND length(search_key) % 2 = 0
    THEN 'https://shop.example/products/' || length(search_key) ELSE product_url END AS product_url,
  CASE WHEN product_url <> '' OR length(search_key) % 2 = 0 THEN note
    WHEN note = '' THEN '検索ヒットなし' ELSE note || ' / 検索ヒットなし' END AS note,
  CASE WHEN product_url = '' AND length(search_key) % 2 = 0 THEN '2026-10-11 00:00:01' END AS resolved_at FROM rn"""

_DASHES = "translate({}, '‐‑‒–—―⁃−－', '---------')"
_NAME = "trim(regexp_replace(" + _DASHES.format("replace(text, chr(173), '-')") + r", '\s+', ' ', 'g'))"
ORACLES["normalize_text"] = f"SELECT doc_id, md5({_NAME}) AS name_md5, CAST(length({_NAME}) AS INTEGER) AS chars FROM documents"
ORACLES["normalize_codes"] = """SELECT c_custkey, replace(upper(c_mktsegment), ' ', '') || '-' || c_custkey || '-P' AS code FROM customer"""
_COMPACT = r"regexp_replace(regexp_replace(lower({}), '\[[^\]]*\]', '', 'g'), '[^0-9a-zぁ-んァ-ヶ一-龠々]+', '', 'g')"
ORACLES["compact_names"] = f"""SELECT doc_id, md5({_COMPACT.format('text')}) AS compact_md5,
  CAST(length({_COMPACT.format('text')}) AS INTEGER) AS chars FROM documents"""
ORACLES["strip_memos"] = "SELECT p_partkey, p_name || ' ' || p_brand AS name FROM part"
ORACLES["extract_codes"] = """SELECT p_partkey, lpad(CAST(p_size AS VARCHAR), 3, '0') || '/165' || lower(substr(p_type, 1, 2)) AS code FROM part"""
ORACLES["sets_of_codes"] = "SELECT p_brand AS card_set, count(*) AS cards FROM part GROUP BY 1"
ORACLES["notes"] = """SELECT p_partkey, CASE WHEN p_type = 'SMALL' THEN p_type || ' / ' || p_brand
    ELSE p_type || ' / ' || p_brand || ' / SMALL' END AS added,
  CASE WHEN p_type = 'SMALL' THEN p_brand ELSE p_type || ' / ' || p_brand END AS dropped FROM part"""
ORACLES["guess_condition"] = """SELECT doc_id, CASE
  WHEN regexp_matches(lower(text), 'psa10|psa_10|graded|鑑定') THEN 'psa10'
  WHEN regexp_matches(lower(text), 'damaged|kizu|played|キズ') THEN 'キズあり'
  WHEN regexp_matches(lower(text), 'mint|bihin|clean|美品|normal') THEN '美品' ELSE '不明' END AS condition FROM documents"""
ORACLES["status_from_stock"] = """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' OR o_orderpriority = '5-LOW'
  THEN '受付終了' ELSE '募集中' END AS status FROM orders"""
ORACLES["upsert_keys"] = """SELECT c_custkey, CASE WHEN c_nationkey = 0 THEN '' ELSE c_name END AS name_key,
  CAST(c_nationkey AS VARCHAR) AS nation_key FROM customer"""

# --- numbers, dates, urls -------------------------------------------------------
ORACLES["parse_numbers"] = """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN -CAST(floor(o_totalprice) AS BIGINT)
    WHEN 'P' THEN NULL ELSE CAST(floor(o_totalprice) AS BIGINT) END AS price,
  CASE WHEN o_orderstatus = 'P' THEN '' ELSE CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR) END AS digits,
  CAST(trunc(o_totalprice) AS BIGINT) AS truncated FROM orders"""
ORACLES["parse_diffs"] = """SELECT o_orderkey,
  CASE WHEN o_orderstatus = 'F' THEN -1 ELSE 1 END * CAST(floor(o_totalprice) AS BIGINT) AS amount,
  CASE WHEN o_orderstatus = 'F' THEN -1 ELSE 1 END *
    CAST((o_custkey % 100) || '.' || lpad(CAST(o_orderkey % 100 AS VARCHAR), 2, '0') AS DOUBLE) AS pct FROM orders"""
ORACLES["parse_dates"] = """SELECT o_orderkey,
  CASE WHEN o_orderstatus = 'P' THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS dated,
  CASE WHEN o_orderstatus = 'P' THEN CAST(TRY_CAST('2025-' || strftime(o_orderdate, '%m-%d') AS DATE) AS VARCHAR)
    ELSE strftime(o_orderdate, '%Y-%m-%d') END AS in_2025,
  CASE WHEN epoch_ms(o_orderdate) > 100000000000 THEN strftime(o_orderdate + INTERVAL 9 HOUR, '%Y-%m-%d') END AS from_epoch
FROM orders"""
ORACLES["pct_change"] = """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
  round((l_extendedprice / nullif(l_discount, 0) - 1) * 100, 2) AS pct FROM lineitem"""
ORACLES["japan_times"] = "SELECT event_id, strftime(ts + INTERVAL 9 HOUR, '%Y-%m-%d %H:%M:%S') AS stamp FROM events"
ORACLES["clean_urls"] = """SELECT page_id, url AS absolute, 'https://img/' || page_id AS same_scheme,
  'https://shop.example/list/a/' || page_id || '.jpg' AS relative FROM pages"""
_PATH = "regexp_replace(regexp_replace(url, '[?#].*$', ''), '^[a-z]+://[^/]*', '')"
ORACLES["slugs"] = f"SELECT page_id, regexp_extract(regexp_replace({_PATH}, '/+$', ''), '([^/]*)$', 1) AS slug FROM pages"

# --- items, pages ---------------------------------------------------------------
ORACLES["dedup_items"] = """SELECT name, grade, price, '' AS image_url, page, pos, stock FROM (
  SELECT CAST(l_suppkey AS VARCHAR) AS name, l_returnflag AS grade, CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS price,
    l_orderkey AS page, CAST(l_linenumber AS BIGINT) AS pos, CAST(l_partkey AS VARCHAR) AS stock FROM lineitem)
QUALIFY row_number() OVER (PARTITION BY name, grade, price ORDER BY page, pos, stock) = 1"""
_LISTED = """it AS (SELECT p_partkey // 20 AS page, CAST(row_number() OVER (PARTITION BY p_partkey // 20 ORDER BY p_partkey) - 1 AS BIGINT) AS pos,
  p_name || ' & co' AS name, p_brand AS grade, CAST(CAST(floor(p_retailprice) AS BIGINT) AS VARCHAR) AS price,
  CASE WHEN p_size < 10 THEN '受付終了' ELSE '残り2点' END AS stock,
  CASE WHEN p_size < 10 THEN '受付終了' ELSE '募集中' END AS accept_status,
  'https://shop.example/up/' || p_partkey || '.jpg' AS image_url FROM part)"""
ORACLES["listing_items"] = f"WITH {_LISTED} SELECT * FROM it"
ORACLES["snapshot_table"] = f"""WITH {_LISTED} SELECT name, grade, price, stock, accept_status, image_url,
  '2026-10-11 00:00:01' AS loaded_at FROM it"""
ORACLES["declared_count"] = """SELECT p_partkey // 20 AS page, count(*) + (p_partkey // 20) % 2 AS declared FROM part GROUP BY p_partkey // 20"""
ORACLES["completeness_audit"] = """SELECT p_partkey // 20 AS page, count(*) + (p_partkey // 20) % 2 AS declared, count(*) AS items,
  1 AS checked, CAST((p_partkey // 20) % 2 AS INTEGER) AS short FROM part GROUP BY p_partkey // 20"""
_NUMBERS = """nu AS (SELECT p_partkey AS page,
  CASE WHEN p_size < 40 THEN CAST(CAST(floor(p_retailprice) AS BIGINT) AS VARCHAR) ELSE '' END AS lowest,
  CASE WHEN p_size < 40 THEN CAST(p_size AS VARCHAR) ELSE '' END AS listed, '' AS last_sold FROM part)"""
ORACLES["product_numbers"] = f"WITH {_NUMBERS} SELECT * FROM nu"
ORACLES["extraction_failures"] = f"""WITH {_NUMBERS} SELECT count(*) AS rows,
  count(*) FILTER (WHERE lowest = '' AND listed = '' AND last_sold = '') AS failed,
  CAST(bool_and(lowest = '' AND listed = '' AND last_sold = '') AS INTEGER) AS all_failed FROM nu"""
_PATTERNS = [("track", 0, r"track\(([0-9]+)\)"), ("link", 0, r'<a href="/[A-Z][a-z]+"'),
             ("link", 1, r'<a href="/[a-z]+"'), ("card", 0, "/card/[0-9]+")]
ORACLES["pattern_coverage"] = " UNION ALL ".join(
    f"""SELECT '{label}' AS label, {no} AS pattern_no, '{p}' AS pattern, count(*) AS pages,
  count(*) FILTER (WHERE regexp_matches(html, '{p}')) AS pages_hit,
  CAST(sum(len(regexp_extract_all(html, '{p}'))) AS BIGINT) AS hits,
  min(list_min(regexp_extract_all(html, '{p}'))) AS sample FROM pages""" for label, no, p in _PATTERNS)
ORACLES["json_shape"] = """SELECT '{' || array_to_string(json_keys(props), ', ') || '}' AS shape, count(*) AS documents
FROM events GROUP BY 1"""
_HOST = "lower(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1))"
_URL_PATH = "regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1)"
ORACLES["robots_filter"] = f"""SELECT page_id, url, CASE WHEN regexp_matches({_HOST}, '^(blog|www)[.]') THEN CAST(
  NOT starts_with({_URL_PATH}, '/en/9') AND
  (starts_with({_URL_PATH}, '/fr/1') OR NOT starts_with({_URL_PATH}, '/fr/')) AS INTEGER) END AS allowed FROM pages"""
_LINKS = """a AS (SELECT page_id, replace(unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)), '&amp;', '&') AS href,
  unnest(regexp_extract_all(html, '<a href="[^"]*">([^<]*)</a>', 1)) AS shown,
  unnest(range(len(regexp_extract_all(html, '<a href="([^"]*)"', 1)))) AS pos FROM pages)"""
_NESTED = "nested AS (SELECT p_partkey % 2 AS kind, CASE WHEN p_partkey % 3 = 0 THEN 'STRING' ELSE 'BIGINT' END AS deep FROM part)"
ORACLES["json_structure"] = f"""WITH {_NESTED} SELECT 'OBJECT<a: OBJECT<b: ARRAY<OBJECT<c: OBJECT<d: ' || deep || '>>>>, n: BIGINT>' AS structure,
  count(*) AS documents FROM nested GROUP BY deep"""
ORACLES["json_structure_cut"] = "SELECT 'OBJECT<a: OBJECT<b: ...>, n: BIGINT>' AS structure, count(*) AS documents FROM part"
ORACLES["json_common_structure"] = f"""WITH {_NESTED} SELECT kind, 'OBJECT<a: OBJECT<b: ARRAY<OBJECT<c: OBJECT<d: '
  || CASE WHEN count(DISTINCT deep) > 1 THEN 'VARIANT' ELSE max(deep) END || '>>>>, n: BIGINT>' AS structure, count(*) AS documents FROM nested GROUP BY kind"""
ORACLES["extract_links_selected"] = """SELECT page_id, 'https://shop.example' || CASE page_id % 4 WHEN 0 THEN '/products/' || page_id
  WHEN 1 THEN '/products/' || page_id WHEN 2 THEN '/trading-cards/' || page_id ELSE '/trading-cards/a-b/' || page_id END AS link FROM pages"""
ORACLES["extract_links"] = f"""WITH {_LINKS}, f AS (SELECT page_id, arg_min(href, pos) AS href FROM a
  WHERE regexp_matches(href, '^/[a-z]+$') GROUP BY 1)
SELECT page_id, 'https://shop.example' || href AS link FROM pages LEFT JOIN f USING (page_id)"""
ORACLES["extract_catalog"] = f"""WITH {_LINKS},
k AS (SELECT *, CASE WHEN regexp_matches(href, '^/[A-Z][a-z]+$') THEN 1 WHEN regexp_matches(href, '^/[a-z]+$') THEN 2 END AS test FROM a),
f AS (SELECT * FROM k QUALIFY test = min(test) OVER (PARTITION BY page_id))
SELECT substr(href, 2) AS card_id, shown AS card_name, '' AS hinban, 'https://shop.example' || href AS url, page_id AS page, pos
FROM f QUALIFY row_number() OVER (PARTITION BY href ORDER BY page_id, pos) = 1"""
ORACLES["first_match"] = r"""SELECT page_id, coalesce(nullif(regexp_extract(t, '/card/([0-9]+)', 1), ''),
  nullif(regexp_extract(t, 'page=([0-9]+)', 1), ''), regexp_extract(t, 'track\(([0-9]+)\)', 1), '') AS number
FROM (SELECT page_id, url || ' ' || html AS t FROM pages)"""
_TEXT = (r"regexp_replace(regexp_replace(html, '(?s)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>', ' ', 'g'), "
         r"'<[^>]*>', ' ', 'g')")
for _from, _to in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&nbsp;", " "), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")):
    _TEXT = f"replace({_TEXT}, '{_from}', '{_to}')"
ORACLES["page_text"] = rf"SELECT page_id, md5(trim(regexp_replace({_TEXT}, '\s+', ' ', 'g'))) AS text_md5 FROM pages"

# --- JSON documents ---------------------------------------------------------------
_FIELD = "CASE condition WHEN 'R' THEN 'mint' WHEN 'A' THEN 'damaged' ELSE 'graded' END"
_NUMBERED = f"""{CARD_DAILY}, nb AS (SELECT *, count(*) OVER (PARTITION BY card_id, condition) AS n_points,
  row_number() OVER (PARTITION BY card_id, condition ORDER BY date) - 1 AS idx FROM dd)"""
_JSON_POINT = """'{"date":"' || date || '","price":' || price || ',"tradeCount":' || trade_count || '}'"""
ORACLES["json_blobs"] = f"""{CARD_DAILY}, cd AS (SELECT card_id, {_FIELD} AS field, string_agg({_JSON_POINT}, ',' ORDER BY date) AS pts
  FROM dd GROUP BY 1, 2), pv AS (SELECT card_id, max(pts) FILTER (WHERE field = 'mint') AS m,
  max(pts) FILTER (WHERE field = 'damaged') AS d, max(pts) FILTER (WHERE field = 'graded') AS g FROM cd GROUP BY 1)
SELECT card_id AS page, 'script' AS part, 0 AS blob_no, CAST(length('{{"props":{{"mint":[' || coalesce(m, '') || '],"damaged":[' ||
  coalesce(d, '') || '],"graded":[' || coalesce(g, '') || ']}}}}') AS INTEGER) AS chars FROM pv"""
ORACLES["json_series"] = f"""{_NUMBERED} SELECT card_id AS page, 'props.' || {_FIELD} AS path, n_points, idx,
  CAST(date AS VARCHAR) AS date, price, trade_count FROM nb WHERE n_points >= 2"""
ORACLES["json_series_known_path"] = f"""{_NUMBERED} SELECT card_id AS page, idx, CAST(date AS VARCHAR) AS date, price, trade_count
FROM nb WHERE condition = 'R'"""
ORACLES["json_values_broken"] = """SELECT page_id, 0 AS value_no, '[1, {"p": ' || page_id || '}]' AS json FROM pages"""
ORACLES["json_values"] = """SELECT event_id, 0 AS value_no, props AS json FROM events
UNION ALL SELECT event_id, 1, '[1]' FROM events"""
_WIDE = f"""{CARD_DAILY}, wd AS (SELECT card_id, date, max(price) FILTER (WHERE condition = 'R') AS price_01,
  max(price) FILTER (WHERE condition = 'A') AS price_02, max(price) FILTER (WHERE condition = 'N') AS price_03,
  CAST(sum(trade_count) AS BIGINT) AS volume FROM dd GROUP BY 1, 2)"""
ORACLES["chart_rows"] = f"""{_WIDE} SELECT card_id AS page, 'data' AS path,
  row_number() OVER (PARTITION BY card_id ORDER BY date) - 1 AS idx, CAST(date AS VARCHAR) AS date, price_01, price_02, price_03, volume FROM wd"""
ORACLES["chart_series"] = f"""{_WIDE}, lg AS (
  SELECT card_id AS page, '美品' AS condition, date, price_01 AS price, volume AS trade_count FROM wd
  UNION ALL SELECT card_id, 'キズあり', date, price_02, volume FROM wd UNION ALL SELECT card_id, 'PSA10', date, price_03, volume FROM wd)
SELECT page, condition, count(*) OVER (PARTITION BY page, condition) AS n_points, CAST(date AS VARCHAR) AS date, price, trade_count
FROM lg WHERE price IS NOT NULL"""
ORACLES["item_records"] = """SELECT 's' || p_partkey AS card_id, p_name || ' [' || p_brand || ' ' || lpad(CAST(p_size AS VARCHAR), 3, '0') || '/165]' AS card_name,
  lpad(CAST(p_size AS VARCHAR), 3, '0') || '/165' AS hinban, 'https://cards.example/s' || p_partkey || '/' AS url FROM part"""
ORACLES["index_records"] = f"""WITH {INDEX} SELECT index_type, CAST(date AS VARCHAR) AS date, value FROM ix
QUALIFY row_number() OVER (PARTITION BY index_type ORDER BY ix.date DESC) <= 20"""
_CONDITION = "CASE condition WHEN 'R' THEN '美品' WHEN 'A' THEN 'キズあり' ELSE 'psa10' END"
ORACLES["card_records"] = f"""{_NUMBERED}, kp AS (SELECT * FROM nb WHERE n_points >= 2 AND idx >= n_points - {V.DAILY_DAYS}),
{marked('card_id, condition', 'kp')}
SELECT CAST(date AS VARCHAR) AS date, card_id, p_name AS card_name, {CODE} AS hinban, {_CONDITION} AS condition, price, trade_count,
  CAST(imputed AS INTEGER) AS imputed FROM mk JOIN part ON CAST(p_partkey AS VARCHAR) = card_id"""

# --- matching -----------------------------------------------------------------------
_CARDS = f"""c AS (SELECT 'c' || p_partkey AS card_id, p_name AS card_name, {CODE} AS hinban, upper({CODE}) AS code,
  'https://cards.example/card/c' || p_partkey AS url, p_partkey AS seq FROM part)"""
_QUERIES = """q AS (SELECT DISTINCT query FROM (SELECT unnest([card_name, split_part(card_name, ' ', 1), split_part(card_name, ' ', 2),
  substr(card_name, 2, 3), lower(hinban), split_part(hinban, '/', 2), upper(card_id), url || '/']) AS query FROM c)),
qq AS (SELECT query, trim(query) AS q, lower(trim(query)) AS ql, replace(upper(query), ' ', '') AS qc,
  CASE WHEN contains(query, '://') THEN regexp_extract(rtrim(query, '/'), '([^/]*)$', 1) ELSE '' END AS slug FROM q)"""
_SCORED = """sc AS (SELECT query, CASE WHEN slug <> '' AND card_id = slug THEN 100 WHEN lower(card_id) = ql THEN 100
    WHEN code = qc THEN 90 WHEN card_name = ql THEN 80 WHEN starts_with(card_name, ql) THEN 60
    WHEN contains(card_name, ql) THEN 40 WHEN contains(code, qc) THEN 30 ELSE 0 END AS score, c.*
  FROM qq JOIN c ON (slug <> '' AND card_id = slug) OR lower(card_id) = ql OR contains(card_name, ql) OR contains(code, qc))"""
ORACLES["match_cards"] = f"WITH {_CARDS}, {_QUERIES}, {_SCORED} SELECT query, score, card_id, card_name, hinban, seq FROM sc WHERE score > 0"
ORACLES["top_matches"] = f"""WITH {_CARDS}, {_QUERIES}, {_SCORED} SELECT query,
  CAST(row_number() OVER (PARTITION BY query ORDER BY score DESC, card_name, seq) AS INTEGER) AS rank, score, card_id FROM sc WHERE score > 0
QUALIFY rank <= {V.REPORT_HITS}"""
_WATCH = f"""w AS (SELECT CASE WHEN p_size < 10 THEN '' ELSE {CODE} END AS code,
  CASE WHEN p_type = 'SMALL' THEN '' WHEN p_size = 20 THEN p_name || ' x' ELSE upper(p_name) END AS name,
  CASE WHEN p_size = 50 THEN 'c' || p_partkey ELSE '' END AS card_id,
  CASE WHEN p_size IN (49, 50) THEN 'https://hand.example/card/h' || p_partkey ELSE '' END AS url, p_partkey AS seq FROM part)"""
_CN = r"regexp_replace(lower({}), '[^0-9a-z]+', '', 'g')"
_OVERLAP = f"(contains({{a}}, {{b}}) OR contains({{b}}, {{a}}))"
ORACLES["resolve_watchlist"] = f"""WITH {_CARDS}, {_WATCH},
o AS (SELECT *, CASE WHEN code <> '' THEN code ELSE name END AS q FROM w WHERE card_id = ''),
d AS (SELECT DISTINCT q, code <> '' AND name <> '' AS two, {_CN.format('name')} AS cn FROM o WHERE q <> ''),
s AS (SELECT d.*, c.card_id, c.card_name, c.seq, c.url AS found_url, two AND {_OVERLAP.format(a='cn', b=_CN.format('card_name'))} AS both_ok,
    CASE WHEN lower(c.card_id) = lower(q) THEN 100 WHEN c.code = replace(upper(q), ' ', '') THEN 90
      WHEN card_name = lower(q) THEN 80 WHEN starts_with(card_name, lower(q)) THEN 60 WHEN contains(card_name, lower(q)) THEN 40
      WHEN contains(c.code, replace(upper(q), ' ', '')) THEN 30 ELSE 0 END AS score FROM d JOIN c
    ON lower(c.card_id) = lower(q) OR contains(card_name, lower(q)) OR contains(c.code, replace(upper(q), ' ', ''))),
k AS (SELECT *, bool_or(both_ok) OVER (PARTITION BY q, two, cn) AS any_both FROM s WHERE score > 0),
p AS (SELECT *, count(*) OVER (PARTITION BY q, two, cn) AS hits FROM k WHERE both_ok OR NOT any_both
  QUALIFY row_number() OVER (PARTITION BY q, two, cn ORDER BY score DESC, card_name, seq) = 1),
p2 AS (SELECT q, two, cn, any_value(hits) AS hits, any_value(card_id) AS cid, any_value(found_url) AS furl FROM p GROUP BY 1, 2, 3)
SELECT o.seq, o.code, o.name, coalesce(cid, '') AS card_id,
  CASE WHEN o.url <> '' THEN o.url ELSE coalesce(furl, '') END AS url,
  CASE WHEN hits IS NULL THEN '{V.MEMO_NOT_FOUND}' WHEN hits > 1 THEN '候補' || hits || '件から先頭を採用（要確認）' ELSE 'memo' END AS memo
FROM o LEFT JOIN p2 ON p2.q = o.q AND p2.two = (o.code <> '' AND o.name <> '') AND p2.cn = {_CN.format('o.name')}
UNION ALL SELECT seq, code, name, card_id, url, 'memo' FROM w WHERE card_id <> ''"""
ORACLES["names_overlap"] = f"""WITH {_CARDS}, {_WATCH}, a AS (SELECT DISTINCT {_CN.format('name')} AS a FROM w),
b AS (SELECT DISTINCT {_CN.format('card_name')} AS b FROM c)
SELECT a, b FROM a, b WHERE a <> '' AND b <> '' AND {_OVERLAP.format(a='a', b='b')}"""
ORACLES["plan_targets"] = f"""WITH {_CARDS}, {_WATCH}
SELECT card_id, card_name, hinban, url, 0 AS part, seq FROM c WHERE card_id IN (SELECT card_id FROM w WHERE card_id <> '')
UNION ALL SELECT 'h' || seq, name, code, url, 1, seq FROM w WHERE url <> '' AND card_id = ''"""
