"""DuckDB oracle SQL, one statement per query key.

Written independently of the Spark plans: the synthetic change feed is
re-derived here straight from the driver's tables as flat CTEs (no maps, no
JSON), then the reference's semantics are applied in plain SQL.
"""

from __future__ import annotations

T0 = 1704067200000


def ms(col: str) -> str:
    """Epoch millis of a naive timestamp, truncating micros (as Spark does)."""
    return f"(epoch_us({col}) // 1000)"


def dstr(ms_expr: str) -> str:
    return f"strftime(make_timestamp(({ms_expr}) * 1000), '%Y-%m-%d')"


def dtstr(ms_expr: str) -> str:
    return f"strftime(make_timestamp(({ms_expr}) * 1000), '%Y-%m-%d %H:%M:%S')"


def dec(col: str) -> str:
    return f"CAST({col} AS DECIMAL(16,2))"


def money(expr: str) -> str:
    return f"CAST(ROUND({expr}, 2) AS DECIMAL(16,2))"


def s(expr: str) -> str:
    return f"CAST({expr} AS VARCHAR)"


LSEQ = ("lpad(CAST(epoch_us(l_shipdate)//1000 AS VARCHAR), 15, '0') || '|' || lpad(CAST(l_partkey AS VARCHAR), 12, '0')"
        " || '|' || lpad(CAST(l_suppkey AS VARCHAR), 12, '0') || '|' || "
        "lpad(CAST(CAST(ROUND(l_extendedprice * 100) AS BIGINT) AS VARCHAR), 15, '0')")

CTE = {
    "order_info": f"""
  SELECT {s('o_orderkey')} AS id, {s('o_custkey')} AS user_id, {s('c_nationkey')} AS province_id,
         CASE o_orderstatus WHEN 'F' THEN '1003' WHEN 'O' THEN '1006' WHEN 'P' THEN '1001' END AS order_status,
         c_name AS consignee,
         {ms('o_orderdate')} + (o_orderkey % 24) * 3600000 AS create_ms,
         {s(ms('o_orderdate') + ' + (o_orderkey % 24) * 3600000')} AS create_time,
         {s(ms('o_orderdate') + ' + (o_orderkey % 24) * 3600000 + 1800000')} AS operate_time,
         {s(dec('o_totalprice'))} AS total_amount,
         {T0} + o_orderkey * 1000 AS ts_ms
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey""",
    "payment_info": f"""
  SELECT {s('o_orderkey')} AS order_id, {s('o_custkey')} AS user_id,
         '110' || {s('o_orderkey % 3 + 1')} AS payment_type,
         {s(ms('o_orderdate') + ' + (o_orderkey % 24) * 3600000 + 600000')} AS callback_time,
         CASE WHEN o_orderkey % 50 = 0 THEN NULL
              WHEN o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') THEN '1602' ELSE '1601' END AS payment_status,
         {T0} + o_orderkey * 1000 + 500 AS ts_ms
  FROM orders""",
    "order_detail": f"""
  SELECT l_orderkey || '-' || l_linenumber AS id, {s('l_orderkey')} AS order_id, {s('l_partkey')} AS sku_id,
         'sku ' || l_partkey AS sku_name, {ms('l_shipdate')} AS create_ms, {s(ms('l_shipdate'))} AS create_time,
         {s('CAST(l_quantity AS INTEGER)')} AS sku_num, {s(dec('l_extendedprice'))} AS order_price,
         {s(money(dec('l_extendedprice') + ' * (1 - ' + dec('l_discount') + ')'))} AS split_total_amount,
         {s(money(dec('l_extendedprice') + ' * ' + dec('l_discount')))} AS split_activity_amount,
         {s(money(dec('l_extendedprice') + ' * ' + dec('l_tax')))} AS split_coupon_amount,
         {T0} + l_orderkey * 1000 + l_linenumber * 10 AS ts_ms,
         {LSEQ} AS seq
  FROM lineitem""",
    "latest_line": f"""
  SELECT l_orderkey, l_linenumber, l_discount, l_tax, l_partkey, l_suppkey FROM (
    SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {LSEQ} DESC) AS rn FROM lineitem)
  WHERE rn = 1""",
    "order_refund_info": f"""
  SELECT l_orderkey || '-' || l_linenumber AS id, {s('l_suppkey')} AS user_id, {s('l_orderkey')} AS order_id,
         {s('l_partkey')} AS sku_id, CASE WHEN l_linestatus = 'F' THEN '1502' ELSE '1501' END AS refund_type,
         {s('CAST(l_quantity AS INTEGER)')} AS refund_num, {s(dec('l_extendedprice'))} AS refund_amount,
         '130' || {s('l_linenumber % 5 + 1')} AS refund_reason_type, 'reason ' || l_linenumber AS refund_reason_txt,
         {s(ms('l_shipdate') + ' + 86400000')} AS create_time,
         CASE WHEN l_suppkey % 2 = 0 THEN '0705' ELSE '0701' END AS refund_status,
         {T0} + l_orderkey * 1000 + l_linenumber * 10 + 5 AS ts_ms
  FROM lineitem WHERE l_returnflag = 'R'""",
    "refund_payment": f"""
  SELECT 'rp' || l_orderkey || '-' || l_linenumber AS id, {s('l_orderkey')} AS order_id, {s('l_partkey')} AS sku_id,
         '1102' AS payment_type, {s(ms('l_shipdate') + ' + 86400000 + 3600000')} AS callback_time,
         {s(dec('l_extendedprice'))} AS total_amount,
         CASE WHEN l_suppkey % 3 <> 0 THEN '1602' ELSE '1601' END AS refund_status,
         {T0} + l_orderkey * 1000 + l_linenumber * 10 + 7 AS ts_ms
  FROM lineitem WHERE l_returnflag = 'R'""",
    "cart_info": f"""
  SELECT {s('event_id')} AS id, {s('user_id')} AS user_id, {s("CAST(json_extract(props, '$.k') AS BIGINT)")} AS sku_id,
         CAST(json_extract(props, '$.k') AS BIGINT) AS k, {ms('ts')} AS ts_ms
  FROM events WHERE event_type = 'purchase'""",
    "comment_info": f"""
  SELECT conv_id || '-' || turn AS id, {s('conv_id')} AS user_id, {s('turn')} AS sku_id,
         {s('conv_id % 5 + 1201')} AS appraise, text AS comment_txt,
         {T0} + conv_id * 1000 + turn * 10 AS create_ms, {T0} + conv_id * 1000 + turn * 10 + 1 AS ts_ms
  FROM conversations""",
    "base_dic": """
  SELECT * FROM (VALUES ('1201', '好评'), ('1202', '中评'), ('1203', '差评'), ('1204', '自动')) AS t(dic_code, dic_name)""",
}


def with_ctes(*names: str, extra: dict[str, str] | None = None) -> str:
    parts = [f"{n} AS ({CTE[n]}\n)" for n in names]
    for k, v in (extra or {}).items():
        parts.append(f"{k} AS ({v}\n)")
    return "WITH " + ",\n".join(parts) + "\n"


DETAIL_SQL = with_ctes("order_info", "order_detail", "latest_line", extra={
    "act": "SELECT l_orderkey || '-' || l_linenumber AS order_detail_id, CAST(l_partkey % 4 + 1 AS VARCHAR) AS activity_id,"
           " CAST(l_suppkey % 6 + 1 AS VARCHAR) AS activity_rule_id FROM latest_line WHERE l_discount >= 0.05",
    "cou": "SELECT l_orderkey || '-' || l_linenumber AS order_detail_id, CAST(l_orderkey % 9 + 1 AS VARCHAR) AS coupon_id"
           " FROM latest_line WHERE l_tax >= 0.04",
    "dwd_detail": f"""
  SELECT od.id, od.order_id, oi.user_id, od.sku_id, od.sku_name, oi.province_id, act.activity_id,
         act.activity_rule_id, cou.coupon_id, {dstr('od.create_ms')} AS date_id, od.create_time, od.sku_num,
         CAST(CAST(od.sku_num AS DECIMAL(16,2)) * CAST(od.order_price AS DECIMAL(16,2)) AS VARCHAR) AS split_original_amount,
         od.split_activity_amount, od.split_coupon_amount, od.split_total_amount, od.ts_ms, od.seq
  FROM order_detail od JOIN order_info oi ON od.order_id = oi.id
  LEFT JOIN act ON od.id = act.order_detail_id
  LEFT JOIN cou ON od.id = cou.order_detail_id"""})

REFUND_ORDERS = "SELECT id, user_id, province_id FROM order_info WHERE order_status = '1006'"

ORACLE: dict[str, str] = {
    "dwd_order_detail": DETAIL_SQL + "SELECT * EXCLUDE (seq) FROM dwd_detail",
    "dwd_order_cancel": DETAIL_SQL.replace("WITH ", "WITH ", 1) + """
SELECT d.id, d.order_id, d.user_id, d.sku_id, d.sku_name, d.province_id, d.activity_id, d.activity_rule_id,
       d.coupon_id, d.date_id, oc.operate_time AS cancel_time, d.sku_num, d.split_original_amount,
       d.split_activity_amount, d.split_coupon_amount, d.split_total_amount, oc.ts_ms
FROM dwd_detail d JOIN (SELECT * FROM order_info WHERE order_status IN ('1001', '1003')) oc ON d.order_id = oc.id""",
    "dwd_pay_success": DETAIL_SQL + ", pi AS (SELECT * FROM (" + CTE["payment_info"] + """) WHERE payment_status = '1602')
SELECT d.id AS order_detail_id, d.order_id, d.user_id, d.sku_id, d.sku_name, d.province_id, d.activity_id,
       d.activity_rule_id, d.coupon_id, pi.payment_type AS payment_type_code, pi.callback_time, d.sku_num,
       d.split_original_amount, d.split_activity_amount, d.split_coupon_amount,
       d.split_total_amount AS split_payment_amount, pi.ts_ms
FROM pi JOIN dwd_detail d ON pi.order_id = d.order_id""",
    "dwd_order_refund": with_ctes("order_info", "order_refund_info") + f"""
SELECT ri.id, ri.user_id, ri.order_id, ri.sku_id, oi.province_id, {dstr('CAST(ri.create_time AS BIGINT)')} AS date_id,
       ri.create_time, ri.refund_type AS refund_type_code, ri.refund_reason_type AS refund_reason_type_code,
       ri.refund_reason_txt, ri.refund_num, ri.refund_amount, ri.ts_ms
FROM order_refund_info ri JOIN ({REFUND_ORDERS}) oi ON ri.order_id = oi.id""",
    "dwd_refund_pay_success": with_ctes("order_info", "order_refund_info", "refund_payment") + f"""
SELECT rp.id, oi.user_id, rp.order_id, rp.sku_id, oi.province_id, rp.payment_type AS payment_type_code,
       {dstr('CAST(rp.callback_time AS BIGINT)')} AS date_id, rp.callback_time, ori.refund_num,
       rp.total_amount AS refund_amount, rp.ts_ms
FROM (SELECT * FROM refund_payment WHERE refund_status = '1602') rp
JOIN (SELECT * FROM order_refund_info WHERE refund_status = '0705') ori
  ON rp.order_id = ori.order_id AND rp.sku_id = ori.sku_id
JOIN ({REFUND_ORDERS}) oi ON rp.order_id = oi.id""",
    "dwd_cart_add": with_ctes("cart_info") + """
SELECT id, user_id, sku_id, CAST(k % 5 + 1 AS VARCHAR) AS sku_num, ts_ms FROM cart_info""",
    "dwd_cart_add_delta": with_ctes("cart_info") + """
SELECT id, user_id, sku_id, CAST(k % 5 + 1 AS VARCHAR) AS sku_num, ts_ms FROM cart_info
UNION ALL
SELECT id, user_id, sku_id, '2' AS sku_num, ts_ms + 1000 FROM cart_info WHERE k % 7 = 0""",
    "dwd_comment_info": with_ctes("comment_info", "base_dic") + """
SELECT c.id, c.user_id, c.sku_id, c.appraise, d.dic_name AS appraise_name, c.comment_txt, c.ts_ms
FROM comment_info c JOIN base_dic d ON c.appraise = d.dic_code""",
}


def win(ws: str, width_ms: int) -> str:
    return f"{dtstr(ws)} AS stt, {dtstr(ws + ' + ' + str(width_ms))} AS edt, {dstr(ws)} AS cur_date"


CTE["cart_add"] = """
  SELECT id, user_id, sku_id, CAST(k % 5 + 1 AS VARCHAR) AS sku_num, ts_ms FROM cart_info"""

CTE["parts"] = """
  SELECT p_partkey, p_name, p_brand, p_type, p_size,
         p_type || '/' || CAST(p_size % 4 AS VARCHAR) AS c3id,
         lower(p_type) || ' ' || CAST(p_size % 4 AS VARCHAR) AS c3name,
         CASE p_brand WHEN 'Brand#1' THEN 'TCL' WHEN 'Brand#2' THEN '苹果' WHEN 'Brand#3' THEN '联想'
                      WHEN 'Brand#4' THEN '小米' WHEN 'Brand#5' THEN '欧莱雅' WHEN 'Brand#6' THEN '香奈儿'
                      ELSE p_brand END AS tname
  FROM part"""

CTE["c1"] = """
  SELECT * FROM (VALUES ('ECONOMY', '手机'), ('STANDARD', '数码'), ('PROMO', '家居家装'), ('LARGE', '家用电器'),
                        ('MEDIUM', '母婴'), ('SMALL', '运动户外')) AS t(id, name)"""

CTE["tree"] = """
  SELECT DISTINCT p.c3id AS id, p.c3name AS b3name, lower(p.p_type) AS b2name, c1.name AS b1name, p.p_type AS c2id
  FROM parts p JOIN c1 ON p.p_type = c1.id"""

CTE["logs_raw"] = f"""
  SELECT e.event_id AS "offset", e.event_type, e.user_id, CAST(json_extract(e.props, '$.k') AS BIGINT) AS k,
         e.value, {ms('e.ts')} AS ts, lower(p.p_type) || ' ' || CAST(p.p_size % 4 AS VARCHAR) AS search_word
  FROM events e LEFT JOIN part p ON p.p_partkey = CAST(json_extract(e.props, '$.k') AS BIGINT)
  WHERE e.event_id % 97 <> 0"""

CTE["logs0"] = f"""
  SELECT "offset", CAST(user_id AS VARCHAR) AS mid,
         CASE WHEN k % 11 = 0 THEN NULL ELSE CAST(user_id AS VARCHAR) END AS uid,
         'v' || CAST(k % 3 AS VARCHAR) AS vc, ['appstore', 'web', 'oppo'][k % 3 + 1] AS ch,
         CAST(user_id % 7 AS VARCHAR) AS ar, CASE WHEN "offset" % 2 = 0 THEN '1' ELSE '0' END AS is_new_raw,
         ['iOS 17', 'Android 14', 'Other 1'][user_id % 3 + 1] AS os, 'model-' || CAST(user_id % 4 AS VARCHAR) AS md,
         ['Apple', 'Xiaomi', 'Huawei', 'Other'][user_id % 4 + 1] AS ba, 's' || CAST("offset" // 10 AS VARCHAR) AS sid,
         k % 13 = 0 AS is_start,
         CASE WHEN k % 13 = 0 THEN NULL ELSE CASE event_type WHEN 'click' THEN 'home' WHEN 'view' THEN 'good_detail'
              WHEN 'purchase' THEN 'payment' WHEN 'signup' THEN 'login' WHEN 'error' THEN 'mine' END END AS page_id,
         CASE WHEN k % 13 = 0 THEN NULL WHEN k % 5 = 0 THEN NULL WHEN k % 5 = 1 THEN 'search'
              WHEN k % 5 = 2 THEN 'login' ELSE 'home' END AS last_page_id,
         CASE WHEN k % 13 = 0 THEN NULL WHEN k % 5 = 1 THEN search_word ELSE CAST(k AS VARCHAR) END AS item,
         CASE WHEN k % 13 = 0 THEN NULL WHEN k % 5 = 1 THEN 'keyword' ELSE 'sku_id' END AS item_type,
         CASE WHEN k % 13 = 0 THEN NULL ELSE CAST(ROUND(value * 1000) AS BIGINT) END AS during_time,
         ts, k, event_type = 'error' AS has_err,
         {dstr('ts')} AS day, {dstr('ts - 86400000')} AS prev_day
  FROM logs_raw"""

CTE["logs"] = """
  SELECT *, CASE WHEN is_new_raw = '1' AND mid_rn > 1 AND d0 <> day THEN '0' ELSE is_new_raw END AS is_new FROM (
    SELECT *, row_number() OVER (PARTITION BY mid ORDER BY ts, "offset") AS mid_rn,
           first_value(CASE WHEN is_new_raw = '1' THEN day ELSE prev_day END)
             OVER (PARTITION BY mid ORDER BY ts, "offset") AS d0
    FROM logs0)"""

CTE["pages"] = "SELECT * FROM logs WHERE NOT is_start"

LOGS = ("logs_raw", "logs0", "logs", "pages")
HOUR = 3600000

ORACLE.update({
    "dedup_latest": with_ctes("order_detail") + """
SELECT id, order_id, sku_id, split_total_amount, ts_ms FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY CAST(ts_ms AS VARCHAR) DESC, seq DESC) AS rn FROM order_detail)
WHERE rn = 1""",
    "dedup_strictly_newer": with_ctes("order_detail") + """
SELECT id, sku_id, create_ms AS create_time, seq FROM (
  SELECT *, max(create_ms) OVER (PARTITION BY id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pm
  FROM order_detail)
WHERE pm IS NULL OR create_ms > pm""",
    "dedup_composite": with_ctes("order_detail") + """
SELECT order_id, ts_ms, id, sku_id, seq FROM (
  SELECT *, row_number() OVER (PARTITION BY order_id, ts_ms ORDER BY seq) AS rn FROM order_detail) WHERE rn = 1""",
    "dedup_first_of_day": with_ctes("cart_info", "cart_add") + f"""
SELECT id, user_id, sku_id, sku_num, ts_ms, day FROM (
  SELECT *, {dstr('ts_ms')} AS day, row_number() OVER (PARTITION BY user_id, {dstr('ts_ms')} ORDER BY ts_ms, id) AS rn
  FROM cart_add) WHERE rn = 1""",
    "order_retraction": DETAIL_SQL + """, d AS (SELECT id, order_id, split_total_amount, ts_ms, seq FROM dwd_detail)
SELECT id, order_id, split_total_amount, ts_ms, seq, false AS is_retraction FROM d
UNION ALL
SELECT d.id, d.order_id, CAST(-CAST(d.split_total_amount AS DECIMAL(38,2)) AS VARCHAR), d.ts_ms, d.seq, true
FROM d JOIN (SELECT id, max(seq) AS ls FROM d GROUP BY id) l ON d.id = l.id WHERE d.seq < l.ls""",
    "upsert_latest": DETAIL_SQL + """
SELECT * EXCLUDE (seq, rn) FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY seq DESC) AS rn FROM dwd_detail)
WHERE rn = 1""",
    "dim_category_tree": with_ctes("parts", "c1", "tree") + "SELECT id, b3name, b2name, b1name FROM tree",
    "dim_sku_wide": with_ctes("parts") + """
SELECT CAST(p_partkey AS VARCHAR) AS skuid, p_name AS spuid, c3id, tname FROM parts""",
    "dim_category_cascade": with_ctes("parts", "c1") + """
SELECT CAST(p_partkey AS VARCHAR) AS id, c3id AS category3_id, c3name AS category3_name, p_type AS category2_id,
       lower(p_type) AS category2_name, p_type AS category1_id, c1.name AS category1_name
FROM parts LEFT JOIN c1 ON p_type = c1.id""",
    "dws_province_order": DETAIL_SQL + f""", r AS (
  SELECT id, order_id, province_id, split_total_amount, ts_ms FROM dwd_detail
  UNION ALL
  SELECT d.id, d.order_id, d.province_id, CAST(-CAST(d.split_total_amount AS DECIMAL(38,2)) AS VARCHAR), d.ts_ms
  FROM dwd_detail d JOIN (SELECT id, max(seq) AS ls FROM dwd_detail GROUP BY id) l ON d.id = l.id WHERE d.seq < l.ls),
agg AS (
  SELECT ts_ms - ts_ms % 10000 AS ws, province_id, count(DISTINCT order_id) AS order_count,
         CAST(sum(COALESCE(CAST(split_total_amount AS DECIMAL(16,2)), 0)) AS DECIMAL(20,2)) AS order_amount
  FROM r GROUP BY ALL)
SELECT {win('ws', 10000)}, province_id, n.n_name AS province_name, order_count, order_amount
FROM agg LEFT JOIN nation n ON agg.province_id = CAST(n.n_nationkey AS VARCHAR)""",
    "dws_sku_order": DETAIL_SQL + ", " + ",\n".join(f"{n} AS ({CTE[n]}\n)" for n in ("parts", "c1")) + f""", latest AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY CAST(ts_ms AS VARCHAR) DESC, seq DESC) AS rn
                 FROM dwd_detail) WHERE rn = 1),
agg AS (
  SELECT ts_ms - ts_ms % 10000 AS ws, sku_id,
         CAST(sum(COALESCE(CAST(split_original_amount AS DECIMAL(18,4)), 0)) AS DECIMAL(22,4)) AS original_amount,
         CAST(sum(COALESCE(CAST(split_activity_amount AS DECIMAL(18,4)), 0)) AS DECIMAL(22,4)) AS activity_reduce_amount,
         CAST(sum(COALESCE(CAST(split_coupon_amount AS DECIMAL(18,4)), 0)) AS DECIMAL(22,4)) AS coupon_reduce_amount,
         CAST(sum(COALESCE(CAST(split_total_amount AS DECIMAL(18,4)), 0)) AS DECIMAL(22,4)) AS order_amount
  FROM latest GROUP BY ALL)
SELECT {win('ws', 10000)}, p.p_brand AS trademark_id, p.tname AS trademark_name, p.p_type AS category1_id,
       c1.name AS category1_name, p.p_type AS category2_id, lower(p.p_type) AS category2_name,
       p.c3id AS category3_id, p.c3name AS category3_name, agg.sku_id, p.p_name AS sku_name, p.p_name AS spu_id,
       p.p_name AS spu_name, original_amount, activity_reduce_amount, coupon_reduce_amount, order_amount
FROM agg LEFT JOIN parts p ON agg.sku_id = CAST(p.p_partkey AS VARCHAR) LEFT JOIN c1 ON p.p_type = c1.id""",
    "dws_cart_uu": with_ctes("cart_info", "cart_add") + f""", firsts AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id, {dstr('ts_ms')} ORDER BY ts_ms, id) AS rn
                 FROM cart_add) WHERE rn = 1)
SELECT {win('ts_ms - ts_ms % 3600000', HOUR)}, count(*) AS cart_add_uu_ct FROM firsts GROUP BY ALL""",
    "log_dirty_split": """SELECT event_id AS "offset" FROM events WHERE event_id % 97 = 0""",
    "log_fix_is_new": with_ctes(*LOGS) + """SELECT "offset", mid, ts, is_new FROM logs""",
    "log_split_page": with_ctes(*LOGS) + """
SELECT "offset", mid, uid, vc, ch, ar, is_new, os, md, ba, sid, page_id, last_page_id, item, item_type, during_time, ts
FROM pages""",
    "log_split_start": with_ctes(*LOGS) + """
SELECT "offset", mid, is_new, 'icon' AS entry, k * 10 AS loading_time, k AS open_ad_id, ts,
       CAST(k % 4 AS INTEGER) AS n_displays
FROM logs WHERE is_start""",
    "log_split_err": with_ctes(*LOGS) + """
SELECT "offset", mid, page_id, is_start AS has_start, k + 1000 AS error_code, 'err ' || CAST(k AS VARCHAR) AS msg, ts
FROM logs WHERE has_err""",
    "log_split_err_only": with_ctes(*LOGS) + """
SELECT "offset", k + 1000 AS error_code, 'err ' || CAST(k AS VARCHAR) AS msg, ts FROM logs WHERE has_err""",
    "log_split_display": with_ctes(*LOGS) + """
SELECT "offset", mid, page_id, CAST(k + i AS VARCHAR) AS display_item, CAST(i AS INTEGER) AS pos_id,
       CAST(i AS INTEGER) AS display_order, ts
FROM (SELECT *, unnest(range(k % 4)) AS i FROM pages)""",
    "log_split_action": with_ctes(*LOGS) + """
SELECT "offset", mid, page_id, CASE WHEN i = 0 THEN 'cart_add' ELSE 'favor_add' END AS action_id,
       CAST(k + i AS VARCHAR) AS action_item, ts + i * 100 AS action_ts
FROM (SELECT *, unnest(range(k % 3)) AS i FROM pages)""",
    "dws_home_detail_uv": with_ctes(*LOGS) + f""", firsts AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY mid, page_id, day ORDER BY ts, "offset") AS rn
                 FROM pages WHERE page_id IN ('home', 'good_detail')) WHERE rn = 1)
SELECT {win('ts - ts % 3600000', HOUR)}, CAST(sum(CASE WHEN page_id = 'home' THEN 1 ELSE 0 END) AS BIGINT) AS home_uv_ct,
       CAST(sum(CASE WHEN page_id = 'good_detail' THEN 1 ELSE 0 END) AS BIGINT) AS good_detail_uv_ct
FROM firsts GROUP BY ALL""",
    "dws_traffic_dims": with_ctes(*LOGS) + f""", firsts AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY mid, day ORDER BY ts, "offset") AS rn FROM pages)
  WHERE rn = 1),
u AS (
  SELECT vc, ch, ar, is_new, ts, 0 AS uv, CASE WHEN coalesce(last_page_id, '') = '' THEN 1 ELSE 0 END AS sv, 1 AS pv,
         coalesce(during_time, 0) AS dur FROM pages
  UNION ALL
  SELECT vc, ch, ar, is_new, ts, 1, 0, 0, 0 FROM firsts)
SELECT {win('ts - ts % 3600000', HOUR)}, vc, ch, ar, is_new, CAST(sum(uv) AS BIGINT) AS uv_ct,
       CAST(sum(sv) AS BIGINT) AS sv_ct, CAST(sum(pv) AS BIGINT) AS pv_ct, CAST(sum(dur) AS BIGINT) AS dur_sum
FROM u GROUP BY ALL""",
    "dws_user_login": with_ctes(*LOGS) + f""", days AS (
  SELECT uid, day, min(ts) AS ts FROM pages
  WHERE coalesce(uid, '') <> '' AND (last_page_id = 'login' OR coalesce(last_page_id, '') = '')
  GROUP BY uid, day),
f AS (
  SELECT ts, CASE WHEN prev IS NOT NULL AND (ts - epoch_us(CAST(prev AS TIMESTAMP)) // 1000) // 86400000 >= 8
                  THEN 1 ELSE 0 END AS back
  FROM (SELECT *, lag(day) OVER (PARTITION BY uid ORDER BY day) AS prev FROM days))
SELECT {win('ts - ts % 3600000', HOUR)}, CAST(sum(back) AS BIGINT) AS back_ct, count(*) AS uu_ct FROM f GROUP BY ALL""",
})

ORACLE["rollup_province_amount"] = (
    "WITH pr AS (" + ORACLE["dws_province_order"] + ")\n"
    "SELECT province_name, CAST(sum(order_amount) AS DECIMAL(20,2)) AS order_amount FROM pr GROUP BY province_name")
ORACLE["rollup_uv_by_channel"] = (
    "WITH tr AS (" + ORACLE["dws_traffic_dims"] + ")\nSELECT ch, CAST(sum(uv_ct) AS BIGINT) AS uv_ct FROM tr GROUP BY ch")

CTE["mixed"] = f"""
  SELECT s_suppkey, s_name, s_nationkey, ['d', 'c', 'u', 'r', 'x'][s_suppkey % 5 + 1] AS op,
         CASE WHEN s_suppkey % 3 = 0 THEN 'other_db' ELSE 'shop' END AS db, {T0} + s_suppkey * 1000 AS ts_ms
  FROM supplier"""

CTE["oms"] = f"""
  SELECT o_orderkey AS id, {ms('o_orderdate')} + (o_orderkey % 24) * 3600000 AS ms FROM orders"""

CTE["bday"] = """
  SELECT c_custkey AS id, CAST(DATE '1970-01-01' + CAST((c_custkey * 13) % 16000 AS INTEGER) AS DATE) AS b FROM customer"""

SLOT_SQL = """CASE WHEN h < 6 THEN '凌晨' WHEN h < 9 THEN '早晨' WHEN h < 12 THEN '上午' WHEN h < 14 THEN '中午'
                   WHEN h < 18 THEN '下午' WHEN h < 22 THEN '晚上' ELSE '夜间' END"""


def zodiac_sql(md: str, english: bool = False) -> str:
    names = (["Capricorn", "Aquarius", "Pisces", "Aries", "Taurus", "Gemini", "Cancer", "Leo", "Virgo", "Libra",
              "Scorpio", "Sagittarius"] if english else
             ["摩羯座", "水瓶座", "双鱼座", "白羊座", "金牛座", "双子座", "巨蟹座", "狮子座", "处女座", "天秤座", "天蝎座",
              "射手座"])
    bounds = [120, 219, 321, 420, 521, 622, 723, 823, 923, 1024, 1123, 1222]
    parts = [f"WHEN {md} < {bounds[0]} THEN '{names[0]}'"]
    for i in range(1, 12):
        parts.append(f"WHEN {md} < {bounds[i]} THEN '{names[i]}'")
    return "CASE " + " ".join(parts) + f" ELSE '{names[0]}' END"


ORACLE.update({
    "cdc_gate": with_ctes("mixed") + """
SELECT CAST(s_suppkey AS VARCHAR) AS id, op FROM mixed WHERE db = 'shop' AND op IN ('c', 'u', 'r')""",
    "cdc_gate_deletes": with_ctes("mixed") + """
SELECT CAST(s_suppkey AS VARCHAR) AS id, op FROM mixed WHERE db = 'shop' AND op IN ('c', 'u', 'd', 'r')""",
    "cdc_demux": with_ctes("payment_info") + """
SELECT order_id AS id, order_id, payment_status, ts_ms FROM payment_info""",
    "cdc_image": with_ctes("mixed") + """
SELECT CAST(s_suppkey AS VARCHAR) AS id, s_name AS name_by_op, op, s_name AS name_nonempty, ts_ms FROM mixed""",
    "fn_datetime": with_ctes("oms") + f"""
SELECT id, ms, {dstr('ms')} AS date_id, {dtstr('ms')} AS dt, strftime(make_timestamp(ms * 1000), '%Y%m%d') AS ds,
       {dstr('ms')} AS date_from_str, ms AS dt_ms, ms - ms % 86400000 AS d_ms,
       {dtstr('ms + 28800000')} AS dt_shanghai
FROM oms""",
    "fn_birthday": with_ctes("bday") + f"""
SELECT id, strftime(b, '%Y-%m-%d') AS birthday, CAST(year(b) // 10 * 10 AS INTEGER) AS decade,
       CAST(2025 - year(b) - CASE WHEN 512 < month(b) * 100 + day(b) THEN 1 ELSE 0 END AS INTEGER) AS age,
       {zodiac_sql('(month(b) * 100 + day(b))')} AS zodiac_sign,
       {zodiac_sql('(month(b) * 100 + day(b))', True)} AS zodiac_en
FROM bday""",
    "fn_time_slot": with_ctes("oms") + f"""
SELECT id, h AS hour, {SLOT_SQL} AS pay_time_slot FROM (SELECT id, hour(make_timestamp(ms * 1000)) AS h FROM oms)""",
    "fn_string": r"""
SELECT conv_id AS id, turn, list_extract(string_split(rtrim(text, ','), ','), -1) AS last_tok,
       string_split(text, ' ')[1] AS first_word, md5(CAST(conv_id AS VARCHAR)) AS row_key,
       CAST(conv_id AS VARCHAR) || '_' || CAST(turn AS VARCHAR) AS order_ts,
       CAST(-CAST(CAST(turn AS VARCHAR) AS DECIMAL(38,2)) AS VARCHAR) AS neg_turn,
       coalesce(regexp_replace(text, '\S', '', 'g'), '') = '' AS no_space
FROM conversations""",
})
ORACLE["fn_to_json"] = (
    "WITH uu AS (" + ORACLE["dws_cart_uu"] + ")\n"
    "SELECT CAST(json_object('stt', stt, 'edt', edt, 'cur_date', cur_date, 'cart_add_uu_ct', cart_add_uu_ct) AS VARCHAR)"
    " AS json FROM uu")

# ------------------------------------------------------------------ user labels
from .functions import weights as _w  # noqa: E402  (fixed weight constants only)

BANDS = ["18_24", "25_29", "30_34", "35_39", "40_49", "50"]
COEF = {"device": "0.1", "search": "0.15", "pay_time": "0.1", "amount": "0.15", "tname": "0.2", "b1name": "0.3"}


def wvalues(rows: dict, default=None) -> str:
    items = list(rows.items()) + ([("__default__", default)] if default is not None else [])
    vals = ", ".join("('" + k + "', " + ", ".join(f"'{x}'" for x in ws) + ")" for k, ws in items)
    return f"SELECT * FROM (VALUES {vals}) AS t(key, w0, w1, w2, w3, w4, w5)"


def wcols(alias: str, fam: str) -> str:
    return ", ".join(f"CAST(ROUND(CAST({alias}.w{i} AS DECIMAL(3,1)) * CAST('{COEF[fam]}' AS DECIMAL(3,2)), 3) "
                     f"AS DECIMAL(10,3)) AS {fam}_{b}" for i, b in enumerate(BANDS))


def fam_cols(fam: str) -> str:
    return ", ".join(f"{fam}_{b}" for b in BANDS)


CTE.update({
    "w_device": wvalues(_w.DEVICE),
    "w_search": wvalues(_w.SEARCH, _w.SEARCH_DEFAULT),
    "w_pay_time": wvalues(_w.PAY_TIME),
    "w_amount": wvalues(_w.AMOUNT),
    "w_tname": wvalues(_w.BRAND, _w.BRAND_DEFAULT),
    "w_b1name": wvalues({**{k: _w.CATEGORY_A for k in _w.CATEGORY_GROUP_A},
                         **{k: _w.CATEGORY_B for k in _w.CATEGORY_GROUP_B}}, _w.CATEGORY_DEFAULT),
    "compare": """
  SELECT * FROM (VALUES ('1', '手机', '科技与数码'), ('2', '数码', '时尚与潮流'), ('3', '家居家装', '家庭与育儿'),
                        ('4', '家用电器', '性价比'), ('5', '母婴', '健康与养生'), ('6', '图书', '学习与发展'))
    AS t(id, category_name, search_category)""",
    "users": f"""
  SELECT CAST(c_custkey AS VARCHAR) AS uid, ' ' || lower(c_name) || ' ' AS uname,
         CAST(c_custkey % 3 + 1 AS VARCHAR) AS user_level, 'user' || CAST(c_custkey AS VARCHAR) AS login_name,
         '138' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS phone_num,
         'user' || CAST(c_custkey AS VARCHAR) || '@example.com' AS email,
         CASE WHEN c_custkey % 3 = 0 THEN 'home' WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
         strftime(b, '%Y-%m-%d') AS birthday, CAST(year(b) // 10 * 10 AS INTEGER) AS decade,
         CAST(2025 - year(b) - CASE WHEN 512 < month(b) * 100 + day(b) THEN 1 ELSE 0 END AS INTEGER) AS age,
         {zodiac_sql('(month(b) * 100 + day(b))')} AS zodiac_sign, {T0} + c_custkey * 1000 AS ts_ms
  FROM (SELECT *, CAST(DATE '1970-01-01' + CAST((c_custkey * 13) % 16000 AS INTEGER) AS DATE) AS b FROM customer)""",
    "sup": f"""
  SELECT CAST(c_custkey AS VARCHAR) AS sup_uid, CAST(c_custkey % 180 + 90 AS VARCHAR) AS height,
         CASE WHEN c_custkey % 2 = 0 THEN 'cm' ELSE 'in' END AS unit_height,
         CAST(c_custkey % 190 + 25 AS VARCHAR) AS weight,
         CASE WHEN c_custkey % 3 = 0 THEN 'lb' ELSE 'kg' END AS unit_weight,
         {T0} + c_custkey * 1000 + 60000 AS sup_ts_ms
  FROM customer""",
    "lorders": f"""
  SELECT ts_ms, id, user_id AS uid, consignee, create_ms AS create_time, total_amount AS original_total_amount,
         total_amount, CAST(province_id AS BIGINT) AS province_id,
         CASE WHEN h < 6 THEN '凌晨' WHEN h < 9 THEN '早晨' WHEN h < 12 THEN '上午' WHEN h < 14 THEN '中午'
              WHEN h < 18 THEN '下午' WHEN h < 22 THEN '晚上' ELSE '夜间' END AS pay_time_slot
  FROM (SELECT *, hour(make_timestamp(create_ms * 1000)) AS h FROM order_info)""",
    "lod": """
  SELECT o.id, o.uid, o.consignee, o.create_time, o.original_total_amount, o.total_amount, o.province_id,
         o.pay_time_slot, o.ts_ms, d.id AS detail_id, d.order_id, d.sku_id, d.sku_name,
         CAST(d.sku_num AS BIGINT) AS sku_num, d.order_price, d.split_activity_amount, d.split_coupon_amount,
         d.split_total_amount, d.seq
  FROM lorders o JOIN order_detail d ON o.id = d.order_id AND d.ts_ms BETWEEN o.ts_ms - 120000 AND o.ts_ms + 120000""",
    "base4": f"""
  SELECT j.* EXCLUDE (seq, rn), p.c3id, p.tname, t.b1name AS b1_name, {wcols('wp', 'pay_time')},
         {wcols('wa', 'amount')}, {wcols('wt', 'tname')}, {wcols('wb', 'b1name')}
  FROM (SELECT *, row_number() OVER (PARTITION BY detail_id ORDER BY seq) AS rn FROM lod) j
  LEFT JOIN parts p ON j.sku_id = CAST(p.p_partkey AS VARCHAR)
  LEFT JOIN (SELECT DISTINCT id, b1name FROM tree) t ON p.c3id = t.id
  LEFT JOIN w_pay_time wp ON wp.key = j.pay_time_slot
  LEFT JOIN w_amount wa ON wa.key = CASE WHEN CAST(j.total_amount AS DOUBLE) < 1000 THEN 'low'
       WHEN CAST(j.total_amount AS DOUBLE) > 1000 AND CAST(j.total_amount AS DOUBLE) < 4000 THEN 'mid' ELSE 'high' END
  LEFT JOIN w_tname wt ON wt.key = CASE WHEN coalesce(p.tname, '') = '' THEN NULL
       WHEN p.tname IN (SELECT key FROM w_tname) THEN p.tname ELSE '__default__' END
  LEFT JOIN w_b1name wb ON wb.key = CASE WHEN coalesce(t.b1name, '') = '' THEN NULL
       WHEN t.b1name IN (SELECT key FROM w_b1name) THEN t.b1name ELSE '__default__' END
  WHERE j.rn = 1""",
    "dev": """
  SELECT coalesce(uid, '-1') AS uid, ts, ar, ba, ch, md, split_part(os, ' ', 1) AS os, uid AS dev_uid, vc,
         CASE WHEN item_type = 'keyword' THEN item END AS search_item, "offset"
  FROM pages""",
    "prof": """
  SELECT uid, ts, count(*) OVER w AS pv,
         array_to_string(list_sort(list_distinct(list(os) OVER w)), ',') AS os,
         array_to_string(list_sort(list_distinct(list(ch) OVER w)), ',') AS ch,
         array_to_string(list_sort(list_distinct(list(md) OVER w)), ',') AS md,
         array_to_string(list_sort(list_distinct(list(ba) OVER w)), ',') AS ba,
         array_to_string(list_sort(list_distinct(list(search_item) OVER w)), ',') AS search_item
  FROM (SELECT uid, ts, ar, ba, ch, md, os, dev_uid, vc, search_item, min("offset") AS first_offset
        FROM dev GROUP BY ALL)
  WINDOW w AS (PARTITION BY uid ORDER BY ts, first_offset ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
    "prof2": """
  SELECT uid, ws AS wstart, ts AS ts_ms, pv, os, ch, md, ba, search_item FROM (
    SELECT *, ts - ts % 120000 AS ws, row_number() OVER (PARTITION BY uid, ts - ts % 120000 ORDER BY ts DESC) AS rn
    FROM prof) WHERE rn = 1""",
    "base2": f"""
  SELECT p.uid, p.ts_ms, p.pv, p.os, p.ch, p.md, p.ba, p.search_item, split_part(p.os, ',', 1) AS judge_os,
         t.b1name AS b1_category, coalesce(c.search_category, 'unknown') AS search_category,
         {wcols('wd', 'device')}, {wcols('ws', 'search')}
  FROM prof2 p
  LEFT JOIN (SELECT DISTINCT b3name, b1name FROM tree) t ON p.search_item = t.b3name AND p.search_item <> ''
  LEFT JOIN (SELECT category_name, arg_min(search_category, id) AS search_category FROM compare GROUP BY 1) c
    ON c.category_name = t.b1name
  LEFT JOIN w_device wd ON wd.key = split_part(p.os, ',', 1)
  LEFT JOIN w_search ws ON ws.key = CASE WHEN coalesce(c.search_category, 'unknown') IN (SELECT key FROM w_search)
       THEN coalesce(c.search_category, 'unknown') ELSE '__default__' END""",
})

LABEL4 = ("order_info", "order_detail", "parts", "c1", "tree", "w_pay_time", "w_amount", "w_tname", "w_b1name",
          "lorders", "lod", "base4")
LABEL2 = LOGS + ("parts", "c1", "tree", "compare", "w_device", "w_search", "dev", "prof", "prof2", "base2")
B4_SCORES = ", ".join(fam_cols(f) for f in ("pay_time", "amount", "tname", "b1name"))

CTE["b24"] = f"""
  SELECT b2.* EXCLUDE (ts_ms), b2.ts_ms AS base2_ts_ms, b4.id, b4.detail_id, b4.ts_ms AS base4_ts_ms,
         b4.pay_time_slot, b4.total_amount, b4.tname, b4.b1_name, {B4_SCORES}, b4.ts_ms AS ts_ms
  FROM base2 b2 JOIN base4 b4 ON b2.uid = b4.uid AND b4.ts_ms BETWEEN b2.ts_ms - 86400000 AND b2.ts_ms + 86400000"""

CTE["base6"] = """
  SELECT u.uid, u.uname, u.user_level, u.login_name, u.phone_num, u.email, u.gender, u.birthday, u.decade, u.age,
         u.zodiac_sign, s.height, s.unit_height, s.weight, s.unit_weight, u.ts_ms
  FROM users u JOIN sup s ON u.uid = s.sup_uid AND s.sup_ts_ms BETWEEN u.ts_ms - 300000 AND u.ts_ms + 300000"""


def _total(b: str) -> str:
    return " + ".join(f"coalesce({f}_{b}, 0)" for f in ("device", "search", "pay_time", "amount", "tname", "b1name"))


ORACLE.update({
    "label_user_flatten": with_ctes("users") + "SELECT * FROM users",
    "label_name_clean": with_ctes("users") + "SELECT uid, upper(trim(uname)) AS uname FROM users",
    "label_base6": with_ctes("users", "sup", "base6") + "SELECT * FROM base6",
    "label_user_join": with_ctes("users", "sup") + """
SELECT u.uid, u.ts_ms, s.sup_ts_ms, s.height, s.weight
FROM users u JOIN sup s ON u.uid = s.sup_uid AND s.sup_ts_ms BETWEEN u.ts_ms - 300000 AND u.ts_ms + 300000""",
    "label_order_flatten": with_ctes("order_info", "lorders") + "SELECT * FROM lorders",
    "label_order_detail_join": with_ctes("order_info", "order_detail", "lorders", "lod") + "SELECT * FROM lod",
    "label_base4": with_ctes(*LABEL4) + "SELECT * FROM base4",
    "label_device_flatten": with_ctes(*LOGS, "dev") + "SELECT * EXCLUDE (\"offset\") FROM dev",
    "dedup_exact": with_ctes(*LOGS, "dev") + f"""
SELECT DISTINCT uid, {dstr('ts')} AS day, ar, ba, ch, md, os, dev_uid, vc, search_item FROM dev""",
    "label_running_profile": with_ctes(*LOGS, "dev", "prof") + "SELECT uid, ts AS ts_ms, * EXCLUDE (uid, ts) FROM prof",
    "label_profile_2min": with_ctes(*LOGS, "dev", "prof", "prof2") + "SELECT * FROM prof2",
    "label_base2": with_ctes(*LABEL2) + "SELECT * FROM base2",
    "label_device_score": with_ctes(*LOGS, "dev", "w_device") + f"""
SELECT d.uid, d.ts, d.os AS judge_os, {wcols('wd', 'device')} FROM dev d LEFT JOIN w_device wd ON wd.key = d.os""",
    "label_search_score": with_ctes(*LOGS, "parts", "c1", "tree", "compare", "w_search") + f"""
SELECT p."offset", p.item AS search_item, t.b1name AS b1_category, coalesce(c.search_category, 'unknown') AS search_category,
       {wcols('ws', 'search')}
FROM pages p LEFT JOIN (SELECT DISTINCT b3name, b1name FROM tree) t ON p.item = t.b3name
LEFT JOIN compare c ON c.category_name = t.b1name
LEFT JOIN w_search ws ON ws.key = CASE WHEN coalesce(c.search_category, 'unknown') IN (SELECT key FROM w_search)
     THEN coalesce(c.search_category, 'unknown') ELSE '__default__' END
WHERE p.item_type = 'keyword'""",
    "label_time_score": with_ctes("order_info", "lorders", "w_pay_time") + f"""
SELECT o.id, o.create_time, o.pay_time_slot, {wcols('wp', 'pay_time')}
FROM lorders o LEFT JOIN w_pay_time wp ON wp.key = o.pay_time_slot""",
    "label_amount_score": with_ctes("order_info", "lorders", "w_amount") + f"""
SELECT o.id, o.total_amount, a.amount_class, {wcols('wa', 'amount')}
FROM lorders o, LATERAL (SELECT CASE WHEN CAST(o.total_amount AS DOUBLE) < 1000 THEN 'low'
     WHEN CAST(o.total_amount AS DOUBLE) > 1000 AND CAST(o.total_amount AS DOUBLE) < 4000 THEN 'mid'
     ELSE 'high' END AS amount_class) a
LEFT JOIN w_amount wa ON wa.key = a.amount_class""",
    "label_brand_score": with_ctes("parts", "w_tname") + f"""
SELECT CAST(p.p_partkey AS VARCHAR) AS skuid, p.tname, {wcols('wt', 'tname')}
FROM parts p LEFT JOIN w_tname wt ON wt.key = CASE WHEN p.tname IN (SELECT key FROM w_tname) THEN p.tname
                                                    ELSE '__default__' END""",
    "label_category_score": with_ctes("parts", "c1", "tree", "w_b1name") + f"""
SELECT t.id, t.b1name, {wcols('wb', 'b1name')}
FROM tree t LEFT JOIN w_b1name wb ON wb.key = CASE WHEN t.b1name IN (SELECT key FROM w_b1name) THEN t.b1name
                                                    ELSE '__default__' END""",
    "label_merge_2_4_6": with_ctes(*dict.fromkeys(LABEL2 + LABEL4), "b24", "users", "sup", "base6") + """
SELECT m.uid, m.base2_ts_ms, m.detail_id, m.ts_ms, b6.ts_ms AS base6_ts_ms, m.pv, m.judge_os, m.search_category,
       m.pay_time_slot, m.tname, m.b1_name, b6.gender, b6.age, b6.zodiac_sign
FROM b24 m JOIN base6 b6 ON m.uid = b6.uid AND b6.ts_ms BETWEEN m.ts_ms - 86400000 AND m.ts_ms + 86400000""",
    "label_age_band": with_ctes(*dict.fromkeys(LABEL2 + LABEL4), "b24") + """
SELECT uid, base2_ts_ms, detail_id, ts_ms, """ + ", ".join(
        f"CAST({_total(b)} AS DECIMAL(12,3)) AS total_{b}" for b in BANDS) + """,
       CASE """ + " ".join(
        f"WHEN {' AND '.join(f'({_total(b)}) >= ({_total(o)})' for o in BANDS if o != b)} THEN '{b}'"
        for b in BANDS) + """ END AS age_band
FROM b24""",
})

# ------------------------------------------------------------------ keywords, comments, config-driven dims
TOKEN_RE2 = r"\p{Han}+|[^\P{L}\p{Han}]+|\p{N}+"

CTE["search_pages"] = """
  SELECT "offset", ts, item AS fullword FROM pages
  WHERE last_page_id = 'search' AND item_type = 'keyword' AND item IS NOT NULL"""
CTE["tokens"] = f"""
  SELECT "offset", ts, fullword, unnest(regexp_extract_all(lower(fullword), '{TOKEN_RE2}')) AS keyword
  FROM search_pages"""
CTE["comments"] = """
  SELECT c.*, CAST(c.user_id AS BIGINT) AS uid_n, CAST(c.sku_id AS BIGINT) AS sku_n,
         CAST(c.user_id AS BIGINT) AS order_n, coalesce(d.dic_name, 'N/A') AS dic_name
  FROM comment_info c LEFT JOIN base_dic d ON md5(c.appraise) = md5(d.dic_code)"""
CTE["cwide"] = """
  SELECT c.id, c.order_n AS order_id, c.uid_n AS user_id, c.sku_n AS sku_id, c.sku_n AS spu_id, c.appraise,
         c.dic_name, c.comment_txt AS "commentTxt", c.create_ms AS create_time, c.ts_ms,
         strftime(make_timestamp(c.ts_ms * 1000), '%Y%m%d') AS ds, o.id AS info_id, 'r' AS info_op,
         o.ts_ms AS info_tm_ms, o.consignee AS info_consignee, o.total_amount AS info_total_amount,
         o.order_status AS info_order_status
  FROM comments c JOIN order_info o ON c.order_n = CAST(o.id AS BIGINT)
   AND o.ts_ms BETWEEN c.ts_ms - 60000 AND c.ts_ms + 60000"""
CTE["swords"] = """
  SELECT DISTINCT word FROM (SELECT unnest(string_split(replace(text, chr(10), ','), ',')) AS word FROM documents)
  WHERE word <> ''"""
CTE["sfeed"] = f"""
  SELECT CAST(s_suppkey AS VARCHAR) AS id, 'r' AS op, 1 AS n, s_name, CAST(s_nationkey AS VARCHAR) AS nk,
         s_suppkey, {T0} + s_suppkey * 1000 AS ts FROM supplier
  UNION ALL SELECT CAST(s_suppkey AS VARCHAR), 'u', 2, upper(s_name), '', s_suppkey, {T0} + s_suppkey * 1000
    FROM supplier WHERE s_suppkey % 2 = 0
  UNION ALL SELECT CAST(s_suppkey AS VARCHAR), 'd', 3, s_name, CAST(s_nationkey AS VARCHAR), s_suppkey,
    {T0} + s_suppkey * 1000 FROM supplier WHERE s_suppkey % 5 = 0
  UNION ALL SELECT CAST(s_suppkey AS VARCHAR), 'c', 4, 'reborn ' || CAST(s_suppkey AS VARCHAR), '', s_suppkey,
    {T0} + s_suppkey * 1000 FROM supplier WHERE s_suppkey % 10 = 0"""
ORACLE.update({
    "keyword_tokenize": with_ctes(*LOGS, "search_pages", "tokens") + 'SELECT "offset", fullword, keyword FROM tokens',
    "dws_keyword": with_ctes(*LOGS, "search_pages", "tokens") + f"""
SELECT {win('ts - ts % 3600000', HOUR)}, keyword, count(*) AS keyword_count FROM tokens GROUP BY ALL""",
    "dim_enrich_default": with_ctes("comment_info", "base_dic", "comments") + "SELECT id, appraise, dic_name FROM comments",
    "comment_order_join": with_ctes("comment_info", "base_dic", "comments", "order_info", "cwide") + """
SELECT id, order_id, user_id, appraise, dic_name, ts_ms, info_id, info_op, info_tm_ms, info_consignee,
       info_total_amount, info_order_status FROM cwide""",
    "comment_wide": with_ctes("comment_info", "base_dic", "comments", "order_info", "cwide") + """
SELECT id, order_id, user_id, sku_id, spu_id, appraise, dic_name, "commentTxt", create_time, ts_ms, ds,
       info_consignee, info_tm_ms FROM cwide""",
    "comment_sensitive": with_ctes("comment_info", "base_dic", "comments", "order_info", "cwide", "swords") + """
SELECT w.user_id, w.info_consignee AS consignee, w.ts_ms, w.ds, w."commentTxt" AS msg,
       CASE WHEN s.word IS NOT NULL THEN 1 ELSE 0 END AS is_violation,
       CASE WHEN s.word IS NOT NULL THEN 'P0' ELSE '' END AS violation_grade,
       CASE WHEN s.word IS NOT NULL THEN s.word ELSE '' END AS violation_msg
FROM cwide w LEFT JOIN swords s
  ON coalesce(list_extract(string_split(rtrim(w."commentTxt", ','), ','), -1), '') = s.word""",
    "dim_point_lookup": with_ctes("cart_info") + """
SELECT c.id, c.sku_id, p.p_name AS dim_sku_name, p.p_brand AS dim_tm_id
FROM cart_info c LEFT JOIN part p ON c.sku_id = CAST(p.p_partkey AS VARCHAR)""",
    "dim_enrich_generic": with_ctes("order_info") + """
SELECT o.id, o.province_id, n.n_name AS province_name
FROM order_info o LEFT JOIN nation n ON o.province_id = CAST(n.n_nationkey AS VARCHAR)""",
    "interval_join": f"""
WITH ev AS (SELECT event_id, user_id, event_type, {ms('ts')} AS ms FROM events)
SELECT b.event_id AS purchase_id, v.event_id AS view_id, b.user_id AS uid, b.ms - v.ms AS lag_ms
FROM ev b JOIN ev v ON b.user_id = v.user_id AND v.ms BETWEEN b.ms - 21600000 AND b.ms
WHERE b.event_type = 'purchase' AND v.event_type = 'view'""",
})

# ------------------------------------------------------------------ the whole change topic, as lists of keys and values


def _pad16(expr: str) -> str:
    return f"lpad(CAST({expr} AS VARCHAR), 16, '0')"


_ORDER_MS = f"{ms('o_orderdate')} + (o_orderkey % 24) * 3600000"
_LINE = "l_orderkey || '-' || l_linenumber"
_CART = {"id": "event_id", "user_id": "user_id", "sku_id": "CAST(json_extract(props, '$.k') AS BIGINT)", "create_time": ms("ts")}
_K = "CAST(json_extract(props, '$.k') AS BIGINT)"
_SUP = {"id": "s_suppkey", "s_suppkey": "s_suppkey", "s_name": "s_name", "s_nationkey": "s_nationkey"}
#: (table, op, image, record time, arrival position, rows, columns of the image before)
CHANGES = [
    ("order_info", "r", {"id": "o_orderkey", "user_id": "o_custkey", "province_id": "c_nationkey",
                         "order_status": "CASE o_orderstatus WHEN 'F' THEN '1003' WHEN 'O' THEN '1006' WHEN 'P' THEN '1001' END",
                         "consignee": "c_name", "create_time": _ORDER_MS, "operate_time": f"{_ORDER_MS} + 1800000",
                         "total_amount": dec("o_totalprice"), "original_total_amount": dec("o_totalprice")},
     f"{T0} + o_orderkey * 1000", None, "orders LEFT JOIN customer ON o_custkey = c_custkey", 0),
    ("payment_info", "r", {"id": "o_orderkey", "user_id": "o_custkey", "order_id": "o_orderkey",
                           "payment_type": "'110' || (o_orderkey % 3 + 1)", "callback_time": f"{_ORDER_MS} + 600000",
                           "payment_status": "CASE WHEN o_orderkey % 50 = 0 THEN NULL WHEN o_orderpriority IN "
                                             "('1-URGENT', '2-HIGH', '3-MEDIUM') THEN '1602' ELSE '1601' END"},
     f"{T0} + o_orderkey * 1000 + 500", None, "orders", 0),
    ("order_detail", "r", {"id": _LINE, "order_id": "l_orderkey", "sku_id": "l_partkey", "sku_name": "'sku ' || l_partkey",
                           "create_time": ms("l_shipdate"), "source_type": "'2401'", "sku_num": "CAST(l_quantity AS INTEGER)",
                           "order_price": dec("l_extendedprice"),
                           "split_total_amount": money(f"{dec('l_extendedprice')} * (1 - {dec('l_discount')})"),
                           "split_activity_amount": money(f"{dec('l_extendedprice')} * {dec('l_discount')}"),
                           "split_coupon_amount": money(f"{dec('l_extendedprice')} * {dec('l_tax')}")},
     f"{T0} + l_orderkey * 1000 + l_linenumber * 10", LSEQ, "lineitem", 0),
    ("order_detail_activity", "r", {"id": _LINE, "order_detail_id": _LINE, "activity_id": "l_partkey % 4 + 1",
                                    "activity_rule_id": "l_suppkey % 6 + 1"},
     f"{T0} + l_orderkey * 1000 + l_linenumber * 10 + 1", None, "latest_line WHERE l_discount >= 0.05", 0),
    ("order_detail_coupon", "r", {"id": _LINE, "order_detail_id": _LINE, "coupon_id": "l_orderkey % 9 + 1"},
     f"{T0} + l_orderkey * 1000 + l_linenumber * 10 + 2", None, "latest_line WHERE l_tax >= 0.04", 0),
    ("order_refund_info", "r", {"id": _LINE, "user_id": "l_suppkey", "order_id": "l_orderkey", "sku_id": "l_partkey",
                                "refund_type": "CASE WHEN l_linestatus = 'F' THEN '1502' ELSE '1501' END",
                                "refund_num": "CAST(l_quantity AS INTEGER)", "refund_amount": dec("l_extendedprice"),
                                "refund_reason_type": "'130' || (l_linenumber % 5 + 1)", "refund_reason_txt": "'reason ' || l_linenumber",
                                "create_time": f"{ms('l_shipdate')} + 86400000",
                                "refund_status": "CASE WHEN l_suppkey % 2 = 0 THEN '0705' ELSE '0701' END"},
     f"{T0} + l_orderkey * 1000 + l_linenumber * 10 + 5", LSEQ, "lineitem WHERE l_returnflag = 'R'", 0),
    ("refund_payment", "r", {"id": f"'rp' || {_LINE}", "order_id": "l_orderkey", "sku_id": "l_partkey", "payment_type": "'1102'",
                             "callback_time": f"{ms('l_shipdate')} + 86400000 + 3600000", "total_amount": dec("l_extendedprice"),
                             "refund_status": "CASE WHEN l_suppkey % 3 <> 0 THEN '1602' ELSE '1601' END"},
     f"{T0} + l_orderkey * 1000 + l_linenumber * 10 + 7", LSEQ, "lineitem WHERE l_returnflag = 'R'", 0),
    ("cart_info", "r", {**_CART, "sku_num": f"{_K} % 5 + 1"}, ms("ts"), None, "events WHERE event_type = 'purchase'", 0),
    ("cart_info", "u", {**_CART, "sku_num": f"{_K} % 5 + 3"}, f"{ms('ts')} + 1000", None,
     f"events WHERE event_type = 'purchase' AND {_K} % 7 = 0", 5),
    ("comment_info", "r", {"id": "conv_id || '-' || turn", "user_id": "conv_id", "sku_id": "turn", "spu_id": "turn",
                           "order_id": "conv_id", "appraise": "conv_id % 5 + 1201", "comment_txt": "text",
                           "create_time": f"{T0} + conv_id * 1000 + turn * 10"},
     f"{T0} + conv_id * 1000 + turn * 10 + 1", None, "conversations", 0),
    ("user_info", "r", {"id": "c_custkey", "name": "' ' || lower(c_name) || ' '", "user_level": "c_custkey % 3 + 1",
                        "login_name": "'user' || c_custkey", "phone_num": "'138' || lpad(CAST(c_custkey AS VARCHAR), 8, '0')",
                        "email": "'user' || c_custkey || '@example.com'",
                        "gender": "CASE WHEN c_custkey % 3 = 0 THEN NULL WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END",
                        "birthday": "(c_custkey * 13) % 16000"}, f"{T0} + c_custkey * 1000", None, "customer", 0),
    ("user_info_sup_msg", "r", {"uid": "c_custkey", "height": "c_custkey % 180 + 90",
                                "unit_height": "CASE WHEN c_custkey % 2 = 0 THEN 'cm' ELSE 'in' END",
                                "weight": "c_custkey % 190 + 25", "unit_weight": "CASE WHEN c_custkey % 3 = 0 THEN 'lb' ELSE 'kg' END",
                                "create_ts": f"{T0} + c_custkey * 1000 + 60000"},
     f"{T0} + c_custkey * 1000 + 60000", None, "customer", 0),
]
_SUP_TS = f"{T0} + s_suppkey * 1000"
SUPPLIER_CHANGES = [
    ("supplier", op, image, f"{_SUP_TS} + {n}", f"{_pad16(_SUP_TS)} || '-{n}'", rows, 0)
    for n, op, image, rows in (
        (1, "r", _SUP, "supplier"),
        (2, "u", {**_SUP, "s_name": "upper(s_name)", "s_nationkey": "''"}, "supplier WHERE s_suppkey % 2 = 0"),
        (3, "d", _SUP, "supplier WHERE s_suppkey % 5 = 0"),
        (4, "c", {**_SUP, "s_name": "'reborn ' || s_suppkey", "s_nationkey": "''"}, "supplier WHERE s_suppkey % 10 = 0"))]


def _change_sql(changes) -> str:
    """(tbl, op, ts_ms, seq, kv, n_before): kv is the image, for deletes the one before."""
    return "\nUNION ALL ".join(
        f"SELECT '{t}' AS tbl, '{op}' AS op, {at} AS ts_ms, {seq or _pad16(at)} AS seq, "
        f"[{', '.join('{' + repr('k') + f': {c!r}, ' + repr('v') + f': CAST({e} AS VARCHAR)' + '}' for c, e in image.items())}] AS kv, "
        f"{n} AS n_before FROM {rows}" for t, op, image, at, seq, rows, n in changes)


def _config_sql() -> str:
    images = {t: sorted(image) for t, _, image, *_ in CHANGES + SUPPLIER_CHANGES}
    rows = []
    for t, cols in images.items():
        key = "id" if "id" in cols else cols[0]
        rows.append((t, ",".join(cols), key, "r", "1"))
        if "payment" in t:
            rows.append((t, f"{key},payment_type", key, "u", "2"))
        if t == "cart_info":
            rows.append((t, ",".join(cols), key, "d", "3"))
    return "SELECT * FROM (VALUES " + ", ".join(f"('{t}', 'dim_{t}', '{c}', '{k}', '{op}', '{q}')" for t, c, k, op, q in rows) + \
        ") AS t(source_table, sink_table, sink_columns, sink_row_key, op, seq)"


CTE["topic"] = _change_sql(CHANGES)
CTE["change"] = "SELECT * FROM topic UNION ALL " + _change_sql(SUPPLIER_CHANGES)
CTE["cfg"] = _config_sql()
CTE["routed"] = """
  SELECT c.tbl AS source_table, g.sink_table, c.op, c.ts_ms, c.seq, kv_key.v AS row_key, d AS data
  FROM (SELECT *, list_filter(kv, lambda x: list_contains(string_split(sink_columns, ','), x.k)) AS d FROM change c
        JOIN (SELECT * FROM cfg QUALIFY row_number() OVER (PARTITION BY source_table ORDER BY seq DESC) = 1) g
          ON g.source_table = c.tbl AND g.op <> 'd') x,
  LATERAL (SELECT x.tbl, x.op, x.ts_ms, x.seq) c, LATERAL (SELECT x.sink_table) g,
  LATERAL (SELECT list_filter(x.d, lambda y: y.k = x.sink_row_key)[1].v AS v) kv_key"""
CTE["live"] = """
  SELECT r.* FROM routed r LEFT JOIN (SELECT sink_table, row_key, max(seq) AS gone FROM routed WHERE op = 'd' GROUP BY 1, 2) d
    ON d.sink_table = r.sink_table AND d.row_key = r.row_key
  WHERE r.op <> 'd' AND (d.gone IS NULL OR r.seq > d.gone)"""
CTE["cell"] = "SELECT sink_table, row_key, ts_ms, seq, unnest(data).k AS k, unnest(data).v AS v FROM live"
DIMS = ("latest_line", "topic", "change", "cfg", "routed")
_ROWS_SQL = """
SELECT sink_table, row_key, string_agg(k || '=' || v, ';' ORDER BY k || '=' || v) AS cells
FROM (SELECT sink_table, row_key, k, arg_max(v, seq) AS v FROM cell WHERE coalesce(v, '') <> '' {more} GROUP BY ALL) GROUP BY ALL"""
#: Columns of the wide dimension rows (K6, K7).
WIDE = ("id", "uid", "user_id", "order_id", "sku_id", "payment_type", "s_name", "s_nationkey")

ORACLE.update({
    "cdc_parse": with_ctes("latest_line", "topic") + """
SELECT tbl AS source_table, op, ts_ms, list_filter(kv, lambda x: x.k = 'id')[1].v AS id, len(kv) AS n_after, n_before FROM topic""",
    "event_time_pick": with_ctes("latest_line", "topic") + f"""
SELECT 'cdc' AS src, list_filter(kv, lambda x: x.k = 'id')[1].v AS id, ts_ms AS event_ms FROM topic
UNION ALL SELECT 'log', CAST(event_id AS VARCHAR), CASE WHEN event_id % 97 = 0 THEN 0 ELSE {ms('ts')} END FROM events""",
    "src_file_stream": with_ctes("latest_line", "topic") + """
SELECT tbl AS source_table, list_filter(kv, lambda x: x.k = 'id')[1].v AS id, op, len(kv) AS n_after, ts_ms FROM topic""",
    "sink_dynamic_topic": with_ctes("latest_line", "topic") + "SELECT 'dwd_' || tbl AS topic, count(*) AS records FROM topic GROUP BY ALL",
    "dim_config_scan": with_ctes("cfg") + """
SELECT source_table AS "sourceTable", sink_table AS "sinkTable", sink_columns AS "sinkColumns",
       'info' AS "sinkFamily", sink_row_key AS "sinkRowKey"
FROM (SELECT *, row_number() OVER (PARTITION BY source_table ORDER BY seq DESC) AS rn FROM cfg)
WHERE rn = 1 AND op <> 'd'""",
    "dim_table_plan": with_ctes("cfg") + """
SELECT seq, 0 AS step, CASE WHEN op IN ('r', 'c') THEN 'create' ELSE 'drop' END AS action, sink_table,
       'info' AS sink_family, CASE WHEN op IN ('r', 'c') THEN sink_columns END AS columns FROM cfg
UNION ALL SELECT seq, 1, 'create', sink_table, 'info', sink_columns FROM cfg WHERE op = 'u'""",
    "dim_route": with_ctes(*DIMS) + "SELECT source_table, sink_table, op, seq, row_key, len(data) AS n_cols FROM routed",
    "dim_column_prune": with_ctes(*DIMS) + """
SELECT sink_table, seq, array_to_string(list_sort(list_transform(data, lambda x: x.k)), ',') AS columns FROM routed""",
    "dim_upsert_merge": with_ctes(*DIMS, "live", "cell") + "SELECT sink_table, row_key, " + ", ".join(
        f"arg_max(v, seq) FILTER (WHERE k = '{c}' AND coalesce(v, '') <> '') AS {c}" for c in WIDE) + " FROM cell GROUP BY ALL",
    "dim_upsert_md5": with_ctes(*DIMS) + ", last AS (SELECT sink_table, md5(row_key) AS row_key, arg_max(data, seq) AS d FROM routed WHERE op <> 'd' GROUP BY ALL) "
        "SELECT sink_table, row_key, " + ", ".join(f"list_filter(d, lambda x: x.k = '{c}')[1].v AS {c}" for c in WIDE) + " FROM last",
    "dim_build": with_ctes(*DIMS, "live", "cell") + _ROWS_SQL.format(more=""),
    # tables whose config was updated between the halves hold the second half only
    "dim_build_stream": with_ctes(*DIMS, "live", "cell") + _ROWS_SQL.format(
        more="AND (sink_table NOT LIKE '%payment%' OR ts_ms > (SELECT (min(ts_ms) + max(ts_ms)) // 2 FROM change))"),
})

# ------------------------------------------------------------------ design-note tags
AGE_RANGE_SQL = """CASE WHEN {a} IS NULL THEN NULL WHEN {a} < 25 THEN '18-24' WHEN {a} < 30 THEN '25-29'
  WHEN {a} < 35 THEN '30-34' WHEN {a} < 40 THEN '35-39' WHEN {a} < 50 THEN '40-49' ELSE '50+' END"""

CTE["ages2"] = """
  SELECT uid, b, 2025 - year(b) - CASE WHEN 512 < month(b) * 100 + day(b) THEN 1 ELSE 0 END AS age_new,
         2024 - year(b) - CASE WHEN 512 < month(b) * 100 + day(b) THEN 1 ELSE 0 END AS age_old
  FROM (SELECT CAST(c_custkey AS VARCHAR) AS uid,
               CAST(DATE '1970-01-01' + CAST((c_custkey * 13) % 16000 AS INTEGER) AS DATE) AS b FROM customer)"""

CTE["beh"] = """
  SELECT "offset", uid, ts, item, CASE WHEN page_id = 'payment' THEN 'purchase' ELSE 'browse' END AS kind FROM pages
  WHERE uid IS NOT NULL AND page_id IN ('payment', 'good_detail')
  UNION ALL
  SELECT "offset", uid, ts + i * 100, CAST(k + i AS VARCHAR), 'cart' FROM (SELECT *, unnest(range(k % 3)) AS i FROM pages)
  WHERE uid IS NOT NULL"""

CTE["beh_cat"] = """
  SELECT b.uid, t.b1name, CAST(CASE b.kind WHEN 'purchase' THEN 0.5 WHEN 'cart' THEN 0.3 ELSE 0.2 END AS DECIMAL(4,2)) AS w,
         CASE WHEN t.b1name IN ('母婴', '个护化妆', '服饰内衣', '家居家装') THEN 'female'
              WHEN t.b1name IN ('数码', '手机', '电脑办公', '家用电器', '汽车用品') THEN 'male' ELSE 'family' END AS lean
  FROM beh b JOIN parts p ON b.item = CAST(p.p_partkey AS VARCHAR) JOIN (SELECT DISTINCT id, b1name FROM tree) t ON p.c3id = t.id"""

ORACLE.update({
    "tag_zodiac": with_ctes("users") + f"""
SELECT uid AS user_id, lower({zodiac_sql('(month(CAST(birthday AS DATE)) * 100 + day(CAST(birthday AS DATE)))', True)})
       AS zodiac, birthday, 'profile' AS birthday_source FROM users""",
    "tag_generation": with_ctes("users") + """
SELECT uid AS user_id, CASE WHEN y BETWEEN 2000 AND 2009 THEN 'post-00s' WHEN y BETWEEN 1990 AND 1999 THEN 'post-90s'
       WHEN y BETWEEN 1980 AND 1989 THEN 'post-80s' WHEN y BETWEEN 1970 AND 1979 THEN 'post-70s'
       WHEN y BETWEEN 1960 AND 1969 THEN 'post-60s' ELSE 'other' END AS generation, y AS birth_year,
       'profile' AS data_source
FROM (SELECT uid, CAST(year(CAST(birthday AS DATE)) AS INTEGER) AS y FROM users)""",
    "tag_update_log": with_ctes("ages2") + f"""
SELECT uid AS user_id, 'age' AS tag_type, o AS old_value, n AS new_value, 'recompute' AS update_reason,
       'system' AS operator
FROM (SELECT uid, {AGE_RANGE_SQL.format(a='age_old')} AS o, {AGE_RANGE_SQL.format(a='age_new')} AS n FROM ages2)
WHERE o IS DISTINCT FROM n""",
    "tag_weight": """
SELECT user_id, weight, 'profile' AS data_source, 0 AS is_abnormal FROM (
  SELECT CAST(c_custkey AS VARCHAR) AS user_id,
         CAST(ROUND(CASE WHEN c_custkey % 3 = 0
                         THEN CAST(c_custkey % 190 + 25 AS DECIMAL(10,2)) * CAST('0.4536' AS DECIMAL(6,4))
                         ELSE CAST(c_custkey % 190 + 25 AS DECIMAL(10,2)) END, 1) AS DECIMAL(5,1)) AS weight
  FROM customer)
WHERE weight BETWEEN 30 AND 200""",
    "tag_height": """
SELECT user_id, height, 'profile' AS data_source FROM (
  SELECT CAST(c_custkey AS VARCHAR) AS user_id,
         CAST(ROUND(CASE WHEN c_custkey % 2 <> 0
                         THEN CAST(c_custkey % 180 + 90 AS DECIMAL(10,2)) * CAST('2.54' AS DECIMAL(4,2))
                         ELSE CAST(c_custkey % 180 + 90 AS DECIMAL(10,2)) END, 0) AS INTEGER) AS height
  FROM customer)
WHERE height BETWEEN 100 AND 250""",
    "tag_gender": with_ctes(*LOGS, "parts", "c1", "tree", "beh", "beh_cat") + """
SELECT a.uid AS user_id,
       CASE WHEN f > m * CAST(1.1 AS DECIMAL(3,1)) THEN 'female' WHEN m > f * CAST(1.1 AS DECIMAL(3,1)) THEN 'male'
            ELSE 'family' END AS gender,
       f AS female_score, m AS male_score, fa AS family_score, mc.b1name AS main_category
FROM (SELECT uid, CAST(sum(CASE WHEN lean = 'female' THEN w ELSE 0 END) AS DECIMAL(12,2)) AS f,
             CAST(sum(CASE WHEN lean = 'male' THEN w ELSE 0 END) AS DECIMAL(12,2)) AS m,
             CAST(sum(CASE WHEN lean = 'family' THEN w ELSE 0 END) AS DECIMAL(12,2)) AS fa
      FROM beh_cat GROUP BY uid) a
JOIN (SELECT uid, b1name FROM (SELECT uid, b1name, row_number() OVER (PARTITION BY uid ORDER BY cw DESC, b1name DESC) AS rn
      FROM (SELECT uid, b1name, sum(w) AS cw FROM beh_cat GROUP BY uid, b1name)) WHERE rn = 1) mc ON a.uid = mc.uid""",
    "tag_behavior_summary": with_ctes(*LOGS, "cart_info", "comment_info") + f""", u AS (
  SELECT CAST(uid AS BIGINT) AS user_id, {dstr('ts')} AS data_date, ts,
         CASE WHEN page_id = 'good_detail' THEN 1 ELSE 0 END AS v, CASE WHEN item_type = 'keyword' THEN 1 ELSE 0 END AS s,
         0 AS fav, 0 AS cart, CASE WHEN page_id = 'payment' THEN 1 ELSE 0 END AS o, 0 AS pay, 0 AS cm, os
  FROM pages WHERE uid IS NOT NULL
  UNION ALL
  SELECT CAST(uid AS BIGINT), {dstr('ts + i * 100')}, ts + i * 100, 0, 0, CASE WHEN i > 0 THEN 1 ELSE 0 END,
         CASE WHEN i = 0 THEN 1 ELSE 0 END, 0, 0, 0, NULL
  FROM (SELECT *, unnest(range(k % 3)) AS i FROM pages) WHERE uid IS NOT NULL
  UNION ALL
  SELECT CAST(user_id AS BIGINT), {dstr('ts_ms')}, ts_ms, 0, 0, 0, 0, 0, 1, 0, NULL FROM cart_info
  UNION ALL
  SELECT CAST(user_id AS BIGINT), {dstr('create_ms')}, create_ms, 0, 0, 0, 0, 0, 0, 1, NULL FROM comment_info)
SELECT user_id, data_date, CAST(sum(v) AS INTEGER) AS view_count, CAST(sum(s) AS INTEGER) AS search_count,
       CAST(sum(fav) AS INTEGER) AS favorite_count, CAST(sum(cart) AS INTEGER) AS cart_count,
       CAST(sum(o) AS INTEGER) AS order_count, CAST(sum(pay) AS INTEGER) AS payment_count,
       0 AS live_view_count, CAST(sum(cm) AS INTEGER) AS comment_count, 0 AS share_count,
       arg_min(os, ts) FILTER (WHERE os IS NOT NULL) AS device_type
FROM u GROUP BY user_id, data_date""",
})

ORACLE["tag_age"] = (
    "WITH ab AS (" + ORACLE["label_age_band"] + "),\n" +
    ",\n".join(f"{n} AS ({CTE[n]}\n)" for n in ("users",)) + """,
sums AS (SELECT uid, """ + ", ".join(f"sum(total_{b}) AS t_{b}" for b in BANDS) + """ FROM ab GROUP BY uid),
beh AS (SELECT uid, """ + "CASE " + " ".join(
        f"WHEN {' AND '.join(f't_{b} >= t_{o}' for o in BANDS if o != b)} THEN '{r}'"
        for b, r in zip(BANDS, ["18-24", "25-29", "30-34", "35-39", "40-49", "50+"])) + """ END AS b_range,
        CASE WHEN (""" + " + ".join(f"t_{b}" for b in BANDS) + ") > 0 THEN greatest(" + ", ".join(
        f"t_{b}" for b in BANDS) + ") / (" + " + ".join(f"t_{b}" for b in BANDS) + """) ELSE 0 END AS b_conf FROM sums)
SELECT coalesce(u.uid, b.uid) AS user_id,
       CASE WHEN u.uid IS NOT NULL THEN """ + AGE_RANGE_SQL.format(a="u.age") + """ ELSE b.b_range END AS age_range,
       CAST(CASE WHEN u.uid IS NOT NULL THEN 1 ELSE b.b_conf END AS DECIMAL(5,2)) AS confidence_score,
       CASE WHEN u.uid IS NOT NULL THEN 'birth_year' ELSE 'behavior_analysis' END AS data_source,
       CAST(year(CAST(u.birthday AS DATE)) AS INTEGER) AS birth_year
FROM users u FULL JOIN beh b ON u.uid = b.uid""")

ORACLE.update({
})
ORACLE["sink_jsonl_roundtrip"] = ORACLE["dws_cart_uu"]

ORACLE["late_drop"] = f"""
WITH e AS (SELECT {ms('ts')} AS ts FROM events WHERE {ms('ts')} >= {T0} + 2 * 86400000),
w AS (SELECT ts - ts % 3600000 AS wstart, count(*) AS n FROM e GROUP BY 1)
SELECT wstart, n FROM w WHERE wstart < (SELECT max(wstart) FROM w)"""

# stream forms of the DWD joins: in these feeds the records of one order lie within a second of each other, far
# inside the join bound, so the bounded joins give the batch rows (the bound itself is tested on planted records)
for _n in ("order_detail", "order_cancel", "pay_success", "order_refund", "refund_pay_success"):
    ORACLE[f"dwd_{_n}_stream"] = ORACLE[f"dwd_{_n}"]

# stream forms of the windows: the feeds arrive in record-time order, a heartbeat closes the last window
for _n in ("cart_uu", "home_detail_uv", "traffic_dims", "user_login"):
    ORACLE[f"dws_{_n}_stream"] = ORACLE[f"dws_{_n}"]
ORACLE["dedup_exact_stream"] = ORACLE["dedup_exact"]
ORACLE["dedup_composite_stream"] = ORACLE["dedup_composite"]
ORACLE["label_merge_stream"] = ORACLE["label_merge_2_4_6"]
# forward longest match as a walk over each title's places
ORACLE["keyword_segment"] = "WITH RECURSIVE " + ", ".join(f"{n} AS ({CTE[n]}\n)" for n in ("parts", "c1", "tree")) + """,
dict AS (SELECT DISTINCT lower(w) AS word FROM (SELECT tname AS w FROM parts UNION ALL SELECT name FROM c1) WHERE length(w) > 1),
titles AS (SELECT CAST(p.p_partkey AS VARCHAR) AS sku_id, lower(coalesce(p.tname, '') || coalesce(c1.name, '') || '专卖 ' || p.p_name) AS t
  FROM parts p LEFT JOIN c1 ON p.p_type = c1.id),
pieces AS (SELECT sku_id, unnest(ps) AS piece, generate_subscripts(ps, 1) AS i FROM (SELECT sku_id, regexp_extract_all(t, '""" + TOKEN_RE2 + """') AS ps FROM titles)),
runs AS (SELECT DISTINCT piece AS run FROM pieces WHERE regexp_full_match(piece, '\\p{Han}+')),
best AS (SELECT run, place, max(length(word)) AS n FROM (SELECT run, unnest(range(1, length(run) + 1)) AS place FROM runs), dict
  WHERE substr(run, place, length(word)) = word GROUP BY 1, 2),
walk AS (SELECT run, 1::BIGINT AS place FROM runs
  UNION ALL SELECT w.run, w.place + coalesce(b.n, 1) FROM walk w LEFT JOIN best b ON b.run = w.run AND b.place = w.place WHERE w.place + coalesce(b.n, 1) <= length(w.run)),
toks AS (SELECT p.sku_id, p.i, w.place, substr(w.run, w.place, coalesce(b.n, 1)) AS keyword FROM pieces p JOIN walk w ON w.run = p.piece LEFT JOIN best b ON b.run = w.run AND b.place = w.place
  UNION ALL SELECT sku_id, i, 0, piece FROM pieces WHERE NOT regexp_full_match(piece, '\\p{Han}+'))
SELECT sku_id, row_number() OVER (PARTITION BY sku_id ORDER BY i, place) - 1 AS pos, keyword FROM toks"""
ORACLE["ods_snapshot_envelope"] = "\nUNION ALL ".join(
    f"SELECT 'shop' AS db, '{t}' AS tbl, 'r' AS op, CAST({k} AS VARCHAR) AS id, len(json_keys(to_json({t}))) AS n_fields, "
    f"len(list_filter(list_transform(json_keys(to_json({t})), lambda c: to_json({t})->>c), lambda x: x IS NOT NULL)) AS n_set FROM {t}"
    for t, k in (("region", "r_regionkey"), ("nation", "n_nationkey"), ("customer", "c_custkey"), ("supplier", "s_suppkey"),
                 ("part", "p_partkey"), ("orders", "o_orderkey"), ("lineitem", "l_orderkey")))
ORACLE["dwd_comment_info_stream"] = ORACLE["dwd_comment_info"]
ORACLE["dws_province_order_stream"] = ORACLE["dws_province_order"]
# the windows run on the clock that ends the wait of 5 s after a detail's first version
ORACLE["dws_sku_order_stream"] = ORACLE["dws_sku_order"].replace(
    "SELECT ts_ms - ts_ms % 10000 AS ws", "SELECT (ts_ms + 5000) - (ts_ms + 5000) % 10000 AS ws")
ORACLE["interval_join_stream"] = ORACLE["interval_join"]

_SINK = {"page": ("mid", "is_new", "NULL"), "start": ("mid", "is_new", "NULL"), "err": ("mid", "NULL", "NULL"),
         "display": ("mid", "NULL", "display_item"), "action": ("mid", "NULL", "action_item")}
ORACLE["log_split_stream"] = "\nUNION ALL\n".join(
    [f"""SELECT '{n}' AS sink, "offset", {m} AS mid, CAST({i} AS VARCHAR) AS is_new, CAST({x} AS VARCHAR) AS item
FROM ({ORACLE['log_split_' + n]})""" for n, (m, i, x) in _SINK.items()]
    + [f"""SELECT 'dirty', "offset", NULL, NULL, NULL FROM ({ORACLE['log_dirty_split']})"""])

LARGE_STREAMS = {k: ORACLE.pop(k) for k in ("dedup_composite_stream", "dws_sku_order_stream", "dws_province_order_stream")}
