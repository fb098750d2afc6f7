"""DuckDB oracle SQL for CDC / DWD / trade keys (flat tables, no maps)."""

from __future__ import annotations

from .oracle import EV, ORACLE, day, win_cols, with_

AS_OF_MS = 1747008000000


def dec(x: str) -> str:
    return f"CAST({x} AS DECIMAL(16,2))"


def vc(x: str) -> str:
    return f"CAST({x} AS VARCHAR)"


LI_ID = f"{vc('l_orderkey')} || '-' || {vc('l_linenumber')}"

OD = f"""od AS (
  SELECT {LI_ID} AS id, {vc('l_orderkey')} AS order_id, {vc('l_partkey')} AS sku_id,
    'sku-' || {vc('l_partkey')} AS sku_name, {vc('epoch_us(l_shipdate)//1000')} AS create_time,
    {vc('l_suppkey')} AS source_id, '2401' AS source_type, {vc('CAST(l_quantity AS BIGINT)')} AS sku_num,
    {vc(dec('l_extendedprice'))} AS order_price,
    {vc(dec('l_extendedprice') + ' - ' + dec('l_extendedprice') + ' * ' + dec('l_discount'))} AS split_total_amount,
    {vc(dec('l_extendedprice') + ' * ' + dec('l_discount'))} AS split_activity_amount,
    {vc(dec('l_extendedprice') + ' * ' + dec('l_tax'))} AS split_coupon_amount,
    epoch_us(l_shipdate)//1000 AS ts_ms, l_partkey, l_suppkey
  FROM lineitem)"""

ODP = f"""odp AS (
  SELECT id, order_id, sku_id, sku_name, create_time, source_id, source_type, sku_num,
    {vc(dec('sku_num') + ' * ' + dec('order_price'))} AS split_original_amount,
    split_total_amount, split_activity_amount, split_coupon_amount, ts_ms, l_partkey, l_suppkey
  FROM od)"""

ODL = """odl AS (SELECT * FROM odp
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY ts_ms DESC, l_partkey DESC, l_suppkey DESC) = 1)"""


def latest_li(name: str, where: str, cols: str) -> str:
    return f"""{name} AS (SELECT {cols} FROM (SELECT *, {LI_ID} AS id FROM lineitem WHERE {where})
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC) = 1)"""


ACT = latest_li(
    "act", "l_discount >= 0.05",
    f"id AS order_detail_id, {vc('l_suppkey % 5')} AS activity_id, {vc('l_suppkey % 5')} || '-r' AS activity_rule_id",
)
COU = latest_li("cou", "l_tax >= 0.04", f"id AS order_detail_id, {vc('l_suppkey % 7')} AS coupon_id")

OI = f"""oi AS (
  SELECT {vc('o_orderkey')} AS id, {vc('o_custkey')} AS user_id, {vc('c_nationkey')} AS province_id,
    CASE o_orderstatus WHEN 'F' THEN '1001' WHEN 'O' THEN '1002' WHEN 'P' THEN '1006' END AS order_status,
    {vc('epoch_us(o_orderdate)//1000')} AS operate_time, {vc(dec('o_totalprice'))} AS total_amount,
    epoch_us(o_orderdate)//1000 AS ts_ms
  FROM orders JOIN customer ON o_custkey = c_custkey)"""

DETAIL = f"""detail AS (
  SELECT od.id, od.order_id, oi.user_id, od.sku_id, od.sku_name, oi.province_id, act.activity_id,
    act.activity_rule_id, cou.coupon_id, {day('CAST(od.create_time AS BIGINT)')} AS date_id, od.create_time,
    od.sku_num, od.split_original_amount, od.split_activity_amount, od.split_coupon_amount,
    od.split_total_amount, od.ts_ms
  FROM odl od JOIN oi ON od.order_id = oi.id
  LEFT JOIN act ON od.id = act.order_detail_id LEFT JOIN cou ON od.id = cou.order_detail_id)"""

PAY = f"""pay AS (
  SELECT {vc('o_custkey')} AS user_id, {vc('o_orderkey')} AS order_id, left(o_orderpriority, 1) AS payment_type,
    {vc('epoch_us(o_orderdate)//1000')} AS callback_time,
    CASE WHEN o_orderpriority = '5-LOW' THEN '1601' ELSE '1602' END AS payment_status, {vc('o_orderkey')} AS id,
    epoch_us(o_orderdate)//1000 AS ts_ms
  FROM orders)"""

RL = latest_li("rl", "l_returnflag = 'R'", "*")

RI = f"""ri AS (
  SELECT rl.id, {vc('o_custkey')} AS user_id, {vc('l_orderkey')} AS order_id, {vc('l_partkey')} AS sku_id,
    CASE WHEN l_linestatus = 'F' THEN '1502' ELSE '1503' END AS refund_type,
    {vc('CAST(l_quantity AS BIGINT)')} AS refund_num, {vc(dec('l_extendedprice'))} AS refund_amount,
    '1301' AS refund_reason_type, 'reason-' || {vc('l_suppkey % 3')} AS refund_reason_txt,
    {vc('epoch_us(l_shipdate)//1000')} AS create_time,
    CASE WHEN l_linestatus = 'F' THEN '0705' ELSE '0701' END AS refund_status,
    epoch_us(l_shipdate)//1000 AS ts_ms
  FROM rl JOIN orders ON l_orderkey = o_orderkey)"""

RP = f"""rp AS (
  SELECT 'rp-' || id AS id, {vc('l_orderkey')} AS order_id, {vc('l_partkey')} AS sku_id, '1101' AS payment_type,
    {vc('epoch_us(l_shipdate)//1000 + 3600000')} AS callback_time, {vc(dec('l_extendedprice'))} AS total_amount,
    epoch_us(l_shipdate)//1000 + 3600000 AS ts_ms
  FROM rl WHERE l_linestatus = 'F')"""

CART = f"""cart AS (
  SELECT {vc('event_id')} AS id, {vc('user_id')} AS user_id, {vc('k')} AS sku_id, {vc('k % 3 + 1')} AS sku_num, ts AS ts_ms
  FROM ev WHERE event_type IN ('click', 'purchase'))"""

COMMENT = f"""cm AS (
  SELECT {vc('doc_id')} AS id, {vc('o_custkey')} AS user_id, {vc('doc_id % 200')} AS sku_id,
    CASE WHEN quality = 1 THEN '1201' WHEN quality = 0 THEN '1203' ELSE '1204' END AS appraise,
    text AS comment_txt,
    {vc('epoch_us(o_orderdate)//1000 + (doc_id % 7 - 3) * 30000')} AS create_time,
    epoch_us(o_orderdate)//1000 + (doc_id % 7 - 3) * 30000 AS ts_ms
  FROM documents LEFT JOIN labels USING (doc_id) LEFT JOIN orders ON doc_id = o_orderkey)"""

DIC = "dic AS (SELECT * FROM (VALUES ('1201', '好评'), ('1202', '中评'), ('1203', '差评')) t(dic_code, dic_name))"

CHANGES = f"""ch AS (
  SELECT c_custkey AS key, 'r' AS op, 1 AS seq, {AS_OF_MS} + c_custkey AS ts_ms,
    {vc('c_custkey')} AS id, c_name AS name, {vc('c_nationkey')} AS nation, c_mktsegment AS segment,
    {vc(dec('c_acctbal'))} AS balance, NULL AS b_id, NULL AS b_segment, NULL AS b_balance, 'retail' AS db
  FROM customer
  UNION ALL
  SELECT c_custkey, CASE WHEN c_custkey % 11 = 0 THEN 'd' ELSE 'u' END, 2, {AS_OF_MS} + c_custkey + 86400000,
    CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE {vc('c_custkey')} END,
    CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_name END,
    CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE {vc('c_nationkey')} END,
    CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE '' END,
    CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE {vc(dec('c_acctbal') + ' + 1')} END,
    {vc('c_custkey')}, c_mktsegment, {vc(dec('c_acctbal'))}, 'retail'
  FROM customer WHERE c_custkey % 11 = 0 OR c_custkey % 5 = 0
  UNION ALL
  SELECT c_custkey, 'r', 3, {AS_OF_MS} + c_custkey + 1, {vc('c_custkey')}, c_name, {vc('c_nationkey')}, c_mktsegment,
    {vc(dec('c_acctbal'))}, NULL, NULL, NULL, 'legacy'
  FROM customer WHERE c_custkey % 13 = 0)"""

# ---- keys ---------------------------------------------------------------------------------------

ORACLE["src_cdc_envelope"] = with_(OI) + """SELECT 'order_info' AS tbl, 'r' AS op, id, user_id, province_id,
  order_status, total_amount, ts_ms FROM oi"""

ORACLE["ods_snapshot_envelope"] = with_(OI, PAY) + f"""SELECT 'order_info' AS tbl, 'r' AS op, id, ts_ms FROM oi
UNION ALL SELECT 'user_info', 'r', {vc('c_custkey')}, {AS_OF_MS} FROM customer
UNION ALL SELECT 'payment_info', 'r', id, ts_ms FROM pay"""

ORACLE["dim_rename_camel"] = with_(OI) + """SELECT id, user_id AS userId, province_id AS provinceId,
  order_status AS orderStatus, total_amount AS totalAmount FROM oi"""

SKU = f"""sku AS (SELECT {vc('p_partkey')} AS row_key, p_name AS sku_name, {vc('p_partkey - p_partkey % 4')} AS spu_id FROM part)"""

ORACLE["dim_point_lookup"] = with_(EV, CART, SKU) + "SELECT row_key, sku_name, spu_id FROM sku WHERE row_key IN (SELECT sku_id FROM cart)"
ORACLE["dim_scan_limit"] = with_(SKU) + "SELECT row_key, sku_name, spu_id FROM sku ORDER BY row_key LIMIT 10"
ORACLE["dim_row_count"] = with_(SKU) + "SELECT CAST(count(*) AS BIGINT) AS row_count FROM sku"

ORACLE["cdc_valid_filter"] = with_(CHANGES) + "SELECT id, op, CAST(seq AS BIGINT) AS seq FROM ch WHERE db = 'retail' AND op <> 'd'"

ORACLE["cdc_before_after"] = with_(CHANGES) + """SELECT CASE WHEN op = 'd' THEN b_id ELSE id END AS id,
  CASE WHEN op = 'd' THEN b_segment ELSE segment END AS segment,
  CASE WHEN op = 'd' THEN b_balance ELSE balance END AS balance, op, CAST(seq AS BIGINT) AS seq
FROM ch WHERE db = 'retail'"""

ORACLE["cdc_after_else_before"] = with_(CHANGES) + """SELECT CASE WHEN op = 'd' THEN b_id ELSE id END AS id,
  CASE WHEN op = 'd' THEN b_segment ELSE segment END AS segment, op, CAST(ts_ms AS VARCHAR) AS tm_ms
FROM ch WHERE db = 'retail'"""

ORACLE["upsert_latest_by_key"] = with_(CHANGES) + """SELECT id, op, CAST(seq AS BIGINT) AS seq, ts_ms, segment, balance
FROM ch WHERE db = 'retail' AND key NOT IN (SELECT key FROM ch WHERE op = 'd')
QUALIFY row_number() OVER (PARTITION BY key ORDER BY seq DESC, ts_ms DESC) = 1"""

ORACLE["dim_columnwise_upsert"] = with_(
    CHANGES,
    "live AS (SELECT * FROM ch WHERE db = 'retail' AND key NOT IN (SELECT key FROM ch WHERE op = 'd'))",
) + """SELECT CAST(key AS VARCHAR) AS row_key,
  arg_max(name, seq) FILTER (WHERE coalesce(name, '') <> '') AS name,
  arg_max(nation, seq) FILTER (WHERE coalesce(nation, '') <> '') AS nation,
  arg_max(segment, seq) FILTER (WHERE coalesce(segment, '') <> '') AS segment,
  arg_max(balance, seq) FILTER (WHERE coalesce(balance, '') <> '') AS balance
FROM live GROUP BY key"""

ORACLE["cdc_table_route"] = with_(OI) + f"""SELECT 'user_info' AS tbl, {vc('c_custkey')} AS id, {AS_OF_MS} AS ts_ms FROM customer
UNION ALL SELECT 'order_info', id, ts_ms FROM oi"""

DIM_ROUTE = f"""dr AS (
  SELECT 'dim_sku' AS sink_table, {vc('p_partkey')} AS row_key, 'r' AS op, p_name AS name, NULL AS region_id,
    CAST(2 AS BIGINT) AS n_cols, 'id,name' AS kept FROM part
  UNION ALL
  SELECT 'dim_province', {vc('n_nationkey')}, 'r', n_name, {vc('n_regionkey')}, CAST(3 AS BIGINT), 'id,name,region_id'
  FROM nation)"""

ORACLE["dim_route"] = with_(DIM_ROUTE) + "SELECT sink_table, row_key, op, name, region_id, n_cols FROM dr"
ORACLE["route_prune_columns"] = with_(DIM_ROUTE) + "SELECT sink_table, row_key, kept FROM dr"

DWD_ROUTE = f"""dw AS (
  SELECT 'dwd_user_update' AS sink_table, id, segment, NULL AS name, ts_ms FROM ch WHERE db = 'retail' AND op = 'u'
  UNION ALL
  SELECT 'dwd_user_delete', b_id, NULL, (SELECT c_name FROM customer WHERE c_custkey = ch.key), ts_ms
  FROM ch WHERE db = 'retail' AND op = 'd')"""

ORACLE["dwd_route"] = with_(CHANGES, DWD_ROUTE) + "SELECT sink_table, id, segment, name, ts_ms FROM dw"

ORACLE["route_dynamic_sink"] = with_(CHANGES, DWD_ROUTE) + """SELECT sink_table AS topic, id AS key,
  CASE WHEN sink_table = 'dwd_user_update' THEN json_object('id', id, 'segment', segment)::VARCHAR
       ELSE json_object('id', id, 'name', name)::VARCHAR END AS value
FROM dw"""

ORACLE["dwd_comment_info"] = with_(COMMENT) + """SELECT id, user_id, sku_id, appraise, create_time,
  md5(comment_txt) AS txt_md5, ts_ms FROM cm"""

ORACLE["dwd_comment_join"] = with_(COMMENT, DIC) + """SELECT id, user_id, sku_id, appraise, dic_name AS appraise_name,
  md5(comment_txt) AS txt_md5, ts_ms FROM cm JOIN dic ON appraise = dic_code"""

ORACLE["dwd_trade_cart_add"] = with_(EV, CART) + "SELECT id, user_id, sku_id, sku_num, ts_ms FROM cart"

ORACLE["order_detail_projection"] = with_(OD, ODP) + """SELECT id, order_id, sku_id, sku_name, create_time, source_id,
  source_type, sku_num, split_original_amount, split_total_amount, split_activity_amount, split_coupon_amount, ts_ms
FROM odp"""

TRADE = (OD, ODP, ODL, ACT, COU, OI, DETAIL)

ORACLE["dwd_trade_order_detail"] = with_(*TRADE) + "SELECT * FROM detail"

ORACLE["dwd_trade_order_cancel"] = with_(*TRADE) + """SELECT d.id, d.order_id, d.user_id, d.sku_id, d.sku_name,
  d.province_id, d.activity_id, d.activity_rule_id, d.coupon_id, d.date_id, d.sku_num, d.split_original_amount,
  d.split_activity_amount, d.split_coupon_amount, d.split_total_amount, oi.operate_time AS cancel_time, oi.ts_ms
FROM detail d JOIN oi ON d.order_id = oi.id WHERE oi.order_status IN ('1001', '1003')"""

ORACLE["dwd_trade_pay_suc"] = with_(*TRADE, PAY) + """SELECT d.id AS order_detail_id, p.order_id, p.user_id, d.sku_id,
  d.sku_name, d.province_id, d.activity_id, d.activity_rule_id, d.coupon_id, p.payment_type AS payment_type_code,
  p.callback_time, d.sku_num, d.split_original_amount, d.split_activity_amount, d.split_coupon_amount,
  d.split_total_amount AS split_payment_amount, p.ts_ms
FROM pay p JOIN detail d ON p.order_id = d.order_id WHERE p.payment_status = '1602'"""

ORACLE["dwd_trade_order_refund"] = with_(RL, RI, OI) + f"""SELECT ri.id, ri.user_id, ri.order_id, ri.sku_id,
  oi.province_id, {day('CAST(ri.create_time AS BIGINT)')} AS date_id, ri.create_time,
  ri.refund_type AS refund_type_code, ri.refund_reason_type AS refund_reason_type_code, ri.refund_reason_txt,
  ri.refund_num, ri.refund_amount, ri.ts_ms
FROM ri JOIN oi ON ri.order_id = oi.id WHERE oi.order_status = '1006'"""

ORACLE["dwd_trade_refund_pay_suc"] = with_(RL, RI, RP, OI) + f"""SELECT rp.id, oi.user_id, rp.order_id, rp.sku_id,
  oi.province_id, rp.payment_type AS payment_type_code, {day('CAST(rp.callback_time AS BIGINT)')} AS date_id,
  rp.callback_time, ri.refund_num, rp.total_amount AS refund_amount, rp.ts_ms
FROM rp JOIN ri ON rp.order_id = ri.order_id AND rp.sku_id = ri.sku_id AND ri.refund_status = '0705'
JOIN oi ON rp.order_id = oi.id AND oi.order_status = '1006'"""

CART_UU = f"""uu AS (SELECT * FROM cart
  QUALIFY row_number() OVER (PARTITION BY user_id, {day('ts_ms')} ORDER BY ts_ms, CAST(id AS BIGINT)) = 1)"""

ORACLE["cart_daily_unique"] = with_(EV, CART, CART_UU) + "SELECT id, user_id, ts_ms FROM uu"

ORACLE["dws_trade_cart_add_uu"] = with_(EV, CART, CART_UU) + f"""SELECT {win_cols('ts_ms', '1 hour')},
  CAST(count(*) AS BIGINT) AS cart_add_uu_ct FROM uu GROUP BY ALL"""

RETRACT = """rt AS (
  SELECT id, order_id, amount, ts_ms, 1 AS sign FROM v
  UNION ALL
  SELECT id, order_id, -amount, ts_ms, -1 FROM v WHERE nxt IS NOT NULL)"""

VERSIONS = """v AS (SELECT id, order_id, CAST(split_total_amount AS DECIMAL(18,4)) AS amount, ts_ms,
  lead(ts_ms) OVER (PARTITION BY id ORDER BY ts_ms, l_partkey, l_suppkey) AS nxt FROM od)"""

ORACLE["order_retract_stream"] = with_(OD, VERSIONS, RETRACT) + """SELECT id, order_id, CAST(amount AS VARCHAR) AS amount,
  ts_ms, CAST(sign AS BIGINT) AS sign FROM rt"""

ORACLE["dws_trade_province_order"] = with_(OD, VERSIONS, RETRACT, OI) + f"""SELECT {win_cols('rt.ts_ms', '1 day')},
  oi.province_id, n_name AS province_name, CAST(sum(amount) AS VARCHAR) AS order_amount,
  CAST(count(DISTINCT rt.order_id) AS BIGINT) AS order_count
FROM rt JOIN oi ON rt.order_id = oi.id LEFT JOIN nation ON oi.province_id = CAST(n_nationkey AS VARCHAR)
GROUP BY ALL"""

ORACLE["order_keep_latest"] = with_(OD, ODP, ODL) + "SELECT id, sku_id, split_total_amount, ts_ms FROM odl"

C1 = "CASE left(p_type, 1) WHEN 'M' THEN '数码' WHEN 'S' THEN '家居家装' WHEN 'L' THEN '厨具' WHEN 'P' THEN '手机' WHEN 'E' THEN '其他' ELSE left(p_type, 1) END"
TM = "CASE p_brand WHEN 'Brand#1' THEN 'TCL' WHEN 'Brand#2' THEN '苹果' WHEN 'Brand#3' THEN '欧莱雅' WHEN 'Brand#4' THEN '香奈儿' ELSE p_brand END"

SKU_NAMES = f"""skun AS (
  SELECT {vc('k.p_partkey')} AS sku_id, k.p_name AS sku_name, {vc('s.p_partkey')} AS spu_id, s.p_name AS spu_name,
    s.p_brand AS trademark_id, CASE s.p_brand WHEN 'Brand#1' THEN 'TCL' WHEN 'Brand#2' THEN '苹果'
      WHEN 'Brand#3' THEN '欧莱雅' WHEN 'Brand#4' THEN '香奈儿' ELSE s.p_brand END AS trademark_name,
    s.p_type AS category3_id, s.p_type AS category3_name, 'c2-' || left(s.p_type, 1) AS category2_id,
    'c2-' || left(s.p_type, 1) AS category2_name, 'c1-' || left(s.p_type, 1) AS category1_id,
    CASE left(s.p_type, 1) WHEN 'M' THEN '数码' WHEN 'S' THEN '家居家装' WHEN 'L' THEN '厨具' WHEN 'P' THEN '手机'
      WHEN 'E' THEN '其他' ELSE left(s.p_type, 1) END AS category1_name
  FROM part k JOIN part s ON s.p_partkey = k.p_partkey - k.p_partkey % 4)"""

ORACLE["dws_trade_sku_order"] = with_(OD, ODP, ODL, SKU_NAMES) + f"""SELECT {win_cols('ts_ms', '1 day')},
  o.sku_id, sku_name, spu_id, spu_name, trademark_id, trademark_name, category3_id, category3_name,
  category2_id, category2_name, category1_id, category1_name,
  CAST(sum(CAST(split_original_amount AS DECIMAL(18,4))) AS VARCHAR) AS original_amount,
  CAST(sum(CAST(split_activity_amount AS DECIMAL(18,4))) AS VARCHAR) AS activity_reduce_amount,
  CAST(sum(CAST(split_coupon_amount AS DECIMAL(18,4))) AS VARCHAR) AS coupon_reduce_amount,
  CAST(sum(CAST(split_total_amount AS DECIMAL(18,4))) AS VARCHAR) AS order_amount
FROM (SELECT sku_id, ts_ms, split_original_amount, split_activity_amount, split_coupon_amount, split_total_amount
      FROM odl) o LEFT JOIN skun USING (sku_id) GROUP BY ALL"""

ORACLE["strictly_newer_detail"] = with_(OD) + """SELECT id, sku_id, source_id, create_time FROM (
  SELECT *, max(ts_ms) OVER (PARTITION BY id ORDER BY l_partkey, l_suppkey, ts_ms
                             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pm FROM od)
WHERE pm IS NULL OR ts_ms > pm"""

ORACLE["strictly_newer_user"] = with_(PAY) + """SELECT id, user_id, ts_ms FROM (
  SELECT *, max(ts_ms) OVER (PARTITION BY user_id ORDER BY CAST(id AS BIGINT)
                             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pm FROM pay)
WHERE pm IS NULL OR ts_ms > pm"""

ORACLE["dim_category_chain"] = f"""SELECT DISTINCT p_type AS id, p_type AS b3name, 'c2-' || left(p_type, 1) AS b2name,
  {C1} AS b1name FROM part"""

ORACLE["dim_sku_chain"] = f"""SELECT {vc('k.p_partkey')} AS skuid, {vc('s.p_partkey')} AS spuid, s.p_type AS c3id,
  CASE s.p_brand WHEN 'Brand#1' THEN 'TCL' WHEN 'Brand#2' THEN '苹果' WHEN 'Brand#3' THEN '欧莱雅'
    WHEN 'Brand#4' THEN '香奈儿' ELSE s.p_brand END AS tname
FROM part k JOIN part s ON s.p_partkey = k.p_partkey - k.p_partkey % 4"""

ORACLE["dim_enrich_generic"] = with_(OI) + f"""SELECT id, user_id, province_id, n_name AS province_name,
  {vc('n_regionkey')} AS region_id, ts_ms FROM oi LEFT JOIN nation ON province_id = {vc('n_nationkey')}"""

ORACLE["dim_lookup_default"] = with_(COMMENT, DIC) + """SELECT id, appraise, coalesce(dic_name, 'N/A') AS appraise_name
FROM cm LEFT JOIN dic ON md5(appraise) = md5(dic_code)"""
