"""DuckDB oracle SQL for the label pipeline and the comment pipeline."""

from __future__ import annotations

from .oracle import EV, ORACLE, with_
from .oracle_trade import AS_OF_MS, COMMENT, OI, dec, vc

# Fixed values, written out again so that a wrong score in the operators shows.
BUCKETS = ["18_24", "25_29", "30_34", "35_39", "40_49", "50"]

# Model weights.
WEIGHTS = {"device": 0.1, "search": 0.15, "pay_time": 0.1, "amount": 0.15, "tname": 0.2, "b1name": 0.3}

# Raw scores per bucket (18-24, 25-29, 30-34, 35-39, 40-49, 50+).
DEVICE_SCORES = {
    "iOS": (0.7, 0.6, 0.5, 0.4, 0.3, 0.2),
    "Android": (0.8, 0.7, 0.6, 0.5, 0.4, 0.3),
}
SEARCH_SCORES = {
    "时尚与潮流": (0.9, 0.7, 0.5, 0.3, 0.2, 0.1),
    "性价比": (0.2, 0.4, 0.6, 0.7, 0.8, 0.8),
    "健康与养生": (0.1, 0.2, 0.4, 0.6, 0.8, 0.7),
    "家庭与育儿": (0.1, 0.2, 0.4, 0.6, 0.8, 0.7),
    "科技与数码": (0.8, 0.6, 0.4, 0.3, 0.2, 0.1),
    "学习与发展": (0.4, 0.5, 0.6, 0.7, 0.8, 0.7),
}
SEARCH_DEFAULT = (0.0, 0.0, 0.0, 0.0, 0.0, 0.0)
PAY_TIME_SCORES = {
    "凌晨": (0.2, 0.1, 0.1, 0.1, 0.1, 0.1),
    "早晨": (0.1, 0.1, 0.1, 0.1, 0.2, 0.3),
    "上午": (0.2, 0.2, 0.2, 0.2, 0.3, 0.4),
    "中午": (0.4, 0.4, 0.4, 0.4, 0.4, 0.3),
    "下午": (0.4, 0.5, 0.5, 0.5, 0.5, 0.4),
    "晚上": (0.8, 0.7, 0.6, 0.5, 0.4, 0.3),
    "夜间": (0.9, 0.7, 0.5, 0.3, 0.2, 0.1),
}
AMOUNT_SCORES = {
    "low": (0.8, 0.6, 0.4, 0.3, 0.2, 0.1),  # total < 1000
    "mid": (0.2, 0.4, 0.6, 0.7, 0.8, 0.7),  # 1000 < total < 4000
    "high": (0.1, 0.2, 0.3, 0.4, 0.5, 0.6),  # everything else, including exactly 1000
}
BRAND_SCORES = {
    "TCL": (0.2, 0.3, 0.4, 0.5, 0.6, 0.7),
    "苹果": (0.9, 0.8, 0.7, 0.7, 0.7, 0.5),
    "联想": (0.9, 0.8, 0.7, 0.7, 0.7, 0.5),
    "小米": (0.9, 0.8, 0.7, 0.7, 0.7, 0.5),
    "欧莱雅": (0.5, 0.6, 0.8, 0.8, 0.9, 0.2),
    "香奈儿": (0.3, 0.4, 0.6, 0.8, 0.9, 0.2),
}
BRAND_DEFAULT = (0.1, 0.2, 0.3, 0.4, 0.5, 0.6)
CATEGORY_YOUNG = ("数码", "手机", "电脑办公", "个护化妆", "服饰内衣")
CATEGORY_OLDER = ("家居家装", "图书、音像、电子书刊", "厨具", "鞋靴", "母婴", "汽车用品", "珠宝", "家用电器")
CATEGORY_SCORES = {
    **{c: (0.9, 0.8, 0.6, 0.4, 0.2, 0.1) for c in CATEGORY_YOUNG},
    **{c: (0.2, 0.4, 0.6, 0.8, 0.9, 0.7) for c in CATEGORY_OLDER},
}
CATEGORY_DEFAULT = (0.1, 0.2, 0.4, 0.5, 0.8, 0.9)

B = BUCKETS
EPOCH_2024_MS = 1704067200000

POS = """pos AS (SELECT p_type AS name, row_number() OVER (ORDER BY p_type) - 1 AS pos
  FROM (SELECT DISTINCT p_type FROM part))"""

DEV = f"""dev AS (
  SELECT coalesce(CASE WHEN k % 10 = 0 THEN NULL ELSE {vc('user_id')} END, '-1') AS uid, ts, event_id,
    {vc('user_id % 7')} AS ar, 'ch' || {vc('user_id % 4')} AS ch,
    CASE WHEN user_id % 3 = 0 THEN 'iOS' WHEN user_id % 3 = 1 THEN 'Android' ELSE 'Other' END AS os,
    'v' || {vc('k % 3')} AS vc, CASE WHEN k % 2 = 0 THEN pos.name END AS search_item
  FROM ev LEFT JOIN pos ON ev.k % (SELECT count(*) FROM pos) = pos.pos)"""

C1 = ("CASE left(p_type, 1) WHEN 'M' THEN '数码' WHEN 'S' THEN '家居家装' WHEN 'L' THEN '厨具' "
      "WHEN 'P' THEN '手机' WHEN 'E' THEN '其他' ELSE left(p_type, 1) END")  # fmt: skip
CAT = f"cat AS (SELECT DISTINCT p_type AS b3name, {C1} AS b1name FROM part)"
CMP = "cmp AS (SELECT * FROM (VALUES ('数码', '科技与数码'), ('手机', '时尚与潮流'), ('家居家装', '性价比'), ('厨具', '健康与养生')) t(category_name, search_category))"


def score_values(name: str, scores: dict) -> str:
    rows = ", ".join(
        "(" + ", ".join([f"'{k}'"] + [f"CAST({v} AS DECIMAL(4,3))" for v in vals]) + ")" for k, vals in scores.items()
    )
    cols = ", ".join(["score_key"] + [f"s_{b}" for b in B])
    return f"{name} AS (SELECT * FROM (VALUES {rows}) t({cols}))"


def weighted(raw: str, weight: float) -> str:
    return f"CAST(round({raw} * CAST({weight} AS DECIMAL(4,3)), 3) AS DOUBLE)"


def score_cols(alias: str, prefix: str, weight: float, key: str, default=None, null_default=False) -> str:
    out = []
    for i, b in enumerate(B):
        raw = f"{alias}.s_{b}"
        if default is not None:
            filled = f"coalesce({raw}, CAST({default[i]} AS DECIMAL(4,3)))"
            raw = filled if null_default else f"CASE WHEN {key} IS NULL THEN NULL ELSE {filled} END"
        out.append(f"{weighted(raw, weight)} AS {prefix}_{b}")
    return ", ".join(out)


W = WEIGHTS

B2 = f"""b2 AS (
  SELECT d.*, cat.b1name AS b1_category, cmp.search_category, split_part(d.os, ',', 1) AS judge_os
  FROM dev d LEFT JOIN cat ON d.search_item = cat.b3name LEFT JOIN cmp ON cat.b1name = cmp.category_name),
{score_values('sd', DEVICE_SCORES)},
{score_values('ss', SEARCH_SCORES)},
b2s AS (
  SELECT b2.*, {score_cols('sd', 'device', W['device'], 'b2.judge_os')},
    {score_cols('ss', 'search', W['search'], 'b2.search_category', SEARCH_DEFAULT, True)}
  FROM b2 LEFT JOIN sd ON b2.judge_os = sd.score_key LEFT JOIN ss ON b2.search_category = ss.score_key)"""

ORDERS = f"""o AS (
  SELECT id, user_id AS uid, CAST(operate_time AS BIGINT) AS create_time, total_amount,
    CAST(province_id AS BIGINT) AS province_id, ts_ms,
    CASE WHEN hour(make_timestamp(CAST(operate_time AS BIGINT) * 1000)) < 6 THEN '凌晨'
         WHEN hour(make_timestamp(CAST(operate_time AS BIGINT) * 1000)) < 9 THEN '早晨'
         WHEN hour(make_timestamp(CAST(operate_time AS BIGINT) * 1000)) < 12 THEN '上午'
         WHEN hour(make_timestamp(CAST(operate_time AS BIGINT) * 1000)) < 14 THEN '中午'
         WHEN hour(make_timestamp(CAST(operate_time AS BIGINT) * 1000)) < 18 THEN '下午'
         WHEN hour(make_timestamp(CAST(operate_time AS BIGINT) * 1000)) < 22 THEN '晚上'
         ELSE '夜间' END AS pay_time_slot
  FROM oi)"""

DETAILS = f"""d AS (
  SELECT {vc('l_orderkey')} || '-' || {vc('l_linenumber')} AS id, {vc('l_orderkey')} AS order_id,
    l_partkey AS sku_id, CAST(l_quantity AS BIGINT) AS sku_num,
    CAST({dec('l_extendedprice')} * {dec('l_discount')} AS DOUBLE) AS split_activity_amount,
    CAST({dec('l_extendedprice')} - {dec('l_extendedprice')} * {dec('l_discount')} AS DOUBLE) AS split_total_amount,
    epoch_us(o_orderdate)//1000 + (l_linenumber - 3) * 60000 AS ts_ms, l_suppkey AS source_id
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

J10 = """j10 AS (
  SELECT o.id, o.uid, o.create_time, o.total_amount, o.province_id, o.pay_time_slot, o.ts_ms,
    d.sku_num, CAST(d.sku_num AS VARCHAR) AS split_coupon_amount, d.id AS detail_id, d.order_id, d.sku_id,
    d.split_activity_amount, d.split_total_amount, d.ts_ms AS detail_ts, d.source_id
  FROM o JOIN d ON o.id = d.order_id AND d.ts_ms BETWEEN o.ts_ms - 120000 AND o.ts_ms + 120000)"""

D9 = """d9 AS (
  SELECT * EXCLUDE (pm) FROM (
    SELECT *, max(create_time) OVER (PARTITION BY detail_id ORDER BY detail_ts, sku_id, source_id
                                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pm FROM j10)
  WHERE pm IS NULL OR create_time > pm)"""

TMN = ("CASE s.p_brand WHEN 'Brand#1' THEN 'TCL' WHEN 'Brand#2' THEN '苹果' WHEN 'Brand#3' THEN '欧莱雅' "
       "WHEN 'Brand#4' THEN '香奈儿' ELSE s.p_brand END")  # fmt: skip

AMOUNT_BAND = """CASE WHEN coalesce(TRY_CAST(b4.total_amount AS DOUBLE), 0) < 1000 THEN 'low'
  WHEN coalesce(TRY_CAST(b4.total_amount AS DOUBLE), 0) > 1000 AND coalesce(TRY_CAST(b4.total_amount AS DOUBLE), 0) < 4000 THEN 'mid'
  ELSE 'high' END"""

B4 = f"""skc AS (SELECT k.p_partkey AS sku_id, s.p_type AS c3id, {TMN} AS tname
  FROM part k JOIN part s ON s.p_partkey = k.p_partkey - k.p_partkey % 4),
b4 AS (SELECT d9.*, skc.c3id, skc.tname, cat.b1name AS b1_name
  FROM d9 LEFT JOIN skc USING (sku_id) LEFT JOIN cat ON skc.c3id = cat.b3name),
{score_values('sp', PAY_TIME_SCORES)},
{score_values('sa', AMOUNT_SCORES)},
{score_values('sb', BRAND_SCORES)},
{score_values('sc', CATEGORY_SCORES)},
b4s AS (
  SELECT b4.*, {score_cols('sp', 'pay_time', W['pay_time'], 'b4.pay_time_slot')},
    {score_cols('sa', 'amount', W['amount'], 'x')},
    {score_cols('sb', 'tname', W['tname'], 'b4.tname', BRAND_DEFAULT)},
    {score_cols('sc', 'b1name', W['b1name'], 'b4.b1_name', CATEGORY_DEFAULT)}
  FROM b4 LEFT JOIN sp ON b4.pay_time_slot = sp.score_key
  LEFT JOIN sa ON ({AMOUNT_BAND}) = sa.score_key
  LEFT JOIN sb ON b4.tname = sb.score_key LEFT JOIN sc ON b4.b1_name = sc.score_key)"""


def age_expr(prefixes: list[str], alias: dict[str, str]) -> str:
    sums = []
    for b in B:
        parts = " + ".join(f"coalesce({alias.get(p, '')}{p}_{b}, 0.0)" for p in prefixes)
        sums.append(f"round({parts}, 6)")
    arr = "[" + ", ".join(sums) + "]"
    labels = "[" + ", ".join(f"'{b}'" for b in B) + "]"
    return f"{labels}[list_position({arr}, list_max({arr}))]"


LABEL_BASE = (EV, POS, DEV, CAT, CMP, B2)
ORDER_BASE = (OI, ORDERS, DETAILS, J10, D9, CAT, B4)


def bk(prefix: str) -> str:
    return ", ".join(f"{prefix}_{b}" for b in B)


ORACLE["label_device_info"] = with_(EV, POS, DEV) + "SELECT * EXCLUDE (event_id) FROM dev"
ORACLE["dedup_full_row"] = with_(EV, POS, DEV) + "SELECT DISTINCT uid, ts, ar, ch, os, vc, search_item FROM dev"
ORACLE["label_uid_profile_agg"] = with_(EV, POS, DEV) + """SELECT uid,
  array_to_string(list_sort(list_distinct(list(os))), ',') AS os, CAST(count(*) AS BIGINT) AS n_events,
  arg_max(search_item, ts) FILTER (WHERE search_item IS NOT NULL) AS search_item, max(ts) AS ts
FROM dev GROUP BY uid"""
ORACLE["label_last_per_window"] = with_(EV, POS, DEV) + """SELECT
  strftime(time_bucket(INTERVAL '1 hour', make_timestamp(ts * 1000)), '%Y-%m-%d %H:%M:%S') AS stt, * EXCLUDE (event_id)
FROM dev QUALIFY row_number() OVER (PARTITION BY uid, time_bucket(INTERVAL '1 hour', make_timestamp(ts * 1000)) ORDER BY ts DESC, event_id DESC) = 1"""

ORACLE["score_device"] = with_(*LABEL_BASE) + f"SELECT uid, ts, os, judge_os, {bk('device')} FROM b2s"
ORACLE["score_search"] = with_(*LABEL_BASE) + f"SELECT uid, ts, search_item, b1_category, search_category, {bk('search')} FROM b2s"

ORACLE["label_order_info"] = with_(OI, ORDERS) + "SELECT id, uid, create_time, total_amount, province_id, pay_time_slot, ts_ms FROM o"
ORACLE["ijoin_order_detail"] = with_(OI, ORDERS, DETAILS, J10) + """SELECT id, uid, detail_id, sku_id, sku_num,
  split_coupon_amount, split_activity_amount, split_total_amount, pay_time_slot, ts_ms FROM j10"""
ORACLE["strictly_newer_order_detail"] = with_(OI, ORDERS, DETAILS, J10, D9) + """SELECT detail_id, id, sku_id,
  CAST(source_id AS VARCHAR) AS source_id, create_time FROM d9"""

ORACLE["score_pay_time"] = with_(*ORDER_BASE) + f"SELECT detail_id, pay_time_slot, {bk('pay_time')} FROM b4s"
ORACLE["score_amount"] = with_(*ORDER_BASE) + f"SELECT detail_id, total_amount, {bk('amount')} FROM b4s"
ORACLE["score_brand"] = with_(*ORDER_BASE) + f"SELECT detail_id, tname, {bk('tname')} FROM b4s"
ORACLE["score_category"] = with_(*ORDER_BASE) + f"SELECT detail_id, b1_name, {bk('b1name')} FROM b4s"
ORACLE["score_age_argmax"] = with_(*ORDER_BASE) + f"""SELECT detail_id,
  {age_expr(['pay_time', 'b1name', 'tname', 'amount'], {})} AS age_level FROM b4s"""

USERS = f"""u AS (
  SELECT {vc('c_custkey')} AS uid, c_name AS uname,
    coalesce(CASE WHEN c_custkey % 3 = 0 THEN 'M' WHEN c_custkey % 3 = 1 THEN 'F' END, 'home') AS gender,
    strftime(DATE '1970-01-01' + CAST((c_custkey * 37) % 20000 AS INTEGER), '%Y-%m-%d') AS birthday,
    CAST({AS_OF_MS} AS BIGINT) AS ts_ms, DATE '1970-01-01' + CAST((c_custkey * 37) % 20000 AS INTEGER) AS bd
  FROM customer),
up AS (
  SELECT uid, uname, gender, birthday, ts_ms,
    CAST(year(bd) // 10 * 10 AS BIGINT) AS decade,
    CAST((20250512 - (year(bd) * 10000 + month(bd) * 100 + day(bd))) // 10000 AS BIGINT) AS age,
    CASE WHEN month(bd) * 100 + day(bd) <= 119 THEN '摩羯座' WHEN month(bd) * 100 + day(bd) <= 218 THEN '水瓶座'
         WHEN month(bd) * 100 + day(bd) <= 320 THEN '双鱼座' WHEN month(bd) * 100 + day(bd) <= 419 THEN '白羊座'
         WHEN month(bd) * 100 + day(bd) <= 520 THEN '金牛座' WHEN month(bd) * 100 + day(bd) <= 621 THEN '双子座'
         WHEN month(bd) * 100 + day(bd) <= 722 THEN '巨蟹座' WHEN month(bd) * 100 + day(bd) <= 822 THEN '狮子座'
         WHEN month(bd) * 100 + day(bd) <= 922 THEN '处女座' WHEN month(bd) * 100 + day(bd) <= 1023 THEN '天秤座'
         WHEN month(bd) * 100 + day(bd) <= 1122 THEN '天蝎座' WHEN month(bd) * 100 + day(bd) <= 1221 THEN '射手座'
         ELSE '摩羯座' END AS zodiac_sign
  FROM u),
sup AS (
  SELECT {vc('c_custkey')} AS uid, {vc('c_custkey % 50 + 150')} AS height, 'cm' AS unit_height,
    {vc('c_custkey % 40 + 45')} AS weight, 'kg' AS unit_weight,
    {AS_OF_MS} + (c_custkey % 13 - 6) * 60000 AS ts_ms
  FROM customer),
b6 AS (
  SELECT up.*, sup.height, sup.unit_height, sup.weight, sup.unit_weight
  FROM up JOIN sup ON up.uid = sup.uid AND sup.ts_ms BETWEEN up.ts_ms - 300000 AND up.ts_ms + 300000)"""

ORACLE["label_user_profile"] = with_(USERS) + "SELECT uid, uname, gender, birthday, decade, age, zodiac_sign, ts_ms FROM up"
ORACLE["ijoin_user_sup"] = with_(USERS) + """SELECT uid, gender, birthday, age, zodiac_sign, height, unit_height,
  weight, unit_weight, ts_ms FROM b6"""

AGES = f"""b4t AS (SELECT * REPLACE ({EPOCH_2024_MS} + (CAST(id AS BIGINT) % 720) * 3600000 AS ts_ms) FROM b4s),
ages AS (
  SELECT l.uid, l.ts AS ts_ms,
    {age_expr(['search', 'device', 'pay_time', 'b1name', 'tname', 'amount'], {'search': 'l.', 'device': 'l.', 'pay_time': 'r.', 'b1name': 'r.', 'tname': 'r.', 'amount': 'r.'})} AS age_level
  FROM b2s l JOIN b4t r ON l.uid = r.uid AND r.ts_ms BETWEEN l.ts - 86400000 AND l.ts + 86400000)"""

ORACLE["label_age_level"] = with_(*LABEL_BASE, OI, ORDERS, DETAILS, J10, D9, B4, AGES) + "SELECT * FROM ages"

ORACLE["label_final"] = with_(*LABEL_BASE, OI, ORDERS, DETAILS, J10, D9, B4, AGES, USERS) + f"""SELECT a.uid, r.ts_ms, a.age_level,
  r.gender, r.age, r.decade, r.zodiac_sign, r.height, r.weight
FROM ages a JOIN (SELECT * REPLACE ({EPOCH_2024_MS} + (CAST(uid AS BIGINT) % 30) * 86400000 AS ts_ms) FROM b6) r
  ON a.uid = r.uid AND r.ts_ms BETWEEN a.ts_ms - 86400000 AND a.ts_ms + 86400000"""

# ---- comments -----------------------------------------------------------------------------------

CF = """cf AS (
  SELECT ts_ms, 'retail' AS db, 'comment_info' AS "table", appraise, 'r' AS op, CAST(NULL AS VARCHAR) AS nick_name,
    CAST(create_time AS BIGINT) AS create_time, CAST(user_id AS BIGINT) AS user_id, CAST(sku_id AS BIGINT) AS sku_id,
    CAST(id AS BIGINT) AS id, CAST(sku_id AS BIGINT) - CAST(sku_id AS BIGINT) % 4 AS spu_id,
    CAST(id AS BIGINT) AS order_id, comment_txt
  FROM cm)"""

ORACLE["comment_flatten"] = with_(COMMENT, CF) + """SELECT ts_ms, db, "table", appraise, op, nick_name, create_time,
  user_id, sku_id, id, spu_id, order_id, md5(comment_txt) AS txt_md5 FROM cf"""

ORACLE["ijoin_comment_order"] = with_(COMMENT, CF, OI) + """SELECT c.id, c.order_id, c.ts_ms, oi.id AS info_id,
  oi.user_id AS info_user_id, oi.total_amount AS info_total_amount, 'r' AS info_op, CAST(oi.ts_ms AS VARCHAR) AS info_tm_ms
FROM cf c JOIN oi ON c.order_id = CAST(oi.id AS BIGINT) AND oi.ts_ms BETWEEN c.ts_ms - 60000 AND c.ts_ms + 60000"""

WORDS_SQL = "['die', 'que', 'und', 'les', 'was']"

ORACLE["comment_sensitive_flag"] = with_(COMMENT, CF) + rf"""SELECT id, user_id, hits, CAST(hits > 0 AS BIGINT) AS flagged FROM (
  SELECT id, user_id, CAST(len(list_filter(regexp_split_to_array(lower(comment_txt), '[^\p{{L}}\p{{N}}]+'),
                                           lambda t: list_contains({WORDS_SQL}, t))) AS BIGINT) AS hits
  FROM cf)"""

ORACLE["comment_sample"] = with_(COMMENT, CF) + "SELECT id, user_id, ts_ms, md5(comment_txt) AS txt_md5 FROM cf WHERE id % 5 = 0"

ORACLE["comment_ds"] = with_(COMMENT, CF) + "SELECT id, ts_ms, strftime(make_timestamp(ts_ms * 1000), '%Y%m%d') AS ds FROM cf"
