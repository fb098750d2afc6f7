"""DuckDB oracle SQL for scalar-function keys, P-24 and O-11a."""

from __future__ import annotations

from .oracle import EV, ORACLE, with_
from .oracle_trade import OD, OI

ORACLE["fn_epoch_to_date"] = with_(OI) + """SELECT id, operate_time,
  strftime(make_timestamp(CAST(operate_time AS BIGINT) * 1000), '%Y-%m-%d') AS date_id FROM oi"""

ORACLE["fn_date_formats"] = with_(EV) + """SELECT event_id, strftime(make_timestamp(ts * 1000), '%Y-%m-%d') AS d,
  strftime(make_timestamp(ts * 1000), '%Y-%m-%d %H:%M:%S') AS dt, strftime(make_timestamp(ts * 1000), '%Y%m%d') AS ds
FROM ev"""

ORACLE["fn_datetime_to_ts"] = with_(EV) + """SELECT event_id,
  epoch_us(date_trunc('second', make_timestamp(ts * 1000)))//1000 - 28800000 AS ts_from_dt,
  epoch_us(date_trunc('day', make_timestamp(ts * 1000)))//1000 - 28800000 AS ts_from_d,
  CAST(trunc((ts - (epoch_us(TIMESTAMP '2024-01-01')//1000 - 28800000)) / 86400000) AS BIGINT) AS days_since
FROM ev"""

ORACLE["fn_string_ops"] = with_(OD) + """SELECT id, split_part(id, '-', 1) AS order_part, replace(id, '-', '_') AS id_key,
  CAST(-CAST(split_total_amount AS DECIMAL(38,4)) AS VARCHAR) AS retract_amount,
  CAST(coalesce(source_type, '') = '' AS BIGINT) AS no_source, 'order_detail:' || id AS cache_key, md5(id) AS row_key
FROM od"""

BD = "DATE '1970-01-01' + CAST((c_custkey * 37) % 20000 AS INTEGER)"

ORACLE["fn_age_years"] = f"""SELECT c_custkey AS uid, strftime({BD}, '%Y-%m-%d') AS birthday,
  CAST((20250512 - (year({BD}) * 10000 + month({BD}) * 100 + day({BD}))) // 10000 AS BIGINT) AS age,
  CAST(year({BD}) // 10 * 10 AS BIGINT) AS decade
FROM customer"""

MD = f"(month({BD}) * 100 + day({BD}))"

ORACLE["fn_zodiac"] = f"""SELECT c_custkey AS uid, strftime({BD}, '%Y-%m-%d') AS birthday,
  CASE WHEN {MD} <= 119 THEN '摩羯座' WHEN {MD} <= 218 THEN '水瓶座' WHEN {MD} <= 320 THEN '双鱼座'
       WHEN {MD} <= 419 THEN '白羊座' WHEN {MD} <= 520 THEN '金牛座' WHEN {MD} <= 621 THEN '双子座'
       WHEN {MD} <= 722 THEN '巨蟹座' WHEN {MD} <= 822 THEN '狮子座' WHEN {MD} <= 922 THEN '处女座'
       WHEN {MD} <= 1023 THEN '天秤座' WHEN {MD} <= 1122 THEN '天蝎座' WHEN {MD} <= 1221 THEN '射手座'
       ELSE '摩羯座' END AS zodiac_sign
FROM customer"""

ORACLE["fn_pay_time_slot"] = with_(EV) + """SELECT event_id, CAST(hour(make_timestamp(ts * 1000)) AS BIGINT) AS hour,
  CASE WHEN hour(make_timestamp(ts * 1000)) < 6 THEN '凌晨' WHEN hour(make_timestamp(ts * 1000)) < 9 THEN '早晨'
       WHEN hour(make_timestamp(ts * 1000)) < 12 THEN '上午' WHEN hour(make_timestamp(ts * 1000)) < 14 THEN '中午'
       WHEN hour(make_timestamp(ts * 1000)) < 18 THEN '下午' WHEN hour(make_timestamp(ts * 1000)) < 22 THEN '晚上'
       ELSE '夜间' END AS slot
FROM ev"""

ORACLE["fn_map_merge"] = with_(OI) + """SELECT id, '0.00' AS total_amount, 'r' AS op, user_id AS info_user_id,
  CAST(9 AS BIGINT) AS n_keys FROM oi"""

ORACLE["region_city_filter"] = f"""SELECT c_custkey AS code, r_name AS province, n_name AS city,
  coalesce(CASE WHEN c_custkey % 3 <> 0 THEN c_mktsegment END, n_name, r_name) AS area
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
WHERE c_custkey % 7 <> 0 AND r_name NOT IN ('ASIA', 'EUROPE', 'MIDDLE EAST')"""


def _bean_json() -> str:
    from .oracle_trade import ORACLE as O

    base = O["dws_trade_province_order"]
    return f"""SELECT json_object('stt', stt, 'edt', edt, 'cur_date', cur_date, 'province_id', province_id,
  'province_name', province_name, 'order_amount', order_amount, 'order_count', order_count)::VARCHAR AS json
FROM ({base})"""


ORACLE["bean_to_snake_json"] = _bean_json()
