"""DuckDB oracle SQL, one statement per query key.

Each statement derives the same logical inputs as :mod:`tillstream.sources`
(FIXTURES.md column rules) straight from the pre-registered parquet views
and computes the operator in plain SQL, independently of the Spark code.
Shared derivations are CTE fragments composed with :func:`with_`.
"""

from __future__ import annotations

ORACLE: dict[str, str] = {}


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def day(ms: str) -> str:
    """epoch ms -> 'yyyy-MM-dd' (UTC)."""
    return f"strftime(make_timestamp(({ms})*1000), '%Y-%m-%d')"


def dt(ms: str) -> str:
    return f"strftime(make_timestamp(({ms})*1000), '%Y-%m-%d %H:%M:%S')"


def win_cols(ms: str, interval: str) -> str:
    b = f"time_bucket(INTERVAL '{interval}', make_timestamp(({ms})*1000))"
    return (
        f"strftime({b}, '%Y-%m-%d %H:%M:%S') AS stt, "
        f"strftime({b} + INTERVAL '{interval}', '%Y-%m-%d %H:%M:%S') AS edt, "
        f"strftime({b}, '%Y-%m-%d') AS cur_date"
    )


# ---- behaviour log ------------------------------------------------------------------------------

EV = """ev AS (
  SELECT event_id, epoch_us(ts)//1000 AS ts, user_id, event_type, value,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
  FROM events)"""

LOG = """log AS (
  SELECT event_id, ts, k, event_type,
    CAST(user_id AS VARCHAR) AS mid,
    CASE WHEN k % 10 = 0 THEN NULL ELSE CAST(user_id AS VARCHAR) END AS uid,
    'v' || CAST(k % 3 AS VARCHAR) AS vc,
    'ch' || CAST(user_id % 4 AS VARCHAR) AS ch,
    CAST(user_id % 7 AS VARCHAR) AS ar,
    CASE WHEN user_id % 2 = 0 THEN '1' ELSE '0' END AS is_new,
    CASE WHEN user_id % 3 = 0 THEN 'iOS 13' WHEN user_id % 3 = 1 THEN 'Android 12' ELSE 'Other' END AS os,
    CASE event_type WHEN 'view' THEN 'home' WHEN 'click' THEN 'good_detail' WHEN 'signup' THEN 'login'
                    WHEN 'purchase' THEN 'payment' WHEN 'error' THEN 'mine' END AS page_id,
    CASE k % 4 WHEN 1 THEN 'login' WHEN 2 THEN 'search' WHEN 3 THEN 'home' END AS last_page_id,
    CASE WHEN k % 2 = 0 THEN 'keyword' ELSE 'sku_id' END AS item_type,
    event_type || ' kw' || CAST(k % 5 AS VARCHAR) AS item,
    CAST(floor(value * 100) AS BIGINT) AS during_time,
    event_type = 'error' AS has_err,
    event_type = 'signup' AS has_start,
    k % 4 AS n_displays, k % 3 AS n_actions, value
  FROM ev)"""

PAGE = "page AS (SELECT * FROM log WHERE NOT has_start)"

LOGINS = """logins AS (
  SELECT * FROM page
  WHERE coalesce(uid, '') <> '' AND (coalesce(last_page_id, '') = 'login' OR coalesce(last_page_id, '') = ''))"""

LOGIN_BACK = f"""lb AS (
  SELECT uid, ts, cur_date, CAST(1 AS BIGINT) AS uu_ct,
    CAST(CASE WHEN prev IS NOT NULL AND floor((ts - epoch_us(CAST(prev AS TIMESTAMP))//1000) / 86400000) >= 8
              THEN 1 ELSE 0 END AS BIGINT) AS back_ct
  FROM (SELECT uid, ts, cur_date, lag(cur_date) OVER (PARTITION BY uid ORDER BY cur_date) AS prev
        FROM (SELECT uid, {day('ts')} AS cur_date, min(ts) AS ts FROM logins GROUP BY 1, 2)))"""

SEARCH = """search AS (
  SELECT * FROM page WHERE last_page_id = 'search' AND item_type = 'keyword' AND item IS NOT NULL)"""

WORDS = r"""words AS (
  SELECT * FROM (SELECT mid, ts, unnest(regexp_split_to_array(lower(item), '\s+')) AS keyword FROM search)
  WHERE keyword <> '')"""

ORACLE["src_event_text"] = with_(EV, LOG) + """SELECT FALSE AS dirty, event_id, mid, uid, vc, page_id, last_page_id, item, during_time, ts,
  CAST(n_displays AS BIGINT) AS n_displays, has_err, has_start FROM log
UNION ALL SELECT TRUE, event_id, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM log WHERE k % 17 = 0"""

ORACLE["parse_dirty_split"] = with_(EV) + "SELECT '{bad ' || CAST(event_id AS VARCHAR) AS dirty FROM ev WHERE k % 17 = 0"

ORACLE["visitor_is_new_fix"] = with_(
    EV,
    LOG,
    f"""f AS (SELECT mid, CASE WHEN is_new = '1' THEN {day('ts')} ELSE {day('ts - 86400000')} END AS first_state
         FROM log WHERE mid IS NOT NULL QUALIFY row_number() OVER (PARTITION BY mid ORDER BY ts, event_id) = 1)""",
) + f"""SELECT l.mid, l.ts, l.is_new,
  CASE WHEN l.is_new = '1' AND f.first_state <> {day('l.ts')} THEN '0' ELSE l.is_new END AS is_new_fixed
FROM log l LEFT JOIN f USING (mid)"""

ORACLE["log_split_err"] = with_(EV, LOG) + """SELECT mid, ts, k AS error_code, 'err ' || CAST(k AS VARCHAR) AS msg,
  page_id, CAST(n_displays AS BIGINT) AS n_displays, CAST(n_actions AS BIGINT) AS n_actions
FROM log WHERE has_err"""

ORACLE["log_split_start"] = with_(EV, LOG) + """SELECT mid, uid, ts, 'icon' AS entry,
  CAST(floor(value * 10) AS BIGINT) AS loading_time
FROM log WHERE has_start"""

ORACLE["log_split_page"] = with_(EV, LOG, PAGE) + """SELECT mid, uid, vc, ch, ar, page_id, last_page_id, item,
  item_type, during_time, ts FROM page"""

ORACLE["log_split_display"] = with_(EV, LOG, PAGE) + """SELECT mid, page_id, CAST((k * i) % 50 AS VARCHAR) AS item,
  'sku_id' AS item_type, CAST(i AS BIGINT) AS pos_id, ts
FROM (SELECT *, unnest(generate_series(1, n_displays)) AS i FROM page WHERE n_displays > 0)"""

ORACLE["log_split_action"] = with_(EV, LOG, PAGE) + """SELECT mid, page_id, 'a' || CAST(i AS VARCHAR) AS action_id,
  CAST((k + i) % 50 AS VARCHAR) AS item, ts + i * 1000 AS action_ts
FROM (SELECT *, unnest(generate_series(1, n_actions)) AS i FROM page WHERE n_actions > 0)"""

ORACLE["page_view_measures"] = with_(EV, LOG, PAGE) + f"""SELECT mid, ts, vc, ch, ar, is_new,
  CAST(CASE WHEN mid IS NOT NULL AND row_number() OVER (PARTITION BY mid, {day('ts')} ORDER BY ts, event_id) = 1 THEN 1 ELSE 0 END AS BIGINT) AS uv_ct,
  CAST(CASE WHEN coalesce(last_page_id, '') = '' THEN 1 ELSE 0 END AS BIGINT) AS sv_ct,
  CAST(1 AS BIGINT) AS pv_ct, during_time AS dur_sum
FROM page"""

ORACLE["dws_traffic_vc_ch_ar_is_new"] = with_(
    EV,
    LOG,
    PAGE,
    f"""m AS (SELECT *, CASE WHEN mid IS NOT NULL AND row_number() OVER (PARTITION BY mid, {day('ts')} ORDER BY ts, event_id) = 1 THEN 1 ELSE 0 END AS uv,
                 CASE WHEN coalesce(last_page_id, '') = '' THEN 1 ELSE 0 END AS sv FROM page)""",
) + f"""SELECT {win_cols('ts', '1 hour')}, vc, ch, ar, is_new,
  CAST(sum(uv) AS BIGINT) AS uv_ct, CAST(sum(sv) AS BIGINT) AS sv_ct,
  CAST(count(*) AS BIGINT) AS pv_ct, CAST(sum(during_time) AS BIGINT) AS dur_sum
FROM m GROUP BY ALL"""

ORACLE["dws_traffic_home_detail"] = with_(
    EV,
    LOG,
    PAGE,
    f"""hd AS (SELECT page_id, min(ts) AS ts FROM page WHERE page_id IN ('home', 'good_detail')
              GROUP BY mid, {day('ts')}, page_id)""",
) + f"""SELECT {win_cols('ts', '1 hour')},
  CAST(sum(CASE WHEN page_id = 'home' THEN 1 ELSE 0 END) AS BIGINT) AS home_uv_ct,
  CAST(sum(CASE WHEN page_id = 'good_detail' THEN 1 ELSE 0 END) AS BIGINT) AS good_detail_uv_ct
FROM hd GROUP BY ALL"""

ORACLE["login_event_filter"] = with_(EV, LOG, PAGE, LOGINS) + "SELECT mid, uid, last_page_id, ts FROM logins"

ORACLE["user_login_back"] = with_(EV, LOG, PAGE, LOGINS, LOGIN_BACK) + "SELECT * FROM lb"

ORACLE["dws_user_login"] = with_(EV, LOG, PAGE, LOGINS, LOGIN_BACK) + f"""SELECT {win_cols('ts', '1 day')},
  CAST(sum(uu_ct) AS BIGINT) AS uu_ct, CAST(sum(back_ct) AS BIGINT) AS back_ct FROM lb GROUP BY ALL"""

ORACLE["keyword_tokenize"] = with_(EV, LOG, PAGE, SEARCH, WORDS) + "SELECT mid, ts, keyword FROM words"

ORACLE["dws_traffic_keyword"] = with_(EV, LOG, PAGE, SEARCH, WORDS) + f"""SELECT {win_cols('ts', '1 hour')}, keyword,
  CAST(count(*) AS BIGINT) AS keyword_count FROM words GROUP BY ALL"""
