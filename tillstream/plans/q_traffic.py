"""Traffic / behaviour-log keys: parse + split (DWD) and traffic windows (DWS)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import logsplit, state, text, windows
from ..sources.logs import log_text, page_log
from .catalog import flat, query

TEST_WINDOW = "1 hour"
TEST_DAY_WINDOW = "1 day"


def _clean_log(spark, sf_dir):
    return logsplit.clean_rows(logsplit.parse_log(log_text(spark, sf_dir)))


def _page_topic(spark, sf_dir):
    """Page rows as the DWS jobs read them (typed log, start rows excluded)."""
    return logsplit.split_page(page_log(spark, sf_dir))


@query("src_event_text")
def src_event_text(spark, sf_dir):
    """O-1: value-only text source (batch form of the topic), with the fields of each line."""
    v = F.col("value")
    dirty = v.startswith("{bad ")

    def field(path: str, kind: str = "string"):
        return F.get_json_object(v, f"$.{path}").try_cast(kind)

    return log_text(spark, sf_dir).select(
        dirty.alias("dirty"),
        F.when(dirty, F.substring_index(v, " ", -1).try_cast("bigint")).otherwise(field("event_id", "bigint")).alias("event_id"),
        field("common.mid").alias("mid"),
        field("common.uid").alias("uid"),
        field("common.vc").alias("vc"),
        field("page.page_id").alias("page_id"),
        field("page.last_page_id").alias("last_page_id"),
        field("page.item").alias("item"),
        field("page.during_time", "bigint").alias("during_time"),
        field("ts", "bigint").alias("ts"),
        F.when(~dirty, F.size(F.from_json(field("displays"), "array<struct<item:string>>"))).cast("bigint").alias("n_displays"),
        F.when(~dirty, field("err").isNotNull()).alias("has_err"),
        F.when(~dirty, field("start").isNotNull()).alias("has_start"),
    )


@query("parse_dirty_split")
def parse_dirty_split(spark, sf_dir):
    """P-1 side output: raw text of every malformed line."""
    return logsplit.dirty_rows(logsplit.parse_log(log_text(spark, sf_dir)))


@query("visitor_is_new_fix")
def visitor_is_new_fix(spark, sf_dir):
    """D-1 on the parsed clean log."""
    log = _clean_log(spark, sf_dir)
    fixed = logsplit.fix_is_new(log.withColumn("orig_is_new", F.col("common.is_new")))
    return flat(fixed, {"mid": "common.mid", "ts": "ts", "is_new": "orig_is_new", "is_new_fixed": "common.is_new"})


@query("log_split_err")
def log_split_err(spark, sf_dir):
    err = logsplit.split_err(_clean_log(spark, sf_dir))
    return err.select(
        F.col("common.mid").alias("mid"),
        "ts",
        F.col("err.error_code").alias("error_code"),
        F.col("err.msg").alias("msg"),
        F.col("page.page_id").alias("page_id"),
        F.size("displays").cast("bigint").alias("n_displays"),
        F.size("actions").cast("bigint").alias("n_actions"),
    )


@query("log_split_start")
def log_split_start(spark, sf_dir):
    st = logsplit.split_start(_clean_log(spark, sf_dir))
    return flat(st, {"mid": "common.mid", "uid": "common.uid", "ts": "ts", "entry": "start.entry", "loading_time": "start.loading_time"})


@query("log_split_page")
def log_split_page(spark, sf_dir):
    pg = logsplit.split_page(_clean_log(spark, sf_dir))
    return flat(
        pg,
        {
            "mid": "common.mid",
            "uid": "common.uid",
            "vc": "common.vc",
            "ch": "common.ch",
            "ar": "common.ar",
            "page_id": "page.page_id",
            "last_page_id": "page.last_page_id",
            "item": "page.item",
            "item_type": "page.item_type",
            "during_time": "page.during_time",
            "ts": "ts",
        },
    )


@query("log_split_display")
def log_split_display(spark, sf_dir):
    d = logsplit.split_display(_clean_log(spark, sf_dir))
    return flat(
        d,
        {
            "mid": "common.mid",
            "page_id": "page.page_id",
            "item": "display.item",
            "item_type": "display.item_type",
            "pos_id": "display.pos_id",
            "ts": "ts",
        },
    )


@query("log_split_action")
def log_split_action(spark, sf_dir):
    a = logsplit.split_action(_clean_log(spark, sf_dir))
    return flat(a, {"mid": "common.mid", "page_id": "page.page_id", "action_id": "action.action_id", "item": "action.item", "action_ts": "action.ts"})


@query("page_view_measures")
def page_view_measures(spark, sf_dir):
    """D-6 per page record."""
    return state.page_view_measures(_page_topic(spark, sf_dir))


@query("dws_traffic_vc_ch_ar_is_new")
def dws_traffic_vc_ch_ar_is_new(spark, sf_dir):
    """Flagship: page topic -> D-6 -> W-6 -> stt/edt/cur_date."""
    return windows.traffic_vc_ch_ar_is_new(_page_topic(spark, sf_dir), TEST_WINDOW)


def _page_flat(spark, sf_dir):
    return flat(
        _page_topic(spark, sf_dir),
        {
            "mid": "common.mid",
            "uid": "common.uid",
            "page_id": "page.page_id",
            "last_page_id": "page.last_page_id",
            "item": "page.item",
            "item_type": "page.item_type",
            "ts": "ts",
        },
    )


@query("dws_traffic_home_detail")
def dws_traffic_home_detail(spark, sf_dir):
    """P-14 + D-5 + W-4."""
    uv = state.home_detail_daily_uv(_page_flat(spark, sf_dir))
    return windows.window_sums(uv, "ts", TEST_WINDOW, [], {"home_uv_ct": "home_uv_ct", "good_detail_uv_ct": "good_detail_uv_ct"})


def _logins(spark, sf_dir):
    """P-15: uid non-empty and (previous page is login or empty)."""
    p = _page_flat(spark, sf_dir)
    last = F.coalesce(F.col("last_page_id"), F.lit(""))
    return p.filter((F.coalesce(F.col("uid"), F.lit("")) != "") & ((last == "login") | (last == "")))


@query("login_event_filter")
def login_event_filter(spark, sf_dir):
    return _logins(spark, sf_dir).select("mid", "uid", "last_page_id", "ts")


@query("user_login_back")
def user_login_back(spark, sf_dir):
    """D-7."""
    return state.login_back(_logins(spark, sf_dir))


@query("dws_user_login")
def dws_user_login(spark, sf_dir):
    """D-7 + W-7."""
    rows = state.login_back(_logins(spark, sf_dir))
    return windows.window_sums(rows, "ts", TEST_DAY_WINDOW, [], {"uu_ct": "uu_ct", "back_ct": "back_ct"})


def _search_rows(spark, sf_dir):
    """P-16: last page 'search', item_type 'keyword', item present."""
    p = _page_flat(spark, sf_dir)
    return p.filter((F.col("last_page_id") == "search") & (F.col("item_type") == "keyword") & F.col("item").isNotNull())


@query("keyword_tokenize")
def keyword_tokenize(spark, sf_dir):
    """U-1 over the search items."""
    return text.explode_keywords(_search_rows(spark, sf_dir), "item").select("mid", "ts", "keyword")


@query("dws_traffic_keyword")
def dws_traffic_keyword(spark, sf_dir):
    """P-16 + U-1 + W-5."""
    words = text.explode_keywords(_search_rows(spark, sf_dir), "item")
    return windows.keyword_counts(words, "ts", TEST_WINDOW)
