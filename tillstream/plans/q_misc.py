"""Scalar-function keys (F-*), the region filter (P-24) and bean -> JSON (O-11a)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import maps, text, time
from ..operators import cdc, facts
from ..sources import cdc as src
from ..sources.logs import events_keyed
from ..sources.tables import table
from .catalog import query


@query("fn_epoch_to_date")
def fn_epoch_to_date(spark, sf_dir):
    """F-2: epoch-ms strings -> yyyy-MM-dd."""
    oi = facts.order_info(src.topic_db(spark, sf_dir, ["order_info"]))
    return oi.select("id", "operate_time", time.epoch_string_to_date(F.col("operate_time")).alias("date_id"))


@query("fn_date_formats")
def fn_date_formats(spark, sf_dir):
    """F-3: tsToDate / tsToDateTime / tsToDateForPartition."""
    ev = events_keyed(spark, sf_dir)
    return ev.select(
        "event_id",
        time.ts_to_date(F.col("ts")).alias("d"),
        time.ts_to_datetime(F.col("ts")).alias("dt"),
        time.ts_to_partition(F.col("ts")).alias("ds"),
    )


@query("fn_datetime_to_ts")
def fn_datetime_to_ts(spark, sf_dir):
    """F-4: datetime / date strings read at the fixed +08:00 offset -> epoch ms; F-5 whole-day gap."""
    ev = events_keyed(spark, sf_dir).select("event_id", "ts", time.ts_to_datetime(F.col("ts")).alias("dt"), time.ts_to_date(F.col("ts")).alias("d"))
    return ev.select(
        "event_id",
        time.datetime_to_ts(F.col("dt")).alias("ts_from_dt"),
        time.date_to_ts(F.col("d")).alias("ts_from_d"),
        time.day_diff(F.col("ts"), F.lit("2024-01-01")).alias("days_since"),
    )


@query("fn_string_ops")
def fn_string_ops(spark, sf_dir):
    """F-7: first token before a separator, '-' prefix, '-' -> '_', emptiness, string compare."""
    d = facts.order_detail(src.topic_db(spark, sf_dir, ["order_detail"]))
    return d.select(
        "id",
        text.first_token(F.col("id"), "-").alias("order_part"),
        text.underscored(F.col("id")).alias("id_key"),
        text.negate_amount(F.col("split_total_amount")).alias("retract_amount"),
        text.is_empty(F.col("source_type")).cast("bigint").alias("no_source"),
        text.join_key(F.lit("order_detail"), F.col("id")).alias("cache_key"),
        text.md5_key(F.col("id")).alias("row_key"),
    )


def _customers(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey")
    bd = F.to_date(time.epoch_day_to_date((F.col("c_custkey") * 37) % 20000))
    return c.select(F.col("c_custkey").alias("uid"), bd.alias("birthday"))


@query("fn_age_years")
def fn_age_years(spark, sf_dir):
    """F-9 + F-10 (as of the fixture date; 29 Feb safe)."""
    c = _customers(spark, sf_dir)
    return c.select("uid", F.date_format("birthday", "yyyy-MM-dd").alias("birthday"), time.age_years(F.col("birthday"), F.lit(src.AS_OF).cast("date")).alias("age"), time.decade(F.col("birthday")).alias("decade"))


@query("fn_zodiac")
def fn_zodiac(spark, sf_dir):
    """F-11."""
    c = _customers(spark, sf_dir)
    return c.select("uid", F.date_format("birthday", "yyyy-MM-dd").alias("birthday"), time.zodiac(F.col("birthday")).alias("zodiac_sign"))


@query("fn_pay_time_slot")
def fn_pay_time_slot(spark, sf_dir):
    """F-12 over event times."""
    ev = events_keyed(spark, sf_dir)
    return ev.select("event_id", F.hour(F.timestamp_millis("ts")).cast("bigint").alias("hour"), time.pay_time_slot(F.col("ts")).alias("slot"))


@query("fn_map_merge")
def fn_map_merge(spark, sf_dir):
    """F-16: right-wins map merge and key prefixing over CDC payloads."""
    t = facts.rows_of(src.topic_db(spark, sf_dir, ["order_info"]), "order_info")
    extra = F.create_map(F.lit("total_amount"), F.lit("0.00"), F.lit("op"), F.col("op"))
    merged = maps.merge_right_wins(F.col("after"), extra)
    prefixed = maps.prefix_keys(F.col("after"), "info_")
    return t.select(
        merged["id"].alias("id"),
        merged["total_amount"].alias("total_amount"),
        merged["op"].alias("op"),
        prefixed["info_user_id"].alias("info_user_id"),
        F.size(prefixed).cast("bigint").alias("n_keys"),
    )


@query("region_city_filter")
def region_city_filter(spark, sf_dir):
    """P-24 over a code table built from customer ⋈ nation ⋈ region (city nullable, area nullable)."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    codes = c.join(n, c["c_nationkey"] == n["n_nationkey"]).join(r, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("c_custkey").alias("code"),
        F.col("r_name").alias("province"),
        F.when(F.col("c_custkey") % 7 != 0, F.col("n_name")).alias("city"),
        F.when(F.col("c_custkey") % 3 != 0, F.col("c_mktsegment")).alias("area"),
    )
    return text.region_city_filter(codes, excluded=("ASIA", "EUROPE", "MIDDLE EAST"))


@query("bean_to_snake_json")
def bean_to_snake_json(spark, sf_dir):
    """O-11a: the province-window bean serialised as snake_case JSON (non-serialised fields dropped)."""
    from .q_trade import dws_trade_province_order

    w = dws_trade_province_order(spark, sf_dir)
    bean = w.select(
        "stt", "edt", F.col("cur_date").alias("curDate"), F.col("province_id").alias("provinceId"),
        F.col("province_name").alias("provinceName"), F.col("order_amount").alias("orderAmount"),
        F.col("order_count").alias("orderCount"), F.lit(None).cast("string").alias("orderDetailId"),
        F.array().cast("array<string>").alias("orderIdSet"),
    )
    return cdc.bean_to_snake_json(bean, drop=("orderDetailId", "orderIdSet"))
