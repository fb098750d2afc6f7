"""Tumbling-window aggregates of the DWS layer (W-1 ... W-9).

Every window is epoch-aligned and tumbling; its length is a parameter whose
default is the reference's value. Aggregates are plain ``groupBy(window(..))``
so Spark runs partial (map-side) aggregation and one shuffle of partial
results; lookups run after the aggregation, on the (small) window rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.time import ts_to_date, window_strings


def _win(ts_col: str, duration: str):
    return F.window(F.timestamp_millis(F.col(ts_col)), duration).alias("window")


def _finish(df: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    return df.select(*window_strings("window"), *keys, *measures)


def window_count(df: DataFrame, ts: str, duration: str, name: str) -> DataFrame:
    """W-1: un-keyed window, count of records."""
    agg = df.groupBy(_win(ts, duration)).agg(F.count(F.lit(1)).cast("bigint").alias(name))
    return _finish(agg, [], [name])


def window_sums(df: DataFrame, ts: str, duration: str, keys: list[str], sums: dict[str, str]) -> DataFrame:
    """Keyed (or un-keyed) window with ``out_name -> sum(col)`` measures (W-4, W-6, W-7)."""
    aggs = [F.sum(F.col(src)).cast("bigint").alias(out) for out, src in sums.items()]
    agg = df.groupBy(_win(ts, duration), *keys).agg(*aggs)
    return _finish(agg, keys, list(sums))


# Room for an event id below the time in one ordering number.
ID_SPAN = "1" + 19 * "0"


def _arrival(ts: str, event_id: str) -> Column:
    """(ts, event_id) as one decimal, so that the smallest pair is a plain hash aggregate."""
    return F.col(ts).cast("decimal(15,0)") * F.lit(ID_SPAN).cast("decimal(20,0)") + F.col(event_id).cast("decimal(19,0)")


def traffic_vc_ch_ar_is_new(page: DataFrame, duration: str = "10 seconds") -> DataFrame:
    """W-6 (+ D-6): page views per window and (vc, ch, ar, is_new): uv, sv, pv, duration sum.

    One scan. Records are first summed per (device, day, window, keys) with the smallest (ts, event_id) of
    each group, partial sums first, so a device holding a third of all rows ships one row per group and
    task. Over these reduced rows the group with the device's smallest arrival of the day gets uv = 1, and
    a last aggregation sums the groups per window and keys. Records without a device count as no
    visitor (N-19).
    """
    keys = ["vc", "ch", "ar", "is_new"]
    rows = page.select(
        F.col("common.mid").alias("mid"),
        *[F.col(f"common.{k}").alias(k) for k in keys],
        F.when(F.coalesce(F.col("page.last_page_id"), F.lit("")) == "", 1).otherwise(0).cast("bigint").alias("sv"),
        F.col("page.during_time").cast("bigint").alias("dur"),
        ts_to_date(F.col("ts")).alias("_day"),
        _win("ts", duration),
        _arrival("ts", "event_id").alias("_at"),
    )
    groups = rows.groupBy("mid", "_day", "window", *keys).agg(
        F.sum("sv").alias("sv"), F.count(F.lit(1)).alias("pv"), F.sum("dur").alias("dur"), F.min("_at").alias("_at")
    )
    first = F.row_number().over(Window.partitionBy("mid", "_day").orderBy(F.col("_at").asc_nulls_last()))
    flagged = groups.withColumn("uv", F.when(F.col("mid").isNotNull() & (first == 1), 1).otherwise(0))
    agg = flagged.groupBy("window", *keys).agg(
        F.sum("uv").cast("bigint").alias("uv_ct"),
        F.sum("sv").alias("sv_ct"),
        F.sum("pv").alias("pv_ct"),
        F.sum("dur").alias("dur_sum"),
    )
    return _finish(agg, keys, ["uv_ct", "sv_ct", "pv_ct", "dur_sum"])


def keyword_counts(words: DataFrame, ts: str = "ts", duration: str = "5 seconds") -> DataFrame:
    """W-5: ``TUMBLE`` over keywords, ``count(*)`` per (window, keyword)."""
    agg = words.groupBy(_win(ts, duration), "keyword").agg(F.count(F.lit(1)).cast("bigint").alias("keyword_count"))
    return _finish(agg, ["keyword"], ["keyword_count"])


def province_order(details: DataFrame, orders: DataFrame, provinces: DataFrame, duration: str = "10 seconds") -> DataFrame:
    """W-2 + J-14: details ⋈ orders; per province and window, order amount (signed, after D-3) and distinct
    order ids; province name looked up once per window row (left join: a missing province keeps the row).

    Both sides are partitioned and sorted by the order id once: the first record of an order in a window and
    the first of an (order, province) are marked in that sort, the join reuses it, and an order counts where
    both marks meet. ``count_distinct`` would hold all of a task's orders in two more hash maps.
    """
    rows = details.repartition("order_id").select("order_id", "split_total_amount", _win("ts_ms", duration))
    rows = rows.select("order_id", "split_total_amount", F.col("window.start").alias("_start"))
    own = orders.repartition("id").select(F.col("id").alias("_oid"), "province_id")
    rows = rows.withColumn("_first", F.row_number().over(Window.partitionBy("order_id", "_start").orderBy("_start")) == 1)
    own = own.withColumn("_one", F.row_number().over(Window.partitionBy("_oid", "province_id").orderBy("_oid")) == 1)
    j = rows.join(own, rows["order_id"] == own["_oid"], "inner")
    agg = j.groupBy(F.window("_start", duration).alias("window"), "province_id").agg(
        F.sum(F.col("split_total_amount")).alias("order_amount"),
        F.sum(F.when(F.col("_first") & F.col("_one"), 1).otherwise(0)).cast("bigint").alias("order_count"),
    )
    named = agg.join(provinces.select(F.col("id").alias("province_id"), F.col("name").alias("province_name")), "province_id", "left")
    return _finish(named, ["province_id", "province_name"], ["order_amount", "order_count"])


SKU_SUMS = {
    "original_amount": "split_original_amount",
    "activity_reduce_amount": "split_activity_amount",
    "coupon_reduce_amount": "split_coupon_amount",
    "order_amount": "split_total_amount",
}


def sku_order(details: DataFrame, duration: str = "10 seconds", ts: str = "ts_ms") -> DataFrame:
    """W-3: per sku and window, four decimal sums. Dimension names are attached afterwards
    (J-15) by :func:`tillstream.operators.enrich.sku_lookup_chain`."""
    aggs = [F.sum(F.col(src)).alias(out) for out, src in SKU_SUMS.items()]
    agg = details.groupBy(_win(ts, duration), "sku_id").agg(*aggs)
    return agg.select("window", "sku_id", *SKU_SUMS)
