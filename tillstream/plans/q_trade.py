"""CDC / DWD trade facts / trade windows keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import cdc, enrich, facts, state, windows
from ..sources import cdc as src
from ..functions.time import window_strings
from ..sources import dims
from .catalog import query

DAY = "1 day"
HOUR = "1 hour"


def _topic(spark, sf_dir, *tables):
    return src.topic_db(spark, sf_dir, list(tables))


# ---- sources / envelopes -------------------------------------------------------------------------


@query("src_cdc_envelope")
def src_cdc_envelope(spark, sf_dir):
    """O-3: JSON envelope text -> typed envelope (``after`` as MAP) -> projection."""
    text = src.topic_db_text(spark, sf_dir, ["order_info"])
    env = text.select(F.from_json("value", src.ENVELOPE_DDL).alias("e")).select("e.*")
    return env.select(
        F.col("source")["table"].alias("tbl"),
        "op",
        *facts.after("id", "user_id", "province_id", "order_status", "total_amount"),
        "ts_ms",
    )


@query("ods_snapshot_envelope")
def ods_snapshot_envelope(spark, sf_dir):
    """O-4: snapshot rows wrapped as op='r' envelopes (pass-through of several tables)."""
    t = _topic(spark, sf_dir, "order_info", "user_info", "payment_info")
    return t.select(F.col("source")["table"].alias("tbl"), "op", F.col("after")["id"].alias("id"), "ts_ms")


@query("dim_rename_camel")
def dim_rename_camel(spark, sf_dir):
    """O-5: rows with underscore columns -> camelCase names."""
    oi = src.order_info_rows(spark, sf_dir).select("id", "user_id", "province_id", "order_status", "total_amount")
    return cdc.rename_camel(oi)


def _sku_dim(spark, sf_dir):
    return dims.sku(spark, sf_dir).withColumnRenamed("id", "row_key")


@query("dim_point_lookup")
def dim_point_lookup(spark, sf_dir):
    """O-6a: point reads of the sku dimension for every sku in the cart stream."""
    keys = src.cart_info_rows(spark, sf_dir).select(F.col("sku_id").alias("row_key"))
    return cdc.point_lookup(_sku_dim(spark, sf_dir), keys).select("row_key", "sku_name", "spu_id")


@query("dim_scan_limit")
def dim_scan_limit(spark, sf_dir):
    """O-6b: first 10 rows of the sku dimension in row-key order (the limit is the feature)."""
    return cdc.scan_limit(_sku_dim(spark, sf_dir), 10).select("row_key", "sku_name", "spu_id")


@query("dim_row_count")
def dim_row_count(spark, sf_dir):
    """O-6c."""
    return cdc.row_count(_sku_dim(spark, sf_dir))


# ---- CDC change handling (customer change log) ---------------------------------------------------


def _changes(spark, sf_dir):
    return src.customer_change_log(spark, sf_dir)


@query("cdc_valid_filter")
def cdc_valid_filter(spark, sf_dir):
    """P-4."""
    v = cdc.valid_changes(_changes(spark, sf_dir), src.DB)
    return v.select(F.col("after")["id"].alias("id"), "op", "seq")


@query("cdc_before_after")
def cdc_before_after(spark, sf_dir):
    """P-5."""
    ch = _changes(spark, sf_dir).filter(F.col("source")["db"] == src.DB)
    img = cdc.before_or_after(ch)
    return ch.select(img["id"].alias("id"), img["segment"].alias("segment"), img["balance"].alias("balance"), "op", "seq")


@query("cdc_after_else_before")
def cdc_after_else_before(spark, sf_dir):
    """P-5a."""
    ch = _changes(spark, sf_dir).filter(F.col("source")["db"] == src.DB)
    m = cdc.after_else_before(ch)
    return ch.select(m["id"].alias("id"), m["segment"].alias("segment"), m["op"].alias("op"), m["tm_ms"].alias("tm_ms"))


@query("upsert_latest_by_key")
def upsert_latest_by_key(spark, sf_dir):
    """O-7: final state of an upsert topic keyed by id; deletes are tombstones."""
    ch = _changes(spark, sf_dir).filter(F.col("source")["db"] == src.DB)
    img = cdc.before_or_after(ch)
    rows = ch.select(img["id"].alias("id"), "op", "seq", "ts_ms", F.col("after")["segment"].alias("segment"), F.col("after")["balance"].alias("balance"))
    return cdc.upsert_final(rows, "id", ["seq", "ts_ms"])


@query("dim_columnwise_upsert")
def dim_columnwise_upsert(spark, sf_dir):
    """O-10: wide-column merge with deletes."""
    ch = _changes(spark, sf_dir).filter(F.col("source")["db"] == src.DB)
    ch = ch.withColumn("row_key", cdc.before_or_after(ch)["id"])
    m = cdc.columnwise_merge(ch, "row_key", ["seq", "ts_ms"])
    c = F.col("cells")
    return m.select("row_key", c["name"].alias("name"), c["nation"].alias("nation"), c["segment"].alias("segment"), c["balance"].alias("balance"))


@query("cdc_table_route")
def cdc_table_route(spark, sf_dir):
    """P-17: one topic scan split by source table."""
    t = _topic(spark, sf_dir, "user_info", "user_info_sup_msg", "order_info")
    routed = t.filter(F.col("source")["table"].isin("user_info", "order_info"))
    key = F.coalesce(F.col("after")["id"], F.col("after")["uid"])
    return routed.select(F.col("source")["table"].alias("tbl"), key.alias("id"), "ts_ms")


def _dim_route(spark, sf_dir):
    cfg = cdc.fold_config(dims.config_dim_changes(spark))
    data = cdc.valid_changes(dims.dim_source_envelopes(spark, sf_dir), src.DB)
    return cdc.route_dim(data, cfg)


@query("dim_route")
def dim_route(spark, sf_dir):
    """O-13 (+ O-13a fold, O-12 prune)."""
    r = _dim_route(spark, sf_dir)
    return r.select("sink_table", "row_key", "op", F.col("data")["name"].alias("name"), F.col("data")["region_id"].alias("region_id"), F.size("data").cast("bigint").alias("n_cols"))


@query("route_prune_columns")
def route_prune_columns(spark, sf_dir):
    """O-12: the kept payload keys per routed row."""
    r = _dim_route(spark, sf_dir)
    return r.select("sink_table", "row_key", F.array_join(F.array_sort(F.map_keys("data")), ",").alias("kept"))


def _dwd_route(spark, sf_dir):
    ch = _changes(spark, sf_dir).filter(F.col("source")["db"] == src.DB)
    return cdc.route_dwd(ch, dims.config_dwd(spark))


@query("dwd_route")
def dwd_route(spark, sf_dir):
    """O-14."""
    r = _dwd_route(spark, sf_dir)
    d = F.col("data")
    return r.select("sink_table", d["id"].alias("id"), d["segment"].alias("segment"), d["name"].alias("name"), "ts_ms")


@query("route_dynamic_sink")
def route_dynamic_sink(spark, sf_dir):
    """O-9: topic per record from its config row; value = JSON of the pruned payload."""
    return cdc.dynamic_sink_records(_dwd_route(spark, sf_dir))


# ---- DWD facts -----------------------------------------------------------------------------------


@query("dwd_comment_info")
def dwd_comment_info(spark, sf_dir):
    """P-6."""
    c = facts.comment_info(_topic(spark, sf_dir, "comment_info"))
    return c.select("id", "user_id", "sku_id", "appraise", "create_time", F.md5("comment_txt").alias("txt_md5"), "ts_ms")


@query("dwd_comment_join")
def dwd_comment_join(spark, sf_dir):
    """J-1."""
    j = facts.comment_with_dic(_topic(spark, sf_dir, "comment_info"), dims.base_dic(spark))
    return j.select("id", "user_id", "sku_id", "appraise", "appraise_name", F.md5("comment_txt").alias("txt_md5"), "ts_ms")


@query("dwd_trade_cart_add")
def dwd_trade_cart_add(spark, sf_dir):
    """P-7."""
    return facts.cart_add(_topic(spark, sf_dir, "cart_info"))


@query("order_detail_projection")
def order_detail_projection(spark, sf_dir):
    """P-9."""
    return facts.order_detail(_topic(spark, sf_dir, "order_detail"))


def _trade_detail(spark, sf_dir, *extra):
    return facts.trade_order_detail(_topic(spark, sf_dir, "order_detail", "order_info", "order_detail_activity", "order_detail_coupon", *extra))


@query("dwd_trade_order_detail")
def dwd_trade_order_detail(spark, sf_dir):
    """J-2."""
    return _trade_detail(spark, sf_dir)


@query("dwd_trade_order_cancel")
def dwd_trade_order_cancel(spark, sf_dir):
    """J-3 (+ P-8)."""
    t = _topic(spark, sf_dir, "order_info")
    return facts.trade_order_cancel(_trade_detail(spark, sf_dir), t)


@query("dwd_trade_pay_suc")
def dwd_trade_pay_suc(spark, sf_dir):
    """J-4 (+ P-11)."""
    t = _topic(spark, sf_dir, "payment_info")
    return facts.trade_pay_success(_trade_detail(spark, sf_dir), t)


@query("dwd_trade_order_refund")
def dwd_trade_order_refund(spark, sf_dir):
    """J-5 (+ P-12)."""
    return facts.trade_order_refund(_topic(spark, sf_dir, "order_refund_info", "order_info"))


@query("dwd_trade_refund_pay_suc")
def dwd_trade_refund_pay_suc(spark, sf_dir):
    """J-6 (+ P-13)."""
    return facts.trade_refund_pay_success(_topic(spark, sf_dir, "refund_payment", "order_refund_info", "order_info"))


# ---- keyed state over trade facts ---------------------------------------------------------------


def _cart(spark, sf_dir):
    return facts.cart_add(_topic(spark, sf_dir, "cart_info"))


@query("cart_daily_unique")
def cart_daily_unique(spark, sf_dir):
    """D-2."""
    c = _cart(spark, sf_dir)
    return state.daily_unique(c, "user_id", "ts_ms", ["ts_ms", F.col("id").cast("bigint")]).select("id", "user_id", "ts_ms")


@query("dws_trade_cart_add_uu")
def dws_trade_cart_add_uu(spark, sf_dir):
    """D-2 + W-1."""
    c = state.daily_unique(_cart(spark, sf_dir), "user_id", "ts_ms", ["ts_ms", F.col("id").cast("bigint")])
    return windows.window_count(c, "ts_ms", HOUR, "cart_add_uu_ct")


def _detail_versions(spark, sf_dir):
    return facts.order_detail(_topic(spark, sf_dir, "order_detail"))


@query("order_retract_stream")
def order_retract_stream(spark, sf_dir):
    """D-3."""
    d = _detail_versions(spark, sf_dir).select(
        "id", "order_id", "sku_id", "source_id", F.col("split_total_amount").cast("decimal(18,4)").alias("amount"), "ts_ms"
    )
    r = state.retract_and_replace(d, "id", ["amount"], [F.col("ts_ms"), F.col("sku_id").cast("bigint"), F.col("source_id").cast("bigint")])
    return r.select("id", "order_id", F.col("amount").cast("string").alias("amount"), "ts_ms", F.col("sign").cast("bigint").alias("sign"))


@query("dws_trade_province_order")
def dws_trade_province_order(spark, sf_dir):
    """D-3 + W-2 + J-14."""
    t = _topic(spark, sf_dir, "order_detail", "order_info")
    d = facts.order_detail(t).select(
        "id", "order_id", "sku_id", "source_id", F.col("split_total_amount").cast("decimal(18,4)").alias("split_total_amount"), "ts_ms"
    )
    r = state.retract_and_replace(d, "id", ["split_total_amount"], [F.col("ts_ms"), F.col("sku_id").cast("bigint"), F.col("source_id").cast("bigint")])
    out = windows.province_order(r, facts.order_info(t), dims.province(spark, sf_dir), DAY)
    return out.withColumn("order_amount", F.col("order_amount").cast("string"))


@query("order_keep_latest")
def order_keep_latest(spark, sf_dir):
    """D-4."""
    d = _detail_versions(spark, sf_dir)
    k = state.keep_latest(d, "id", src.detail_arrival())
    return k.select("id", "sku_id", "split_total_amount", "ts_ms")


@query("dws_trade_sku_order")
def dws_trade_sku_order(spark, sf_dir):
    """D-4 + W-3 + J-15 lookup chain."""
    d = state.keep_latest(_detail_versions(spark, sf_dir), "id", src.detail_arrival())
    d = d.select(
        "sku_id",
        "ts_ms",
        *[F.col(c).cast("decimal(18,4)").alias(c) for c in ("split_original_amount", "split_activity_amount", "split_coupon_amount", "split_total_amount")],
    )
    agg = windows.sku_order(d, DAY)
    named = enrich.sku_lookup_chain(spark, sf_dir, agg)
    return named.select(
        *window_strings("window"),
        "sku_id", "sku_name", "spu_id", "spu_name", "trademark_id", "trademark_name",
        "category3_id", "category3_name", "category2_id", "category2_name", "category1_id", "category1_name",
        *[F.col(c).cast("string").alias(c) for c in windows.SKU_SUMS],
    )


@query("strictly_newer_detail")
def strictly_newer_detail(spark, sf_dir):
    """D-9: per detail id keep versions whose create_time beats every earlier version."""
    d = _detail_versions(spark, sf_dir).withColumn("ct", F.col("create_time").cast("bigint"))
    order = [F.col("sku_id").cast("bigint"), F.col("source_id").cast("bigint"), F.col("ts_ms")]
    out = state.strictly_newer(d, "id", "ct", order)
    return out.select("id", "sku_id", "source_id", "create_time")


@query("strictly_newer_user")
def strictly_newer_user(spark, sf_dir):
    """D-10: per user keep payments whose ts_ms beats every earlier (by id) payment of the user.
    Users are the hot-key risk here, so the chunked form bounds each task to one id chunk."""
    p = src.payment_info_rows(spark, sf_dir).withColumn("_arrival", F.col("id").cast("bigint"))
    out = state.strictly_newer_chunked(p, "user_id", "ts_ms", "_arrival", ARRIVAL_CHUNK)
    return out.select("id", "user_id", "ts_ms")


# Arrival-id chunk width for the hot-key-safe running maximum (result does not depend on it).
ARRIVAL_CHUNK = 4096


@query("dim_category_chain")
def dim_category_chain(spark, sf_dir):
    """J-7."""
    return enrich.category_chain(spark, sf_dir)


@query("dim_sku_chain")
def dim_sku_chain(spark, sf_dir):
    """J-8."""
    return enrich.sku_chain(spark, sf_dir)


@query("dim_enrich_generic")
def dim_enrich_generic(spark, sf_dir):
    """J-17: order rows enriched with the province dimension (miss keeps the row unchanged)."""
    oi = facts.order_info(_topic(spark, sf_dir, "order_info"))
    out = enrich.enrich(oi, dims.province(spark, sf_dir), "province_id", "id", {"name": "province_name", "region_id": "region_id"})
    return out.select("id", "user_id", "province_id", "province_name", "region_id", "ts_ms")


@query("dim_lookup_default")
def dim_lookup_default(spark, sf_dir):
    """J-16: comment appraise name looked up by md5 row key, default 'N/A'."""
    c = facts.comment_info(_topic(spark, sf_dir, "comment_info"))
    out = enrich.lookup_md5_default(c, dims.base_dic(spark), "appraise", "dic_code", "info.dic_name", "appraise_name")
    return out.select("id", "appraise", "appraise_name")
