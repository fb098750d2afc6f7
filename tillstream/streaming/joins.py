"""The DWD joins as streams (J-2 ... J-6) and what follows them (W-2).

A streaming equi-join keeps both sides as keyed state (:class:`.processors.ChangelogJoin`) and emits a changelog: a row, and later
its correction when another side arrives or changes. Each join is a query of its own whose changelog is the topic of the next one,
as the layers of the warehouse are chained; the last changelog goes into an upsert sink (O-7), whose state is the batch key's
result, in whatever order and however late the sides have arrived. State is kept for ``RETAIN_MS`` after a row's last change (D-12).

Rows whose join key is null meet nothing: they bypass the state, so no group gathers them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.time import epoch_string_to_date
from ..operators import facts, state
from ..session import prepare
from ..sources import cdc as src
from ..sources import dims
from . import processors as P
from .twins import DAY, _as_stream, _scratch, _tws, run, run_foreach, topic
from .sinks import UpsertSink
from .sources import event_time

#: 30 min 5 s, the idle-state retention of the reference's joins (D-12).
RETAIN_MS = 1_805_000
CHANGE = "k string, l_id string, r_id string, op string, seq long, l string, r string"


def order_key(*cols: str | Column) -> Column:
    """Whole numbers as one string that sorts as they do (nulls first)."""
    return F.concat_ws("|", *[F.lpad(F.coalesce((F.col(c) if isinstance(c, str) else c).cast("bigint").cast("string"), F.lit("")), 20, "0") for c in cols])


def side(rows: DataFrame, key: list[str], ident: list[str], order: Column, op: Column | str = "u") -> DataFrame:
    """Rows as the state takes them: ``(k, id, ord, op, body)``; the body is the row as JSON. ``k`` is null if a key column is."""
    whole = [F.col(c).isNotNull() for c in key]
    k = F.when(whole[0] if len(whole) == 1 else whole[0] & whole[1], F.concat_ws("\x1f", *key))
    return rows.select(
        k.alias("k"), F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ident]).alias("id"), order.alias("ord"),
        (F.lit(op) if isinstance(op, str) else op).alias("op"), F.to_json(F.struct(*[c for c in rows.columns if c not in ("pk", "op", "seq")])).alias("body"),
    )


def changelog_join(left: DataFrame, right: DataFrame, outer: bool = False, ttl_ms: int | None = RETAIN_MS) -> DataFrame:
    """Stream of changes ``CHANGE`` of left ⋈ right (⟕ if ``outer``), both as :func:`side` makes them."""
    both = left.withColumn("side", F.lit("l")).unionByName(right.withColumn("side", F.lit("r")))
    joined = _tws(both.where("k IS NOT NULL"), "k", P.ChangelogJoin(outer, ttl_ms), CHANGE)
    if not outer:
        return joined
    alone = left.where("k IS NULL").select("k", F.col("id").alias("l_id"), F.lit(None).cast("string").alias("r_id"), "op", F.lit(0).cast("bigint").alias("seq"), F.col("body").alias("l"), F.lit(None).cast("string").alias("r"))
    return joined.unionByName(alone)


def joined_rows(changes: DataFrame, left: StructType, right: StructType, drop: tuple[str, ...] = ()) -> DataFrame:
    """A changelog as ``(pk, op, seq, left columns, right columns)``."""
    l, r = F.from_json("l", left), F.from_json("r", right)
    cols = [l[f].alias(f) for f in left.names] + [r[f].alias(f) for f in right.names if f not in left.names and f not in drop]
    pk = F.concat_ws("\x1e", "l_id", F.coalesce("r_id", F.lit("")))
    return changes.select(pk.alias("pk"), "op", "seq", *cols)


def join_topics(spark: SparkSession, name: str, left: DataFrame, right: DataFrame, l: DataFrame, r: DataFrame, outer: bool = False, ttl_ms: int | None = RETAIN_MS) -> DataFrame:
    """One join as a query: sides ``l`` and ``r`` made of the streams ``left`` and ``right``; returns the changelog topic (a batch table that
    :func:`follow` turns into the next query's stream)."""
    changes = run(spark, changelog_join(l, r, outer, ttl_ms), name, timed=ttl_ms is not None)
    skip = ("pk", "op", "seq")
    shape = [StructType([f for f in s.schema.fields if f.name not in skip]) for s in (left, right)]
    return joined_rows(changes, *shape)


def follow(spark: SparkSession, name: str, changelog: DataFrame) -> DataFrame:
    """A changelog as the next query's stream: written as a topic and read as files arrive."""
    path = _scratch(spark, f"topic-{name}")
    changelog.write.parquet(path)
    return spark.readStream.schema(changelog.schema).parquet(path)


def final_state(spark: SparkSession, changelog: DataFrame, name: str) -> DataFrame:
    """What an upsert sink holds after the changelog stream has run into it."""
    sink = UpsertSink(_scratch(spark, f"upsert-{name}"), "pk", ["seq"])
    run_foreach(spark, follow(spark, name, changelog), name, sink)
    return sink.state(spark).drop("pk", "op", "seq")


# ---- the jobs ----------------------------------------------------------------------------------


def _rows(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return src.topic_db(spark, sf_dir, [table])


def _arriving(spark: SparkSession, rows: DataFrame, name: str, batches: int = 3) -> DataFrame:
    """A side replayed in an order of its own, so some rows come before those they join with and some after."""
    return topic(spark, rows.withColumn("arr", F.xxhash64(*rows.columns)), name, "arr", batches).drop("arr")


def order_detail_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J-2 as three queries: detail ⟕ activity ⟕ coupon ⋈ order. Returns the changelog of ``facts.DETAIL_OUT``."""
    detail = topic(spark, facts.order_detail(_rows(spark, sf_dir, "order_detail")), "detail", "ts_ms", 3)
    extra = {
        "activity": _arriving(spark, facts.detail_activity(_rows(spark, sf_dir, "order_detail_activity")), "activity"),
        "coupon": _arriving(spark, facts.detail_coupon(_rows(spark, sf_dir, "order_detail_coupon")), "coupon"),
    }
    changes, left = None, side(detail, ["id"], ["id"], order_key("ts_ms", "sku_id", "source_id"))
    held = detail
    for name, rows in extra.items():
        right = side(rows, ["order_detail_id"], rows.columns, F.lit("0"))
        changes = join_topics(spark, f"detail_{name}", held, rows, left, right, outer=True).drop("order_detail_id")
        held = follow(spark, f"detail_{name}", changes)
        left = side(held, ["id"], ["pk"], order_key("seq"), F.col("op"))
    orders = _arriving(spark, facts.order_info(_rows(spark, sf_dir, "order_info")).select(F.col("id").alias("_oid"), "user_id", "province_id", F.col("ts_ms").alias("_ts")), "orders")
    left = side(held, ["order_id"], ["pk"], order_key("seq"), F.col("op"))
    out = join_topics(spark, "detail_order", held, orders, left, side(orders, ["_oid"], ["_oid"], order_key("_ts")))
    return out.withColumn("date_id", epoch_string_to_date(F.col("create_time"))).select("pk", "op", "seq", *facts.DETAIL_OUT)


def trade_order_detail(spark: SparkSession, sf_dir: str, detail: DataFrame | None = None) -> DataFrame:
    """J-2 twin. ``detail`` is the changelog of :func:`order_detail_changes` where it has been made before."""
    prepare(spark)
    return final_state(spark, order_detail_changes(spark, sf_dir) if detail is None else detail, "order_detail")


def _with_detail(spark: SparkSession, sf_dir: str, name: str, changes: DataFrame | None, other: DataFrame, key: str, ident: list[str], order: Column, keep: list[str]) -> DataFrame:
    """The J-2 changelog (columns ``keep``) ⋈ ``other`` on the order id, as a changelog."""
    changes = order_detail_changes(spark, sf_dir) if changes is None else changes
    detail = follow(spark, f"{name}_detail", changes.select("pk", "op", "seq", *keep))
    left = side(detail, ["order_id"], ["pk"], order_key("seq"), F.col("op"))
    return join_topics(spark, name, detail, other, left, side(other, [key], ident, order))


def trade_order_cancel(spark: SparkSession, sf_dir: str, detail: DataFrame | None = None) -> DataFrame:
    """J-3 twin: detail changelog ⋈ cancelled orders."""
    prepare(spark)
    cols = [c for c in facts.DETAIL_OUT if c not in ("create_time", "ts_ms")]
    orders = facts.order_info(_rows(spark, sf_dir, "order_info"), ("1001", "1003")).select(F.col("id").alias("_oid"), F.col("operate_time").alias("cancel_time"), "ts_ms")
    out = _with_detail(spark, sf_dir, "order_cancel", detail, _arriving(spark, orders, "cancelled"), "_oid", ["_oid"], order_key("ts_ms"), cols)
    return final_state(spark, out.select("pk", "op", "seq", *cols, "cancel_time", "ts_ms"), "order_cancel")


def trade_pay_success(spark: SparkSession, sf_dir: str, detail: DataFrame | None = None) -> DataFrame:
    """J-4 twin: detail changelog ⋈ paid payments."""
    prepare(spark)
    st = F.col("after")["payment_status"]
    pay = facts.rows_of(_rows(spark, sf_dir, "payment_info"), "payment_info").filter(st.isNotNull() & (st == "1602"))
    pay = pay.select(*facts.after("user_id", "callback_time", _poid="order_id", _pid="id", payment_type_code="payment_type"), "ts_ms")
    keep = [c for c in facts.DETAIL_OUT if c not in ("user_id", "ts_ms", "date_id", "create_time")]
    out = _with_detail(spark, sf_dir, "pay_suc", detail, _arriving(spark, pay, "paid"), "_poid", ["_pid", "_poid"], order_key("ts_ms"), keep)
    cols = ["sku_id", "sku_name", "province_id", "activity_id", "activity_rule_id", "coupon_id", "payment_type_code", "callback_time", "sku_num", "split_original_amount", "split_activity_amount", "split_coupon_amount"]
    out = out.select("pk", "op", "seq", F.col("id").alias("order_detail_id"), "order_id", "user_id", *cols, F.col("split_total_amount").alias("split_payment_amount"), "ts_ms")
    return final_state(spark, out, "pay_suc")


def _refund_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = facts.order_info(_rows(spark, sf_dir, "order_info"), ("1006",))
    return _arriving(spark, rows.select(F.col("id").alias("_oid"), F.col("user_id").alias("o_user_id"), "province_id", F.col("ts_ms").alias("_ts")), "refund_orders")


def trade_order_refund(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J-5 twin: refund requests ⋈ orders in status 1006."""
    prepare(spark)
    fields = ("id", "user_id", "order_id", "sku_id", "refund_type", "refund_num", "refund_amount", "refund_reason_type", "refund_reason_txt", "create_time")
    refund = topic(spark, facts.rows_of(_rows(spark, sf_dir, "order_refund_info"), "order_refund_info").select(*facts.after(*fields), "ts_ms"), "refund", "ts_ms", 3)
    orders = _refund_orders(spark, sf_dir)
    out = join_topics(spark, "order_refund", refund, orders, side(refund, ["order_id"], ["id"], order_key("ts_ms")), side(orders, ["_oid"], ["_oid"], order_key("_ts")))
    cols = ["id", "user_id", "order_id", "sku_id", "province_id", epoch_string_to_date(F.col("create_time")).alias("date_id"), "create_time"]
    cols += [F.col("refund_type").alias("refund_type_code"), F.col("refund_reason_type").alias("refund_reason_type_code"), "refund_reason_txt", "refund_num", "refund_amount", "ts_ms"]
    return final_state(spark, out.select("pk", "op", "seq", *cols), "order_refund")


def trade_refund_pay_success(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J-6 twin: refund payments ⋈ refund infos on (order, sku), then ⋈ orders in status 1006."""
    prepare(spark)

    def settled(table: str, status: str) -> DataFrame:
        st = F.col("after")["refund_status"]
        return facts.rows_of(_rows(spark, sf_dir, table), table).filter(st.isNotNull() & (st == status))

    pay = topic(spark, settled("refund_payment", "1602").select(*facts.after("id", "order_id", "sku_id", "payment_type", "callback_time", "total_amount"), "ts_ms"), "refund_payment", "ts_ms", 3)
    info = _arriving(spark, settled("order_refund_info", "0705").select(*facts.after(_rid="id", _roid="order_id", _rsku="sku_id", refund_num="refund_num"), F.col("ts_ms").alias("_rts")), "refund_info")
    paid = join_topics(spark, "refund_paid", pay, info, side(pay, ["order_id", "sku_id"], ["id"], order_key("ts_ms")), side(info, ["_roid", "_rsku"], ["_rid"], order_key("_rts")))
    held, orders = follow(spark, "refund_paid", paid), _refund_orders(spark, sf_dir)
    out = join_topics(spark, "refund_pay_suc", held, orders, side(held, ["order_id"], ["pk"], order_key("seq"), F.col("op")), side(orders, ["_oid"], ["_oid"], order_key("_ts")))
    cols = ["id", F.col("o_user_id").alias("user_id"), "order_id", "sku_id", "province_id", F.col("payment_type").alias("payment_type_code"), epoch_string_to_date(F.col("callback_time")).alias("date_id"), "callback_time", "refund_num", F.col("total_amount").alias("refund_amount"), "ts_ms"]
    return final_state(spark, out.select("pk", "op", "seq", *cols), "refund_pay_suc")


# ---- W-2 ---------------------------------------------------------------------------------------


def province_window(spark: SparkSession, sf_dir: str, duration: str = DAY) -> DataFrame:
    """W-2 twin: D-3's corrected details get their order's province, each order is counted once per province and window,
    and the window sums amounts and counts under a watermark of its own. Names are looked up after the window (J-14)."""
    prepare(spark)
    detail = topic(spark, facts.order_detail(_rows(spark, sf_dir, "order_detail")), "detail", "ts_ms").select(
        "id", "order_id", F.col("split_total_amount").cast("decimal(18,4)").cast("string").alias("amount"), F.col("ts_ms").cast("string").alias("ts_ms"),
        F.col("sku_id").cast("bigint").alias("arr_sku"), F.col("source_id").cast("bigint").alias("arr_src"), F.col("ts_ms").alias("arr_ts"),
    )
    out = ["id", "order_id", "amount", "ts_ms", "arr_sku", "arr_src"]
    versions = run(spark, _tws(detail, "id", P.RetractReplace("amount", ["arr_ts", "arr_sku", "arr_src"], out), ", ".join(f"{c} string" for c in [*out, "sign"])), "retract")
    held = _as_stream(spark, versions)
    orders = _arriving(spark, facts.order_info(_rows(spark, sf_dir, "order_info")).select(F.col("id").alias("_oid"), "province_id", F.col("ts_ms").alias("_ts")), "orders")
    left = side(held, ["order_id"], ["id", "ts_ms", "arr_sku", "arr_src", "sign"], F.lit("0"))
    placed = join_topics(spark, "detail_province", held, orders, left, side(orders, ["_oid"], ["_oid"], order_key("_ts")))
    start = F.unix_millis(F.window(F.timestamp_millis(F.col("ts_ms").cast("bigint")), duration)["start"])
    events = placed.select("province_id", "order_id", F.col("ts_ms").cast("bigint").alias("ts_ms"), "amount", start.alias("w"))
    flagged = _tws(follow(spark, "province_events", events), ["province_id", "order_id"], P.FirstOfKey("w", ["province_id", "ts_ms", "amount"], "first", RETAIN_MS), "province_id string, ts_ms long, amount string, first long")
    counted = run(spark, flagged, "province_first", timed=True)
    timed = topic(spark, counted, "province", "ts_ms").withColumn("event_time", event_time("ts_ms")).withWatermark("event_time", "0 seconds")
    agg = timed.groupBy(F.window("event_time", duration), "province_id").agg(F.sum(F.col("amount").cast("decimal(18,4)")).cast("string").alias("order_amount"), F.sum("first").cast("bigint").alias("order_count"))
    at = "yyyy-MM-dd HH:mm:ss"
    sums = run(spark, agg.select(F.date_format("window.start", at).alias("stt"), F.date_format("window.end", at).alias("edt"), F.date_format("window.start", "yyyy-MM-dd").alias("cur_date"), "province_id", "order_amount", "order_count"), "province_window")
    return sums.join(dims.province(spark, sf_dir).select(F.col("id").alias("province_id"), F.col("name").alias("province_name")), "province_id", "left")


#: key -> (twin, whether its last windows stay open)
TWINS = {
    "dwd_trade_order_detail": (trade_order_detail, False),
    "dwd_trade_order_cancel": (trade_order_cancel, False),
    "dwd_trade_pay_suc": (trade_pay_success, False),
    "dwd_trade_order_refund": (trade_order_refund, False),
    "dwd_trade_refund_pay_suc": (trade_refund_pay_success, False),
    "dws_trade_province_order": (province_window, True),
}
