"""DWD fact operators over the CDC topic (P-6 ... P-13, J-1 ... J-6).

Each reference SQL job is one function: filtered ``after[...]`` projections of
the envelope topic, then joins. Upsert sinks keyed by a primary key are
materialised as their final state (latest version per key, O-7). Joins are
plain equi-joins; Catalyst chooses broadcast (dictionaries, under the size
threshold) or sort-merge with AQE skew splitting for fact-to-fact joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import small
from ..functions.time import epoch_string_to_date
from ..sources.cdc import detail_arrival
from .state import keep_latest


def rows_of(topic: DataFrame, tbl: str, op: str | None = "r") -> DataFrame:
    """P-17: one source table's change rows (``source['table']`` and, optionally, ``op``)."""
    cond = F.col("source")["table"] == tbl
    if op is not None:
        cond = cond & (F.col("op") == op)
    return topic.filter(cond)


def after(*names: str, **renames: str) -> list:
    """``after['x'] AS x`` for each name, and ``after['src'] AS dst`` for renames."""
    cols = [F.col("after")[n].alias(n) for n in names]
    cols += [F.col("after")[src].alias(dst) for dst, src in renames.items()]
    return cols


def decimal_product_str(a: str, b: str):
    """P-9: cast(cast(a as decimal(16,2)) * cast(b as decimal(16,2)) as string) -> 4 decimals kept."""
    return (F.col("after")[a].cast("decimal(16,2)") * F.col("after")[b].cast("decimal(16,2)")).cast("string")


# ---- projections --------------------------------------------------------------------------------


def comment_info(topic: DataFrame) -> DataFrame:
    """P-6."""
    return rows_of(topic, "comment_info").select(
        *after("id", "user_id", "sku_id", "appraise", "comment_txt", "create_time"), "ts_ms"
    )


def cart_add(topic: DataFrame) -> DataFrame:
    """P-7: the reference's predicate and ``if`` reduce to ``op = 'r'`` and ``sku_num`` (N-2)."""
    return rows_of(topic, "cart_info").select(*after("id", "user_id", "sku_id", "sku_num"), "ts_ms")


def order_detail(topic: DataFrame) -> DataFrame:
    """P-9: order_detail projection with the decimal product ``split_original_amount``."""
    return rows_of(topic, "order_detail").select(
        *after("id", "order_id", "sku_id", "sku_name", "create_time", "source_id", "source_type", "sku_num"),
        decimal_product_str("sku_num", "order_price").alias("split_original_amount"),
        *after("split_total_amount", "split_activity_amount", "split_coupon_amount"),
        "ts_ms",
    )


def order_info(topic: DataFrame, statuses: tuple[str, ...] | None = None) -> DataFrame:
    """P-10 / P-8 / P-12: order_info projection, optionally restricted to some statuses."""
    rows = rows_of(topic, "order_info")
    if statuses is not None:
        st = F.col("after")["order_status"]
        rows = rows.filter(st.isNotNull() & st.isin(*statuses))
    return rows.select(*after("id", "user_id", "province_id", "order_status", "operate_time"), "ts_ms")


def detail_activity(topic: DataFrame) -> DataFrame:
    return rows_of(topic, "order_detail_activity").select(*after("order_detail_id", "activity_id", "activity_rule_id"))


def detail_coupon(topic: DataFrame) -> DataFrame:
    return rows_of(topic, "order_detail_coupon").select(*after("order_detail_id", "coupon_id"))


# ---- joins --------------------------------------------------------------------------------------


def comment_with_dic(topic: DataFrame, base_dic: DataFrame) -> DataFrame:
    """J-1: comment ⋈ dictionary on appraise = dic_code; the name is the nested ``info.dic_name`` (N-3).
    Inner join: comments whose code has no dictionary row are dropped."""
    c = comment_info(topic)
    dic = small(base_dic.select("dic_code", F.col("info.dic_name").alias("appraise_name")))
    j = c.join(dic, c["appraise"] == dic["dic_code"], "inner")
    return j.select("id", "user_id", "sku_id", "appraise", "appraise_name", "comment_txt", "ts_ms")


DETAIL_OUT = [
    "id", "order_id", "user_id", "sku_id", "sku_name", "province_id", "activity_id", "activity_rule_id",
    "coupon_id", "date_id", "create_time", "sku_num", "split_original_amount", "split_activity_amount",
    "split_coupon_amount", "split_total_amount", "ts_ms",
]


def trade_order_detail(topic: DataFrame) -> DataFrame:
    """J-2: order_detail ⋈ order_info ⟕ activity ⟕ coupon, as the upsert topic's final state.

    The latest detail version per id is taken first, so the two left joins on the
    detail id reuse its hash partitioning; the order join follows.
    """
    od = keep_latest(order_detail(topic), "id", detail_arrival())
    od = od.join(detail_activity(topic).withColumnRenamed("order_detail_id", "id"), "id", "left")
    od = od.join(detail_coupon(topic).withColumnRenamed("order_detail_id", "id"), "id", "left")
    oi = order_info(topic).select(F.col("id").alias("_oid"), "user_id", "province_id")
    j = od.join(oi, od["order_id"] == oi["_oid"], "inner")
    j = j.withColumn("date_id", epoch_string_to_date(F.col("create_time")))
    return j.select(*DETAIL_OUT)


def trade_order_cancel(detail: DataFrame, topic: DataFrame) -> DataFrame:
    """J-3: detail ⋈ cancelled orders (status 1001 or 1003); operate_time becomes cancel_time (N-16)."""
    oc = order_info(topic, ("1001", "1003")).select(F.col("id").alias("_oid"), F.col("operate_time").alias("cancel_time"), F.col("ts_ms").alias("_ts"))
    j = detail.join(oc, detail["order_id"] == oc["_oid"], "inner")
    cols = [c for c in DETAIL_OUT if c not in ("create_time", "ts_ms")]
    return j.select(*cols, "cancel_time", F.col("_ts").alias("ts_ms"))


def trade_pay_success(detail: DataFrame, topic: DataFrame) -> DataFrame:
    """J-4: paid payments (status 1602) ⋈ detail on order_id; split_total_amount -> split_payment_amount."""
    pay = rows_of(topic, "payment_info")
    st = F.col("after")["payment_status"]
    pay = pay.filter(st.isNotNull() & (st == "1602")).select(
        *after("user_id", "order_id", "callback_time", payment_type_code="payment_type"), F.col("ts_ms").alias("_ts")
    )
    d = detail.drop("user_id", "ts_ms").withColumnRenamed("id", "order_detail_id").withColumnRenamed("order_id", "_doid")
    j = pay.join(d, pay["order_id"] == d["_doid"], "inner")
    return j.select(
        "order_detail_id", "order_id", "user_id", "sku_id", "sku_name", "province_id", "activity_id",
        "activity_rule_id", "coupon_id", "payment_type_code", "callback_time", "sku_num", "split_original_amount",
        "split_activity_amount", "split_coupon_amount", F.col("split_total_amount").alias("split_payment_amount"),
        F.col("_ts").alias("ts_ms"),
    )


def trade_order_refund(topic: DataFrame) -> DataFrame:
    """J-5: refund requests ⋈ orders in status 1006; refund_type -> refund_type_code (N-16)."""
    ri = rows_of(topic, "order_refund_info").select(
        *after("id", "user_id", "order_id", "sku_id", "refund_type", "refund_num", "refund_amount",
               "refund_reason_type", "refund_reason_txt", "create_time"),
        "ts_ms",
    )
    oi = order_info(topic, ("1006",)).select(F.col("id").alias("_oid"), "province_id")
    j = ri.join(oi, ri["order_id"] == oi["_oid"], "inner")
    return j.select(
        "id", "user_id", "order_id", "sku_id", "province_id",
        epoch_string_to_date(F.col("create_time")).alias("date_id"), "create_time",
        F.col("refund_type").alias("refund_type_code"), F.col("refund_reason_type").alias("refund_reason_type_code"),
        "refund_reason_txt", "refund_num", "refund_amount", "ts_ms",
    )


def trade_refund_pay_success(topic: DataFrame) -> DataFrame:
    """J-6: refund payments (1602) ⋈ refund infos (0705) on (order_id, sku_id) ⋈ orders (1006)."""
    rp_rows = rows_of(topic, "refund_payment")
    st = F.col("after")["refund_status"]
    rp = rp_rows.filter(st.isNotNull() & (st == "1602")).select(
        *after("id", "order_id", "sku_id", "payment_type", "callback_time", "total_amount"), "ts_ms"
    )
    ri_rows = rows_of(topic, "order_refund_info")
    st2 = F.col("after")["refund_status"]
    ri = ri_rows.filter(st2.isNotNull() & (st2 == "0705")).select(
        *after(_roid="order_id", _rsku="sku_id", refund_num="refund_num")
    )
    oi = order_info(topic, ("1006",)).select(F.col("id").alias("_oid"), "user_id", "province_id")
    j = rp.join(ri, (rp["order_id"] == ri["_roid"]) & (rp["sku_id"] == ri["_rsku"]), "inner")
    j = j.join(oi, j["order_id"] == oi["_oid"], "inner")
    return j.select(
        "id", "user_id", "order_id", "sku_id", "province_id", F.col("payment_type").alias("payment_type_code"),
        epoch_string_to_date(F.col("callback_time")).alias("date_id"), "callback_time", "refund_num",
        F.col("total_amount").alias("refund_amount"), "ts_ms",
    )
