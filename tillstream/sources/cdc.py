"""Change-data-capture input derived from the driver tables.

The reference's ODS topic carries MySQL change envelopes
``{before, after, source{db, table}, op, ts_ms}`` with every payload value a
string. :func:`topic_db` builds the same envelopes from the TPC-H-ish tables
(column rules in FIXTURES.md), one projection per logical source table, so a
query that reads two source tables scans only those two.

Flat builders (``*_rows``) return the ``after`` payload as string columns plus
``ts_ms``; :func:`envelope` wraps any of them. Where a source table has
repeated primary keys (lineitem ids), the arrival order is
``(ts_ms, sku_id, source_id)`` (FIXTURES.md).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .logs import events_keyed
from .tables import epoch_ms, table

DB = "retail"
AS_OF = "2025-05-12"
AS_OF_MS = 1_747_008_000_000  # 2025-05-12T00:00:00Z

ENVELOPE_T = T.StructType(
    [
        T.StructField("before", T.MapType(T.StringType(), T.StringType())),
        T.StructField("after", T.MapType(T.StringType(), T.StringType())),
        T.StructField("source", T.MapType(T.StringType(), T.StringType())),
        T.StructField("op", T.StringType()),
        T.StructField("ts_ms", T.LongType()),
    ]
)
ENVELOPE_DDL = "before MAP<STRING,STRING>, after MAP<STRING,STRING>, source MAP<STRING,STRING>, op STRING, ts_ms BIGINT"

# Fixture values (FIXTURES.md): order status by TPC-H status, comment rating by label quality.
ORDER_STATUS = {"F": "1001", "O": "1002", "P": "1006"}
APPRAISE_BY_QUALITY = {1: "1201", 0: "1203"}
APPRAISE_UNLABELLED = "1204"


def s(c) -> Column:
    """any column -> string"""
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def dec2(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(16,2)")


# ---- flat payload builders ----------------------------------------------------------------------


def order_detail_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(*_detail_payload(epoch_ms("l_shipdate")))


def _detail_payload(ts: Column) -> list[Column]:
    """lineitem columns -> order_detail payload (strings) + ``ts_ms``; ``ts`` is the event time."""
    price = dec2("l_extendedprice")
    act = price * dec2("l_discount")
    cou = price * dec2("l_tax")
    return [
        F.concat_ws("-", s("l_orderkey"), s("l_linenumber")).alias("id"),
        s("l_orderkey").alias("order_id"),
        s("l_partkey").alias("sku_id"),
        F.concat(F.lit("sku-"), s("l_partkey")).alias("sku_name"),
        s(ts).alias("create_time"),
        s("l_suppkey").alias("source_id"),
        F.lit("2401").alias("source_type"),
        s(F.col("l_quantity").cast("bigint")).alias("sku_num"),
        s(price).alias("order_price"),
        s(price - act).alias("split_total_amount"),
        s(act).alias("split_activity_amount"),
        s(cou).alias("split_coupon_amount"),
        ts.alias("ts_ms"),
    ]


def label_detail_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """order_detail payload as the label job's interval join sees it: event time =
    the order's date + (line number - 3) minutes (FIXTURES.md, J-10)."""
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    j = li.join(o, li["l_orderkey"] == o["o_orderkey"], "inner")
    return j.select(*_detail_payload(epoch_ms("o_orderdate") + (F.col("l_linenumber") - 3) * 60_000))


def detail_arrival() -> list[Column]:
    """Total arrival order of order-detail changes (ties of ts_ms broken by sku, supplier)."""
    return [F.col("ts_ms"), F.col("sku_id").cast("bigint"), F.col("source_id").cast("bigint")]


def _latest_lineitem(li: DataFrame) -> DataFrame:
    """Latest lineitem version per detail id (arrival = shipdate, partkey, suppkey)."""
    from ..operators.state import latest_version

    keyed = li.withColumn("_id", F.concat_ws("-", s("l_orderkey"), s("l_linenumber")))
    return latest_version(keyed, "_id", ["l_shipdate", "l_partkey", "l_suppkey"])


def order_detail_activity_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").filter(F.col("l_discount") >= 0.05)
    li = li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    one = _latest_lineitem(li)
    aid = s(F.col("l_suppkey") % 5)
    return one.select(
        F.col("_id").alias("order_detail_id"),
        aid.alias("activity_id"),
        F.concat(aid, F.lit("-r")).alias("activity_rule_id"),
        epoch_ms("l_shipdate").alias("ts_ms"),
    )


def order_detail_coupon_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").filter(F.col("l_tax") >= 0.04)
    li = li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    one = _latest_lineitem(li)
    return one.select(
        F.col("_id").alias("order_detail_id"),
        s(F.col("l_suppkey") % 7).alias("coupon_id"),
        epoch_ms("l_shipdate").alias("ts_ms"),
    )


def order_info_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_name")
    j = o.join(c, o["o_custkey"] == c["c_custkey"], "inner")
    ts = epoch_ms("o_orderdate")
    status = F.when(F.col("o_orderstatus") == "F", ORDER_STATUS["F"])
    for k in ("O", "P"):
        status = status.when(F.col("o_orderstatus") == k, ORDER_STATUS[k])
    return j.select(
        s("o_orderkey").alias("id"),
        s("o_custkey").alias("user_id"),
        s("c_nationkey").alias("province_id"),
        status.alias("order_status"),
        s(ts).alias("operate_time"),
        F.col("c_name").alias("consignee"),
        s(ts).alias("create_time"),
        s(dec2("o_totalprice")).alias("original_total_amount"),
        s(dec2("o_totalprice")).alias("total_amount"),
        ts.alias("ts_ms"),
    )


def payment_info_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    ts = epoch_ms("o_orderdate")
    return o.select(
        s("o_orderkey").alias("id"),
        s("o_custkey").alias("user_id"),
        s("o_orderkey").alias("order_id"),
        F.substring("o_orderpriority", 1, 1).alias("payment_type"),
        s(ts).alias("callback_time"),
        F.when(F.col("o_orderpriority") == "5-LOW", "1601").otherwise("1602").alias("payment_status"),
        ts.alias("ts_ms"),
    )


def _refund_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").filter(F.col("l_returnflag") == "R")
    li = li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity", "l_extendedprice", "l_linestatus")
    return _latest_lineitem(li)


def order_refund_info_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _refund_lines(spark, sf_dir)
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    j = r.join(o, r["l_orderkey"] == o["o_orderkey"], "inner")
    ts = epoch_ms("l_shipdate")
    return j.select(
        F.col("_id").alias("id"),
        s("o_custkey").alias("user_id"),
        s("l_orderkey").alias("order_id"),
        s("l_partkey").alias("sku_id"),
        F.when(F.col("l_linestatus") == "F", "1502").otherwise("1503").alias("refund_type"),
        s(F.col("l_quantity").cast("bigint")).alias("refund_num"),
        s(dec2("l_extendedprice")).alias("refund_amount"),
        F.lit("1301").alias("refund_reason_type"),
        F.concat(F.lit("reason-"), s(F.col("l_suppkey") % 3)).alias("refund_reason_txt"),
        s(ts).alias("create_time"),
        F.when(F.col("l_linestatus") == "F", "0705").otherwise("0701").alias("refund_status"),
        ts.alias("ts_ms"),
    )


def refund_payment_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _refund_lines(spark, sf_dir).filter(F.col("l_linestatus") == "F")
    ts = epoch_ms("l_shipdate")
    return r.select(
        F.concat(F.lit("rp-"), F.col("_id")).alias("id"),
        s("l_orderkey").alias("order_id"),
        s("l_partkey").alias("sku_id"),
        F.lit("1101").alias("payment_type"),
        s(ts + 3_600_000).alias("callback_time"),
        s(dec2("l_extendedprice")).alias("total_amount"),
        F.lit("1602").alias("refund_status"),
        (ts + 3_600_000).alias("ts_ms"),
    )


def cart_info_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = events_keyed(spark, sf_dir).filter(F.col("event_type").isin("click", "purchase"))
    return ev.select(
        s("event_id").alias("id"),
        s("user_id").alias("user_id"),
        s("k").alias("sku_id"),
        s(F.col("k") % 3 + 1).alias("sku_num"),
        s("ts").alias("create_time"),
        F.col("ts").alias("ts_ms"),
    )


def comment_info_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    lab = table(spark, sf_dir, "labels").select("doc_id", "quality")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    j = d.join(lab, "doc_id", "left").join(o, d["doc_id"] == o["o_orderkey"], "left")
    ts = epoch_ms("o_orderdate") + (F.col("doc_id") % 7 - 3) * 30_000
    appraise = F.when(F.col("quality") == 1, APPRAISE_BY_QUALITY[1]).when(F.col("quality") == 0, APPRAISE_BY_QUALITY[0])
    sku = F.col("doc_id") % 200
    return j.select(
        s("doc_id").alias("id"),
        s("o_custkey").alias("user_id"),
        s(sku).alias("sku_id"),
        s(sku - sku % 4).alias("spu_id"),
        s("doc_id").alias("order_id"),
        appraise.otherwise(APPRAISE_UNLABELLED).alias("appraise"),
        F.col("text").alias("comment_txt"),
        s(ts).alias("create_time"),
        ts.alias("ts_ms"),
    )


def user_info_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    key = F.col("c_custkey")
    return c.select(
        s(key).alias("id"),
        F.col("c_name").alias("name"),
        F.lit("1").alias("user_level"),
        F.concat(F.lit("login"), s(key)).alias("login_name"),
        F.concat(F.lit("1380000"), F.lpad(s(key), 4, "0")).alias("phone_num"),
        F.concat(F.lit("u"), s(key), F.lit("@example.com")).alias("email"),
        F.when(key % 3 == 0, "M").when(key % 3 == 1, "F").alias("gender"),
        s((key * 37) % 20000).alias("birthday"),
        F.lit(AS_OF_MS).alias("ts_ms"),
    )


def user_info_sup_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey")
    key = F.col("c_custkey")
    ts = F.lit(AS_OF_MS) + (key % 13 - 6) * 60_000
    return c.select(
        s(key).alias("uid"),
        s(key % 50 + 150).alias("height"),
        F.lit("cm").alias("unit_height"),
        s(key % 40 + 45).alias("weight"),
        F.lit("kg").alias("unit_weight"),
        ts.alias("create_ts"),
        ts.alias("ts_ms"),
    )


BUILDERS = {
    "order_detail": order_detail_rows,
    "order_info": order_info_rows,
    "order_detail_activity": order_detail_activity_rows,
    "order_detail_coupon": order_detail_coupon_rows,
    "payment_info": payment_info_rows,
    "order_refund_info": order_refund_info_rows,
    "refund_payment": refund_payment_rows,
    "cart_info": cart_info_rows,
    "comment_info": comment_info_rows,
    "user_info": user_info_rows,
    "user_info_sup_msg": user_info_sup_rows,
}


# ---- envelopes ----------------------------------------------------------------------------------


def payload_map(df: DataFrame, exclude=("ts_ms",)) -> Column:
    """Flat string columns -> MAP<STRING,STRING> (null values kept, like JSON nulls)."""
    cols = [c for c in df.columns if c not in exclude]
    return F.create_map(*[x for c in cols for x in (F.lit(c), F.col(c).cast("string"))])


def source_map(tbl: str, db: str = DB) -> Column:
    return F.create_map(F.lit("db"), F.lit(db), F.lit("table"), F.lit(tbl), F.lit("server_id"), F.lit("1"))


def envelope(rows: DataFrame, tbl: str, op: str = "r", db: str = DB) -> DataFrame:
    """Snapshot rows -> CDC envelopes (op 'r': ``before`` is null)."""
    return rows.select(
        F.lit(None).cast("map<string,string>").alias("before"),
        payload_map(rows).alias("after"),
        source_map(tbl, db).alias("source"),
        F.lit(op).alias("op"),
        F.col("ts_ms").cast("bigint").alias("ts_ms"),
    )


def topic_db(spark: SparkSession, sf_dir: str, tables: list[str]) -> DataFrame:
    """The ODS topic restricted to ``tables`` (each a separate scan, unioned)."""
    parts = [envelope(BUILDERS[t](spark, sf_dir), t) for t in tables]
    return reduce(DataFrame.unionByName, parts)


def topic_db_text(spark: SparkSession, sf_dir: str, tables: list[str]) -> DataFrame:
    """The ODS topic as JSON text (``value``), as a Kafka consumer would see it."""
    return topic_db(spark, sf_dir, tables).select(F.to_json(F.struct("*")).alias("value"))


# ---- dimension change log (O-10, P-4, P-5) -------------------------------------------------------


def customer_change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two passes over ``customer`` (FIXTURES.md): pass 1 snapshots every row (op 'r');
    pass 2 deletes c_custkey%11=0 (op 'd', ``after`` null) and otherwise, for c_custkey%5=0,
    updates with ``segment`` blanked and ``balance`` + 1 (op 'u'). A third group of rows, c_custkey%13=0, is
    re-sent from another database and must be ignored by the validity filter.
    ``seq`` is the pass number."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment", "c_acctbal")
    key = F.col("c_custkey")
    base = F.create_map(
        F.lit("id"), s(key),
        F.lit("name"), F.col("c_name"),
        F.lit("nation"), s("c_nationkey"),
        F.lit("segment"), F.col("c_mktsegment"),
        F.lit("balance"), s(dec2("c_acctbal")),
    )
    # the update blanks ``segment`` (must not overwrite) and moves ``balance`` by one
    blanked = F.map_concat(
        base, F.create_map(F.lit("segment"), F.lit(""), F.lit("balance"), s(dec2("c_acctbal") + 1))
    )
    t0 = F.lit(AS_OF_MS) + key
    none = F.lit(None).cast("map<string,string>")
    recs = F.array(
        F.struct(none.alias("before"), base.alias("after"), F.lit("r").alias("op"), t0.alias("ts_ms"), F.lit(1).alias("seq"), F.lit(DB).alias("db")),
        F.when(
            key % 11 == 0,
            F.struct(base.alias("before"), none.alias("after"), F.lit("d").alias("op"), (t0 + 86_400_000).alias("ts_ms"), F.lit(2).alias("seq"), F.lit(DB).alias("db")),
        ).when(
            key % 5 == 0,
            F.struct(base.alias("before"), blanked.alias("after"), F.lit("u").alias("op"), (t0 + 86_400_000).alias("ts_ms"), F.lit(2).alias("seq"), F.lit(DB).alias("db")),
        ),
        F.when(
            key % 13 == 0,
            F.struct(none.alias("before"), base.alias("after"), F.lit("r").alias("op"), (t0 + 1).alias("ts_ms"), F.lit(3).alias("seq"), F.lit("legacy").alias("db")),
        ),
    )
    ex = c.select(F.explode(F.filter(recs, lambda r: r.isNotNull())).alias("e")).select("e.*")
    return ex.select(
        "before",
        "after",
        F.create_map(F.lit("db"), F.col("db"), F.lit("table"), F.lit("customer"), F.lit("server_id"), F.lit("1")).alias("source"),
        "op",
        F.col("ts_ms").cast("bigint").alias("ts_ms"),
        F.col("seq").cast("bigint").alias("seq"),
    )
