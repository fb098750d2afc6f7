"""Behaviour-log input derived from the ``events`` table.

The reference consumes app logs shaped as
``{common{...}, page{...}, displays[], actions[], err, start, ts}``. Here the
same shape is derived from ``events`` with the column rules of FIXTURES.md
("page log" rows). Two forms are offered:

* :func:`page_log` – the typed, already-parsed log (one row per event);
* :func:`log_text` – the raw JSON text topic (one ``value`` string per line),
  including one dirty line for every event whose ``k % 17 == 0``.

Both are single-scan projections of ``events``: the text form uses
``explode`` over a 1-or-2 element array instead of a union so the table is
read once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import epoch_ms, small, table

# Fixture values (FIXTURES.md "page log"): event type -> page id, k%4 -> previous page.
PAGE_OF_EVENT = {"view": "home", "click": "good_detail", "signup": "login", "purchase": "payment", "error": "mine"}
LAST_PAGE_BY_K4 = {1: "login", 2: "search", 3: "home"}

COMMON_T = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("ar", "ch", "is_new", "mid", "os", "sid", "uid", "vc")]
)
PAGE_T = T.StructType(
    [
        T.StructField("during_time", T.LongType()),
        T.StructField("item", T.StringType()),
        T.StructField("item_type", T.StringType()),
        T.StructField("last_page_id", T.StringType()),
        T.StructField("page_id", T.StringType()),
    ]
)
DISPLAY_T = T.StructType(
    [
        T.StructField("item", T.StringType()),
        T.StructField("item_type", T.StringType()),
        T.StructField("pos_id", T.LongType()),
    ]
)
ACTION_T = T.StructType(
    [
        T.StructField("action_id", T.StringType()),
        T.StructField("item", T.StringType()),
        T.StructField("ts", T.LongType()),
    ]
)
ERR_T = T.StructType([T.StructField("error_code", T.LongType()), T.StructField("msg", T.StringType())])
START_T = T.StructType([T.StructField("entry", T.StringType()), T.StructField("loading_time", T.LongType())])

LOG_T = T.StructType(
    [
        T.StructField("common", COMMON_T),
        T.StructField("page", PAGE_T),
        T.StructField("displays", T.ArrayType(DISPLAY_T)),
        T.StructField("actions", T.ArrayType(ACTION_T)),
        T.StructField("err", ERR_T),
        T.StructField("start", START_T),
        T.StructField("ts", T.LongType()),
        T.StructField("event_id", T.LongType()),
    ]
)


def events_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events with ``k`` (props.k) and epoch-ms ``ts``."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        "event_id",
        epoch_ms("ts").alias("ts"),
        "user_id",
        "event_type",
        "value",
        F.get_json_object("props", "$.k").cast("bigint").alias("k"),
    )


def _case(col, mapping: dict, default=None):
    expr = None
    for key, val in mapping.items():
        expr = (F.when(col == F.lit(key), F.lit(val))) if expr is None else expr.when(col == F.lit(key), F.lit(val))
    return expr.otherwise(F.lit(default)) if default is not None else expr


def _log_columns(ev: DataFrame, keyword_item=None) -> list:
    k, uid, et = F.col("k"), F.col("user_id"), F.col("event_type")
    item = F.concat(et, F.lit(" kw"), (k % 5).cast("string"))
    if keyword_item is not None:
        item = F.when(k % 2 == 0, keyword_item).otherwise(item)
    common = F.struct(
        (uid % 7).cast("string").alias("ar"),
        F.concat(F.lit("ch"), (uid % 4).cast("string")).alias("ch"),
        F.when(uid % 2 == 0, "1").otherwise("0").alias("is_new"),
        uid.cast("string").alias("mid"),
        F.when(uid % 3 == 0, "iOS 13").when(uid % 3 == 1, "Android 12").otherwise("Other").alias("os"),
        F.concat(F.lit("s"), uid.cast("string")).alias("sid"),
        F.when(k % 10 == 0, F.lit(None).cast("string")).otherwise(uid.cast("string")).alias("uid"),
        F.concat(F.lit("v"), (k % 3).cast("string")).alias("vc"),
    )
    page = F.struct(
        F.floor(F.col("value") * 100).cast("bigint").alias("during_time"),
        item.alias("item"),
        F.when(k % 2 == 0, "keyword").otherwise("sku_id").alias("item_type"),
        _case(k % 4, LAST_PAGE_BY_K4).alias("last_page_id"),
        _case(et, PAGE_OF_EVENT).alias("page_id"),
    )
    displays = F.slice(
        F.array(
            *[
                F.struct(
                    ((k * i) % 50).cast("string").alias("item"),
                    F.lit("sku_id").alias("item_type"),
                    F.lit(i).cast("bigint").alias("pos_id"),
                )
                for i in (1, 2, 3)
            ]
        ),
        1,
        (k % 4).cast("int"),
    )
    actions = F.slice(
        F.array(
            *[
                F.struct(
                    F.lit(f"a{i}").alias("action_id"),
                    ((k + i) % 50).cast("string").alias("item"),
                    (F.col("ts") + i * 1000).alias("ts"),
                )
                for i in (1, 2)
            ]
        ),
        1,
        (k % 3).cast("int"),
    )
    err = F.when(et == "error", F.struct(k.alias("error_code"), F.concat(F.lit("err "), k.cast("string")).alias("msg")))
    start = F.when(
        et == "signup",
        F.struct(F.lit("icon").alias("entry"), F.floor(F.col("value") * 10).cast("bigint").alias("loading_time")),
    )
    return [
        common.alias("common"),
        page.alias("page"),
        displays.alias("displays"),
        actions.alias("actions"),
        err.alias("err"),
        start.alias("start"),
        F.col("ts"),
        F.col("event_id"),
    ]


def page_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed behaviour log, one row per event (no dirty lines)."""
    ev = events_keyed(spark, sf_dir)
    return ev.select(*_log_columns(ev))


def label_page_log(spark: SparkSession, sf_dir: str, positions: DataFrame | None = None) -> DataFrame:
    """Typed log as the label pipeline sees it: a keyword search item is a category-3 name,
    the one at position ``k % n`` of the ``n`` sorted names (FIXTURES.md, search item for M-2).
    ``positions`` lets a stream twin pass the (static) category positions."""
    from .dims import category3_positions

    ev = events_keyed(spark, sf_dir)
    pos = small(positions if positions is not None else category3_positions(spark, sf_dir))
    ev = ev.join(pos, F.pmod(ev["k"], F.lit(max(pos.count(), 1))) == pos["pos"], "left")
    return ev.select(*_log_columns(ev, F.col("name")))


def log_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw JSON log topic: ``value STRING``; nulls are omitted by ``to_json``.

    A topic is dealt to partitions when it is written; the hint leaves their number to AQE, so writing and parsing
    the lines run in parallel however few row groups the events file has."""
    ev = events_keyed(spark, sf_dir).hint("rebalance")
    line = F.to_json(F.struct(*_log_columns(ev)))
    dirty = F.when(F.col("k") % 17 == 0, F.concat(F.lit("{bad "), F.col("event_id").cast("string")))
    # the nulls go after the explode: a filtered array would be made twice, once for a filter that Catalyst infers
    return ev.select(F.explode(F.array(line, dirty)).alias("value")).where("value is not null")
