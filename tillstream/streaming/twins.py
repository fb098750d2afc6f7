"""Streaming twins of the ``(s)`` keys.

A twin replays the logical input of its key (:func:`tillstream.streaming.sources.replay`: several files in
arrival order, one file per micro-batch) and runs the stream-native mechanism: watermarks + windows,
``transformWithStateInPandas`` for keyed state, stream-stream interval joins, stream-static joins, and
``foreachBatch`` change-log sinks for upserts. ``run`` drives a query with ``trigger(availableNow=True)``
into a parquet sink under the shared checkpoint folder and returns the written rows as a batch DataFrame.

Keyed state followed by a window is two queries: the second reads what the first has written and sets its
own watermark (T-5), which is also how the layers of the warehouse are chained through topics.

In append mode a window is emitted once the watermark passes its end, so the last windows of a bounded
replay stay open; ``closed`` names the windows that a twin must have emitted.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import cdc, comments, facts, labels, logsplit, state, text
from ..operators.interval import stream_interval_join
from ..session import checkpoint_dir, prepare
from ..sources import cdc as src
from ..sources import dims
from ..sources.logs import label_page_log, log_text, page_log
from . import processors as P
from .sinks import ColumnwiseSink, UpsertSink
from .sources import event_time, replay, text_source

HOUR, DAY = "1 hour", "1 day"


def _scratch(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:10]}"


def topic(spark: SparkSession, df: DataFrame, name: str, order: str, batches: int = 4) -> DataFrame:
    return replay(spark, df, _scratch(spark, f"topic-{name}"), order, batches)


def run(spark: SparkSession, df: DataFrame, name: str, mode: str = "append", timed: bool = False, base: str | None = None) -> DataFrame:
    """Run a streaming frame to completion (availableNow) into parquet; return what was written.

    ``timed``: the frame's state lives in processing time (TTL or timers). Such a query always asks for another batch, so it
    must not run batches without data here. ``base`` names the folder, to run a query on from where it was.
    """
    base, idle = base or _scratch(spark, name), "spark.sql.streaming.noDataMicroBatches.enabled"
    before = spark.conf.get(idle)
    try:
        if timed:
            spark.conf.set(idle, "false")
        q = (
            df.writeStream.format("parquet")
            .outputMode(mode)
            .option("checkpointLocation", f"{base}/_checkpoint")
            .option("path", f"{base}/data")
            .trigger(availableNow=True)
            .start()
        )
    finally:
        spark.conf.set(idle, before)
    _finish(q)
    return spark.read.schema(df.schema).parquet(f"{base}/data")


def _finish(q) -> None:
    """Wait for an ``availableNow`` run, which ends by itself however long its input is."""
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def run_foreach(spark: SparkSession, df: DataFrame, name: str, sink) -> None:
    base = _scratch(spark, name)
    _finish(df.writeStream.foreachBatch(sink).option("checkpointLocation", f"{base}/_checkpoint").trigger(availableNow=True).start())


def _tws(df: DataFrame, key: str | list[str], proc, schema: str) -> DataFrame:
    """Keyed state without timers. The reference's state TTLs are processing-time TTLs; a processor
    built with ``ttl_ms`` needs ``timeMode="ProcessingTime"`` (and ``run(timed=True)`` in a bounded run)."""
    mode = "ProcessingTime" if getattr(proc, "ttl_ms", None) else "None"
    return df.groupBy(*([key] if isinstance(key, str) else key)).transformWithStateInPandas(
        statefulProcessor=proc, outputStructType=schema, outputMode="Append", timeMode=mode
    )


def _window_strings(df: DataFrame, *rest) -> DataFrame:
    at = "yyyy-MM-dd HH:mm:ss"
    return df.select(
        F.date_format("window.start", at).alias("stt"), F.date_format("window.end", at).alias("edt"), F.date_format("window.start", "yyyy-MM-dd").alias("cur_date"), *rest
    )


def window_over(spark: SparkSession, rows: DataFrame, name: str, ts: str, duration: str, keys: list[str], sums: dict[str, str], delay: str = "0 seconds") -> DataFrame:
    """T-3 / T-5: a query of its own over a first query's result: watermark, tumbling window, sums per key."""
    timed = topic(spark, rows, name, ts).withColumn("event_time", event_time(ts)).withWatermark("event_time", delay)
    agg = timed.groupBy(F.window("event_time", duration), *keys).agg(*[F.sum(c).cast("bigint").alias(out) for out, c in sums.items()])
    return run(spark, _window_strings(agg, *keys, *sums), name)


def closed(batch: DataFrame) -> DataFrame:
    """The windows of a batch result that end before its last window starts."""
    return batch.where(F.col("edt") <= batch.agg(F.max("stt")).first()[0])


# ---- traffic -----------------------------------------------------------------------------------


def event_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-1 / P-2 twin: the log topic as text files, read by the value-only source."""
    prepare(spark)
    path = _scratch(spark, "topic-log")
    lines = log_text(spark, sf_dir)
    for k in range(3):
        lines.where(F.pmod(F.xxhash64("value"), F.lit(3)) == k).write.mode("append").text(path)
    return run(spark, text_source(spark, "text", path=path, maxFilesPerTrigger=4), "event_text")


def _page_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topic(spark, logsplit.split_page(page_log(spark, sf_dir)), "page", "ts")


def keyword_window(spark: SparkSession, sf_dir: str, duration: str = HOUR, delay: str = "3 seconds") -> DataFrame:
    """W-5 twin: watermark ``delay`` on the page time, tumbling count per keyword."""
    prepare(spark)
    rows = _page_topic(spark, sf_dir).filter(
        (F.col("page.last_page_id") == "search") & (F.col("page.item_type") == "keyword") & F.col("page.item").isNotNull()
    ).select(event_time("ts"), F.explode(text.tokens(F.col("page.item"))).alias("keyword"))
    agg = rows.withWatermark("event_time", delay).groupBy(F.window("event_time", duration), "keyword").count()
    return run(spark, _window_strings(agg, "keyword", F.col("count").alias("keyword_count")), "keyword_window")


def traffic_window(spark: SparkSession, sf_dir: str, duration: str = HOUR) -> DataFrame:
    """Flagship twin (D-6 + W-6): per-record measures with keyed state, then the window over their topic."""
    prepare(spark)
    keys = ["vc", "ch", "ar", "is_new"]
    rows = _page_topic(spark, sf_dir).select(
        F.col("common.mid").alias("mid"),
        *[F.col(f"common.{k}").alias(k) for k in keys],
        "ts",
        "event_id",
        F.when(F.coalesce(F.col("page.last_page_id"), F.lit("")) == "", 1).otherwise(0).cast("bigint").alias("sv_ct"),
        F.lit(1).cast("bigint").alias("pv_ct"),
        F.col("page.during_time").cast("bigint").alias("dur_sum"),
    )
    proc = P.DailyFlag("ts", ["ts", "event_id"], [*keys, "ts", "sv_ct", "pv_ct", "dur_sum"])
    measured = run(spark, _tws(rows, "mid", proc, "vc string, ch string, ar string, is_new string, ts long, sv_ct long, pv_ct long, dur_sum long, uv_ct long"), "measures")
    return window_over(spark, measured, "traffic", "ts", duration, keys, {c: c for c in ("uv_ct", "sv_ct", "pv_ct", "dur_sum")})


def home_detail_window(spark: SparkSession, sf_dir: str, duration: str = HOUR) -> DataFrame:
    """W-4 twin (D-5): first home and detail views per device and day, then the window."""
    prepare(spark)
    rows = _page_topic(spark, sf_dir).where(F.col("page.page_id").isin("home", "good_detail")).select(F.col("common.mid").alias("mid"), F.col("page.page_id").alias("page_id"), "ts", "event_id")
    proc = P.DailyFirst("ts", ["ts", "event_id"], ["page_id", "ts"])
    firsts = run(spark, _tws(rows, ["mid", "page_id"], proc, "page_id string, ts long"), "home_detail")
    flags = {f"{p}_uv_ct": F.when(F.col("page_id") == p, 1).otherwise(0).cast("bigint") for p in ("home", "good_detail")}
    return window_over(spark, firsts.select("ts", *[c.alias(n) for n, c in flags.items()]), "home_detail", "ts", duration, [], {c: c for c in flags})


def user_login_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D-7 twin."""
    prepare(spark)
    page = _page_topic(spark, sf_dir)
    last = F.coalesce(F.col("page.last_page_id"), F.lit(""))
    logins = page.filter((F.coalesce(F.col("common.uid"), F.lit("")) != "") & ((last == "login") | (last == "")))
    schema = "uid string, ts long, cur_date string, uu_ct long, back_ct long"
    return run(spark, _tws(logins.select(F.col("common.uid").alias("uid"), "ts"), "uid", P.LoginBack(), schema), "login_back")


def user_login_window(spark: SparkSession, sf_dir: str, duration: str = DAY) -> DataFrame:
    """W-7 twin."""
    return window_over(spark, user_login_back(spark, sf_dir), "user_login", "ts", duration, [], {"uu_ct": "uu_ct", "back_ct": "back_ct"})


def visitor_is_new_fix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D-1 twin: parsed log -> TWS is_new correction."""
    prepare(spark)
    log = topic(spark, logsplit.clean_rows(logsplit.parse_log(log_text(spark, sf_dir))), "log", "ts")
    rows = log.select(F.col("common.mid").alias("mid"), F.col("common.is_new").alias("is_new"), "ts", "event_id")
    return run(spark, _tws(rows, "mid", P.IsNewFix(["ts", "event_id"]), "mid string, ts long, is_new string, is_new_fixed string"), "is_new")


def dirty_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P-1 twin: dirty side output of the text topic."""
    return run(spark, logsplit.dirty_rows(logsplit.parse_log(_as_stream(spark, event_text(spark, sf_dir)))), "dirty")


def _as_stream(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """A first query's result as the input of a second one."""
    return spark.readStream.schema(rows.schema).parquet(rows.inputFiles()[0].rsplit("/", 1)[0])


# ---- trade -------------------------------------------------------------------------------------


def snapshot_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-4 twin: snapshot rows of several tables wrapped as envelopes."""
    prepare(spark)
    out = None
    for name, rows in (("order_info", src.order_info_rows(spark, sf_dir)), ("user_info", src.user_info_rows(spark, sf_dir)), ("payment_info", src.payment_info_rows(spark, sf_dir))):
        t = src.envelope(topic(spark, rows, name, "ts_ms", 3), name).select(F.col("source")["table"].alias("tbl"), "op", F.col("after")["id"].alias("id"), "ts_ms")
        out = t if out is None else out.unionByName(t)
    return run(spark, out, "snapshot")


def cart_daily_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D-2 twin (TWS, state = last emitted date per user)."""
    prepare(spark)
    cart = topic(spark, facts.cart_add(src.topic_db(spark, sf_dir, ["cart_info"])), "cart", "ts_ms")
    rows = cart.select("id", "user_id", "ts_ms", F.col("id").cast("bigint").alias("arr_id"))
    proc = P.DailyFirst("ts_ms", ["ts_ms", "arr_id"], ["id", "user_id", "ts_ms"])
    return run(spark, _tws(rows, "user_id", proc, "id string, user_id string, ts_ms long"), "cart_uu")


def cart_window(spark: SparkSession, sf_dir: str, duration: str = HOUR) -> DataFrame:
    """W-1 twin: count of the day's first cart records per window."""
    rows = cart_daily_unique(spark, sf_dir).withColumn("one", F.lit(1))
    return window_over(spark, rows, "cart_window", "ts_ms", duration, [], {"cart_add_uu_ct": "one"})


def _detail_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = facts.order_detail(src.topic_db(spark, sf_dir, ["order_detail"]))
    return d.withColumn("arr_sku", F.col("sku_id").cast("bigint")).withColumn("arr_src", F.col("source_id").cast("bigint"))


def strictly_newer_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D-9 twin."""
    prepare(spark)
    d = topic(spark, _detail_versions(spark, sf_dir), "detail_by_sku", "arr_sku").select(
        "id", "sku_id", "source_id", "create_time", F.col("create_time").cast("bigint").alias("ct"), "arr_sku", "arr_src", F.col("ts_ms").alias("arr_ts")
    )
    proc = P.StrictlyNewer("ct", ["arr_sku", "arr_src", "arr_ts"], ["id", "sku_id", "source_id", "create_time"])
    return run(spark, _tws(d, "id", proc, "id string, sku_id string, source_id string, create_time string"), "newer")


def order_retract_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D-3 twin."""
    prepare(spark)
    d = topic(spark, _detail_versions(spark, sf_dir), "detail", "ts_ms").select(
        "id", "order_id", F.col("split_total_amount").cast("decimal(18,4)").cast("string").alias("amount"),
        F.col("ts_ms").cast("string").alias("ts_ms"), "arr_sku", "arr_src", F.col("ts_ms").alias("arr_ts"),
    )
    proc = P.RetractReplace("amount", ["arr_ts", "arr_sku", "arr_src"], ["id", "order_id", "amount", "ts_ms"])
    out = run(spark, _tws(d, "id", proc, "id string, order_id string, amount string, ts_ms string, sign string"), "retract")
    return out.select("id", "order_id", "amount", F.col("ts_ms").cast("bigint").alias("ts_ms"), F.col("sign").cast("bigint").alias("sign"))


def keep_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D-4 twin: order-detail changes -> change-log upsert sink -> final state, compacted half way."""
    prepare(spark)
    d = topic(spark, _detail_versions(spark, sf_dir), "detail", "ts_ms").select("id", "sku_id", "split_total_amount", "ts_ms", "arr_sku", "arr_src", F.lit("r").alias("op"))
    return _upserted(spark, d, ["ts_ms", "arr_sku", "arr_src"]).select("id", "sku_id", "split_total_amount", "ts_ms")


def _upserted(spark: SparkSession, changes: DataFrame, order: list[str]) -> DataFrame:
    sink = UpsertSink(_scratch(spark, "upsert"), "id", order)

    def write(batch: DataFrame, batch_id: int) -> None:
        sink(batch, batch_id)
        if batch_id == 1:
            sink.compact(batch.sparkSession)

    run_foreach(spark, changes, "upsert", write)
    return sink.state(spark)


def hold_latest(spark: SparkSession, details: DataFrame, hold_ms: int = 5000) -> DataFrame:
    """D-4 by timer: per detail the latest version seen within ``hold_ms`` of processing time. ``details`` is a
    stream with ``id``, ``ts_ms``, ``amount``; the caller starts the query with a processing-time trigger."""
    out = T.StructType([T.StructField("id", T.StringType()), T.StructField("ts_ms", T.LongType()), T.StructField("amount", T.StringType())])
    return details.groupBy("id").transformWithStateInPandas(statefulProcessor=P.HoldLatest("ts_ms", out, hold_ms), outputStructType=out, outputMode="Append", timeMode="ProcessingTime")


def _customer_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    ch = src.customer_change_log(spark, sf_dir)
    return ch.filter(F.col("source")["db"] == src.DB).withColumn("row_key", cdc.before_or_after(ch)["id"])


def upsert_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-7 twin with deletes."""
    prepare(spark)
    ch = topic(spark, _customer_changes(spark, sf_dir), "customer", "seq")
    rows = ch.select(F.col("row_key").alias("id"), "op", "seq", "ts_ms", F.col("after")["segment"].alias("segment"), F.col("after")["balance"].alias("balance"))
    return _upserted(spark, rows, ["seq", "ts_ms"])


def columnwise_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-10 twin: customer change log -> change-log sink, compacted half way -> column-wise merge."""
    prepare(spark)
    ch = topic(spark, _customer_changes(spark, sf_dir).select("row_key", "op", "after", "seq", "ts_ms"), "customer", "seq")
    sink = ColumnwiseSink(_scratch(spark, "columnwise"), "row_key", ["seq", "ts_ms"])

    def write(batch: DataFrame, batch_id: int) -> None:
        sink(batch, batch_id)
        if batch_id == 1:
            sink.compact(batch.sparkSession)

    run_foreach(spark, ch, "columnwise", write)
    c = F.col("cells")
    return sink.state(spark).select("row_key", c["name"].alias("name"), c["nation"].alias("nation"), c["segment"].alias("segment"), c["balance"].alias("balance"))


def dim_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-13 twin: change stream ⋈ broadcast current config (stream-static join)."""
    prepare(spark)
    cfg = cdc.fold_config(dims.config_dim_changes(spark))
    data = topic(spark, cdc.valid_changes(dims.dim_source_envelopes(spark, sf_dir), src.DB), "dims", "ts_ms")
    r = cdc.route_dim(data, cfg).select(
        "sink_table", "row_key", "op", F.col("data")["name"].alias("name"),
        F.col("data")["region_id"].alias("region_id"), F.size("data").cast("bigint").alias("n_cols"),
    )
    return run(spark, r, "dim_route")


def retained_detail_join(spark: SparkSession, details: DataFrame, orders: DataFrame, delay: str = "0 seconds", keep: str = "1805 seconds") -> DataFrame:
    """D-12: a streaming DWD join (detail ⋈ order) whose state is kept 30 min 5 s: rows meet only within that
    time of each other, which bounds the state. Streams with ``ts_ms``; details have ``order_id``, orders ``id``."""
    d = details.withColumn("d_time", F.timestamp_millis("ts_ms")).withWatermark("d_time", delay)
    o = orders.select(F.col("id").alias("o_id"), F.timestamp_millis("ts_ms").alias("o_time"), "user_id", "province_id").withWatermark("o_time", delay)
    return stream_interval_join(d, o, "order_id", "o_id", "d_time", "o_time", f"-{keep}", keep).select("id", "order_id", "user_id", "province_id")


# ---- labels and comments -----------------------------------------------------------------------


def _interval(spark: SparkSession, left: DataFrame, right: DataFrame, keys: tuple[str, str], ts: tuple[str, str], lower: str, upper: str, delay: str) -> DataFrame:
    """Stream-stream interval join of two replayed tables, both watermarked."""
    l = topic(spark, left, "left", ts[0]).withColumn("l_time", F.timestamp_millis(ts[0])).withWatermark("l_time", delay)
    r = topic(spark, right, "right", ts[1]).withColumn("r_time", F.timestamp_millis(ts[1])).withWatermark("r_time", delay)
    return stream_interval_join(l, r, keys[0], keys[1], "l_time", "r_time", lower, upper)


def ijoin_user_sup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J-11 twin."""
    prepare(spark)
    users = labels.user_profile(src.envelope(src.user_info_rows(spark, sf_dir), "user_info"), src.AS_OF)
    sups = labels.sup_map(src.envelope(src.user_info_sup_rows(spark, sf_dir), "user_info_sup_msg"))
    sups = sups.select(*[F.col(c).alias(f"s_{c}") for c in sups.columns])
    j = _interval(spark, users, sups, ("uid", "s_uid"), ("ts_ms", "s_ts_ms"), "-5 minutes", "5 minutes", "3 seconds")
    out = j.select(
        "uid", "gender", "birthday", "age", "zodiac_sign", F.col("s_height").alias("height"),
        F.col("s_unit_height").alias("unit_height"), F.col("s_weight").alias("weight"),
        F.col("s_unit_weight").alias("unit_weight"), "ts_ms",
    )
    return run(spark, out, "user_sup")


def ijoin_order_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J-10 twin."""
    prepare(spark)
    orders = labels.order_info_map(facts.rows_of(src.topic_db(spark, sf_dir, ["order_info"]), "order_info", None))
    details = labels.order_detail_map(src.envelope(src.label_detail_rows(spark, sf_dir), "order_detail"))
    details = details.select(*[F.col(c).alias(f"d_{c}") for c in details.columns])
    j = _interval(spark, orders, details, ("id", "d_order_id"), ("ts_ms", "d_ts_ms"), "-2 minutes", "2 minutes", "3 seconds")
    out = j.select(
        "id", "uid", F.col("d_id").alias("detail_id"), F.col("d_sku_id").alias("sku_id"), F.col("d_sku_num").alias("sku_num"),
        F.col("d_sku_num").cast("string").alias("split_coupon_amount"),
        *[F.coalesce(F.col(f"d_{c}").try_cast("double"), F.lit(0.0)).alias(c) for c in ("split_activity_amount", "split_total_amount")],
        "pay_time_slot", "ts_ms",
    )
    return run(spark, out, "order_detail")


def ijoin_comment_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J-9 twin."""
    prepare(spark)
    c = comments.flatten(facts.rows_of(src.topic_db(spark, sf_dir, ["comment_info"]), "comment_info"))
    image = comments.order_image(facts.rows_of(src.topic_db(spark, sf_dir, ["order_info"]), "order_info", None))
    fields = ["id", "user_id", "total_amount", "op", "tm_ms"]
    orders = image.select(F.col("m")["id"].try_cast("bigint").alias("_oid"), "o_ts", *[F.col("m")[f].alias(f"info_{f}") for f in fields])
    j = _interval(spark, c, orders, ("order_id", "_oid"), ("ts_ms", "o_ts"), "-1 minutes", "1 minutes", "3 seconds")
    return run(spark, j.select("id", "order_id", "ts_ms", *[f"info_{f}" for f in fields]), "comment_order")


def dedup_full_row(spark: SparkSession, sf_dir: str, ttl_ms: int | None = None) -> DataFrame:
    """D-8 twin: state is maps of 128-bit record digests, parted by the digest (a hot user is spread), which forget a digest
    ``ttl_ms`` after it was seen."""
    from ..plans.q_label import replayed

    prepare(spark)
    dev = topic(spark, replayed(labels.device_info(label_page_log(spark, sf_dir))).drop("event_id"), "devices", "ts")
    return run(spark, seen_once(dev, ttl_ms), "dedup", timed=ttl_ms is not None)


def seen_once(rows: DataFrame, ttl_ms: int | None = None, parts: int = 256) -> DataFrame:
    """The first of identical records (null equals null) of a stream, by :class:`.processors.SeenOnce`; ``parts`` bounds the tasks."""
    whole = F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"})
    keyed = rows.select(F.md5(whole).alias("d"), whole.alias("body")).withColumn("part", F.pmod(F.xxhash64("d"), F.lit(parts)))
    passed = _tws(keyed, "part", P.SeenOnce("d", ["body"], ttl_ms), "body string")
    return passed.select(F.from_json("body", rows.schema).alias("r")).select("r.*")


def running_profile(devices: DataFrame, ttl_ms: int | None = None) -> DataFrame:
    """D-11 as a running aggregate: a user's profile each time that records change it."""
    rows = devices.where("uid is not null").select("uid", "os", "search_item", "ts")
    return _tws(rows, "uid", P.RunningProfile(ttl_ms), "uid string, os string, n_events long, search_item string, ts long")


def uid_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D-11 twin: the last emission per user (the one of most records) is the batch profile."""
    prepare(spark)
    emitted = run(spark, running_profile(topic(spark, labels.device_info(label_page_log(spark, sf_dir)), "profiles", "ts")), "profile")
    return state.last_per_group(emitted, ["uid"], ["n_events"])


def label_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J-12 -> J-13 twin: two interval joins (24 h either way). The first one's ages are a topic; the second query sets a watermark
    of its own over it (T-5, 5 s), as one query may not. Both are inner joins, so every pair is emitted when its later row comes."""
    ages = run(spark, _ages(spark, sf_dir), "ages")
    return run(spark, _labels(spark, ages, _bases(spark, sf_dir)[2]), "labels")


def age_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J-12 twin."""
    return run(spark, _ages(spark, sf_dir), "ages")


def _bases(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    from ..plans.q_label import label_bases

    return label_bases(prepare(spark), sf_dir)


def _ages(spark: SparkSession, sf_dir: str) -> DataFrame:
    base2, base4, _ = _bases(spark, sf_dir)
    l, r = labels.age_sides(base2, base4)
    return labels.age_of(_interval(spark, l, r, ("uid", "r_uid"), ("ts", "r_ts_ms"), "-24 hours", "24 hours", "3 seconds"))


def _labels(spark: SparkSession, ages: DataFrame, base6: DataFrame) -> DataFrame:
    r = base6.select(*[F.col(c).alias(f"r_{c}") for c in base6.columns])
    return labels.merged_label(_interval(spark, ages, r, ("uid", "r_uid"), ("ts_ms", "r_ts_ms"), "-24 hours", "24 hours", "5 seconds"), ages.columns, base6.columns)


# ---- windows of processing time ----------------------------------------------------------------


def _by_timer(rows: DataFrame, key: str, proc: P.ProcessingWindow) -> DataFrame:
    out = T.StructType([T.StructField("w_ms", T.LongType()), *proc.held.fields])
    return rows.groupBy(key).transformWithStateInPandas(statefulProcessor=proc, outputStructType=out, outputMode="Append", timeMode="ProcessingTime")


def last_by_timer(rows: DataFrame, key: str, order: str, length_ms: int = 120_000) -> DataFrame:
    """W-8 as the reference runs it: the last record per key and window of processing time, emitted by timer when the window ends."""
    return _by_timer(rows, key, P.WindowLast(order, rows.schema, length_ms))


def sku_order_by_timer(details: DataFrame, length_ms: int = 10_000) -> DataFrame:
    """W-3 as the reference runs it: sums per sku and window of processing time, emitted by timer. ``details`` has ``sku_id`` and the amounts."""
    from ..operators.windows import SKU_SUMS

    rows = details.select(F.col("sku_id").cast("string").alias("sku_id"), *[F.col(src).cast("decimal(18,4)").cast("string").alias(out) for out, src in SKU_SUMS.items()])
    return _by_timer(rows, "sku_id", P.WindowSums("sku_id", list(SKU_SUMS), length_ms))


#: key -> (twin, whether its last windows stay open)
TWINS = {
    "src_event_text": (event_text, False),
    "parse_dirty_split": (dirty_split, False),
    "visitor_is_new_fix": (visitor_is_new_fix, False),
    "dws_traffic_keyword": (keyword_window, True),
    "dws_traffic_vc_ch_ar_is_new": (traffic_window, True),
    "dws_traffic_home_detail": (home_detail_window, True),
    "user_login_back": (user_login_back, False),
    "dws_user_login": (user_login_window, True),
    "ods_snapshot_envelope": (snapshot_envelope, False),
    "cart_daily_unique": (cart_daily_unique, False),
    "dws_trade_cart_add_uu": (cart_window, True),
    "strictly_newer_detail": (strictly_newer_detail, False),
    "order_retract_stream": (order_retract_stream, False),
    "order_keep_latest": (keep_latest, False),
    "upsert_latest_by_key": (upsert_changes, False),
    "dim_columnwise_upsert": (columnwise_upsert, False),
    "dim_route": (dim_route, False),
    "ijoin_user_sup": (ijoin_user_sup, False),
    "ijoin_order_detail": (ijoin_order_detail, False),
    "ijoin_comment_order": (ijoin_comment_order, False),
    "dedup_full_row": (dedup_full_row, False),
    "label_uid_profile_agg": (uid_profile, False),
    "label_age_level": (age_level, False),
    "label_final": (label_chain, False),
}
