"""Label pipeline and comment pipeline keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import comments, facts, labels, scoring, state
from ..sources import cdc as src
from ..sources.logs import label_page_log
from .catalog import query

TEST_WINDOW = "1 hour"
EPOCH_2024_MS = 1_704_067_200_000  # 2024-01-01T00:00:00Z
HOUR_MS = 3_600_000
DAY_MS = 86_400_000


def _devices(spark, sf_dir):
    return labels.device_info(label_page_log(spark, sf_dir))


@query("label_device_info")
def label_device_info(spark, sf_dir):
    """P-19."""
    return _devices(spark, sf_dir).drop("event_id")


def _orders(spark, sf_dir):
    return labels.order_info_map(facts.rows_of(src.topic_db(spark, sf_dir, ["order_info"]), "order_info", None))


def _details(spark, sf_dir):
    return labels.order_detail_map(src.envelope(src.label_detail_rows(spark, sf_dir), "order_detail"))


@query("label_order_info")
def label_order_info(spark, sf_dir):
    """P-20 (order map with pay-time slot)."""
    return _orders(spark, sf_dir).select("id", "uid", "create_time", "total_amount", "province_id", "pay_time_slot", "ts_ms")


def _users(spark, sf_dir):
    return labels.user_profile(src.envelope(src.user_info_rows(spark, sf_dir), "user_info"), src.AS_OF)


def _sups(spark, sf_dir):
    return labels.sup_map(src.envelope(src.user_info_sup_rows(spark, sf_dir), "user_info_sup_msg"))


@query("label_user_profile")
def label_user_profile(spark, sf_dir):
    """P-21 (+ F-8 ... F-11)."""
    return _users(spark, sf_dir).select("uid", "uname", "gender", "birthday", "decade", "age", "zodiac_sign", "ts_ms")


def _order_detail_join(spark, sf_dir):
    return labels.join_order_detail(_orders(spark, sf_dir), _details(spark, sf_dir))


@query("ijoin_order_detail")
def ijoin_order_detail(spark, sf_dir):
    """J-10."""
    j = _order_detail_join(spark, sf_dir)
    return j.select("id", "uid", "detail_id", "sku_id", "sku_num", "split_coupon_amount", "split_activity_amount", "split_total_amount", "pay_time_slot", "ts_ms")


def _base6(spark, sf_dir):
    return labels.join_user_sup(_users(spark, sf_dir), _sups(spark, sf_dir))


@query("ijoin_user_sup")
def ijoin_user_sup(spark, sf_dir):
    """J-11."""
    return _base6(spark, sf_dir).select("uid", "gender", "birthday", "age", "zodiac_sign", "height", "unit_height", "weight", "unit_weight", "ts_ms")


@query("dedup_full_row")
def dedup_full_row(spark, sf_dir):
    """D-8: whole device records, time included; every fifth event is delivered twice and collapses to one."""
    return state.dedup_full_row(replayed(_devices(spark, sf_dir)).drop("event_id"))


def replayed(devices):
    """Device records as an at-least-once topic delivers them: those of every fifth event come twice."""
    times = F.when(F.col("event_id") % 5 == 0, 2).otherwise(1)
    return devices.withColumn("_n", F.explode(F.sequence(F.lit(1), times))).drop("_n")


@query("label_uid_profile_agg")
def label_uid_profile_agg(spark, sf_dir):
    """D-11."""
    return labels.uid_profile_agg(_devices(spark, sf_dir))


@query("label_last_per_window")
def label_last_per_window(spark, sf_dir):
    """W-8 (window length = test window)."""
    return labels.last_per_window(_devices(spark, sf_dir), "uid", "ts", TEST_WINDOW).drop("event_id")


def _base2(spark, sf_dir):
    return labels.base2(spark, sf_dir, _devices(spark, sf_dir))


def _buckets(prefix):
    return [f"{prefix}_{b}" for b in scoring.BUCKETS]


@query("score_device")
def score_device(spark, sf_dir):
    """M-1 (no lookup needed)."""
    return scoring.score_device(spark, _devices(spark, sf_dir)).select("uid", "ts", "os", "judge_os", *_buckets("device"))


@query("score_search")
def score_search(spark, sf_dir):
    """M-2 (+ J-18 category lookups)."""
    return _base2(spark, sf_dir).select("uid", "ts", "search_item", "b1_category", "search_category", *_buckets("search"))


def _newest(spark, sf_dir):
    return labels.newest_per_detail(_order_detail_join(spark, sf_dir))


def _base4(spark, sf_dir):
    return labels.base4(spark, sf_dir, _newest(spark, sf_dir))


@query("strictly_newer_order_detail")
def strictly_newer_order_detail(spark, sf_dir):
    """D-9 on the J-10 output (the label job's use)."""
    return labels.newest_per_detail(_order_detail_join(spark, sf_dir)).select("detail_id", "id", "sku_id", "source_id", "create_time")


@query("score_pay_time")
def score_pay_time(spark, sf_dir):
    """M-3 (no lookup needed)."""
    return scoring.score_pay_time(spark, _newest(spark, sf_dir)).select("detail_id", "pay_time_slot", *_buckets("pay_time"))


@query("score_amount")
def score_amount(spark, sf_dir):
    """M-4 (no lookup needed)."""
    return scoring.score_amount(spark, _newest(spark, sf_dir)).select("detail_id", "total_amount", *_buckets("amount"))


@query("score_brand")
def score_brand(spark, sf_dir):
    """M-5 (+ J-18 sku -> brand)."""
    return _base4(spark, sf_dir).select("detail_id", "tname", *_buckets("tname"))


@query("score_category")
def score_category(spark, sf_dir):
    """M-6 (+ J-18 sku -> category3 -> top category)."""
    return _base4(spark, sf_dir).select("detail_id", "b1_name", *_buckets("b1name"))


@query("score_age_argmax")
def score_age_argmax(spark, sf_dir):
    """M-7 over the four order-side models of each base4 row."""
    b4 = _base4(spark, sf_dir)
    sums = scoring.bucket_sums([], labels.RIGHT_MODELS)
    return b4.select("detail_id", scoring.age_level(sums).alias("age_level"))


def _base4_timed(spark, sf_dir):
    """base4 on the J-12 time line: 2024-01-01 + (order id % 720) hours (FIXTURES.md)."""
    b4 = _base4(spark, sf_dir)
    return b4.withColumn("ts_ms", F.lit(EPOCH_2024_MS) + (F.col("id").cast("bigint") % 720) * HOUR_MS)


def _ages(spark, sf_dir):
    return labels.age_level_join(_base2(spark, sf_dir), _base4_timed(spark, sf_dir))


@query("label_age_level")
def label_age_level(spark, sf_dir):
    """J-12 + M-7."""
    return _ages(spark, sf_dir)


@query("label_final")
def label_final(spark, sf_dir):
    """J-13: age level ⋈ base6 (base6 on its J-13 time line: 2024-01-01 + (uid % 30) days)."""
    return labels.final_label(_ages(spark, sf_dir), _base6_timed(spark, sf_dir))


def _base6_timed(spark, sf_dir):
    b6 = _base6(spark, sf_dir).select("uid", "gender", "age", "decade", "zodiac_sign", "height", "weight", "ts_ms")
    return b6.withColumn("ts_ms", F.lit(EPOCH_2024_MS) + (F.col("uid").cast("bigint") % 30) * DAY_MS)


def label_bases(spark, sf_dir):
    """base2, base4 and base6 on the time lines of J-12 and J-13: the topics of the label job."""
    return _base2(spark, sf_dir), _base4_timed(spark, sf_dir), _base6_timed(spark, sf_dir)


# ---- comments -----------------------------------------------------------------------------------


def _comments(spark, sf_dir):
    return comments.flatten(facts.rows_of(src.topic_db(spark, sf_dir, ["comment_info"]), "comment_info"))


@query("comment_flatten")
def comment_flatten(spark, sf_dir):
    """P-22."""
    c = _comments(spark, sf_dir)
    return c.select("ts_ms", "db", "table", "appraise", "op", "nick_name", "create_time", "user_id", "sku_id", "id", "spu_id", "order_id", F.md5("comment_txt").alias("txt_md5"))


@query("ijoin_comment_order")
def ijoin_comment_order(spark, sf_dir):
    """J-9."""
    orders = comments.order_image(facts.rows_of(src.topic_db(spark, sf_dir, ["order_info"]), "order_info", None))
    j = comments.join_comment_order(_comments(spark, sf_dir), orders, ["id", "user_id", "total_amount", "op", "tm_ms"])
    return j.select("id", "order_id", "ts_ms", "info_id", "info_user_id", "info_total_amount", "info_op", "info_tm_ms")


@query("comment_sensitive_flag")
def comment_sensitive_flag(spark, sf_dir):
    """O-28: sensitive-term hits per comment over the whole text."""
    h = comments.sensitive_hits(_comments(spark, sf_dir))
    return h.select("id", "user_id", "hits", (F.col("hits") > 0).cast("bigint").alias("flagged"))


@query("comment_sample")
def comment_sample(spark, sf_dir):
    """O-29 (the sampling half)."""
    return comments.sample_comments(_comments(spark, sf_dir)).select("id", "user_id", "ts_ms", F.md5("comment_txt").alias("txt_md5"))


@query("comment_ds")
def comment_ds(spark, sf_dir):
    """O-30."""
    return comments.with_ds(_comments(spark, sf_dir)).select("id", "ts_ms", "ds")
