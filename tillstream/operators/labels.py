"""User age-label pipeline (P-19 ... P-21, J-10 ... J-13, D-9, D-11, W-8, M-*).

base2 = behaviour log -> device / search scores; base4 = order ⋈ detail
(interval) -> newest per detail -> time / amount / brand / category scores;
base6 = user profile ⋈ body supplement (interval). base2 ⋈ base4 (±24 h)
gives the age level, which ⋈ base6 (±24 h) is the final label.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.time import age_years, decade, epoch_day_to_date, pay_time_slot, zodiac
from . import scoring
from ..sources import dims
from ..sources.tables import small
from .enrich import category_chain, enrich, one_per_key
from .interval import interval_join
from .state import last_per_group, strictly_newer
from .windows import _win

MINUTE = 60_000
HOUR = 3_600_000


# ---- P-19 / P-20 / P-21 -------------------------------------------------------------------------


def device_info(log: DataFrame) -> DataFrame:
    """P-19: uid (default "-1"), ts, the device fields of ``common`` without sid/mid/is_new, ``os``
    cut at the first space, and ``search_item`` when the page item is a keyword."""
    c, p = F.col("common"), F.col("page")
    return log.select(
        F.coalesce(c.uid, F.lit("-1")).alias("uid"),
        F.col("ts"),
        F.col("event_id"),
        c.ar.alias("ar"),
        c.ch.alias("ch"),
        F.split(c.os, " ").getItem(0).alias("os"),
        c.vc.alias("vc"),
        F.when(p.item_type == "keyword", p.item).alias("search_item"),
    )


def _long(c: str):
    """getLongValue: missing or unparsable -> 0."""
    return F.coalesce(F.col("after")[c].try_cast("bigint"), F.lit(0)).cast("bigint")


def order_info_map(rows: DataFrame) -> DataFrame:
    """P-20 order map + pay-time slot of create_time."""
    a = F.col("after")
    return rows.select(
        F.coalesce(F.col("ts_ms"), F.lit(0)).alias("ts_ms"),
        a["id"].alias("id"),
        a["user_id"].alias("uid"),
        a["consignee"].alias("consignee"),
        _long("create_time").alias("create_time"),
        a["original_total_amount"].alias("original_total_amount"),
        a["total_amount"].alias("total_amount"),
        _long("province_id").alias("province_id"),
        pay_time_slot(_long("create_time")).alias("pay_time_slot"),
    )


def order_detail_map(rows: DataFrame) -> DataFrame:
    """P-20 detail map."""
    a = F.col("after")
    return rows.select(
        F.coalesce(F.col("ts_ms"), F.lit(0)).alias("ts_ms"),
        _long("sku_num").alias("sku_num"),
        _long("create_time").alias("create_time"),
        _long("sku_id").alias("sku_id"),
        a["split_coupon_amount"].alias("split_coupon_amount"),
        a["sku_name"].alias("sku_name"),
        a["order_price"].alias("order_price"),
        a["id"].alias("id"),
        a["order_id"].alias("order_id"),
        a["split_activity_amount"].alias("split_activity_amount"),
        a["split_total_amount"].alias("split_total_amount"),
        a["source_id"].alias("source_id"),
    )


def user_profile(rows: DataFrame, as_of: str) -> DataFrame:
    """P-21: user map with gender default "home", ISO birthday from epoch days, age (as of
    ``as_of``), decade and zodiac sign."""
    a = F.col("after")
    birthday = epoch_day_to_date(a["birthday"])
    bdate = F.to_date(birthday)
    asof = F.lit(as_of).cast("date")
    return rows.select(
        a["id"].alias("uid"),
        a["name"].alias("uname"),
        a["user_level"].alias("user_level"),
        a["login_name"].alias("login_name"),
        a["phone_num"].alias("phone_num"),
        a["email"].alias("email"),
        F.coalesce(a["gender"], F.lit("home")).alias("gender"),
        birthday.alias("birthday"),
        F.coalesce(F.col("ts_ms"), F.lit(0)).alias("ts_ms"),
        decade(bdate).alias("decade"),
        age_years(bdate, asof).alias("age"),
        zodiac(bdate).alias("zodiac_sign"),
    ).filter(F.coalesce(F.col("uid"), F.lit("")) != "")


def sup_map(rows: DataFrame) -> DataFrame:
    a = F.col("after")
    return rows.select(
        a["uid"].alias("uid"),
        a["unit_height"].alias("unit_height"),
        a["create_ts"].cast("bigint").alias("create_ts"),
        a["weight"].alias("weight"),
        a["unit_weight"].alias("unit_weight"),
        a["height"].alias("height"),
        F.coalesce(F.col("ts_ms"), F.lit(0)).alias("ts_ms"),
    ).filter(F.coalesce(F.col("uid"), F.lit("")) != "")


# ---- J-10 / J-11 --------------------------------------------------------------------------------


def join_order_detail(orders: DataFrame, details: DataFrame, lower_ms: int = -2 * MINUTE, upper_ms: int = 2 * MINUTE, fix_coupon: bool = False) -> DataFrame:
    """J-10: order ⋈ detail on order id within ±2 min. Order fields win; selected detail fields are
    added; ``split_coupon_amount`` takes the detail's ``sku_num`` (N-5) unless ``fix_coupon``;
    missing doubles become 0.0."""
    o = orders.filter(F.coalesce(F.col("id"), F.lit("")) != "")
    d = details.select(*[F.col(c).alias(f"d_{c}") for c in details.columns])
    j = interval_join(o, d, "id", "d_order_id", "ts_ms", "d_ts_ms", lower_ms, upper_ms)
    coupon = F.col("d_split_coupon_amount") if fix_coupon else F.col("d_sku_num").cast("string")
    return j.select(
        *[F.col(c) for c in orders.columns],
        F.col("d_sku_num").alias("sku_num"),
        coupon.alias("split_coupon_amount"),
        F.col("d_sku_name").alias("sku_name"),
        F.col("d_order_price").alias("order_price"),
        F.col("d_id").alias("detail_id"),
        F.col("d_order_id").alias("order_id"),
        F.col("d_sku_id").alias("sku_id"),
        F.coalesce(F.col("d_split_activity_amount").try_cast("double"), F.lit(0.0)).alias("split_activity_amount"),
        F.coalesce(F.col("d_split_total_amount").try_cast("double"), F.lit(0.0)).alias("split_total_amount"),
        F.col("d_ts_ms").alias("detail_ts"),
        F.col("d_source_id").alias("source_id"),
    )


def join_user_sup(users: DataFrame, sups: DataFrame, lower_ms: int = -5 * MINUTE, upper_ms: int = 5 * MINUTE) -> DataFrame:
    """J-11: user ⋈ supplement on uid within ±5 min; user fields plus body measures."""
    s = sups.select(*[F.col(c).alias(f"s_{c}") for c in sups.columns])
    j = interval_join(users, s, "uid", "s_uid", "ts_ms", "s_ts_ms", lower_ms, upper_ms)
    return j.select(
        *[F.col(c) for c in users.columns],
        F.col("s_height").alias("height"),
        F.col("s_unit_height").alias("unit_height"),
        F.col("s_weight").alias("weight"),
        F.col("s_unit_weight").alias("unit_weight"),
    )


# ---- D-11 / W-8 ---------------------------------------------------------------------------------


def uid_profile_agg(devices: DataFrame) -> DataFrame:
    """D-11 (inferred): per uid the sorted distinct OS list (comma-joined), the record count and
    the latest search item. Partial aggregation keeps hot users off a single task."""
    return devices.groupBy("uid").agg(
        F.array_join(F.array_sort(F.collect_set("os")), ",").alias("os"),
        F.count(F.lit(1)).cast("bigint").alias("n_events"),
        F.max_by("search_item", F.when(F.col("search_item").isNotNull(), F.col("ts"))).alias("search_item"),
        F.max("ts").alias("ts"),
    )


def last_per_window(df: DataFrame, key: str, ts: str, duration: str = "2 minutes") -> DataFrame:
    """W-8: per key and tumbling window, the last record wins (by time, then event id).
    Top-1 per (key, window) -- reduced map-side before the shuffle like the reduce function."""
    cols = list(df.columns)
    w = df.withColumn("_wstart", _win(ts, duration).getField("start"))
    last = last_per_group(w, [key, "_wstart"], [ts, "event_id"] if "event_id" in cols else [ts])
    return last.select(F.date_format(F.col("_wstart"), "yyyy-MM-dd HH:mm:ss").alias("stt"), *cols)


# ---- base2 / base4 / age level / final ----------------------------------------------------------


def base2(spark: SparkSession, sf_dir: str, devices: DataFrame) -> DataFrame:
    """M-1 device + M-2 search: search item (a category-3 name) -> top category -> search category."""
    from ..sources.dims import category_compare_dic

    cats = one_per_key(category_chain(spark, sf_dir).select("b3name", "b1name"), "b3name")
    cmp = one_per_key(category_compare_dic(spark).select("category_name", "search_category"), "category_name")
    # the two dimensions are joined first, so the events meet one small table and are not shuffled by its key
    cats = small(enrich(cats, cmp, "b1name", "category_name", {"search_category": "search_category"}))
    d = enrich(devices, cats, "search_item", "b3name", {"b1name": "b1_category", "search_category": "search_category"})
    d = scoring.score_device(spark, d)
    return scoring.score_search(spark, d)


def newest_per_detail(joined: DataFrame) -> DataFrame:
    """D-9 on the J-10 output: per detail id keep rows whose create_time beats all earlier ones."""
    order = [F.col("detail_ts"), F.col("sku_id"), F.col("source_id").cast("bigint")]
    return strictly_newer(joined, "detail_id", "create_time", order)


def base4(spark: SparkSession, sf_dir: str, joined: DataFrame) -> DataFrame:
    """J-18 lookups (sku -> category3 id and brand name; category3 -> top category) + M-3 ... M-6."""
    skus = dims.sku_dim(spark, sf_dir).where("spu_name is not null")  # one row per sku
    j = enrich(joined.withColumn("_sku", F.col("sku_id").cast("string")), skus, "_sku", "id", {"category3_id": "c3id", "trademark_name": "tname", "category1_name": "b1_name"}).drop("_sku")
    j = scoring.score_pay_time(spark, j)
    j = scoring.score_amount(spark, j)
    j = scoring.score_brand(spark, j)
    return scoring.score_category(spark, j)


LEFT_MODELS = ["search", "device"]
RIGHT_MODELS = ["pay_time", "b1name", "tname", "amount"]


def age_level_join(b2: DataFrame, b4: DataFrame, lower_ms: int = -24 * HOUR, upper_ms: int = 24 * HOUR, faithful: bool = False) -> DataFrame:
    """J-12 + M-7: base2 ⋈ base4 on uid within ±24 h; per pair the bucket with the largest summed
    weight. ``faithful`` reproduces the reference reading base4 weights from the wrong side (N-13)."""
    l, r = age_sides(b2, b4)
    return age_of(interval_join(l, r, "uid", "r_uid", "ts", "r_ts_ms", lower_ms, upper_ms), faithful)


def age_sides(b2: DataFrame, b4: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The columns of base2 and (prefixed ``r_``) base4 that J-12 needs."""
    keep2 = ["uid", "ts"] + [f"{m}_{b}" for m in LEFT_MODELS for b in scoring.BUCKETS]
    keep4 = ["uid", "ts_ms"] + [f"{m}_{b}" for m in RIGHT_MODELS for b in scoring.BUCKETS]
    return b2.select(*keep2), b4.select(*[F.col(c).alias(f"r_{c}") for c in keep4])


def age_of(joined: DataFrame, faithful: bool = False) -> DataFrame:
    """M-7 of the joined pairs."""
    right = [] if faithful else [f"r_{m}" for m in RIGHT_MODELS]
    sums = scoring.bucket_sums(LEFT_MODELS, right)
    return joined.select("uid", F.col("ts").alias("ts_ms"), scoring.age_level(sums).alias("age_level"))


def final_label(ages: DataFrame, b6: DataFrame, lower_ms: int = -24 * HOUR, upper_ms: int = 24 * HOUR) -> DataFrame:
    """J-13: (base2 ⋈ base4) ⋈ base6 on uid within ±24 h; right fields override left ones."""
    r = b6.select(*[F.col(c).alias(f"r_{c}") for c in b6.columns])
    return merged_label(interval_join(ages, r, "uid", "r_uid", "ts_ms", "r_ts_ms", lower_ms, upper_ms), ages.columns, b6.columns)


def merged_label(joined: DataFrame, left: list[str], right: list[str]) -> DataFrame:
    """J-13's merge: right fields (``r_<name>``) override left ones."""
    out = [F.coalesce(F.col(f"r_{c}"), F.col(c)).alias(c) if c in right else F.col(c) for c in left]
    return joined.select(*out, *[F.col(f"r_{c}").alias(c) for c in right if c not in left])
