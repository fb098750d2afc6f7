"""Batch forms of the reference's keyed stateful operators (D-2 ... D-11).

The reference keeps per-key ValueState in a keyed stream. In batch the same
answer comes from aggregates and window functions. Design rules used here:

* "first record per key and day" style state (D-2, D-5, D-6, D-7) and "latest
  per key" (D-4, O-7) are a top-1 per key (``row_number() = 1``), which Spark
  plans with a partial ``WindowGroupLimit`` in every map task before the
  shuffle: a hot user/device ships one row per task, never all of its rows
  (order-detail versions use :func:`latest_version`, sorted after the shuffle only);
* running comparisons (D-3 lead, D-9 running max) use window functions
  partitioned by a *fact primary key* (order-detail id), whose versions per key
  are few by construction; D-7 windows run after the per-day reduction; D-10,
  keyed by user, uses :func:`strictly_newer_chunked` so a hot user is split by
  arrival chunk.

Arrival order in the fixtures is total: ``ts`` plus a tie-breaker column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.time import date_to_ts, ts_to_date

DAY_MS = 86_400_000


def _cols(cols) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def _top1(df: DataFrame, keys: list, order: list[Column]) -> DataFrame:
    """``row_number() = 1`` per key. Spark plans it as a partial ``WindowGroupLimit`` (top-1 per key
    inside each map task) before the exchange and a final one after, so a hot key ships at most
    one row per map task -- the sort-based equivalent of a combiner. ``max_by(struct)`` would fall
    back to SortAggregate (struct buffers are not hash-aggregatable) and is slower."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def first_per_group(df: DataFrame, keys: list, order: list) -> DataFrame:
    """One row per ``keys``: the row with the smallest ``order`` tuple."""
    return _top1(df, keys, [c.asc() for c in _cols(order)])


def last_per_group(df: DataFrame, keys: list, order: list) -> DataFrame:
    """One row per ``keys``: the row with the largest ``order`` tuple."""
    return _top1(df, keys, [c.desc() for c in _cols(order)])


def latest_version(df: DataFrame, key: str, order: list) -> DataFrame:
    """:func:`last_per_group` for a fact primary key, whose versions are few: the rows go to their key's
    task before they are sorted. A top-1 inside each map task would sort (and spill) the task's whole
    wide split to drop next to nothing."""
    return last_per_group(df.repartition(F.col(key)), [key], order)


# D-2 -------------------------------------------------------------------------------------------


def daily_unique(df: DataFrame, key: str, ts: str = "ts", order: list | None = None) -> DataFrame:
    """D-2: the first record of every (key, calendar day); the reference emits exactly these."""
    with_day = df.withColumn("_day", ts_to_date(F.col(ts)))
    out = first_per_group(with_day, [key, "_day"], order or [ts])
    return out.drop("_day")


# D-3 -------------------------------------------------------------------------------------------


def retract_and_replace(
    df: DataFrame, key: str, amount_cols: list[str], order: list, ttl_ms: int | None = None, ts: str = "ts_ms"
) -> DataFrame:
    """D-3: every record, plus a negated copy of each record that a later record of the same key replaces.

    The negated copy keeps the *old* record's columns (and so its ``ts`` and window, N-8).
    With ``ttl_ms`` the previous record is only retracted when the replacement arrives within
    that time (the reference's state TTL). Output has ``sign`` = 1 / -1.
    """
    w = Window.partitionBy(key).orderBy(*_cols(order))
    marked = df.withColumn("_next_ts", F.lead(F.col(ts)).over(w))
    has_next = F.col("_next_ts").isNotNull()
    if ttl_ms is not None:
        has_next = has_next & ((F.col("_next_ts") - F.col(ts)) <= F.lit(ttl_ms))
    # one pass: each record yields itself (+1) and, when replaced, its retraction (-1)
    signs = F.when(has_next, F.array(F.lit(1), F.lit(-1))).otherwise(F.array(F.lit(1)))
    out = marked.withColumn("sign", F.explode(signs))
    for c in amount_cols:
        out = out.withColumn(c, F.when(F.col("sign") == -1, -F.col(c)).otherwise(F.col(c)))
    return out.drop("_next_ts")


# D-4 -------------------------------------------------------------------------------------------


def keep_latest(df: DataFrame, key: str, order: list) -> DataFrame:
    """D-4: per key the record with the greatest (ts, arrival) -- later-or-equal replaces (N-9)."""
    return latest_version(df, key, order)


# D-5 -------------------------------------------------------------------------------------------


def home_detail_daily_uv(page: DataFrame, mid: str = "mid", page_id: str = "page_id", ts: str = "ts") -> DataFrame:
    """D-5: per device and day, the first home view (home_uv=1) and first detail view (detail_uv=1)."""
    sel = page.filter(F.col(page_id).isin("home", "good_detail"))
    with_day = sel.withColumn("_day", ts_to_date(F.col(ts)))
    f = first_per_group(with_day, [mid, "_day", page_id], [ts]).drop("_day")
    return f.select(
        mid,
        ts,
        F.when(F.col(page_id) == "home", 1).otherwise(0).cast("bigint").alias("home_uv_ct"),
        F.when(F.col(page_id) == "good_detail", 1).otherwise(0).cast("bigint").alias("good_detail_uv_ct"),
    )


# D-6 -------------------------------------------------------------------------------------------


def page_view_measures(page: DataFrame) -> DataFrame:
    """D-6 per record: uv (the device's first record of the day), sv (no previous page), pv=1, dur.

    The first record per (mid, day) in (ts, event_id) order is a top-1, reduced map-side; its flag goes back
    to the records by their unique ``event_id``, so no join key is hot. A record without a device is kept
    and counts as no visitor (N-19).
    """
    rows = page.select(
        "event_id",
        F.col("common.mid").alias("mid"),
        F.col("common.vc").alias("vc"),
        F.col("common.ch").alias("ch"),
        F.col("common.ar").alias("ar"),
        F.col("common.is_new").alias("is_new"),
        F.col("page.last_page_id").alias("last_page_id"),
        F.col("page.during_time").alias("during_time"),
        "ts",
    )
    seen = rows.where("mid is not null").select("mid", "ts", "event_id", ts_to_date(F.col("ts")).alias("_day"))
    firsts = first_per_group(seen, ["mid", "_day"], ["ts", "event_id"]).select("event_id", F.lit(1).alias("_uv"))
    return rows.join(firsts, "event_id", "left").select(
        "mid",
        "ts",
        "vc",
        "ch",
        "ar",
        "is_new",
        F.coalesce("_uv", F.lit(0)).cast("bigint").alias("uv_ct"),
        F.when(F.coalesce(F.col("last_page_id"), F.lit("")) == "", 1).otherwise(0).cast("bigint").alias("sv_ct"),
        F.lit(1).cast("bigint").alias("pv_ct"),
        F.col("during_time").cast("bigint").alias("dur_sum"),
    )


# D-7 -------------------------------------------------------------------------------------------


def login_back(logins: DataFrame, uid: str = "uid", ts: str = "ts", back_days: int = 8, zone: str = "UTC") -> DataFrame:
    """D-7: one row per user and login day (uu_ct=1); back_ct=1 when the previous login day's
    midnight is at least ``back_days`` whole days before this login (N-10: one zone for both
    directions). The per-day reduction runs first, so the window sees at most one row per day."""
    day = logins.select(F.col(uid).alias("uid"), F.col(ts).alias("ts")).withColumn("cur_date", ts_to_date(F.col("ts")))
    firsts = day.groupBy("uid", "cur_date").agg(F.min("ts").alias("ts"))
    prev = F.lag("cur_date").over(Window.partitionBy("uid").orderBy("cur_date"))
    out = firsts.withColumn("_prev", prev)
    gap = F.floor((F.col("ts") - date_to_ts(F.col("_prev"), zone)) / F.lit(DAY_MS))
    return out.select(
        "uid",
        "ts",
        "cur_date",
        F.lit(1).cast("bigint").alias("uu_ct"),
        F.when(F.col("_prev").isNotNull() & (gap >= back_days), 1).otherwise(0).cast("bigint").alias("back_ct"),
    )


# D-8 -------------------------------------------------------------------------------------------


def dedup_full_row(df: DataFrame) -> DataFrame:
    """D-8: drop records identical in every column (hash aggregate on the whole row)."""
    return df.dropDuplicates()


# D-9 / D-10 ------------------------------------------------------------------------------------


def strictly_newer(df: DataFrame, key: str, value: str, order: list) -> DataFrame:
    """D-9/D-10: keep a record only if its ``value`` is greater than every earlier record's of the key
    (first record always kept). Earlier = arrival ``order``."""
    w = Window.partitionBy(key).orderBy(*_cols(order)).rowsBetween(Window.unboundedPreceding, -1)
    prev_max = F.max(F.col(value)).over(w)
    return df.withColumn("_prev_max", prev_max).filter(
        F.col("_prev_max").isNull() | (F.col(value) > F.col("_prev_max"))
    ).drop("_prev_max")


def strictly_newer_chunked(df: DataFrame, key: str, value: str, order_col: str, width: int) -> DataFrame:
    """D-9/D-10 for a numeric arrival column, split for hot keys.

    Arrival positions are cut into chunks of ``width``. (1) the maximum value per (key, chunk) is a
    partial aggregate; (2) each chunk's "maximum of all earlier chunks" is a running max over the
    chunk rows of a key (one row per chunk, so bounded); (3) inside a (key, chunk) partition the
    running max of earlier rows is combined with (2). Same rows as :func:`strictly_newer`, null keys (one
    key) and null arrivals (a first chunk of their own) included, but no task ever holds more than one
    chunk of a key.
    """
    d = df.withColumn("_chunk", F.floor(F.col(order_col) / F.lit(width)))
    per_chunk = d.groupBy(key, "_chunk").agg(F.max(value).alias("_cmax"))
    earlier_chunks = Window.partitionBy(key).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    prior = per_chunk.select(key, "_chunk", F.max("_cmax").over(earlier_chunks).alias("_prior"))
    prior = prior.select(F.col(key).alias("_k"), F.col("_chunk").alias("_c"), "_prior")
    j = d.join(prior, d[key].eqNullSafe(prior["_k"]) & d["_chunk"].eqNullSafe(prior["_c"]), "inner").drop("_k", "_c")
    inside = Window.partitionBy(key, "_chunk").orderBy(order_col).rowsBetween(Window.unboundedPreceding, -1)
    pm = F.greatest(F.max(F.col(value)).over(inside), F.col("_prior"))
    out = j.withColumn("_pm", pm)
    return out.filter(F.col("_pm").isNull() | (F.col(value) > F.col("_pm"))).drop("_chunk", "_prior", "_pm")
