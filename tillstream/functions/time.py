"""Date / time column functions (F-2 ... F-6, F-8 ... F-12, W-9).

All are built-in Spark expressions, so they stay inside whole-stage codegen.
Epoch values are milliseconds. Formatting uses the session time zone, which
:func:`tillstream.session.prepare` pins to UTC; functions that the reference
pins to a fixed offset take a ``zone`` parameter instead.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DATE_FMT = "yyyy-MM-dd"
DATETIME_FMT = "yyyy-MM-dd HH:mm:ss"
PARTITION_FMT = "yyyyMMdd"

# Zone that string -> epoch conversions are pinned to in the reference (dateTimeToTs / dateToTs).
FIXED_PARSE_ZONE = "+08:00"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ts_to_date(ms) -> Column:
    """epoch ms -> 'yyyy-MM-dd' (tsToDate)."""
    return F.date_format(F.timestamp_millis(_c(ms)), DATE_FMT)


def ts_to_datetime(ms) -> Column:
    """epoch ms -> 'yyyy-MM-dd HH:mm:ss' (tsToDateTime)."""
    return F.date_format(F.timestamp_millis(_c(ms)), DATETIME_FMT)


def ts_to_partition(ms) -> Column:
    """epoch ms -> 'yyyyMMdd' (tsToDateForPartition, the ``ds`` column)."""
    return F.date_format(F.timestamp_millis(_c(ms)), PARTITION_FMT)


def epoch_string_to_date(s) -> Column:
    """F-2: epoch-ms carried as a string -> 'yyyy-MM-dd' (integer division, never '/')."""
    return F.date_format(F.timestamp_millis(_c(s).cast("bigint")), DATE_FMT)


def datetime_to_ts(s, zone: str = FIXED_PARSE_ZONE) -> Column:
    """F-4 dateTimeToTs: 'yyyy-MM-dd HH:mm:ss' read in ``zone`` -> epoch ms."""
    return F.unix_millis(F.to_utc_timestamp(F.to_timestamp(_c(s), DATETIME_FMT), zone))


def date_to_ts(s, zone: str = FIXED_PARSE_ZONE) -> Column:
    """F-4 dateToTs: 'yyyy-MM-dd' midnight in ``zone`` -> epoch ms."""
    return F.unix_millis(F.to_utc_timestamp(F.to_timestamp(_c(s), DATE_FMT), zone))


def day_diff(ms, date_str, zone: str = FIXED_PARSE_ZONE) -> Column:
    """F-5: whole days between an epoch-ms instant and midnight of a date (truncating)."""
    return ((_c(ms) - date_to_ts(date_str, zone)) / F.lit(86_400_000)).cast("bigint")


def epoch_day_to_date(n) -> Column:
    """F-8: epoch day number -> ISO date string."""
    return F.date_format(F.date_add(F.lit("1970-01-01").cast("date"), _c(n).cast("int")), DATE_FMT)


def yyyymmdd(d) -> Column:
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("bigint")


def age_years(birth, as_of) -> Column:
    """F-9: completed years between two dates (same as java.time.Period years; 29 Feb safe)."""
    return F.floor((yyyymmdd(as_of) - yyyymmdd(birth)) / 10000).cast("bigint")


def decade(birth) -> Column:
    """F-10: year div 10 * 10."""
    return (F.floor(F.year(birth) / 10) * 10).cast("bigint")


# Zodiac sign by (month*100 + day) upper bound, in calendar order.
# Capricorn wraps the year end (>= 1222 or <= 119).
ZODIAC_UPPER_BOUNDS = [
    (119, "摩羯座"),
    (218, "水瓶座"),
    (320, "双鱼座"),
    (419, "白羊座"),
    (520, "金牛座"),
    (621, "双子座"),
    (722, "巨蟹座"),
    (822, "狮子座"),
    (922, "处女座"),
    (1023, "天秤座"),
    (1122, "天蝎座"),
    (1221, "射手座"),
]
ZODIAC_WRAP = "摩羯座"


def zodiac(birth) -> Column:
    """F-11: zodiac sign of a date."""
    md = F.month(birth) * 100 + F.dayofmonth(birth)
    expr = F.when(md <= ZODIAC_UPPER_BOUNDS[0][0], ZODIAC_UPPER_BOUNDS[0][1])
    for bound, sign in ZODIAC_UPPER_BOUNDS[1:]:
        expr = expr.when(md <= bound, sign)
    return expr.otherwise(ZODIAC_WRAP)


# Day-part slot by hour upper bound (exclusive), in order; the last slot takes the rest.
PAY_TIME_SLOTS = [(6, "凌晨"), (9, "早晨"), (12, "上午"), (14, "中午"), (18, "下午"), (22, "晚上")]
PAY_TIME_LAST_SLOT = "夜间"


def pay_time_slot(ms) -> Column:
    """F-12: epoch ms -> one of seven day-part names (session zone)."""
    h = F.hour(F.timestamp_millis(_c(ms)))
    expr = F.when(h < PAY_TIME_SLOTS[0][0], PAY_TIME_SLOTS[0][1])
    for bound, name in PAY_TIME_SLOTS[1:]:
        expr = expr.when(h < bound, name)
    return expr.otherwise(PAY_TIME_LAST_SLOT)


def window_strings(win: str = "window") -> list[Column]:
    """W-9: a ``window`` struct -> ``stt``, ``edt``, ``cur_date`` strings."""
    w = F.col(win)
    return [
        F.date_format(w.start, DATETIME_FMT).alias("stt"),
        F.date_format(w.end, DATETIME_FMT).alias("edt"),
        F.date_format(w.start, DATE_FMT).alias("cur_date"),
    ]
