"""Hand-made rows for the semantics notes (N-x) and the reference's own sample outputs."""

import datetime as dt

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from tillstream.functions import time as T
from tillstream.operators import cdc, interval, scoring, state, windows


def test_label_samples_from_reference_comments(spark):
    # birthday -> decade, zodiac, age as of 2025-05-12 (the reference's printed samples)
    rows = [("1979-07-06",), ("2005-08-12",), ("1997-09-06",)]
    df = spark.createDataFrame(rows, "b string").select(
        "b",
        T.decade(F.to_date("b")).alias("decade"),
        T.zodiac(F.to_date("b")).alias("z"),
        T.age_years(F.to_date("b"), F.lit("2025-05-12").cast("date")).alias("age"),
    )
    got = {r.b: (r.decade, r.z, r.age) for r in df.collect()}
    assert got["1979-07-06"] == (1970, "巨蟹座", 45)
    assert got["2005-08-12"] == (2000, "狮子座", 19)
    assert got["1997-09-06"] == (1990, "处女座", 27)


def test_age_on_29_february(spark):
    df = spark.createDataFrame([("2004-02-29", "2025-02-28"), ("2004-02-29", "2025-03-01")], "b string, a string")
    ages = [r[0] for r in df.select(T.age_years(F.to_date("b"), F.to_date("a"))).collect()]
    assert ages == [20, 21]


def test_zodiac_boundaries(spark):
    days = ["2000-01-19", "2000-01-20", "2000-12-21", "2000-12-22", "2000-02-18", "2000-02-19"]
    df = spark.createDataFrame([(d,) for d in days], "d string")
    got = [r[0] for r in df.select(T.zodiac(F.to_date("d"))).collect()]
    assert got == ["摩羯座", "水瓶座", "射手座", "摩羯座", "水瓶座", "双鱼座"]


def test_amount_band_exactly_1000_is_high(spark):
    df = spark.createDataFrame([("999.99",), ("1000",), ("1000.01",), ("4000",), (None,)], "t string")
    got = [r[0] for r in df.select(scoring.amount_band(F.col("t"))).collect()]
    assert got == ["low", "high", "mid", "high", "low"]


def test_half_up_rounding_of_weights(spark):
    df = spark.createDataFrame([("Android",), ("iOS",), ("Other",)], "os string")
    out = scoring.score_device(spark, df).collect()
    by = {r.os: r for r in out}
    assert by["iOS"].device_18_24 == 0.07 and by["Android"].device_50 == 0.03
    assert by["Other"].device_18_24 is None


def test_age_argmax_first_wins_on_ties(spark):
    df = spark.createDataFrame([(0.5, 0.5, 0.1, 0.1, 0.1, 0.1), (0.1, 0.2, 0.2, 0.1, 0.0, 0.0)], "a double, b double, c double, d double, e double, f double")
    got = [r[0] for r in df.select(scoring.age_level([F.col(c) for c in "abcdef"])).collect()]
    assert got == ["18_24", "25_29"]


def test_columnwise_merge_empty_never_overwrites_and_delete_erases(spark):
    rows = [
        Row(row_key="1", op="r", seq=1, after={"a": "x", "b": "y"}),
        Row(row_key="1", op="u", seq=2, after={"a": "", "b": "z"}),
        Row(row_key="2", op="r", seq=1, after={"a": "p"}),
        Row(row_key="2", op="d", seq=2, after=None),
        Row(row_key="3", op="r", seq=1, after={"a": "old"}),
        Row(row_key="3", op="d", seq=2, after=None),
        Row(row_key="3", op="c", seq=3, after={"b": "new"}),
    ]
    df = spark.createDataFrame(rows, "row_key string, op string, seq int, after map<string,string>")
    got = {r.row_key: dict(r.cells) for r in cdc.columnwise_merge(df, "row_key", ["seq"]).collect()}
    assert got == {"1": {"a": "x", "b": "z"}, "3": {"b": "new"}}


def test_upsert_final_tombstone(spark):
    df = spark.createDataFrame([("k", "r", 1, "a"), ("k", "d", 2, None), ("j", "r", 1, "b")], "id string, op string, seq int, v string")
    assert sorted(r.id for r in cdc.upsert_final(df, "id", ["seq"]).collect()) == ["j"]


def test_keep_latest_tie_later_arrival_wins(spark):
    df = spark.createDataFrame([("d1", 100, 1, "first"), ("d1", 100, 2, "second"), ("d1", 50, 3, "older")], "id string, ts long, arrival int, v string")
    got = state.keep_latest(df, "id", ["ts", "arrival"]).collect()
    assert [r.v for r in got] == ["second"]


def test_latest_version_is_last_per_group(spark):
    # null and repeated keys over several partitions
    rows = [(None if i % 11 == 0 else f"d{i % 7}", i * 37 % 50, i, f"v{i}") for i in range(200)]
    df = spark.createDataFrame(rows, "id string, ts long, arrival int, v string").repartition(5)
    want = {}
    for r in rows:
        want[r[0]] = max(want.get(r[0], (-1, -1, "")), r[1:])
    got = {r.id: (r.ts, r.arrival, r.v) for r in state.latest_version(df, "id", ["ts", "arrival"]).collect()}
    assert got == want


def test_retraction_keeps_old_time(spark):
    df = spark.createDataFrame([("d", 10, "5.00"), ("d", 20, "7.00")], "id string, ts_ms long, amount string")
    df = df.withColumn("amount", F.col("amount").cast("decimal(10,2)"))
    got = sorted((r.ts_ms, str(r.amount), r.sign) for r in state.retract_and_replace(df, "id", ["amount"], ["ts_ms"]).collect())
    assert got == [(10, "-5.00", -1), (10, "5.00", 1), (20, "7.00", 1)]


def test_strictly_newer_drops_equal_and_older(spark):
    df = spark.createDataFrame([("k", 1, 10), ("k", 2, 10), ("k", 3, 9), ("k", 4, 11)], "k string, arrival int, v long")
    got = [r.arrival for r in state.strictly_newer(df, "k", "v", ["arrival"]).orderBy("arrival").collect()]
    assert got == [1, 4]


def test_login_back_after_eight_days(spark):
    ms = lambda s: int(dt.datetime.fromisoformat(s).replace(tzinfo=dt.timezone.utc).timestamp() * 1000)
    rows = [("u", ms("2024-01-01 10:00:00")), ("u", ms("2024-01-01 12:00:00")), ("u", ms("2024-01-09 00:00:01")), ("u", ms("2024-01-10 00:00:00"))]
    df = spark.createDataFrame(rows, "uid string, ts long")
    got = [(r.cur_date, r.back_ct) for r in state.login_back(df).orderBy("ts").collect()]
    assert got == [("2024-01-01", 0), ("2024-01-09", 1), ("2024-01-10", 0)]


def test_interval_join_bounds_inclusive(spark):
    left = spark.createDataFrame([("a", 1_000_000)], "k string, t long")
    right = spark.createDataFrame([("a", 1_000_000 - 120_000), ("a", 1_000_000 + 120_000), ("a", 1_000_000 + 120_001), ("b", 1_000_000)], "rk string, rt long")
    got = sorted(r.rt for r in interval.interval_join(left, right, "k", "rk", "t", "rt", -120_000, 120_000).collect())
    assert got == [880_000, 1_120_000]


def test_prune_columns_sample(spark):
    df = spark.createDataFrame([({"tm_name": "x", "create_time": "1", "logo_url": "u", "id": "7"}, "id,tm_name")], "m map<string,string>, cols string")
    got = df.select(cdc.prune_columns(F.col("m"), F.col("cols")).alias("p")).collect()[0].p
    assert got == {"tm_name": "x", "id": "7"}


def test_config_fold_and_actions(spark):
    from tillstream.sources import dims

    ch = dims.config_dim_changes(spark)
    cur = {r.source_table: r.sink_columns for r in cdc.fold_config(ch).collect()}
    assert cur == {"part": "id,name", "nation": "id,name,region_id"}
    acts = [(r.seq, r.action) for r in cdc.config_actions(ch).orderBy("seq", "step").collect()]
    assert acts == [(1, "create"), (2, "create"), (3, "create"), (4, "drop"), (5, "drop"), (5, "create")]


def test_map_merge_right_wins(spark):
    from tillstream.functions import maps

    df = spark.createDataFrame([({"a": "1", "b": "2"}, {"b": "3"})], "l map<string,string>, r map<string,string>")
    got = df.select(maps.merge_right_wins(F.col("l"), F.col("r")).alias("m"), maps.prefix_keys(F.col("r"), "info_").alias("p")).collect()[0]
    assert got.m == {"a": "1", "b": "3"} and got.p == {"info_b": "3"}


def test_epoch_string_to_date_uses_integer_division(spark):
    df = spark.createDataFrame([("1704153599999",)], "s string")
    assert df.select(T.epoch_string_to_date(F.col("s"))).collect()[0][0] == "2024-01-01"


def test_keyword_udtf_twin_matches_builtin(spark):
    from tillstream.operators import text

    text.register_keyword_udtf(spark)
    got = [r.word for r in spark.sql("SELECT word FROM ik_analyze('Hello  big\tWorld')").collect()]
    df = spark.createDataFrame([("Hello  big\tWorld",)], "t string")
    want = [r.keyword for r in text.explode_keywords(df, "t").collect()]
    assert got == want == ["hello", "big", "world"]


def test_partitioned_writers(spark, tmp_path):
    from tillstream.operators import comments

    recs = spark.createDataFrame([("dwd_a", "1", "{}"), ("dwd_b", "2", "{}")], "topic string, key string, value string")
    cdc.write_dynamic(recs, str(tmp_path / "topics"))
    back = spark.read.json(str(tmp_path / "topics"))
    assert sorted((r.topic, r.key) for r in back.collect()) == [("dwd_a", "1"), ("dwd_b", "2")]
    rows = spark.createDataFrame([(1, 1704067200000)], "id long, ts_ms long")
    comments.write_partitioned(comments.with_ds(rows), str(tmp_path / "ds"))
    assert [r.ds for r in spark.read.parquet(str(tmp_path / "ds")).collect()] == [20240101]


def test_chunked_running_max_equals_plain_on_a_hot_key(spark):
    import random

    rnd = random.Random(7)
    rows = [("hot", i, rnd.randint(0, 50)) for i in range(200)] + [("cold", i, rnd.randint(0, 50)) for i in range(7)]
    df = spark.createDataFrame(rows, "k string, arrival long, v long")
    plain = sorted((r.k, r.arrival) for r in state.strictly_newer(df, "k", "v", ["arrival"]).collect())
    chunked = sorted((r.k, r.arrival) for r in state.strictly_newer_chunked(df, "k", "v", "arrival", 3).collect())
    assert plain == chunked


def test_sensitive_hits_do_not_depend_on_dictionary_size_or_ids(spark, tmp_path):
    from tillstream.operators import comments

    rows = [(1, "Die Katze, die QUE-und was"), (1, "die"), (None, "die die"), (2, "nothing here"), (3, None)]
    df = spark.createDataFrame(rows, "id long, comment_txt string")
    small = ["Die", "die", "que", "und"]
    want = [0, 0, 1, 2, 4]
    for words in (small, small + [f"zz{i}" for i in range(5000)]):
        assert sorted(r.hits for r in comments.sensitive_hits(df, words=words).collect()) == want
    assert sorted(r.hits for r in comments.sensitive_hits(df, words=[]).collect()) == [0] * 5
    (tmp_path / "words.txt").write_text("Die\n\n que \nund\ndie\n")
    loaded = comments.load_dictionary(spark, str(tmp_path / "words.txt"))
    assert loaded == ["die", "que", "und"]
    with pytest.raises(ValueError, match="more than 2"):
        comments.load_dictionary(spark, str(tmp_path / "words.txt"), most=2)
    assert sorted(r.hits for r in comments.sensitive_hits(df, words=loaded).collect()) == want


LOG_ROW = "common struct<mid:string,is_new:string,vc:string,ch:string,ar:string>, page struct<last_page_id:string,during_time:long>, ts long, event_id long"


def _log(spark, rows):
    data = [((mid, new, "v", ch, "a"), (None, 5), ts, i) for mid, new, ch, ts, i in rows]
    return spark.createDataFrame(data, LOG_ROW)


TIED = [("m", "1", "c1", 1000, 2), ("m", "1", "c2", 1000, 1), ("m", "1", "c1", 2000, 3), ("m", "1", "c1", 90_000_000, 4), (None, "1", "c1", 5, 5), (None, "1", "c1", 90_000_005, 6)]


def test_first_view_rule_on_ties_nulls_and_any_order(spark):
    from tillstream.operators import logsplit, windows

    for rows in (TIED, TIED[::-1], TIED[2:] + TIED[:2]):
        log = _log(spark, rows)
        d6 = state.page_view_measures(log).collect()
        assert len(d6) == 6 and sorted((r.mid, r.ts, r.ch) for r in d6 if r.uv_ct) == [("m", 1000, "c2"), ("m", 90_000_000, "c1")]
        w6 = {(r.ch, r.cur_date): (r.uv_ct, r.pv_ct) for r in windows.traffic_vc_ch_ar_is_new(log, "1 day").collect()}
        assert w6 == {("c1", "1970-01-01"): (0, 3), ("c2", "1970-01-01"): (1, 1), ("c1", "1970-01-02"): (1, 2)}
        d1 = sorted((r.event_id, r.common.is_new) for r in logsplit.fix_is_new(log).collect())
        assert d1 == [(1, "1"), (2, "1"), (3, "1"), (4, "0"), (5, "1"), (6, "1")]


def test_last_per_window_breaks_ties_by_event_id(spark):
    from tillstream.operators import labels

    rows = [("u", 1000, 1, "a"), ("u", 1000, 2, "b"), ("u", 999, 3, "c")]
    for r in (rows, rows[::-1]):
        df = spark.createDataFrame(r, "uid string, ts long, event_id long, v string")
        assert [x.v for x in labels.last_per_window(df, "uid", "ts").collect()] == ["b"]


def test_chunked_running_max_keeps_null_keys_and_arrivals(spark):
    rows = [(None, 1, 5), (None, 2, 4), (None, 9, 6), ("k", None, 3), ("k", 4, 2), ("k", 5, 7)]
    df = spark.createDataFrame(rows, "k string, arrival long, v long")
    rows_of = lambda d: sorted((str(r.k), r.v) for r in d.collect())
    plain = rows_of(state.strictly_newer(df, "k", "v", ["arrival"]))
    assert rows_of(state.strictly_newer_chunked(df, "k", "v", "arrival", 3)) == plain == [("None", 5), ("None", 6), ("k", 3), ("k", 7)]


def test_hot_device_is_spread_over_groups(spark):
    from tillstream.operators import logsplit

    rows = [("hot" if i % 3 else f"m{i}", "1", "c", i, i) for i in range(6000)]
    p = logsplit.fix_is_new(_log(spark, rows))._jdf.queryExecution().executedPlan().toString()
    assert "_salt" in p
    salted = _log(spark, rows).where("common.mid = 'hot'").groupBy(F.pmod(F.xxhash64("event_id", "ts"), F.lit(logsplit.SALTS))).count()
    assert max(r["count"] for r in salted.collect()) < 4000 / logsplit.SALTS * 1.5


def test_first_token_with_long_separators(spark):
    from tillstream.functions import text

    df = spark.createDataFrame([("ab||cd|e", "x-y")], "a string, b string")
    got = df.select(text.first_token(F.col("a"), "||"), text.first_token(F.col("b"), "-"), text.first_token(F.col("a"), "|")).collect()[0]
    assert tuple(got) == ("ab", "x", "ab")


def test_parse_can_fail_on_bad_lines(spark):
    import pytest

    from tillstream.operators import logsplit

    df = spark.createDataFrame([('{"ts": 1}',), ("{bad",)], "value string")
    assert logsplit.dirty_rows(logsplit.parse_log(df)).count() == 1
    with pytest.raises(Exception, match="(?i)malformed|FAILFAST"):
        logsplit.parse_log(df, fail_fast=True).collect()


def test_small_tables_are_pinned_and_large_ones_left(spark):
    from tillstream.sources.tables import small

    dim = spark.range(50).withColumnRenamed("id", "k")
    df = spark.range(100).withColumnRenamed("id", "x")
    a = df.join(small(dim).withColumnRenamed("k", "x"), "x")
    b = df.join(small(dim, most=10).withColumnRenamed("k", "x"), "x")
    assert a.count() == b.count() == 50
    assert "BroadcastHashJoin" in a._jdf.queryExecution().executedPlan().toString()


def test_sku_sums_use_the_split_original_amount(spark):
    from tillstream.operators import windows

    df = spark.createDataFrame([("s", 0, 10, 20, 1, 2, 17)], "sku_id string, ts_ms long, order_price long, split_original_amount long, split_activity_amount long, split_coupon_amount long, split_total_amount long")
    r = windows.sku_order(df).collect()[0]
    assert (r.original_amount, r.order_amount) == (20, 17)


def test_province_order_counts_an_order_once_per_window_and_province(spark):
    # repeated details, a repeated order row, an order in two provinces, null ids, provinces and amounts
    day = 86_400_000
    details = [("1", 0, "5.00"), ("1", 5, "-5.00"), ("1", day, "2.00"), ("2", 7, None), ("2", 8, "1.50"), (None, 0, "9.00"), ("3", 1, "4.00"), ("9", 1, "8.00"), ("3", None, "6.00")]
    d = spark.createDataFrame(details, "order_id string, ts_ms long, a string").withColumn("split_total_amount", F.col("a").cast("decimal(18,4)"))
    orders = spark.createDataFrame([("1", "p"), ("1", "p"), ("1", "q"), ("2", "p"), ("3", None), ("3", None), (None, "p")], "id string, province_id string")
    provinces = spark.createDataFrame([("p", "P")], "id string, name string")
    joined = d.join(orders, d["order_id"] == orders["id"], "inner").groupBy(F.window(F.timestamp_millis("ts_ms"), "1 day").alias("w"), "province_id")
    want = joined.agg(F.sum("split_total_amount").alias("a"), F.count_distinct("order_id").alias("n"))
    want = {(str(r.w.start.date()), r.province_id, str(r.a), r.n) for r in want.collect()}
    out = windows.province_order(d, orders, provinces, "1 day")
    got = [(r.cur_date, r.province_id, str(r.order_amount), r.order_count) for r in out.collect()]
    assert len(got) == len(want) == 5 and set(got) == want
    assert {r.province_name for r in out.collect() if r.province_id == "p"} == {"P"}
