"""Streaming twins, replayed over several micro-batches, produce the same rows as their batch keys (sf0.001)."""

import time

import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tillstream.operators import windows
from tillstream.plans import QUERIES
from tillstream.sources.logs import log_text
from tillstream.streaming import processors, sinks, sources, twins


def _same(a, b):
    cols = sorted(b.columns)
    ra = sorted(tuple(str(x) for x in r) for r in a.select(*cols).collect())
    rb = sorted(tuple(str(x) for x in r) for r in b.select(*cols).collect())
    assert ra == rb and rb


@pytest.mark.parametrize("key", sorted(k for k in twins.TWINS if k != "src_event_text"))
def test_twin_equals_batch(spark, key):
    twin, windows_stay_open = twins.TWINS[key]
    streamed, batch = twin(spark, SF_SMALL), QUERIES[key](spark, SF_SMALL)
    if windows_stay_open:
        done = twins.closed(batch)
        assert done.count() > 3
        _same(streamed.where(F.col("edt") <= done.agg(F.max("edt")).first()[0]), done)
    else:
        _same(streamed, batch)


def test_text_topic_twin(spark):
    _same(twins.event_text(spark, SF_SMALL), log_text(spark, SF_SMALL))


@pytest.mark.parametrize("parts", [1, 8, 16])
def test_replay_keeps_order_over_batches(spark, tmp_path, parts):
    df = spark.range(1000).withColumn("t", F.when(F.col("id") != 7, (F.col("id") * 7919) % 1000)).repartition(parts)
    seen = []
    stream = sources.replay(spark, df, str(tmp_path / "in"), "t", 4)
    q = stream.writeStream.foreachBatch(lambda b, i: seen.append(b.agg(F.min("t"), F.max("t"), F.count("*")).first())).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert len(seen) == 4 and sum(r[2] for r in seen) == 1000
    assert all(a[1] < b[0] for a, b in zip(seen, seen[1:]))


@pytest.mark.parametrize("parts", [1, 8, 16])
def test_windows_lose_no_row_of_a_replay(spark, parts):
    rows = spark.range(20_000).select(((F.col("id") * 7919) % 20_000 * 7_000).alias("ts"), F.lit(1).alias("one")).repartition(parts)
    got = twins.window_over(spark, rows, "all", "ts", "1 hour", [], {"n": "one"})
    want = windows.window_sums(rows, "ts", "1 hour", [], {"n": "one"})
    done = twins.closed(want)
    _same(got.where(F.col("edt") <= done.agg(F.max("edt")).first()[0]), done)


@pytest.mark.parametrize("parts", [16])
@pytest.mark.parametrize("key", ["dws_traffic_keyword", "ijoin_user_sup", "strictly_newer_detail", "visitor_is_new_fix", "dws_user_login"])
def test_twin_equals_batch_from_many_partitions(spark, monkeypatch, key, parts):
    plain = sources.replay
    monkeypatch.setattr(twins, "replay", lambda spark, df, *a: plain(spark, df.repartition(parts), *a))
    test_twin_equals_batch(spark, key)


def _run_to(spark, df, tmp_path, seconds):
    q = df.writeStream.format("memory").queryName("held").outputMode("append").option("checkpointLocation", str(tmp_path / "ck")).trigger(processingTime="500 milliseconds").start()
    try:
        end = time.time() + seconds
        while time.time() < end and not spark.table("held").count():
            time.sleep(0.5)
        return spark.table("held").collect()
    finally:
        q.stop()


def test_details_are_held_and_emitted_by_timer(spark, tmp_path):
    rows = [("d1", 1, "1.0"), ("d1", 3, "3.0"), ("d1", 2, "2.0"), ("d2", 5, None)]
    spark.createDataFrame(rows, "id string, ts_ms long, amount string").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("id string, ts_ms long, amount string").parquet(str(tmp_path / "in"))
    got = _run_to(spark, twins.hold_latest(spark, stream, 1500), tmp_path, 90)
    assert sorted((r.id, r.ts_ms, r.amount) for r in got) == [("d1", 3, "3.0"), ("d2", 5, None)]


def test_retention_bounds_a_streaming_join(spark, tmp_path):
    minute, start = 60_000, 86_400_000
    details = spark.createDataFrame([(f"d{i}", f"o{i}", start + i * minute) for i in range(200)], "id string, order_id string, ts_ms long")
    orders = spark.createDataFrame([(f"o{i}", start + i * minute + (i % 5) * 10 * minute, f"u{i}", "p") for i in range(200)], "id string, ts_ms long, user_id string, province_id string")
    d, o = sources.replay(spark, details, str(tmp_path / "d"), "ts_ms"), sources.replay(spark, orders, str(tmp_path / "o"), "ts_ms")
    got = twins.run(spark, twins.retained_detail_join(spark, d, o, delay="3 hours"), "retained")
    assert sorted(r.id for r in got.collect()) == sorted(f"d{i}" for i in range(200) if (i % 5) * 10 <= 30)


class _Value:
    def __init__(self):
        self.v = None

    def exists(self):
        return self.v is not None

    def get(self):
        return self.v

    def update(self, v):
        self.v = v


def _feed(proc, key, *batches):
    proc.state = _Value()
    out = [f for b in batches for f in proc.handleInputRows((key,), iter([b]), None)]
    return pd.concat(out, ignore_index=True) if out else pd.DataFrame()


def test_processors_carry_nulls():
    retract = processors.RetractReplace("amount", ["t"], ["id", "amount"])
    rows = pd.DataFrame({"id": ["a", "a"], "amount": ["1.50", None], "t": [1, 2]})
    got = _feed(retract, "a", rows, pd.DataFrame({"id": ["a"], "amount": ["2"], "t": [3]}))
    assert [tuple(r) for r in got[["amount", "sign"]].itertuples(index=False)] == [("1.50", "1"), ("-1.50", "-1"), (None, "1"), (None, "-1"), ("2", "1")]
    newer = processors.StrictlyNewer("v", ["t"], ["t"])
    frame = lambda *v: pd.DataFrame({"v": pd.array(v, dtype="Int64").astype("float64"), "t": range(len(v))})
    assert _feed(newer, "k", frame(None, 3, None, 3, 4), frame(4, 5, None))["t"].tolist() == [0, 1, 4, 1]


def test_daily_state_crosses_batches():
    day = 86_400_000
    rows = lambda *t: pd.DataFrame({"ts": t, "event_id": range(len(t)), "is_new": "1"})
    first = processors.DailyFirst("ts", ["ts"], ["ts"])
    assert _feed(first, "k", rows(5, 3), rows(9, day + 1), rows(day + 2))["ts"].tolist() == [3, day + 1]
    flag = processors.DailyFlag("ts", ["ts", "event_id"], ["ts"])
    assert _feed(flag, "k", rows(1, 1), rows(2, day))["uv_ct"].tolist() == [1, 0, 0, 1]
    assert _feed(flag, None, rows(1, 1))["uv_ct"].tolist() == [0, 0]
    fix = processors.IsNewFix(["ts"])
    assert _feed(fix, "m", rows(1, 2), rows(day))["is_new_fixed"].tolist() == ["1", "1", "0"]
    back = processors.LoginBack()
    got = _feed(back, "u", pd.DataFrame({"ts": [10, 20]}), pd.DataFrame({"ts": [8 * day + 1, 9 * day]}))
    assert got[["cur_date", "back_ct"]].values.tolist() == [["1970-01-01", 0], ["1970-01-09", 1], ["1970-01-10", 0]]


def test_sinks_compact_and_survive_retries(spark, tmp_path):
    up = sinks.UpsertSink(str(tmp_path / "u"), "id", ["seq"])
    rows = lambda *r: spark.createDataFrame(list(r), "id string, seq int, op string, v string")
    up(rows(("a", 1, "r", "x"), ("b", 1, "r", "y")), 0)
    up(rows(("b", 2, "d", None)), 1)
    up.compact(spark)
    up(rows(("a", 3, "u", "z"), ("b", 1, "r", "late")), 2)
    up(rows(("a", 3, "u", "z"), ("b", 1, "r", "late")), 2)  # retried
    assert sorted((r.id, r.v) for r in up.state(spark).collect()) == [("a", "z")]
    read = {"/".join(f.split("/u/")[1].split("/")[:3]) for f in up.log(spark).inputFiles()}
    assert {f.split("/part")[0] for f in read} == {"base/_upto=1", "delta/after=1/_batch=2"}
    up.compact(spark)
    up.compact(spark)  # nothing new: no base
    assert sorted((r.id, r.v) for r in up.state(spark).collect()) == [("a", "z")]
    # a base that died on the way, in part or without its pointer, is not read
    (tmp_path / "u" / "base" / "_upto=9").mkdir()
    rows(("z", 9, "r", "half")).withColumn("_batch", F.lit(9)).write.parquet(str(tmp_path / "u" / "base" / "_upto=10"))
    assert up.upto(spark) == 2 and sorted((r.id, r.v) for r in up.state(spark).collect()) == [("a", "z")]
    assert up.vacuum(spark) == 1 and up.vacuum(spark) == 0
    up(rows(("c", 4, "r", "new")), 3)
    assert sorted((r.id, r.v) for r in up.state(spark).collect()) == [("a", "z"), ("c", "new")]
    left = spark.read.option("recursiveFileLookup", "true").schema("id string").parquet(str(tmp_path / "u" / "delta" / "after=-1"), str(tmp_path / "u" / "delta" / "after=1"))
    assert left.count() == 0

    wide = sinks.ColumnwiseSink(str(tmp_path / "w"), "k", ["seq"])
    change = lambda *r: spark.createDataFrame(list(r), "k string, op string, seq int, after map<string,string>")
    wide(change(("1", "r", 1, {"a": "x", "b": "y"}), ("2", "r", 1, {"a": "p"})), 0)
    wide(change(("1", "u", 2, {"a": "", "b": "z"}), ("2", "d", 2, None)), 1)
    wide.compact(spark)
    wide(change(("2", "c", 3, {"b": "new"}), ("1", "u", 3, {"c": "w"})), 2)
    assert {r.k: r.cells for r in wide.state(spark).collect()} == {"1": {"a": "x", "b": "z", "c": "w"}, "2": {"b": "new"}}


def test_fan_out_dynamic_and_analytic_writers(spark, tmp_path):
    from tillstream.operators import logsplit

    parsed = logsplit.clean_rows(logsplit.parse_log(log_text(spark, SF_SMALL)))
    stream = sources.replay(spark, parsed, str(tmp_path / "in"), "ts", 3)
    q = stream.writeStream.foreachBatch(sinks.fan_out_writer(str(tmp_path / "out"))).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    q.awaitTermination()
    for name, rows in logsplit.five_way_split(parsed).items():
        assert spark.read.parquet(str(tmp_path / "out" / name)).count() == rows.count()

    topics = spark.createDataFrame([("dwd_a", "1", "{}"), ("dwd_b", "2", "{}")], "topic string, key string, value string")
    write = sinks.dynamic_topic_writer(str(tmp_path / "topics"))
    load = sinks.analytic_table_writer(str(tmp_path / "olap"), "t")
    for _ in range(2):  # a retried batch replaces its own folder and label
        write(topics, 0)
        load(topics, 7)
    assert spark.read.json(str(tmp_path / "topics")).count() == 2
    table = sinks.analytic_table(str(tmp_path / "olap"), "t")
    assert table.read(spark).count() == 2
    topics.write.json(str(tmp_path / "olap" / "t" / "data" / "_label=t-8"))  # written, not committed
    assert table.read(spark).count() == 2
    load(topics, 8)
    assert table.read(spark).count() == 4 and sorted(r.label for r in table.labels(spark).collect()) == ["t-7", "t-8"]
    append = sinks.append_writer(str(tmp_path / "topic"))
    for k in (0, 1, 1):
        append(topics, k)
    assert sinks.CommittedLoads(str(tmp_path / "topic"), "json").read(spark).count() == 4


def test_text_source_drops_null_values_and_kafka_options(spark, tmp_path):
    (tmp_path / "a.txt").write_text("x\ny\n")
    got = twins.run(spark, sources.text_source(spark, "text", path=str(tmp_path / "a.txt").replace(".txt", ".tx[t]")), "text")
    assert sorted(r.value for r in got.collect()) == ["x", "y"]
    w = sinks.kafka_writer(sources.text_source(spark, "text", path=str(tmp_path / "a.tx[t]")), "host:1", "topic", str(tmp_path / "ck"))
    assert hasattr(w, "start")


def test_late_rows_are_dropped(spark, tmp_path):
    """T-2 / T-6: with a zero-delay watermark rows behind it are dropped without a trace."""
    hour = 3_600_000
    path = str(tmp_path / "in")
    for rows in ([(0,), (hour * 5,)], [(hour * 5 + 1,)], [(1,)], [(hour * 9,)]):  # a watermark drops rows from the batch after next on
        spark.createDataFrame(rows, "ts long").coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema("ts long").option("maxFilesPerTrigger", 1).parquet(path)
    agg = stream.withColumn("t", F.timestamp_millis("ts")).withWatermark("t", "0 seconds").groupBy(F.window("t", "1 hour")).count()
    got = twins.run(spark, agg.select(F.date_format("window.start", "HH").alias("h"), "count"), "late")
    assert sorted((r.h, r["count"]) for r in got.collect()) == [("00", 1), ("05", 2)]
