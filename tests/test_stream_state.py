"""Live configuration, target life cycle, windows of processing time, TTLs and time guards of the stream forms."""

import time

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tillstream.operators import cdc
from tillstream.sources import cdc as src
from tillstream.sources import dims
from tillstream.streaming import processors as P
from tillstream.streaming import routing, sources, twins
from tillstream.streaming.sinks import CommittedLoads

CONFIG = "seq long, op string, source_table string, sink_table string, sink_family string, sink_columns string, sink_row_key string"


def _change(spark, *rows):
    return spark.createDataFrame(list(rows), CONFIG)


def test_each_batch_is_routed_by_the_config_valid_for_it(spark, tmp_path):
    ledger = routing.TargetLedger(str(tmp_path))
    config = routing.LiveConfig(str(tmp_path), ledger)
    router = routing.LiveRouter(config, str(tmp_path / "out"))
    rows = cdc.valid_changes(dims.dim_source_envelopes(spark, SF_SMALL), src.DB).where(F.col("source")["table"].isin("base_region", "region", "nation", "base_province"))
    tables = sorted(r[0] for r in rows.select(F.col("source")["table"]).distinct().collect())
    table = tables[0]
    data = rows.where(F.col("source")["table"] == table)
    n = data.count()
    assert n > 0
    router(data, 0)  # no configuration yet
    assert router.routed(spark) is None
    config(_change(spark, (1, "r", table, "dim_a", "info", "id,name", "id")), 0)
    router(data, 1)
    config(_change(spark, (2, "u", table, "dim_b", "info", "id", "id")), 1)
    router(data, 2)
    router(data, 1)  # retried after the change: still by the config it was first routed by
    config(_change(spark, (3, "d", table, "dim_b", "info", "id", "id")), 2)
    router(data, 3)
    got = {(r.sink_table, r.config_version, r.cols): r["count"] for r in router.routed(spark).groupBy("sink_table", "config_version", F.array_join(F.array_sort(F.map_keys("data")), ",").alias("cols")).count().collect()}
    assert got == {("dim_a", 0, "id,name"): n, ("dim_b", 1, "id"): n}


def test_targets_are_created_and_dropped_once(spark, tmp_path):
    ledger = routing.TargetLedger(str(tmp_path))
    assert ledger.targets(spark).count() == 0
    first = _change(spark, (1, "r", "t1", "dim_a", "info", "id", "id"), (2, "c", "t2", "dim_b", "info", "id", "id"))
    assert ledger.apply(first, "0") and not ledger.apply(first, "0")
    update = _change(spark, (3, "u", "t1", "dim_a", "more", "id", "id"), (4, "d", "t2", "dim_b", "info", "id", "id"))
    cdc.config_actions(update).write.parquet(f"{ledger.path}/ledger/data/_label=1")  # died before its commit
    assert sorted((r.sink_table, r.version) for r in ledger.targets(spark).collect()) == [("dim_a", 1), ("dim_b", 2)]
    assert ledger.apply(update, "1") and not ledger.apply(update, "1")
    assert [(r.sink_table, r.sink_family, r.version) for r in ledger.targets(spark).collect()] == [("dim_a", "more", 3)]
    assert sorted((r.seq, r.action) for r in ledger.actions(spark).collect()) == [(1, "create"), (2, "create"), (3, "create"), (3, "drop"), (4, "drop")]


# ---- processing time


def _files(spark, path, ddl, *batches):
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, ddl).coalesce(1).write.parquet(f"{path}/{k}")
    return spark.readStream.schema(ddl).option("maxFilesPerTrigger", 1).parquet(f"{path}/*")


def _until(spark, df, path, rows, seconds=90):
    name = f"held_{abs(hash(str(path)))}"
    q = df.writeStream.format("memory").queryName(name).outputMode("append").option("checkpointLocation", str(path)).trigger(processingTime="500 milliseconds").start()
    try:
        end = time.time() + seconds
        while time.time() < end and spark.table(name).count() < rows:
            time.sleep(0.5)
        return spark.table(name).collect()
    finally:
        q.stop()


def test_last_value_of_a_window_of_processing_time(spark, tmp_path):
    rows = [("u1", 1, "a"), ("u1", 3, "c"), ("u1", 2, "b"), ("u2", 5, None)]
    stream = _files(spark, tmp_path / "in", "uid string, ts long, os string", rows)
    got = _until(spark, twins.last_by_timer(stream, "uid", "ts", 2000), tmp_path / "ck", 2)
    assert sorted((r.uid, r.ts, r.os) for r in got) == [("u1", 3, "c"), ("u2", 5, None)] and all(r.w_ms % 2000 == 0 for r in got)


def test_sums_of_windows_of_processing_time(spark, tmp_path):
    cols = ["split_original_amount", "split_activity_amount", "split_coupon_amount", "split_total_amount"]
    ddl = "sku_id string, " + ", ".join(f"{c} string" for c in cols)
    stream = _files(spark, tmp_path / "in", ddl, [("1", "1.50", None, "0", "2"), ("1", "2.25", None, "1", "3")], [("2", "7", "7", "7", "7")])
    got = _until(spark, twins.sku_order_by_timer(stream, 2000), tmp_path / "ck", 2)
    assert sorted((r.sku_id, float(r.original_amount), r.activity_reduce_amount and float(r.activity_reduce_amount), float(r.order_amount)) for r in got) == [("1", 3.75, None, 5.0), ("2", 7.0, 7.0, 7.0)]


class _Timer:
    now = 0

    def getCurrentProcessingTimeInMs(self):
        return self.now


class _Handle:
    def __init__(self):
        self.timers = set()

    def registerTimer(self, t):
        self.timers.add(t)

    def deleteTimer(self, t):
        self.timers.discard(t)


def test_a_window_that_is_over_is_emitted_by_the_next_record():
    import pandas as pd
    from pyspark.sql import types as T
    from test_streaming import _Value

    proc = P.WindowLast("t", T.StructType([T.StructField("k", T.StringType()), T.StructField("t", T.LongType())]), 100)
    proc.handle, proc.state, clock = _Handle(), _Value(), _Timer()
    feed = lambda t: [f.values.tolist() for f in proc.handleInputRows(("a",), iter([pd.DataFrame({"k": ["a"], "t": [t]})]), clock)]
    clock.now = 130
    assert feed(1) == [] and proc.handle.timers == {200}
    clock.now = 199
    assert feed(0) == []
    clock.now = 305
    assert feed(9) == [[[100, "a", 1]]] and proc.handle.timers == {400}


# ---- state that expires

DAY = 86_400_000
TTL = [
    (lambda ttl: P.DailyFirst("ts", ["ts"], ["uid", "ts"], ttl), "uid string, ts long", 2),
    (lambda ttl: P.IsNewFix(["ts"], ttl_ms=ttl), "mid string, ts long, is_new string, is_new_fixed string", ["1", "1"]),
    (lambda ttl: P.StrictlyNewer("ts", ["ts"], ["uid", "ts"], ttl), "uid string, ts long", 2),
    (lambda ttl: P.RetractReplace("amount", ["ts"], ["uid", "amount"], ttl), "uid string, amount string, sign string", 2),
    (lambda ttl: P.SeenOnce("amount", ["uid"], ttl), "uid string", 2),
    (lambda ttl: P.RunningProfile(ttl), "uid string, os string, n_events long, search_item string, ts long", 2),
]


@pytest.mark.parametrize("which", range(len(TTL)))
def test_state_expires(spark, tmp_path, which):
    """The same record again, after the state's time: as if it were the first (D-1, D-2, D-3, D-8, D-9, D-10, D-11)."""
    make, ddl, want = TTL[which]
    row = ("u", DAY * 3, "1", "1.00", "os", None) if which != 1 else ("u", DAY * 3, "1", "1.00", "os", None)
    second = row if which != 1 else ("u", DAY * 5, "1", "1.00", "os", None)  # another day: '0' while the state lives
    cols = "uid string, ts long, is_new string, amount string, os string, search_item string"
    counts = {}
    for ttl in (3_600_000, 1):
        path = tmp_path / str(ttl)
        stream = _files(spark, path / "in", cols, [row], [second])
        counts[ttl] = twins.run(spark, twins._tws(stream, "uid", make(ttl), ddl), "ttl", timed=True).collect()
    if which == 1:
        assert sorted(r.is_new_fixed for r in counts[1]) == want and sorted(r.is_new_fixed for r in counts[3_600_000]) == ["0", "1"]
    elif which == 3:
        assert len(counts[1]) == want and len(counts[3_600_000]) == 3  # with the state: the new one, its retraction, the new one
    elif which == 5:
        assert [r.n_events for r in counts[1]] == [1, 1] and sorted(r.n_events for r in counts[3_600_000]) == [1, 2]
    else:
        assert len(counts[1]) == want and len(counts[3_600_000]) == 1


def test_digests_not_records_are_held(spark, tmp_path):
    """D-8's state has one small entry per distinct record."""
    rows = [(f"u{i % 3}", "long text " * 100 + str(i % 40)) for i in range(200)]
    stream = _files(spark, tmp_path / "in", "uid string, body string", rows[:100], rows[100:])
    q = twins.seen_once(stream).writeStream.format("memory").queryName("digests").option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    q.awaitTermination()
    distinct = len(set(rows))
    assert spark.table("digests").count() == distinct
    assert sum(o["numRowsTotal"] for o in q.lastProgress["stateOperators"]) <= distinct


# ---- time


def test_bad_times_are_zero_and_broker_time_rules(spark, tmp_path):
    times = spark.createDataFrame([("5",), (None,), ("x",)], "ts string").select(F.unix_millis(sources.event_time("ts")).alias("t"))
    assert sorted(r.t for r in times.collect()) == [0, 0, 5]
    hour = 3_600_000
    ddl = "value string, ts long, broker long"  # the record's own time is no guide here
    batches = [[("a", 9 * hour, 0), ("b", 0, 5 * hour)], [("c", 0, 5 * hour + 1)], [("late", 9 * hour, 1)], [("d", 0, 9 * hour)]]
    stream = sources.broker_timed(_files(spark, tmp_path / "in", ddl, *batches).withColumn("timestamp", F.timestamp_millis("broker")), "3 seconds")
    agg = stream.groupBy(F.window("timestamp", "1 hour")).count().select(F.date_format("window.start", "HH").alias("h"), "count")
    assert sorted((r.h, r["count"]) for r in twins.run(spark, agg, "broker").collect()) == [("00", 1), ("05", 2)]


def test_committed_loads_before_the_first(spark, tmp_path):
    loads = CommittedLoads(str(tmp_path / "none"))
    assert loads.read(spark) is None and loads.labels(spark).count() == 0
