"""The DWD joins and what follows them as streams: changelogs with corrections, whose final state is the batch key."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from test_streaming import _same
from tillstream.plans import QUERIES
from tillstream.session import prepare
from tillstream.streaming import joins, twins


@pytest.fixture(scope="module")
def detail_changes(spark):
    return joins.order_detail_changes(prepare(spark), SF_SMALL)


@pytest.mark.parametrize("key", sorted(joins.TWINS))
def test_join_twin_equals_batch(spark, key, detail_changes):
    twin, windows_stay_open = joins.TWINS[key]
    shared = [detail_changes] if key in ("dwd_trade_order_detail", "dwd_trade_order_cancel", "dwd_trade_pay_suc") else []
    streamed, batch = twin(spark, SF_SMALL, *shared), QUERIES[key](spark, SF_SMALL)
    if windows_stay_open:
        done = twins.closed(batch)
        assert done.count() > 3
        _same(streamed.where(F.col("edt") <= done.agg(F.max("edt")).first()[0]), done)
    else:
        _same(streamed, batch)


def _join(spark, path, left, right, outer=True, ttl_ms=joins.RETAIN_MS):
    """Changelog rows of files that arrive one by one: left (id, k, v, t) and right (k, w, t); ``None`` stands for no file."""
    for k, (l, r) in enumerate(zip(left, right, strict=True)):
        spark.createDataFrame(l, "id string, k string, v string, t long").coalesce(1).write.parquet(f"{path}/l/{k}")
        spark.createDataFrame(r, "k string, w string, t long").coalesce(1).write.parquet(f"{path}/r/{k}")
    read = lambda side, ddl: spark.readStream.schema(ddl).option("maxFilesPerTrigger", 1).parquet(f"{path}/{side}/*")
    l, r = read("l", "id string, k string, v string, t long"), read("r", "k string, w string, t long")
    sides = joins.side(l, ["k"], ["id"], joins.order_key("t")), joins.side(r, ["k"], ["k"], joins.order_key("t"))
    return joins.join_topics(spark, "own", l, r, *sides, outer=outer, ttl_ms=ttl_ms)


def test_outer_rows_are_corrected_when_the_other_side_arrives(spark, tmp_path):
    left = [[("a", "1", "x", 1), ("n", None, "z", 1)], [("b", "1", "y", 2)], [("a", "1", "old", 0), ("a", "1", "x2", 5)]]
    right = [[("9", "other", 1)], [("1", "first", 1)], [("1", "second", 2)]]
    got = _join(spark, str(tmp_path), left, right)
    log = sorted((r.seq, r.op, r.id, r.v, r.w) for r in got.where("id <> 'n'").collect())
    assert log[0] == (0, "u", "a", "x", None) and (1, "d", "a", "x", None) in log
    assert {x[1:] for x in log if x[1] == "u"} == {("u", "a", "x", None), ("u", "a", "x", "first"), ("u", "b", "y", "first"), ("u", "a", "x2", "second"), ("u", "b", "y", "second")}
    assert sorted((r.id, r.v, r.w) for r in joins.final_state(spark, got, "own").collect()) == [("a", "x2", "second"), ("b", "y", "second"), ("n", "z", None)]


def test_inner_join_forgets_after_its_retention(spark, tmp_path):
    left, right = [[("a", "1", "x", 1)], [("b", "1", "y", 2)]], [[("2", "none", 1)], [("1", "late", 9)]]
    assert {r.id for r in _join(spark, str(tmp_path / "kept"), left, right, outer=False).collect()} == {"a", "b"}
    assert {r.id for r in _join(spark, str(tmp_path / "short"), left, right, outer=False, ttl_ms=1).collect()} == {"b"}


def test_versions_of_a_changelog_may_come_in_any_order(spark, tmp_path):
    rows = [("a", "1", "x", 4, "d"), ("a", "1", "x", 2, "u"), ("b", "1", "y", 1, "u"), ("a", "1", "x", 1, "d")]
    spark.createDataFrame(rows, "id string, k string, v string, t long, op string").coalesce(1).write.parquet(str(tmp_path / "l"))
    spark.createDataFrame([("1", "w")], "k string, w string").write.parquet(str(tmp_path / "r"))
    l, r = spark.readStream.schema("id string, k string, v string, t long, op string").parquet(str(tmp_path / "l")), spark.readStream.schema("k string, w string").parquet(str(tmp_path / "r"))
    got = joins.join_topics(spark, "any", l, r, joins.side(l, ["k"], ["id"], joins.order_key("t"), F.col("op")), joins.side(r, ["k"], ["k"], F.lit("0")))
    assert [(x.id, x.w) for x in got.collect()] == [("b", "w")]
