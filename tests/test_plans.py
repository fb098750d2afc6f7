"""Physical-plan properties the scale design relies on (checked with explain, nothing executed)."""

import re

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

from tillstream.plans import QUERIES  # noqa: E402

BATCH_KEYS = sorted(QUERIES)


def plan(spark, key: str) -> str:
    df = E.queries()[key](spark, SF_SMALL)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", BATCH_KEYS)
def test_no_python_in_batch_plans(spark, key):
    p = plan(spark, key)
    for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas"):
        assert node not in p, f"{key} runs Python ({node})"


def test_flagship_reduces_map_side_and_never_rejoins_rows(spark):
    p = plan(spark, "dws_traffic_vc_ch_ar_is_new")
    assert "partial_sum" in p and p.count("FileScan parquet") == 1
    assert "SortMergeJoin" not in p and "BroadcastHashJoin" not in p
    assert "SortAggregate" not in p


@pytest.mark.parametrize("key", ["dwd_trade_order_detail", "order_keep_latest", "cart_daily_unique", "label_last_per_window"])
def test_latest_per_key_uses_top1_not_sort_aggregate(spark, key):
    p = plan(spark, key)
    assert "SortAggregate" not in p
    assert "WindowGroupLimit" in p


@pytest.mark.parametrize("key", ["dwd_trade_order_detail", "dwd_trade_order_cancel", "dwd_trade_pay_suc", "order_keep_latest"])
def test_latest_detail_sorts_no_scan_split(spark, key):
    # wide detail versions go to their key's task before the first sort: no top-1 (and sort) inside the map tasks
    limits = [x for x in plan(spark, key).split("\n") if "WindowGroupLimit" in x]
    assert limits and not [x for x in limits if x.endswith("Partial")]


def test_cdc_topic_scans_only_the_tables_a_query_reads(spark):
    # J-2 reads order_detail, activity, coupon (lineitem x3) and order_info (orders + customer): five scans,
    # the other union branches of the topic are pruned by the constant source['table'] filters
    p = plan(spark, "dwd_trade_order_detail")
    assert p.count("FileScan parquet") == 5


def test_interval_join_is_bucketed(spark):
    p = plan(spark, "ijoin_order_detail")
    assert "_ib" in p and "_rb" in p


def test_scan_reads_only_projected_columns(spark):
    # the keyword window never needs event_id, so the events scan must not read it
    p = plan(spark, "dws_traffic_keyword")
    read_schema = p.split("FileScan parquet")[1].split("ReadSchema: ")[1].split("\n")[0]
    assert "event_id" not in read_schema and "ts:" in read_schema


def test_score_tables_need_no_join(spark):
    p = plan(spark, "score_device")
    assert "score_key" not in p


def test_no_fixed_repartitions_in_any_batch_plan(spark):
    for key in BATCH_KEYS:
        assert "REPARTITION_BY_NUM" not in plan(spark, key), key


@pytest.mark.parametrize(("key", "most"), [("label_age_level", 2), ("label_final", 2), ("dws_trade_sku_order", 1), ("dim_sku_chain", 1), ("score_device", 0), ("score_pay_time", 0)])
def test_part_is_scanned_once_for_all_lookups(spark, key, most):
    scans = [x for x in plan(spark, key).split("FileScan parquet")[1:] if "part.parquet" in x.split("\n")[0]]
    assert len(scans) <= most


def test_dictionary_lookup_is_no_shuffle(spark):
    p = plan(spark, "dim_lookup_default")
    assert "SortMergeJoin" not in p and "hashpartitioning(md5" not in p


def test_columnwise_merge_is_one_pass(spark):
    p = plan(spark, "dim_columnwise_upsert")
    assert "SortAggregate" not in p and "WindowGroupLimit" in p


@pytest.mark.parametrize("key", ["dws_trade_province_order", "bean_to_snake_json"])
def test_province_window_keeps_no_orders_in_hash_maps(spark, key):
    # distinct orders are marked in the join's own sort: the only hash aggregate is per window and province
    p = plan(spark, key)
    keys = [x.split("keys=[")[1].split("]")[0] for x in p.split("\n") if "HashAggregate(keys=" in x]
    assert keys and not [k for k in keys if "order_id" in k]
    assert p.count("Sort [order_id") <= 1


@pytest.mark.parametrize("key", ["dwd_trade_order_cancel", "bean_to_snake_json"])
def test_shuffles_start_from_enough_partitions(spark, key):
    # a task's sort must not grow with the input because the caller gives few shuffle partitions (8 here)
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"
    parts = [int(n) for n in re.findall(r"Exchange hashpartitioning\(.*, (\d+)\)", plan(spark, key))]
    assert parts and min(parts) >= 200
