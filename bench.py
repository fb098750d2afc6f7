"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is fully computed with the ``noop`` sink (no driver collect), timed
wall-clock, and the total is reported. Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tillstream.plans import QUERIES  # noqa: E402
from tillstream.session import build_session  # noqa: E402

HEADLINE = [
    "dws_traffic_vc_ch_ar_is_new",
    "log_split_page",
    "visitor_is_new_fix",
    "dws_traffic_keyword",
    "dws_user_login",
    "dwd_trade_order_detail",
    "dwd_trade_pay_suc",
    "dws_trade_province_order",
    "dws_trade_sku_order",
    "order_retract_stream",
    "dim_columnwise_upsert",
    "ijoin_order_detail",
    "label_age_level",
    "label_final",
    "comment_sensitive_flag",
]


def run(spark, key: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    QUERIES[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    keys = sys.argv[1:] or HEADLINE
    spark = build_session(app="tillstream-bench")
    # warm-up on the smallest scale so JIT / class loading is not billed to the first query
    warm = os.path.join(os.path.dirname(sf_dir), "sf0.001")
    if os.path.isdir(warm):
        run(spark, keys[0], warm)
    times = {k: round(run(spark, k, sf_dir), 3) for k in keys}
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({"metric": "headline_total_wall", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
