"""Spark session setup shared by jobs, tests and the bench.

Every query builder calls :func:`prepare` on the session it is handed, so the
result does not depend on how the caller configured the session: time zone,
map-key policy and AQE are runtime SQL confs and can be set on a live session.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Runtime SQL confs every query relies on.
RUNTIME_CONF = {
    # All epoch-ms <-> date/time formatting happens in one zone (N-10).
    "spark.sql.session.timeZone": "UTC",
    # map_concat with duplicate keys: right side wins (F-16).
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Skewed sort-merge joins are split by AQE; skewed aggregates rely on partial aggregation.
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
}

# A batch shuffle starts from at least so many partitions and AQE merges the small ones up to its advisory size: a
# task's sorts stay at that size however few ``spark.sql.shuffle.partitions`` the caller gives. Up to 200 (Spark's
# default of spark.shuffle.sort.bypassMergeThreshold) map tasks write rows straight through, without buffering them.
LEAST_PARTITIONS = 200
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def prepare(spark: SparkSession) -> SparkSession:
    for k, v in RUNTIME_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def spread_shuffles(spark: SparkSession) -> SparkSession:
    """Shuffles of the session start from ``LEAST_PARTITIONS``, or from more if the caller asks for more."""
    asked = [int(spark.conf.get("spark.sql.shuffle.partitions")), int(spark.conf.get(INITIAL_PARTITIONS, None) or 0)]
    spark.conf.set(INITIAL_PARTITIONS, str(max(LEAST_PARTITIONS, *asked)))
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and streaming checkpoints.

    Read from ``spark.checkpoint.dir`` (set by the cluster). Only when it is
    unset and everything runs in one local process (tests) is a scratch folder created.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d and not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir is not set: name a folder that the driver and all executors share")
    if not d:
        d = tempfile.mkdtemp(prefix="tillstream-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
        spark.sparkContext.setCheckpointDir(d)
    return d


def build_session(master: str | None = None, app: str = "tillstream", shuffle_partitions: int | None = None) -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    parts = shuffle_partitions or int(cpus)
    b = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
    )
    for k, v in RUNTIME_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)
