"""Routing with a live configuration (O-13, O-13a, O-14) and the life of its targets (O-13b).

The configuration is a change log. Every micro-batch of data is routed by the configuration that is valid for it: the changes
committed when the batch is first seen. That version is written down before the batch is routed, so a retry routes the same rows
to the same targets, whatever has changed since.

Targets live in a ledger. A configuration change drops or creates its target exactly once: the ledger's load is labelled by the change's
batch, and a committed label is not applied again. A target that is created anew gets a new version, that is a new folder, so
nothing is deleted in place and a retried create finds no rows of the target that was dropped.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import cdc
from ..operators.state import last_per_group
from .sinks import CommittedLoads


class TargetLedger:
    """O-13b: which targets are live, and in which folder each keeps its rows."""

    def __init__(self, path: str):
        self.loads = CommittedLoads(f"{path.rstrip('/')}/ledger")
        self.path = path.rstrip("/")

    def apply(self, changes: DataFrame, label: str) -> bool:
        """Apply a batch of config changes (``seq``, ``op``, ``sink_table``, ``sink_family``); False if it has been applied before."""
        return self.loads.load(cdc.config_actions(changes), label)

    def actions(self, spark: SparkSession) -> DataFrame | None:
        """Every drop and create ever applied, once each."""
        return self.loads.read(spark)

    def targets(self, spark: SparkSession) -> DataFrame:
        """``(sink_table, sink_family, version)`` of the live targets; the version is the change that created them last."""
        actions = self.actions(spark)
        if actions is None:
            return spark.createDataFrame([], "sink_table string, sink_family string, version long")
        last = last_per_group(actions, ["sink_table"], ["seq", "step"])
        return last.where("action = 'create'").select("sink_table", "sink_family", F.col("seq").cast("long").alias("version"))


class LiveConfig:
    """A configuration as a log of committed change batches."""

    def __init__(self, path: str, ledger: TargetLedger | None = None):
        self.loads, self.ledger = CommittedLoads(f"{path.rstrip('/')}/config"), ledger

    def __call__(self, changes: DataFrame, batch_id: int) -> None:
        """``foreachBatch`` target of the config stream."""
        self.loads.load(changes.withColumn("version", F.lit(batch_id).cast("long")), f"config-{batch_id}")
        if self.ledger is not None:
            self.ledger.apply(changes, f"config-{batch_id}")

    def newest(self, spark: SparkSession) -> int:
        """The newest committed version (-1: none)."""
        done = self.loads.labels(spark).agg(F.max(F.substring_index("label", "-", -1).cast("long"))).first()[0]
        return -1 if done is None else done

    def at(self, spark: SparkSession, version: int, key: list[str], order: str = "seq") -> DataFrame | None:
        """The configuration after the changes up to ``version``: the last change per key, without the deleted ones."""
        log = self.loads.read(spark)
        if log is None or version < 0:
            return None
        last = last_per_group(log.where(F.col("version") <= version), key, ["version", order])
        return last.where("op <> 'd'").drop("version", "_label")


class LiveRouter:
    """``foreachBatch`` target of the data stream: each batch is routed by the configuration valid for it.

    ``route`` is :func:`tillstream.operators.cdc.route_dim` (O-13) or ``route_dwd`` (O-14); ``key`` names what a config row is
    looked up by. Routed rows carry the configuration's version; they lie under the label of their batch.
    """

    def __init__(self, config: LiveConfig, path: str, route: Callable[[DataFrame, DataFrame], DataFrame] = cdc.route_dim, key: tuple[str, ...] = ("source_table",)):
        self.config, self.route, self.key = config, route, list(key)
        self.chosen, self.rows = CommittedLoads(f"{path.rstrip('/')}/versions", schema="batch long, version long"), CommittedLoads(f"{path.rstrip('/')}/rows")

    def version(self, spark: SparkSession, batch_id: int) -> int:
        """The config version of a batch: chosen when the batch is first seen, and kept for its retries."""
        label = f"batch-{batch_id}"
        newest = spark.createDataFrame([(batch_id, self.config.newest(spark))], "batch long, version long")
        self.chosen.load(newest, label)
        return self.chosen.read(spark).where(F.col("batch") == batch_id).first()["version"]

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        version = self.version(spark, batch_id)
        config = self.config.at(spark, version, self.key)
        if config is not None:
            self.rows.load(self.route(batch, config).withColumn("config_version", F.lit(version)), f"batch-{batch_id}")

    def routed(self, spark: SparkSession) -> DataFrame | None:
        rows = self.rows.read(spark)
        return rows.drop("_label") if rows is not None else None
