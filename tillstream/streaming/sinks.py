"""Streaming sinks, all via ``foreachBatch``: change-log upsert (O-7), column-wise merge (O-10), dynamic
topic (O-9), analytic table (O-11), fan-out of the log split (O-15) and the Kafka append writer (O-8).

Upserts are log-structured. A micro-batch is written once under its own ``_batch=<id>`` folder (overwrite
of that folder only, so a retried batch leaves equal state). ``compact`` folds the log into a base
``_upto=<id>``; the current state is the batch operator over the newest finished base and the batches after it, so
reads do not grow with the stream's age and no write rewrites the table. Lists of what is finished are small tables of
their own, written after the data and read as DataFrames.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.cdc import columnwise_merge, last_cells, upsert_final
from ..operators.logsplit import five_way_split
from ..operators.state import last_per_group


def read_or_none(spark: SparkSession, path: str, fmt: str = "parquet", schema: str | None = None) -> DataFrame | None:
    """The table under ``path``; None if nothing has been written there."""
    reader = spark.read.format(fmt)
    try:
        return (reader.schema(schema) if schema else reader).load(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


class CommittedLoads:
    """A table made of labelled loads (O-11). Rows go under ``data/_label=<label>``, and then the label into the list of
    committed ones; readers go by the list, so half a load is never seen. A committed label is not loaded again, and
    a load that failed is replaced by its retry.
    """

    def __init__(self, path: str, fmt: str = "parquet", schema: str | None = None):
        self.path, self.fmt, self.schema = path.rstrip("/"), fmt, schema

    def labels(self, spark: SparkSession) -> DataFrame:
        found = read_or_none(spark, f"{self.path}/committed", schema="label string, _label string")
        return found.select("label") if found is not None else spark.createDataFrame([], "label string")

    def load(self, rows: DataFrame, label: str) -> bool:
        """Load ``rows`` under ``label``; False if that has been done before."""
        spark = rows.sparkSession
        if self.labels(spark).where(F.col("label") == label).take(1):
            return False
        rows.write.mode("overwrite").format(self.fmt).save(f"{self.path}/data/_label={label}")
        self.commit(spark, label)
        return True

    def commit(self, spark: SparkSession, label: str) -> None:
        spark.range(1).select(F.lit(label).alias("label")).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/committed/_label={label}")

    def read(self, spark: SparkSession) -> DataFrame | None:
        """The rows of all committed loads, with their ``_label``; None before the first load."""
        data = read_or_none(spark, f"{self.path}/data", self.fmt, f"{self.schema}, _label string" if self.schema else None)
        if data is None:
            return None
        done = self.labels(spark).select(F.col("label").alias("__label"))
        return data.join(done, data["_label"].cast("string") == done["__label"], "left_semi")


class ChangeLogSink:
    """``foreachBatch`` target that appends each micro-batch as its own folder of the change log.

    The log is cut into generations: the batches that came after a base lie under ``delta/after=<base>``. ``compact`` writes
    the next base and then points to it; readers go by the pointers, so an unfinished base is never read, and they list
    the newest generation alone. ``vacuum`` empties what lies behind it. One writer: ``compact`` and ``vacuum`` are called between batches.
    """

    def __init__(self, path: str, key: str, order: list[str], fmt: str = "parquet"):
        self.path, self.key, self.order, self.fmt = path.rstrip("/"), key, order, fmt

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        after = self.upto(batch.sparkSession)
        batch.write.mode("overwrite").format(self.fmt).save(f"{self.path}/delta/after={after}/_batch={batch_id}")

    def upto(self, spark: SparkSession) -> int:
        """The last batch that the newest finished base holds (-1: no base yet)."""
        pointers = read_or_none(spark, f"{self.path}/pointer", schema="upto long, _upto long")
        newest = pointers.agg(F.max("upto")).first()[0] if pointers is not None else None
        return -1 if newest is None else newest

    def log(self, spark: SparkSession) -> DataFrame:
        """The newest base and the batches after it: enough to rebuild the state."""
        upto = self.upto(spark)
        base = spark.read.format(self.fmt).load(f"{self.path}/base/_upto={upto}") if upto >= 0 else None
        delta = read_or_none(spark, f"{self.path}/delta/after={upto}", self.fmt)
        if delta is not None and base is not None:
            return base.unionByName(delta.where(F.col("_batch") > upto).withColumn("_batch", F.col("_batch").cast("long")))
        return base if delta is None else delta.withColumn("_batch", F.col("_batch").cast("long"))

    def folded(self, log: DataFrame) -> DataFrame:
        """The changes of ``log`` that still matter."""
        return log

    def compact(self, spark: SparkSession) -> None:
        """Write a new base of everything so far, then point to it. It may be repeated, and may die at any point."""
        upto = self.upto(spark)
        delta = read_or_none(spark, f"{self.path}/delta/after={upto}", self.fmt)
        newest = delta.agg(F.max("_batch")).first()[0] if delta is not None else None
        if newest is None or newest <= upto:
            return
        self.folded(self.log(spark)).write.mode("overwrite").format(self.fmt).save(f"{self.path}/base/_upto={newest}")
        spark.range(1).select(F.lit(newest).cast("long").alias("upto")).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/pointer/_upto={newest}")

    def vacuum(self, spark: SparkSession) -> int:
        """Empty the bases and batches that the newest base supersedes, and forget their pointers; returns how many bases went."""
        pointers = read_or_none(spark, f"{self.path}/pointer", schema="upto long, _upto long")
        bases = sorted(r[0] for r in pointers.select("upto").distinct().collect()) if pointers is not None else []
        nothing = spark.createDataFrame([], "upto long")
        for old, new in zip([-1, *bases], bases, strict=False):  # a generation goes when the base after it is finished
            nothing.write.mode("overwrite").parquet(f"{self.path}/delta/after={old}")
            if old >= 0:
                nothing.write.mode("overwrite").parquet(f"{self.path}/base/_upto={old}")
                nothing.write.mode("overwrite").parquet(f"{self.path}/pointer/_upto={old}")
        return max(len(bases) - 1, 0)


class UpsertSink(ChangeLogSink):
    """O-7: last change per key wins; deletes (``op = 'd'``) leave a tombstone, kept in the base."""

    def folded(self, log: DataFrame) -> DataFrame:
        return last_per_group(log, [self.key], [*self.order, "_batch"])

    def state(self, spark: SparkSession) -> DataFrame:
        return upsert_final(self.log(spark), self.key, [*self.order, "_batch"]).drop("_batch")


class ColumnwiseSink(ChangeLogSink):
    """O-10: wide-column merge of the change log (empty values never overwrite, deletes erase)."""

    def folded(self, log: DataFrame) -> DataFrame:
        cells = last_cells(log, self.key, [*self.order, "_batch"])
        mark = F.col("col").isNull()
        after = F.when(~mark, F.create_map(F.coalesce("col", F.lit("")), F.col("val")))
        return cells.select(self.key, F.when(mark, "d").otherwise("u").alias("op"), after.alias("after"), *self.order, "_batch")

    def state(self, spark: SparkSession) -> DataFrame:
        return columnwise_merge(self.log(spark), self.key, [*self.order, "_batch"])


def dynamic_topic_writer(path: str, fmt: str = "json") -> Callable[[DataFrame, int], None]:
    """O-9 as ``foreachBatch``: rows land under ``topic=<their configured sink>``; batch-id folders
    keep retries idempotent."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").partitionBy("topic").format(fmt).save(f"{path.rstrip('/')}/_batch={batch_id}")

    return write


def analytic_table(path: str, table: str, fmt: str = "json", schema: str | None = None) -> CommittedLoads:
    """O-11: an analytic table; its readers see committed loads only."""
    return CommittedLoads(f"{path.rstrip('/')}/{table}", fmt, schema)


def analytic_table_writer(path: str, table: str, fmt: str = "json") -> Callable[[DataFrame, int], None]:
    """O-11 as ``foreachBatch``: every batch is one load, labelled by the table and the batch id."""
    target = analytic_table(path, table, fmt)
    return lambda batch, batch_id: target.load(batch, f"{table}-{batch_id}")


def append_writer(path: str, fmt: str = "json") -> Callable[[DataFrame, int], None]:
    """O-8 over files: an append-only topic; every batch is appended once, retries included."""
    target = CommittedLoads(path, fmt)
    return lambda batch, batch_id: target.load(batch, f"batch-{batch_id}")


def fan_out_writer(path: str, fmt: str = "parquet") -> Callable[[DataFrame, int], None]:
    """O-15: one parsed batch of the log into five outputs. The batch is kept while it is written, so it is
    parsed once; each output has its batch-id folder."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for name, rows in five_way_split(batch).items():
                rows.write.mode("overwrite").format(fmt).save(f"{path.rstrip('/')}/{name}/_batch={batch_id}")
        finally:
            batch.unpersist()

    return write


def kafka_writer(df: DataFrame, servers: str, topic: str | None = None, checkpoint: str | None = None):
    """O-8: append sink to a fixed topic, or per-row ``topic`` column when ``topic`` is None (O-9).
    The frame must carry ``value`` (and optionally ``key``) strings."""
    w = df.writeStream.format("kafka").option("kafka.bootstrap.servers", servers).option("kafka.acks", "all")
    if topic:
        w = w.option("topic", topic)
    if checkpoint:
        w = w.option("checkpointLocation", checkpoint)
    return w
