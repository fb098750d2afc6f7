"""Streaming sources (O-1, O-2, O-3) and stream forms of the driver tables.

``text_source`` is the reference's value-only topic reader: Kafka when the
connector is on the classpath, otherwise any file format Spark streams
(text / json / parquet). ``replay`` turns a batch table into a file stream of
several micro-batches, so stream twins read the same data as their batch forms. Kafka partitions that are
added later are found by Spark itself; a record's broker time is kept as ``timestamp``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def text_source(spark: SparkSession, fmt: str = "kafka", **options) -> DataFrame:
    """O-1/O-2: one ``value STRING`` column. For Kafka pass ``subscribe``/``kafka.bootstrap.servers``
    and ``startingOffsets`` (the reference starts at the earliest offset); null values are dropped
    (P-2). For files pass ``path``."""
    reader = spark.readStream.format(fmt)
    if fmt == "kafka":
        options.setdefault("startingOffsets", "earliest")
    path = options.pop("path", None)
    for k, v in options.items():
        reader = reader.option(k, v)
    df = reader.load(path) if path else reader.load()
    if fmt == "kafka":
        df = df.selectExpr("CAST(value AS STRING) AS value", "timestamp")
    return df.filter(F.col("value").isNotNull())


#: Rows of a replayed slice, at most about: a slice is one file.
SLICE_ROWS = 2_000_000


def replay(spark: SparkSession, df: DataFrame, path: str, order: str, batches: int = 4, fmt: str = "parquet") -> DataFrame:
    """A batch table replayed as a topic, so state and watermarks cross batches: slices of the ``order`` column (nulls first),
    each one sorted file and one micro-batch, however many partitions ``df`` has.

    The table is computed once, into ``<path>-staged`` by slice; ``batches`` grows with the rows. The slices are written one after
    the other into folders whose names sort alike, so their order does not hang on the clock of the store.
    """
    batches = max(batches, -(-df.count() // SLICE_ROWS))
    cuts = df.agg(F.percentile_approx(order, [k / batches for k in range(1, batches)], 10_000)).first()[0] or []
    slice_of = sum((F.coalesce(F.col(order) > c, F.lit(False)).cast("int") for c in sorted(set(cuts))), F.lit(0))
    df.withColumn("__slice", slice_of).write.partitionBy("__slice").parquet(f"{path}-staged")
    staged = spark.read.schema(T.StructType([*df.schema.fields, T.StructField("__slice", T.IntegerType())])).parquet(f"{path}-staged")
    for k in range(len(set(cuts)) + 1):
        rows = staged.where(F.col("__slice") == k).drop("__slice")
        rows.repartition(1).sortWithinPartitions(order).write.format(fmt).save(f"{path}/slice-{k:06}")
    reader = spark.readStream.format(fmt).option("maxFilesPerTrigger", 1)
    return (reader if fmt == "text" else reader.schema(df.schema)).load(f"{path}/*")


def event_time(ms_col: str = "ts", out: str = "event_time"):
    """epoch ms -> TIMESTAMP column usable by ``withWatermark`` (NTZ is rejected). A missing or unreadable time is 0 (T-3)."""
    return F.timestamp_millis(F.coalesce(F.col(ms_col).try_cast("bigint"), F.lit(0))).alias(out)


def broker_timed(df: DataFrame, delay: str = "3 seconds", timestamp: str = "timestamp") -> DataFrame:
    """T-4: the watermark follows the time at which the broker took each record, whatever the record says."""
    return df.withWatermark(timestamp, delay)
