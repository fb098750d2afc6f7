"""Readers for the driver's parquet tables.

Reads are lazy; Catalyst prunes columns and pushes filters into each scan,
so callers select only what they use.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy parquet scan of a driver table; the scan's splits are Spark's own (``spark.sql.files.*``)."""
    if name not in TABLES:
        raise KeyError(name)
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    return spark.read.parquet(path)


#: A lookup table of at most so many rows may be pinned and broadcast.
SMALL_ROWS = 10_000


def small(dim: DataFrame, most: int = SMALL_ROWS) -> DataFrame:
    """``dim`` pinned as a local table with a broadcast hint if it has at most ``most`` rows; else ``dim`` as it is.

    At most ``most + 1`` rows are read to find out. A larger table is joined as Spark sees fit (a shuffle
    join beyond its broadcast threshold), with the same rows.
    """
    if dim.isStreaming:
        return dim
    rows = dim.take(most + 1)
    return F.broadcast(dim.sparkSession.createDataFrame(rows, dim.schema)) if len(rows) <= most else dim


def epoch_ms(c) -> "F.Column":
    """Parquet timestamp (NTZ or LTZ) -> epoch milliseconds (truncating, like unix_millis)."""
    return F.unix_millis(F.col(c).cast("timestamp") if isinstance(c, str) else c.cast("timestamp"))


def money(c) -> "F.Column":
    """Double amount -> 2-decimal string, the way CDC payloads carry money."""
    col = F.col(c) if isinstance(c, str) else c
    return col.cast("decimal(16,2)").cast("string")
