"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir, prepare


#: Largest Arrow batch handed to a Python worker: texts and packed blocks make long rows.
ARROW_BATCH = "4m"


def session(spark: SparkSession) -> SparkSession:
    """The session with the settings that the operators rely on."""
    spark = prepare(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BATCH)
    return spark


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` once into the cluster's shared folder and read it back.

    Cuts the lineage (a lost executor costs no recomputation), fixes values that depend on the
    partitioning, and gives later joins a plain scan of known size: Spark then broadcasts it only
    under its own threshold and can split skewed partitions otherwise.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/llm-{uuid.uuid4().hex}/{tag}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def sheltered(fn: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """An operator ``fn(docs, ...)`` that names columns of its own with two underscores, made safe for callers who do so too: their
    columns pass under other names and come back under their own, or with one more underscore at the end where the
    result has a column of that name."""

    @wraps(fn)
    def run(docs: DataFrame, *args, **how) -> DataFrame:
        used, names = {c.lower() for c in docs.columns}, {}
        for c in [c for c in docs.columns if c.startswith("__")]:
            names[c] = f"kept_{c.strip('_')}"
            while names[c].lower() in used:
                names[c] += "_"
            used.add(names[c].lower())
        if not names:
            return fn(docs, *args, **how)
        out = fn(docs.withColumnsRenamed(names), *args, **how)
        taken, back = {c.lower() for c in out.columns}, {}
        for c, name in names.items():
            while c.lower() in taken:
                c += "_"
            taken.add(c.lower())
            back[name] = c
        return out.withColumnsRenamed(back)

    return run


def text_key(text: str = "text") -> Column:
    """64-bit digest that tells rows with the same id and another text apart (null: 0)."""
    return F.coalesce(F.xxhash64(F.col(text)), F.lit(0).cast("long"))
