"""Dimension lookups as joins (J-7, J-8, J-14 ... J-18).

The reference performs per-record lookups (sync, async with caches, or
in-memory lists). In Spark each is one join of the whole stream with the
dimension: Catalyst broadcasts the dimension when its estimated size is under
the broadcast threshold and otherwise shuffles; lookups that run after an
aggregation see only the aggregated rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import dims
from ..sources.tables import small


def enrich(df: DataFrame, dim: DataFrame, df_key: str, dim_key: str, cols: dict[str, str], how: str = "left") -> DataFrame:
    """J-17 generic lookup: add ``dim`` columns (``src -> alias``) matched on ``df_key = dim_key``.

    A miss leaves the row unchanged (null columns) with ``how='left'``; a null key never matches,
    which is the reference's "skip the lookup when the id is empty".
    """
    d = dim.select(F.col(dim_key).alias("_dk"), *[F.col(s).alias(a) for s, a in cols.items()])
    return df.join(d, df[df_key] == d["_dk"], how).drop("_dk")


def one_per_key(dim: DataFrame, key: str) -> DataFrame:
    """J-18: first-match lookups need one row per key; keep the smallest row per key (top-1)."""
    from .state import first_per_group

    other = [c for c in dim.columns if c != key]
    return first_per_group(dim, [key], other)


def lookup_md5_default(df: DataFrame, dim: DataFrame, code: str, dim_code: str, name_field: str, out: str, default: str = "N/A") -> DataFrame:
    """J-16: dimension stored under ``md5(code)`` row keys; a miss yields ``default``. A dictionary of few rows
    (counted) is broadcast, so the rows, which share a handful of codes, are not shuffled by them."""
    d = small(dim.select(F.md5(F.col(dim_code)).alias("_rk"), F.col(name_field).alias("_name")))
    j = df.join(d, F.md5(df[code]) == F.col("_rk"), "left")
    return j.withColumn(out, F.coalesce(F.col("_name"), F.lit(default))).drop("_rk", "_name")


def category_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J-7: category3 with its parents -> (id, b3name, b2name, b1name), one row per category3, one scan."""
    return dims.category_dim(spark, sf_dir).select("id", "b3name", "b2name", "b1name")


def sku_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J-8: sku with its spu and trademark -> (skuid, spuid, c3id, tname); skus without an spu are left out."""
    d = dims.sku_dim(spark, sf_dir).where("spu_name is not null")
    return d.select(F.col("id").alias("skuid"), F.col("spu_id").alias("spuid"), F.col("category3_id").alias("c3id"), F.col("trademark_name").alias("tname"))


def sku_lookup_chain(spark: SparkSession, sf_dir: str, df: DataFrame, sku_col: str = "sku_id") -> DataFrame:
    """J-15 (intended form, N-6): sku -> (name, spu); spu -> (name, trademark, category3); trademark -> name;
    category3 -> (name, category2); category2 -> (name, category1); category1 -> name. The steps of the chain
    are columns of one denormalised dimension, so this is one left join; a missing id leaves the later
    columns null."""
    cols = ["sku_name", "spu_id", "spu_name", "trademark_id", "trademark_name", "category3_id", "category3_name", "category2_id", "category2_name", "category1_id", "category1_name"]
    return enrich(df, dims.sku_dim(spark, sf_dir), sku_col, "id", {c: c for c in cols})
