"""String column functions (F-7, F-14, F-15, F-17) and the region filter (P-24)."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Provinces the reference's city table query leaves out (default of P-24).
EXCLUDED_PROVINCES = ("澳门特别行政区", "台湾省", "香港特别行政区")


def first_token(c: Column, sep: str) -> Column:
    """``split(x, sep)[0]`` with a literal separator of any length."""
    return F.split(c, re.escape(sep)).getItem(0)


def underscored(c: Column) -> Column:
    """``replace('-', '_')``."""
    return F.replace(c, F.lit("-"), F.lit("_"))


def negate_amount(amount: Column) -> Column:
    """The reference prefixes '-' to retract an amount; arithmetic negation also handles negative inputs."""
    return (-amount.cast("decimal(38,4)")).cast("string")


def is_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit("")) == ""


def default_if_empty(c: Column, default: str) -> Column:
    """F-15: null/empty -> default."""
    return F.when(is_empty(c), F.lit(default)).otherwise(c)


def md5_key(c: Column) -> Column:
    """F-14: MD5 hex row key."""
    return F.md5(c.cast("string"))


def join_key(*parts: Column) -> Column:
    """F-17: ``table:id`` / ``table:op`` keys."""
    return F.concat_ws(":", *parts)


def region_city_filter(codes: DataFrame, excluded: tuple[str, ...] = EXCLUDED_PROVINCES) -> DataFrame:
    """P-24: rows with a city outside the excluded provinces; city falls back to province,
    area to city then province."""
    kept = codes.filter(F.col("city").isNotNull() & ~F.col("province").isin(*excluded))
    return kept.select(
        F.col("code").cast("bigint").alias("code"),
        "province",
        F.coalesce("city", "province").alias("city"),
        F.coalesce("area", "city", "province").alias("area"),
    )
