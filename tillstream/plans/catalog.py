"""Query registry: one builder per SURVEY §2 key, ``(spark, sf_dir) -> DataFrame``.

Builders read the driver tables through :mod:`tillstream.sources` (derived
inputs per FIXTURES.md), run the operator under test and project flat,
explicitly aliased columns so results compare 1:1 with the DuckDB oracle in
:mod:`tillstream.plans.oracle`. Window lengths are the test lengths (1 hour /
1 day) because the fixture data is sparse; the operator defaults stay at the
reference's 2 s / 5 s / 10 s / 2 min.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import prepare, spread_shuffles

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(key: str):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spread_shuffles(prepare(spark))
            return fn(spark, sf_dir)

        run.__name__ = key
        run.__doc__ = fn.__doc__
        QUERIES[key] = run
        return fn

    return deco


def flat(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Select nested fields under flat aliases."""
    return df.select(*[F.col(src).alias(dst) for dst, src in mapping.items()])


# Importing the modules registers their keys.
from . import q_label, q_misc, q_trade, q_traffic  # noqa: E402,F401
