"""Mixing sources to target weights by Poisson replication (operator 9).

Source ``s`` with ``n_s`` of the corpus' ``n`` rows and target weight ``w_s`` gets the mean repetition
rate ``w_s * n / (n_s * sum(w))``, so the mixture has as many rows as the corpus on average, in the
proportions of the weights. Each row draws a uniform number from a hash of (seed, id, text) and inverts
the Poisson distribution of its source's rate on it: the smallest count whose cumulative probability
reaches the number. The row is exploded into that many copies, and the copies are dealt out and ordered
by a second hash of (seed, id, text, copy), a uniform shuffle of the whole mixture.

The draw depends on the row and its source's rate alone, so a lost task repeats it exactly. A hot source
is only ever counted (partial sums); its rows are never gathered: the rates are one row per source,
a written table that Spark broadcasts under its own size threshold.

Defined cases: a null source is a source of its own; sources without a weight get ``other`` (by default
their count to the power ``temperature``); weight 0 or an unlisted source with ``other=0`` gives no copy; rows that
repeat id and text draw the same count each; null texts and ids hash like a fixed text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, sheltered

SEED = 17
TEMPERATURE = 0.5
#: Share of the upper tail that the table of cumulative probabilities may leave out; a draw has 52 bits.
TAIL = 2.0**-54


def uniform(seed: int, *parts: Column | str) -> Column:
    """A number in (0, 1) from 52 bits of MD5, the same in other SQL engines."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(p).cast("string") if isinstance(p, str) else p, F.lit("~")) for p in parts])
    return (F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") + 0.5) / F.lit(2.0**52)


def cumulative(rate: float) -> list[float]:
    """Cumulative Poisson probabilities of 0, 1, ... until less than ``TAIL`` is left."""
    if rate <= 0:
        return [1.0]
    width = int(rate + 12 * np.sqrt(rate) + 60)
    k = np.arange(width + 1)
    log_p = k * np.log(rate) - rate - np.concatenate([[0.0], np.cumsum(np.log(k[1:]))])
    total = np.cumsum(np.exp(log_p))
    total /= total[-1]  # rounding must not leave a draw above the last entry
    return [*total[: int(np.searchsorted(total, 1 - TAIL)) + 1].tolist()]


def rates(docs: DataFrame, weights: dict[str, float] | None = None, other: float | None = None, temperature: float = TEMPERATURE) -> DataFrame:
    """``(source, n, weight, rate, cdf)``, one row per source."""
    counts = materialize(docs.groupBy("source").agg(F.count("*").alias("n")), "sources")
    usual = F.pow(F.col("n").cast("double"), F.lit(temperature)) if other is None else F.lit(float(other))
    weight = usual
    if weights:
        given = F.create_map(*[F.lit(x) for name, w in weights.items() for x in (name, float(w))])
        weight = F.coalesce(F.try_element_at(given, F.col("source")), usual)
    counts = counts.withColumn("weight", weight)
    whole = counts.agg(F.sum("n").alias("all_rows"), F.sum("weight").alias("all_weight")).first()
    scale = (whole["all_rows"] or 0) / whole["all_weight"] if whole["all_weight"] else 0.0

    def table(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in batches:
            rate = x["weight"] * scale / x["n"]
            yield x.assign(rate=rate, cdf=[cumulative(r) for r in rate])

    return materialize(counts.mapInPandas(table, "source string, n long, weight double, rate double, cdf array<double>"), "rates")


@sheltered
def replicate(docs: DataFrame, weights: dict[str, float] | None = None, seed: int = SEED, **how: float) -> DataFrame:
    """``docs`` replicated to the weights and shuffled, plus ``__copy`` (from 0), ``__rate`` and ``__order`` (the shuffle's key)."""
    by = rates(docs, weights, **how).select(F.col("source").alias("__source"), F.col("rate").alias("__rate"), F.col("cdf").alias("__cdf"))
    drawn = docs.withColumn("__u", uniform(seed, "doc_id", F.md5("text")))
    drawn = drawn.join(by, drawn["source"].eqNullSafe(by["__source"]), "left")
    count = F.size(F.filter("__cdf", lambda c: c < F.col("__u")))
    copies = drawn.withColumn("__n", count).where("__n > 0").withColumn("__copy", F.explode(F.sequence(F.lit(0), F.col("__n") - 1)))
    keyed = copies.withColumn("__order", uniform(seed + 1, "doc_id", F.md5("text"), "__copy"))
    return keyed.select(*docs.columns, "__copy", "__rate", "__order").repartition("__order").sortWithinPartitions("__order")


@sheltered
def stage(docs: DataFrame, weights: dict[str, float] | None = None, seed: int = SEED) -> DataFrame:
    return replicate(docs, weights, seed).select(*docs.columns)
