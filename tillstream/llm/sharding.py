"""Sharding by a hypergeometric communication matrix (operator 10). DataFrame functions only.

The rows are written once with an id of their own and dealt by a hash of it to ``partitions``
partitions. Shards have exact target sizes, at most one row apart. The matrix of counts
partition x shard is drawn from the distribution that a uniform shuffle would give: one partition after
the other takes its rows' places from what the shards have left, without replacement. A partition
permutes its rows (order of a second hash) and deals them to the shards by its row of the matrix; after
the exchange each shard permutes what it got (order of a third hash) and numbers it from 0.

The ranks are taken over rows of (id, hash) alone; a rank inside a shard is the rank inside one of
many ranges of the third hash plus the counts of the ranges before it, so no task sorts a whole
shard. The rows themselves, whatever their size or repeats, move once, joined by their unique id.

Partitions and ranges follow the number of rows (``sizes``): on average a partition, and a range of a shard, holds at most
``GROUP_ROWS`` ids however large the table is. The driver holds the partitions' counts and the matrix, ``partitions * shards``
numbers: about 600,000 for 1e11 rows in 24 shards.

Defined cases: a null text has no bytes; rows that are equal in every column are rows of their own; an
empty table gives an empty result; columns keep their names, the two new ones are ``__shard`` and ``__slot``.
"""

from __future__ import annotations

import json
import math
import random

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import materialize, sheltered

SHARDS = 24
PARTITIONS = 512
RANGE_BITS = 8
GROUP_ROWS = 1 << 22
SEED = 29


def sizes(rows: int, shards: int, partitions: int = PARTITIONS, group_rows: int = GROUP_ROWS) -> tuple[int, int]:
    """Number of partitions, at least ``partitions``, and bits of the third hash that name a range of a shard."""
    ranges = -(-rows // (shards * group_rows))
    return max(partitions, -(-rows // group_rows)), max(RANGE_BITS, (ranges - 1).bit_length())


def hypergeometric(rng: random.Random, good: int, bad: int, drawn: int) -> int:
    """Good ones among ``drawn`` taken without replacement: inversion outwards from the mode."""
    least, most = max(0, drawn - bad), min(drawn, good)
    if least == most:
        return least
    mode = min(max((drawn + 1) * (good + 1) // (good + bad + 2), least), most)

    def log_choose(n: int, k: int) -> float:
        return math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)

    at_mode = math.exp(log_choose(good, mode) + log_choose(bad, drawn - mode) - log_choose(good + bad, drawn))
    u = rng.random() - at_mode
    low, high, p_low, p_high = mode, mode, at_mode, at_mode
    while u >= 0 and (low > least or high < most):
        if high < most:
            p_high *= (good - high) * (drawn - high) / ((high + 1) * (bad - drawn + high + 1))
            high += 1
            u -= p_high
            if u < 0:
                return high
        if low > least:
            p_low *= low * (bad - drawn + low) / ((good - low + 1) * (drawn - low + 1))
            low -= 1
            u -= p_low
            if u < 0:
                return low
    return mode


def targets(rows: int, shards: int) -> list[int]:
    """Shard sizes that differ by one row at most."""
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def communication(counts: list[int], shards: int, seed: int) -> list[list[int]]:
    """Rows that each partition sends to each shard."""
    rng, left, out = random.Random(seed), targets(sum(counts), shards), []
    for n in counts:
        row = []
        for s in range(shards):
            k = hypergeometric(rng, left[s], sum(left[s + 1 :]), n - sum(row))
            row.append(k)
        left = [a - b for a, b in zip(left, row, strict=True)]
        out.append(row)
    return out


def _hash(seed: int) -> Column:
    return F.xxhash64("__rid", F.lit(seed))


def assign(rows: DataFrame, shards: int, partitions: int, seed: int, group_rows: int = GROUP_ROWS) -> DataFrame:
    """``(__rid, __shard, __slot)`` for rows with a unique ``__rid``."""
    partitions, bits = sizes(rows.count(), shards, partitions, group_rows)
    thin = rows.select("__rid", F.pmod(_hash(seed), F.lit(partitions)).cast("int").alias("part"))
    counted = {r["part"]: r["n"] for r in thin.groupBy("part").agg(F.count("*").alias("n")).collect()}
    matrix = communication([counted.get(p, 0) for p in range(partitions)], shards, seed)
    ends = [[sum(row[: s + 1]) for s in range(shards)] for row in matrix]
    dealt = F.get(F.from_json(F.lit(json.dumps(ends)), "array<array<bigint>>"), F.col("id").cast("int"))
    matrix_rows = rows.sparkSession.range(0, partitions, 1, 1).select(F.col("id").cast("int").alias("part"), dealt.alias("ends"))

    permuted = thin.withColumn("rank", F.row_number().over(W.partitionBy("part").orderBy(_hash(seed + 1), "__rid")))
    sent = permuted.join(matrix_rows, "part").select("__rid", F.size(F.filter("ends", lambda e: e < F.col("rank"))).alias("__shard"), _hash(seed + 2).alias("turn"))
    sent = materialize(sent.withColumn("bucket", F.shiftrightunsigned("turn", 64 - bits).cast("int")), "sent")

    counts = sent.groupBy("__shard", "bucket").agg(F.count("*").alias("n"))
    before = F.sum("n").over(W.partitionBy("__shard").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1))
    offsets = materialize(counts.select("__shard", "bucket", F.coalesce(before, F.lit(0)).alias("offset")), "offsets")
    inside = F.row_number().over(W.partitionBy("__shard", "bucket").orderBy("turn", "__rid"))
    ranked = sent.withColumn("inside", inside).join(offsets, ["__shard", "bucket"])
    return ranked.select("__rid", "__shard", (F.col("offset") + F.col("inside") - 1).alias("__slot"))


@sheltered
def shard(docs: DataFrame, shards: int = SHARDS, partitions: int = PARTITIONS, seed: int = SEED, group_rows: int = GROUP_ROWS) -> DataFrame:
    """``docs`` plus ``__shard`` (0 to ``shards`` - 1) and ``__slot`` (gapless from 0 in each shard), dealt over ``partitions`` partitions or more."""
    rows = materialize(docs.withColumn("__rid", F.monotonically_increasing_id()), "rows")
    return rows.join(assign(rows, shards, partitions, seed, group_rows), "__rid").select(*docs.columns, "__shard", "__slot")


def write_shards(docs: DataFrame, path: str, **how: int) -> None:
    """Write each shard's rows, in the order of their slots, under ``path/shard=<n>``."""
    out = shard(docs, **how).withColumnRenamed("__shard", "shard").withColumnRenamed("__slot", "slot")
    out.repartition("shard").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
