"""Exact top-k inner products with vector-approximation files (operator 7).

Every component x becomes floor(256 x). The integers are written as the exact file, one row per vector, and beside it the
approximation file: blocks of up to ``BLOCK`` vectors, with per component the number of one of ``CELLS`` cells whose marks are the
block's own quantiles. The search reads the approximation file only: the cells bound every score from both sides, and a vector
survives for a query if its upper bound reaches the k-th largest lower bound that its task has seen. The k-th largest lower
bound over all survivors then holds for the whole table and thins them out again. Exact rows are read for what is left, in the order of the upper
bounds (the lower bounds of a distance): first ``READ`` for each query, then those whose bound reaches the k-th exact
score so far. Nothing else can be among the k best, ties included.

The stated queries, in packs of up to ``QUERIES``, meet the blocks in a grid: ``SIDE`` packs and ``SIDE`` blocks at most share a square, a square
is one task's, and both sides are shuffled to it. Nothing is broadcast, and no pair of rows is a row of a table before the
bounds have cut it. Of equal vectors only those that some query could rank are searched (``k + 1`` smallest ids: one may be the
query's own), so a group of copies of any size costs as much as ``k + 1`` vectors.

Defined cases: vectors that are null, empty or hold null or non-finite components, and rows without an
id, take no part; a query meets the vectors of its own length; its own row is every row with its id;
an id that occurs several times is several candidates, but one query (its smallest vector).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType
from pyspark.sql.window import Window as W

from .common import materialize
from .vectors import packed, runs, usable

BLOCK = 2048
QUERIES = 512
CELLS = 64
#: Packs and blocks of a square at most.
SIDE = 32
#: Exact rows that are read for each query before the k-th exact score is asked for.
READ = 16
SURVIVORS = "query_id long, rid long, vec_id long, lower double, upper double"


def integers(vectors: DataFrame) -> DataFrame:
    """``(rid, vec_id, dim, v array<long>)`` of the vectors that take part, written; ``rid`` tells rows apart."""
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * 256))
    fit = vectors.where(usable("embedding") & F.col("vec_id").isNotNull())
    rows = fit.select(F.monotonically_increasing_id().alias("rid"), F.col("vec_id").cast("long").alias("vec_id"), F.size("embedding").alias("dim"), whole.alias("v"))
    return materialize(rows, "exact")


def searched(exact: DataFrame, k: int) -> DataFrame:
    """The rows that some query could rank: of equal vectors those of the ``k + 1`` smallest ids, ``k`` rows of an id at most."""
    named = exact.select("rid", "vec_id", F.md5(F.concat_ws(",", F.col("v").cast("array<string>"))).alias("d"))
    of_id = F.row_number().over(W.partitionBy("d", "vec_id").orderBy("rid"))
    some = named.withColumn("n", of_id).where(F.col("n") <= k)
    by_id = F.dense_rank().over(W.partitionBy("d").orderBy("vec_id"))
    kept = materialize(some.withColumn("n", by_id).where(F.col("n") <= k + 1).select("rid"), "searched")
    return exact.join(kept.hint("merge"), "rid", "left_semi")


def approximation_file(exact: DataFrame) -> DataFrame:
    """``(block, dim, rids, ids, marks, cells)``: packed blocks."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task, turn = TaskContext.get().partitionId(), 0
        for x in runs(batches, ["dim"], BLOCK):
            whole = np.stack(x["v"].to_numpy()).astype("i8")
            marks = np.quantile(whole, np.linspace(0, 1, CELLS + 1), axis=0, method="nearest").astype("f8")
            cells = np.stack([np.clip(np.searchsorted(marks[1:-1, d], whole[:, d], side="right"), 0, CELLS - 1) for d in range(whole.shape[1])], 1).astype("u1")
            yield pd.DataFrame({"block": [(task << 32) | turn], "dim": [whole.shape[1]], "rids": [packed(x["rid"].to_numpy("i8"))], "ids": [packed(x["vec_id"].to_numpy("i8"))], "marks": [packed(marks)], "cells": [packed(cells)]})
            turn += 1

    return exact.sortWithinPartitions("dim").mapInPandas(pack, "block long, dim int, rids binary, ids binary, marks binary, cells binary")


def asked_rows(exact: DataFrame, every: int) -> DataFrame:
    """``(query_id, dim, v)``: the vector of each id divisible by ``every``."""
    asked = exact.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min(F.struct("dim", "v")).alias("m"))
    return asked.select(F.col("vec_id").alias("query_id"), "m.dim", "m.v")


def query_packs(asked: DataFrame) -> DataFrame:
    """``(pack, dim, q_ids, queries)``: packed queries."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task, turn = TaskContext.get().partitionId(), 0
        for x in runs(batches, ["dim"], QUERIES):
            yield pd.DataFrame({"pack": [(task << 32) | turn], "dim": [int(x["dim"].iloc[0])], "q_ids": [packed(x["query_id"].to_numpy("i8"))], "queries": [packed(np.stack(x["v"].to_numpy()).astype("i8"))]})
            turn += 1

    return asked.sortWithinPartitions("dim").mapInPandas(pack, "pack long, dim int, q_ids binary, queries binary")


def bounds(marks: np.ndarray, cells: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of all scores (vector, query), from cells: the middle's score, give or take half the cell's."""
    dims = np.arange(cells.shape[1])
    low, high = marks[cells, dims], marks[cells.astype("i8") + 1, dims]
    q = queries.astype("f8").T
    size = np.abs(q)
    slack = 1e-9 * (np.abs(marks).max(0) @ size) + 0.5  # rounding of the sums
    middle, reach = ((low + high) / 2) @ q, ((high - low) / 2) @ size + slack
    return middle - reach, middle + reach


def _survivors(batches: Iterator[pd.DataFrame], k: int) -> Iterator[pd.DataFrame]:
    best: dict[int, np.ndarray] = {}  # pack -> the k largest lower bounds of each of its queries so far
    for x in batches:
        for r in x.itertuples():
            rids, ids, q_ids = np.frombuffer(r.rids, "i8"), np.frombuffer(r.ids, "i8"), np.frombuffer(r.q_ids, "i8")
            cells = np.frombuffer(r.cells, "u1").reshape(-1, r.dim)
            lower, upper = bounds(np.frombuffer(r.marks, "f8").reshape(-1, r.dim), cells, np.frombuffer(r.queries, "i8").reshape(-1, r.dim))
            own = ids[:, None] == q_ids
            lower[own] = -np.inf
            before = best.get(r.pack, np.full((k, len(q_ids)), -np.inf))
            top = np.partition(np.concatenate([before, lower]), -k, axis=0)[-k:]
            best[r.pack] = top
            row, query = np.nonzero((upper >= top.min(0)) & ~own)
            yield pd.DataFrame({"query_id": q_ids[query], "rid": rids[row], "vec_id": ids[row], "lower": lower[row, query], "upper": upper[row, query]})


def survivors(blocks: DataFrame, packs: DataFrame, k: int) -> DataFrame:
    """``SURVIVORS`` of all blocks and packs, both written tables; they meet square by square."""
    n_blocks, n_packs = max(1, blocks.count()), max(1, packs.count())
    across = -(-n_packs // SIDE)
    # at least two squares per core where there are blocks enough; more as the table grows
    down = max(-(-n_blocks // SIDE), min(n_blocks, -(-2 * blocks.sparkSession.sparkContext.defaultParallelism // across)))
    lane = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = blocks.withColumn("down", lane("block", down)).withColumn("across", every(across)).repartition(across * down, "down", "across", "dim")
    right = packs.withColumn("across", lane("pack", across)).withColumn("down", every(down)).repartition(across * down, "down", "across", "dim")
    met = left.join(right.hint("merge"), ["down", "across", "dim"])
    return met.select("dim", "rids", "ids", "marks", "cells", "pack", "q_ids", "queries").mapInPandas(lambda b: _survivors(b, k), SURVIVORS)


@F.pandas_udf(LongType())
def _product(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([int(np.dot(x, y)) for x, y in zip(a, b, strict=True)], dtype="int64")


def exact_scores(wanted: DataFrame, exact: DataFrame, asked: DataFrame) -> DataFrame:
    """``(query_id, vec_id, score)`` of the wanted rows, read from the exact file."""
    rows = wanted.select("query_id", "rid").join(exact.select("rid", "vec_id", "v").hint("merge"), "rid")
    both = rows.join(asked.select("query_id", F.col("v").alias("q")).hint("merge"), "query_id")
    return both.select("query_id", "vec_id", _product("v", "q").alias("score"))


def kth(rows: DataFrame, value: str, k: int) -> DataFrame:
    """``(query_id, least)``: the k-th largest value of each query that has so many."""
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc(value)))
    return rows.withColumn("n", rank).where(F.col("n") <= k).where(F.col("n") == k).select("query_id", F.col(value).cast("double").alias("least"))


def wanted_rows(found: DataFrame, k: int) -> DataFrame:
    """``(query_id, rid, upper, turn)``: survivors by the whole table's k-th lower bound, ``turn`` by descending upper bound."""
    least = F.coalesce("least", F.lit(float("-inf")))
    left = found.join(kth(found, "lower", k), "query_id", "left").where(F.col("upper") >= least)
    turn = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("upper"), "rid"))
    return left.select("query_id", "rid", "upper", turn.alias("turn"))


def top_k(vectors: DataFrame, k: int = 5, every: int = 50) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k best of all vectors for each id divisible by ``every``."""
    exact = integers(vectors)
    blocks = materialize(approximation_file(searched(exact, k)), "approximation")
    asked = materialize(asked_rows(exact, every), "queries")
    packs = materialize(query_packs(asked), "packs")
    wanted = materialize(wanted_rows(materialize(survivors(blocks, packs, k), "survivors"), k), "wanted")
    first = materialize(exact_scores(wanted.where(F.col("turn") <= READ), exact, asked), "first_read")
    rest = wanted.where(F.col("turn") > READ).join(kth(first, "score", k), "query_id").where(F.col("upper") >= F.col("least"))
    scores = first.unionByName(exact_scores(rest, exact, asked))
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return scores.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
