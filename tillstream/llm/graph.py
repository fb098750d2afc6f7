"""Connected components of an edge table by repeated contraction.

Each round hooks every node on the neighbour (or itself) that comes first in a random order drawn
for that round, then relabels the edges and drops loops and repeats. A round removes a constant
share of the nodes on average whatever the shape of the graph, so the rounds grow with the logarithm of
the nodes. Nothing is collected; every round is two written tables.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

EDGE = "a long, b long"
CHUNK = 500_000


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Star edges (node, smallest node of its component) that connect what ``a - b`` connects."""
    ids, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = at[: len(a)], at[len(a) :]
    parent = np.arange(len(ids))
    while True:
        lo, hi = np.minimum(parent[u], parent[v]), np.maximum(parent[u], parent[v])
        if np.array_equal(lo, hi):
            break
        np.minimum.at(parent, hi, lo)
        while not np.array_equal(up := parent[parent], parent):
            parent = up
    child = np.flatnonzero(parent != np.arange(len(ids)))
    return ids[child], ids[parent[child]]


def _local_forest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held = [np.empty(0, "int64"), np.empty(0, "int64")]
    for x in batches:
        held = [np.concatenate([h, x[c].to_numpy("int64")]) for h, c in zip(held, "ab", strict=True)]
        if len(held[0]) > CHUNK:
            held = list(forest(*held))
            if len(held[0]) > CHUNK // 2:
                yield pd.DataFrame({"a": held[0], "b": held[1]})
                held = [np.empty(0, "int64"), np.empty(0, "int64")]
    if len(held[0]):
        a, b = forest(*held)
        yield pd.DataFrame({"a": a, "b": b})


def _rank(node: Column, turn: int) -> Column:
    return F.xxhash64(node, F.lit(turn))


def components(edges: DataFrame) -> DataFrame:
    """``edges(a long, b long)``, undirected, no nulls -> ``(node, root)``: root is the smallest node reachable.

    Only nodes with an edge to another node are returned; loops and repeated edges are allowed.
    """
    left = materialize(edges.where("a <> b").select("a", "b"), "edges")
    maps: list[DataFrame] = []
    while left.take(1):
        turn = len(maps)
        both = left.union(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        best = both.groupBy("a").agg(F.min(_rank(F.col("b"), turn)).alias("rank"), F.min_by("b", _rank(F.col("b"), turn)).alias("b"))
        parent = F.when(F.col("rank") < _rank(F.col("a"), turn), F.col("b")).otherwise(F.col("a"))
        maps.append(materialize(best.select(F.col("a").alias("node"), parent.alias("parent")), f"map{turn}"))
        to = maps[-1]
        moved = (
            left.join(to.select(F.col("node").alias("a"), F.col("parent").alias("pa")), "a")
            .join(to.select(F.col("node").alias("b"), F.col("parent").alias("pb")), "b")
            .where("pa <> pb")
            .select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b"))
            .mapInPandas(_local_forest, EDGE)
            .distinct()
        )
        left = materialize(moved, f"edges{turn + 1}")
    if not maps:
        return left.select(F.col("a").alias("node"), F.col("b").alias("root"))
    out = maps[0]
    for nxt in maps[1:]:
        step = nxt.select(F.col("node").alias("parent"), F.col("parent").alias("up"))
        out = out.join(step, "parent", "left").select("node", F.coalesce("up", "parent").alias("parent"))
    out = materialize(out, "labels")
    smallest = materialize(out.groupBy("parent").agg(F.min("node").alias("root")), "roots")
    return out.join(smallest, "parent").select("node", "root")
