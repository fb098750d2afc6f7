"""Embedding near-duplicates by collision-counting projections (operator 3).

Vectors are compared only when their labels are equal. Equal vectors are one class. The classes are
sorted by label and by their first projection and cut in blocks of up to ``BLOCK``. ``PROJECTIONS``
random lines carry the unit vectors; two vectors collide on a line when one lies in the window of
half-width ``WIDTH`` centred on the other. The collisions of every pair of two blocks are counted, and pairs
with at least ``least_count`` collisions are verified by their exact cosine in double precision.

Calibration: at the threshold the difference of two unit vectors on a Gaussian line is normal with
deviation sqrt(2 - 2 t); ``least_count`` is the largest count that a pair at exactly the threshold reaches
with probability ``RECALL`` (nearer pairs reach it more often). It depends on parameters only.

A pair of blocks is skipped when the ranges of their projections leave fewer than ``least_count`` lines on
which any two of their vectors could collide: such pairs cannot pass. What a pair of blocks hands on is a
number of links per vector and a spanning forest of its links, never the links themselves, so a large
group of near copies costs comparisons inside numpy only, spread over the block pairs.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite components, and vectors with
a null label, link with nothing (their own component); vectors of other lengths do not link; rows that
repeat an id are rows of their own; a row without an id links as any other, its class is named by the
smallest id there is, and it is kept if no id names its component.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize
from .graph import components, forest
from .vectors import packed, runs, usable

BLOCK = 1024
PROJECTIONS = 32
WIDTH = 0.25
RECALL = 0.9999
SEED = 11


def lines(dim: int) -> np.ndarray:
    """The random lines for vectors of a length: (dim, PROJECTIONS)."""
    return np.random.default_rng([SEED, dim]).normal(size=(dim, PROJECTIONS))


def least_count(cosine: float) -> int:
    """Collisions that a pair at the threshold reaches with probability ``RECALL``."""
    hit = math.erf(WIDTH / math.sqrt(2 * max(2 - 2 * cosine, 1e-12)))
    below = 0.0
    for c in range(PROJECTIONS + 1):
        below += math.comb(PROJECTIONS, c) * hit**c * (1 - hit) ** (PROJECTIONS - c)
        if below > 1 - RECALL:
            return max(c, 1)
    return PROJECTIONS


def unit(v: np.ndarray) -> np.ndarray:
    """Rows divided by their norms, first by their largest component so that nothing over- or underflows."""
    v = v / np.abs(v).max(1, keepdims=True)
    return v / np.sqrt((v * v).sum(1, keepdims=True))


def _first_projection(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for x in batches:
        at = np.empty(len(x))
        for dim, rows in x.reset_index(drop=True).groupby("dim").groups.items():
            at[rows] = unit(np.stack(x["embedding"].to_numpy()[rows]).astype("f8")) @ lines(int(dim))[:, 0]
        yield x.assign(at=at)


def _pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    task, turn = TaskContext.get().partitionId(), 0
    for x in runs(batches, ["label", "dim"], BLOCK):
        v = np.stack(x["embedding"].to_numpy()).astype("f8")
        on = unit(v) @ lines(v.shape[1])
        first = x.iloc[0]
        yield pd.DataFrame({"block": [(task << 32) | turn], "label": [int(first["label"])], "dim": [v.shape[1]], "reps": [packed(x["rep"].to_numpy("i8"))], "sizes": [packed(x["n"].to_numpy("i8"))], "vectors": [packed(v)], "lo": [on.min(0)], "hi": [on.max(0)]})
        turn += 1


def blocks(classes: DataFrame) -> DataFrame:
    """Sorted classes in packed blocks, with the range of every projection."""
    at = materialize(classes.mapInPandas(_first_projection, "label long, dim int, rep long, n long, embedding array<double>, at double"), "projected")
    tasks = max(1, -(-at.count() // (4 * BLOCK)))
    slabs = at.repartitionByRange(tasks, "label", "dim", "at").sortWithinPartitions("label", "dim", "at")
    return slabs.mapInPandas(_pack, "block long, label long, dim int, reps binary, sizes binary, vectors binary, lo array<double>, hi array<double>")


def compare(a: tuple, b: tuple, same: bool, cosine: float, count: int) -> tuple[np.ndarray, ...]:
    """Links of two blocks (reps, sizes, vectors): reps, their links, and the edges of a spanning forest."""
    ua, ub = unit(a[2]), unit(b[2])
    pa, pb = (ua @ lines(ua.shape[1])).astype("f4"), (ub @ lines(ub.shape[1])).astype("f4")
    hits = np.zeros((len(pa), len(pb)), "u1")
    for i in range(PROJECTIONS):
        hits += np.abs(pa[:, i, None] - pb[None, :, i]) <= np.float32(WIDTH)
    x, y = np.nonzero(hits >= count)
    if same:
        x, y = x[x < y], y[x < y]
    linked = np.zeros(len(x), bool)
    for k in range(0, len(x), 100_000):
        part = slice(k, k + 100_000)
        linked[part] = np.einsum("ij,ij->i", ua[x[part]], ub[y[part]]) >= cosine
    x, y = x[linked], y[linked]
    n_a = np.bincount(x, weights=b[1][y], minlength=len(pa)).astype("i8")
    n_b = np.bincount(y, weights=a[1][x], minlength=len(pb)).astype("i8")
    stars = forest(a[0][x], b[0][y])
    reps, n = np.concatenate([a[0], b[0]]), np.concatenate([n_a, n_b])
    return reps[n > 0], n[n > 0], *stars


def _compare_rows(batches: Iterator[pd.DataFrame], cosine: float, count: int) -> Iterator[pd.DataFrame]:
    for x in batches:
        for r in x.itertuples():
            sides = [(np.frombuffer(p, "i8"), np.frombuffer(s, "i8"), np.frombuffer(v, "f8").reshape(-1, r.dim)) for p, s, v in ((r.a_reps, r.a_sizes, r.a_vectors), (r.b_reps, r.b_sizes, r.b_vectors))]
            reps, n, u, v = compare(*sides, r.a == r.b, cosine, count)
            yield pd.DataFrame({"a": np.concatenate([reps, u]), "b": np.concatenate([np.full(len(reps), -1), v]), "n": np.concatenate([n, np.zeros(len(u), "i8")])})


def links(classes: DataFrame, cosine: float) -> DataFrame:
    """``(a, b, n)``: ``n`` > 0 is a number of links of class ``a``, ``n`` = 0 an edge between classes."""
    count = least_count(cosine)
    packs = materialize(blocks(classes), "blocks")
    ranges = packs.select("block", "label", "dim", "lo", "hi")
    left, right = ranges.select("label", "dim", *[F.col(c).alias(f"a_{c}") for c in ("block", "lo", "hi")]), ranges.select("label", "dim", *[F.col(c).alias(f"b_{c}") for c in ("block", "lo", "hi")])
    near = F.filter(F.sequence(F.lit(0), F.lit(PROJECTIONS - 1)), lambda i: (F.get("a_lo", i) - WIDTH <= F.get("b_hi", i) + 1e-5) & (F.get("b_lo", i) - WIDTH <= F.get("a_hi", i) + 1e-5))
    pairs = left.join(right, ["label", "dim"]).where((F.col("a_block") <= F.col("b_block")) & (F.size(near) >= count))
    pairs = materialize(pairs.select("dim", F.col("a_block").alias("a"), F.col("b_block").alias("b")), "pairs")
    for side in "ab":
        pairs = pairs.join(packs.select(F.col("block").alias(side), *[F.col(c).alias(f"{side}_{c}") for c in ("reps", "sizes", "vectors")]), side)
    return pairs.mapInPandas(lambda x: _compare_rows(x, cosine, count), "a long, b long, n long")


def near_duplicates(vectors: DataFrame, cosine: float = 0.98) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)``, one row per input row."""
    some = F.exists("embedding", lambda x: x != 0)
    fit = usable("embedding") & F.col("label").isNotNull() & some
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("embedding"))
    rows = materialize(rows.withColumn("fit", F.coalesce(fit, F.lit(False))), "vectors")
    classes = rows.where("fit").groupBy("label", "embedding").agg(F.min("vec_id").alias("smallest"), F.count("*").alias("n"))
    # a class is keyed by a number of its own, fixed by the write: ids may be missing or stand for several vectors
    classes = materialize(classes.withColumn("rep", F.monotonically_increasing_id()), "classes")
    found = materialize(links(classes.select("label", F.size("embedding").alias("dim"), "rep", "n", "embedding"), cosine), "links")
    counts = found.where("n > 0").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("more"))
    roots = components(found.where("n = 0").select("a", "b")).withColumnRenamed("node", "rep")
    members = materialize(classes.select("rep", "smallest").join(roots, "rep"), "components")
    least = materialize(members.groupBy("root").agg(F.min("smallest").alias("least")), "least")
    names = members.join(least, "root").select("rep", "least")
    named = classes.join(counts, "rep", "left").join(names, "rep", "left")
    named = materialize(named.select("label", "embedding", (F.col("n") - 1 + F.coalesce("more", F.lit(0))).alias("n_links"), F.coalesce("least", "smallest").alias("component_id")), "named")
    linked = rows.where("fit").join(named, ["label", "embedding"]).select("vec_id", "n_links", "component_id")
    alone = rows.where("not fit").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
