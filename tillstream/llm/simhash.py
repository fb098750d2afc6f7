"""SimHash near-duplicates with the generalised pigeonhole principle (operator 8).

A fingerprint has one bit per hash bit that is set in over half of a document's word shingles.
Two fingerprints within ``max_bits`` differing bits link; documents reachable over links form a group.

Search: the 64 bits are dealt to ``m`` partitions, correlated bits together. If thresholds ``t_i`` of
at least -1 sum to ``max_bits - m + 1``, any two linked fingerprints agree within ``t_i`` bits on some
partition ``i`` with ``t_i >= 0``. A dynamic programme picks the thresholds that minimise the estimated
candidates and probes. Each fingerprint is stored under its own value of a partition and probes the
larger values in the ball of radius ``t_i``; every pair that meets is verified on all 64 bits.

Scale: equal fingerprints are one node, so copies cost nothing. A value shared by more than ``BLOCK``
rows is cut into blocks whose pairs are separate groups, so no task holds a whole hot value. A task
emits a spanning forest of the links it verified, never all pairs of a group.

Defined cases: null or empty text has fingerprint zero and links like any other; rows that repeat an
id get one output row each; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, sheltered, text_key
from .graph import EDGE, components, forest

BITS = 64
#: Rows of one bucket value that meet in one task.
BLOCK = 512
#: Bytes of a text that are cut into words at a time.
SLICE = 1 << 20
SPACE = b" \t\n\r\x0b\x0c"
#: Cost of moving one row against verifying one pair in numpy.
ROW_COST = 100


def _slices(data: bytes) -> Iterator[bytes]:
    """Pieces of about ``SLICE`` bytes that end between words."""
    at = 0
    while at < len(data):
        end = at + SLICE
        while end < len(data) and data[end] not in SPACE:
            end += 1
        yield data[at:end]
        at = end


def fingerprint(text: str | None, words: int) -> int:
    """SimHash of the lower-cased (A-Z only) word shingles of a text, as an unsigned integer."""
    ones, total, carry, seen = np.zeros(BITS, "int64"), 0, [], 0
    for piece in _slices((text.encode("utf-8", "surrogatepass") if isinstance(text, str) else b"").lower()):
        carry += piece.split()
        if len(carry) >= words:
            grams = map(b" ".join, zip(*(carry[k:] for k in range(words)), strict=False))
            h = np.fromiter((xxhash.xxh64_intdigest(x, 42) for x in grams), "<u8")
            ones += np.unpackbits(h.view("u1").reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype="int64")
            total += len(h)
            seen, carry = 1, carry[len(carry) - words + 1 :]
    if not seen and carry:
        h = np.array([xxhash.xxh64_intdigest(b" ".join(carry), 42)], "<u8")
        ones, total = np.unpackbits(h.view("u1"), bitorder="little").astype("int64"), 1
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, text_key, fp long)``, one row per input row."""

    @F.pandas_udf("long")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, words) for t in texts], "u8").view("i8"))

    return docs.select(F.col(id_col).alias("doc_id"), text_key(text_col).alias("text_key"), run(F.col(text_col)).alias("fp"))


def _bits(fp: np.ndarray) -> np.ndarray:
    return np.unpackbits(fp.astype("<i8").view("u1").reshape(-1, 8), axis=1, bitorder="little")


def bit_counts(fps: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints and the 64 x 64 counts of bits set together (a table of fixed size)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        both, n = np.zeros((BITS, BITS)), 0
        for x in batches:
            b = _bits(x["fp"].to_numpy("int64")).astype("float32")
            for k in range(0, len(b), 65536):
                both += b[k : k + 65536].T @ b[k : k + 65536]
            n += len(b)
        yield pd.DataFrame({"cell": np.arange(BITS * BITS + 1), "n": np.append(both.ravel(), n).astype("int64")})

    cells = fps.select("fp").mapInPandas(run, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    flat = np.zeros(BITS * BITS + 1)
    for r in cells:
        flat[r["cell"]] = r["n"]
    return int(flat[-1]), flat[:-1].reshape(BITS, BITS)


def group_bits(n: int, both: np.ndarray, m: int) -> list[list[int]]:
    """``m`` partitions of the bits, each grown by the bit most correlated with it."""
    p = np.diag(both) / max(n, 1)
    var = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    corr = np.abs((both / max(n, 1) - np.outer(p, p)) / np.outer(var, var))
    np.fill_diagonal(corr, 0)
    left, parts = set(range(BITS)), []
    for k in range(m):
        size = BITS // m + (k < BITS % m)
        part: list[int] = []
        while len(part) < size:
            rest = sorted(left)
            near = corr[np.ix_(rest, part or rest)].sum(1)
            part.append(rest[int(np.argmax(near))])
            left.discard(part[-1])
        parts.append(sorted(part))
    return parts


def within(differ: np.ndarray, radius: int) -> np.ndarray:
    """Chance that a random pair differs in at most 0..radius of independent bits."""
    dist = np.zeros(radius + 1)
    dist[0] = 1
    for q in differ:
        dist[1:] = dist[1:] * (1 - q) + dist[:-1] * q
        dist[0] *= 1 - q
    return np.cumsum(dist)


def allocate(costs: list[list[float]], total: int) -> list[int]:
    """Thresholds, one per partition and at least -1, that sum to ``total`` at the least cost.

    ``costs[i][t + 1]`` is the cost of threshold ``t`` in partition ``i``.
    """
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for row in costs:
        step: dict[int, tuple[float, list[int]]] = {}
        for used, (cost, chosen) in best.items():
            for t, c in enumerate(row, -1):
                if used + t not in step or cost + c < step[used + t][0]:
                    step[used + t] = (cost + c, [*chosen, t])
        best = step
    return best[total][1]


def plan(n: int, both: np.ndarray, m: int, max_bits: int, same: list[float] | None = None) -> tuple[list[list[int]], list[int], float]:
    """Partitions, thresholds and cost for ``m`` partitions. ``same``: counted pairs that share a partition's value."""
    parts = group_bits(n, both, m)
    p = np.diag(both) / max(n, 1)
    pairs, costs = n * n / 2, []
    for i, part in enumerate(parts):
        near = within(2 * p[part] * (1 - p[part]), max_bits)
        scale = same[i] / max(pairs * near[0], 1e-9) if same else 1.0
        rows = [0, *(sum(math.comb(len(part), k) for k in range(1, t + 1)) / 2 + 1 for t in range(max_bits + 1))]
        costs.append([0.0, *(min(pairs, pairs * near[t] * max(scale, 1.0)) + n * ROW_COST * rows[t + 1] for t in range(max_bits + 1))])
    chosen = allocate(costs, max_bits - m + 1)
    return parts, chosen, sum(c[t + 1] for c, t in zip(costs, chosen, strict=True))


def _values(fp: np.ndarray, part: list[int]) -> np.ndarray:
    bits = _bits(fp)[:, part].astype("int64")
    return bits @ (1 << np.arange(len(part), dtype="int64"))


def _key(i: int, value: np.ndarray) -> np.ndarray:
    return (np.int64(i) << np.int64(48)) | value


def buckets(reps: DataFrame, parts: list[list[int]], thresholds: list[int]) -> DataFrame:
    """``(key, probe, fp)``: each fingerprint under its own values, and as a probe under larger values in the ball."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in batches:
            fp = x["fp"].to_numpy("int64")
            for i, (part, t) in enumerate(zip(parts, thresholds, strict=True)):
                if t < 0:
                    continue
                value = _values(fp, part)
                yield pd.DataFrame({"key": _key(i, value), "probe": False, "fp": fp})
                for radius in range(1, t + 1):
                    for flip in combinations(range(len(part)), radius):
                        other = value ^ np.int64(sum(1 << k for k in flip))
                        up = other > value
                        yield pd.DataFrame({"key": _key(i, other[up]), "probe": True, "fp": fp[up]})

    return reps.select("fp").mapInPandas(run, "key long, probe boolean, fp long")


def _popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x.view("u8"))


def _meet(key: np.ndarray, probe: np.ndarray, fp: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Verified pairs of sorted runs of equal keys: each stored row against all rows after it in its run."""
    a, b = [], []
    at, d = np.flatnonzero(~probe), 1
    while len(at):
        at = at[at + d < len(key)]
        at = at[key[at + d] == key[at]]
        x, y = fp[at], fp[at + d]
        hit = (_popcount(x ^ y) <= max_bits) & (x != y)
        a.append(x[hit])
        b.append(y[hit])
        if sum(map(len, a)) > 1_000_000:  # a hot block: keep a forest of what was found so far
            stars = forest(np.concatenate(a), np.concatenate(b))
            a, b = [stars[0]], [stars[1]]
        d += 1
    return (np.concatenate(a), np.concatenate(b)) if a else (np.empty(0, "int64"), np.empty(0, "int64"))


def links(reps: DataFrame, max_bits: int) -> DataFrame:
    """Edges between distinct fingerprints whose components are those of all links within ``max_bits``."""
    n, both = bit_counts(reps)
    m = min(range(2, max(3, max_bits + 2)), key=lambda k: plan(n, both, k, max_bits)[2])
    parts = group_bits(n, both, m)
    shared = buckets(reps, parts, [0] * m).groupBy("key").agg(F.count("*").alias("n"))
    pairs = shared.groupBy(F.shiftright("key", 48).alias("part")).agg(F.sum(F.col("n") * (F.col("n") - 1) / 2).alias("pairs"))
    same = {r["part"]: r["pairs"] for r in pairs.collect()}
    _, thresholds, _ = plan(n, both, m, max_bits, [same.get(i, 0.0) for i in range(m)])

    rows = materialize(buckets(reps, parts, thresholds), "buckets")
    hot = materialize(rows.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > BLOCK), "hot")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    mine = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    split = (
        rows.join(hot.select("key", blocks.alias("blocks")), "key", "left")
        .withColumn("mine", F.coalesce(mine, F.lit(0)))
        .withColumn("other", F.explode(F.when(F.col("blocks").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("blocks") - 1))))
        .select("key", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "probe", "fp")
    )
    grouped = split.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "probe")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for x in batches:
            x = x if rest is None else pd.concat([rest, x], ignore_index=True)
            run_id = ((x["key"].diff() != 0) | (x["i"].diff() != 0) | (x["j"].diff() != 0)).to_numpy().cumsum()
            cut = int(np.searchsorted(run_id, run_id[-1])) if len(x) else 0
            rest = x.iloc[cut:]
            yield found(x.iloc[:cut], run_id[:cut])
        if rest is not None:
            yield found(rest, np.zeros(len(rest)))

    def found(x: pd.DataFrame, run_id: np.ndarray) -> pd.DataFrame:
        a, b = _meet(run_id, x["probe"].to_numpy(bool), x["fp"].to_numpy("int64"), max_bits)
        a, b = forest(a, b)
        return pd.DataFrame({"a": a, "b": b})

    return grouped.mapInPandas(run, EDGE)


def _rooted(docs: DataFrame, words: int, max_bits: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """The fingerprint of every row, and ``(fp, first, root)`` of every distinct one: the root names its group, ``first`` is its smallest id."""
    fps = materialize(fingerprints(docs, words, id_col, text_col), "fingerprints")
    reps = materialize(fps.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    found = materialize(components(links(reps, max_bits)), "components")
    rooted = reps.join(found.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    return fps, materialize(rooted, "rooted")


def near_duplicates(docs: DataFrame, words: int = 4, max_bits: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, text_key, fingerprint hex, component_id)``: smallest id reachable over links, one row per input row."""
    fps, rooted = _rooted(docs, words, max_bits, id_col, text_col)
    smallest = materialize(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "smallest")
    named = materialize(rooted.join(smallest, "root").select("fp", "component_id"), "named")
    return fps.join(named, "fp").select("doc_id", "text_key", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@sheltered
def keep_one(docs: DataFrame, words: int = 4, max_bits: int = 4) -> DataFrame:
    """``docs`` (with ``doc_id`` and ``text``) with one row of each group: the smallest id (rows without one last), then the smallest text key.

    Groups are told apart by their fingerprints, so rows without an id stay with their own group."""
    fps, rooted = _rooted(docs, words, max_bits, "doc_id", "text")
    stay = fps.join(rooted.select("fp", "root"), "fp").groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")).alias("s"))
    stay = materialize(stay.select(F.col("s.doc_id").alias("__id"), F.col("s.text_key").alias("__key")), "stay")
    keyed = docs.withColumn("__text_key", text_key())
    same = keyed["doc_id"].eqNullSafe(stay["__id"]) & (keyed["__text_key"] == stay["__key"])
    return keyed.join(stay, same, "left_semi").dropDuplicates(["doc_id", "__text_key"]).select(*docs.columns)
