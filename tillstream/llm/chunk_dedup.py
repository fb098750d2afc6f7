"""Substring dedup by content-defined chunking with a gear rolling hash (operator 4).

A text's UTF-8 bytes are cut where the gear hash of the last ``REACH`` bytes has its top ``BITS`` bits
zero, at least ``LEAST`` and at most ``MOST`` bytes apart and never inside a character. Cuts depend on the nearby bytes
only, so text inserted before a passage shifts its chunks without changing them. Chunks are compared by
a 128-bit digest. A chunk is a repeat if a document with a smaller id holds it, or its own document
held it before. Runs of adjacent repeats of at least ``least_run`` bytes are deleted.

Scale: digests are counted with partial sums, so a chunk in a third of all documents ships one row per
task; only digests met twice go on. Places are joined with their digest's first document, linear in the
places. Both sides of that join are written tables, whose hot digests Spark can split. What is shuffled is kept small:
a text's chunks are numbered, and it sends each chunk once; where its text meets the found numbers it is cut again,
which gives the offsets and the chunks that it repeats itself.

Defined cases: a null text stays null and an empty one empty; rows with the same id count as one document
(none repeats another) but repeats inside each row are found; null ids come last; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, text_key

LEAST, MOST = 24, 512
REACH = 16
BITS = 4
LEAST_RUN = 128
SLICE = 1 << 22
#: One random 32-bit number for each byte value.
GEAR = np.random.default_rng(97).integers(0, 1 << 32, 256, dtype="u4")


def gear(data: np.ndarray) -> np.ndarray:
    """Gear hash of the last ``REACH`` bytes at every place: each step doubles the bytes that are summed."""
    h, width = GEAR[data], 1
    while width < REACH:
        h[width:] = h[width:] + (h[:-width] << np.uint32(width))
        width *= 2
    return h


def candidates(data: np.ndarray) -> np.ndarray:
    """Places (ends of chunks) that the hash marks, between characters."""
    out = []
    for lo in range(0, len(data), SLICE):
        back = min(lo, REACH)
        h = gear(data[lo - back : lo + SLICE])[back:]
        out.append(lo + 1 + np.flatnonzero(h >> np.uint32(32 - BITS) == 0))
    ends = np.concatenate(out) if out else np.empty(0, "i8")
    ends = ends[ends < len(data)]
    return ends[data[ends] & 0xC0 != 0x80]


def cuts(data: bytes) -> list[int]:
    """Ends of the chunks of a text."""
    raw = np.frombuffer(data, "u1")
    out, start = [], 0
    for end in [*candidates(raw).tolist(), len(raw)]:
        while end - start > MOST:
            start += MOST
            while raw[start] & 0xC0 == 0x80:
                start -= 1
            out.append(start)
        if end - start >= LEAST or (end == len(raw) and end > start):
            out.append(end)
            start = end
    return out


def _chunk_rows(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Places of the chunks that the text did not hold before, and their digests (two longs each)."""
    data = text.encode("utf-8", "surrogatepass") if isinstance(text, str) else b""
    ends, view = cuts(data), memoryview(data)
    places: dict[bytes, int] = {}
    for at, (a, b) in enumerate(zip([0, *ends], ends, strict=False)):
        places.setdefault(hashlib.blake2b(view[a:b], digest_size=16).digest(), at)
    return np.array([*places.values()], "i4"), np.frombuffer(b"".join(places), "i8").reshape(-1, 2)


def _chunk_batches(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for x in batches:
        rows = [_chunk_rows(t) for t in x]
        yield pd.DataFrame({"at": [r[0] for r in rows], "d1": [r[1][:, 0] for r in rows], "d2": [r[1][:, 1] for r in rows]})


def chunks(docs: DataFrame) -> DataFrame:
    """``(id, key, at, d1, d2)``: one row per distinct chunk of a text; ``at`` numbers the text's chunks from 0."""
    cut_up = F.pandas_udf(_chunk_batches, "at array<int>, d1 array<long>, d2 array<long>")
    made = docs.select(F.col("doc_id").alias("id"), text_key().alias("key"), cut_up("text").alias("c"))
    rows = made.select("id", "key", F.explode(F.arrays_zip("c.at", "c.d1", "c.d2")).alias("c"))
    return rows.select("id", "key", "c.at", "c.d1", "c.d2")


def repeats(docs: DataFrame) -> DataFrame:
    """``(id, key, spans array<struct<at, first>>)``: chunks that an earlier document holds and the first document of each."""
    rows = materialize(chunks(docs), "chunks")
    known = rows.groupBy("d1", "d2").agg(F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1")
    known = materialize(known.select("d1", "d2", "first"), "known")
    later = rows.join(known, ["d1", "d2"]).where("first is not null and (id is null or id > first)").select("id", "key", "at", "first")
    # rows with one id and text bring the same places: a set
    return later.repartition("id", "key").groupBy("id", "key").agg(F.collect_set(F.struct("at", "first")).alias("spans"))


def long_runs(spans: list[tuple[int, int]], least_run: int) -> list[tuple[int, int]]:
    """Adjacent spans joined, those of at least ``least_run`` bytes."""
    out: list[list[int]] = []
    for start, stop in spans:
        if out and out[-1][1] == start:
            out[-1][1] = stop
        else:
            out.append([start, stop])
    return [(a, b) for a, b in out if b - a >= least_run]


def _cut(text: str, spans: np.ndarray | None, least_run: int) -> tuple[str, int, list[int], bool]:
    data, found = text.encode("utf-8", "surrogatepass"), {} if spans is None else {s["at"]: s["first"] for s in spans}
    ends, places, again = cuts(data), {}, []
    for at, (a, b) in enumerate(zip([0, *ends], ends, strict=False)):
        place = places.setdefault(data[a:b], at)
        if place < at or at in found:
            again.append((a, b, found.get(place)))
    gone = long_runs([(a, b) for a, b, _ in again], least_run)
    kept, at = [], 0
    for start, stop in gone:
        kept.append(data[at:start])
        at = stop
    kept.append(data[at:])
    ranges = iter(gone)
    now, used = next(ranges, None), set()
    for start, _, first in again:
        while now and start >= now[1]:
            now = next(ranges, None)
        if now and start >= now[0]:
            used.add(first)
    own = None in used
    return b"".join(kept).decode("utf-8", "surrogatepass"), sum(b - a for a, b in gone), sorted(used - {None}), own


def dedup(docs: DataFrame, least_run: int = LEAST_RUN) -> DataFrame:
    """``(doc_id, text, n_removed, first_ids)``: the text without repeats, bytes deleted, documents that hold them first."""

    @F.pandas_udf("text string, n_removed long, first_ids array<long>, own boolean")
    def cut(texts: pd.Series, spans: pd.Series) -> pd.DataFrame:
        rows = [_cut(t, s, least_run) if isinstance(t, str) else (t, 0, [], False) for t, s in zip(texts, spans, strict=True)]
        return pd.DataFrame(rows, columns=["text", "n_removed", "first_ids", "own"])

    # texts and spans meet in a shuffle at every size: the spans grow with the corpus
    found = materialize(repeats(docs), "repeats").select(F.col("id").alias("__id"), F.col("key").alias("__key"), "spans").hint("merge")
    keyed = docs.select("doc_id", "text", text_key().alias("key"))
    joined = keyed.join(found, keyed["doc_id"].eqNullSafe(found["__id"]) & (keyed["key"] == found["__key"]), "left")
    out = joined.select("doc_id", cut("text", "spans").alias("c"))
    # a document that repeats itself is listed among the first ones
    firsts = F.when(F.col("c.own") & F.col("doc_id").isNotNull(), F.array_sort(F.array_append("c.first_ids", F.col("doc_id").cast("long")))).otherwise(F.col("c.first_ids"))
    return out.select("doc_id", "c.text", "c.n_removed", firsts.alias("first_ids"))
