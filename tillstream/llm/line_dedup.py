"""Line dedup by winnowing over line hashes (operator 5). DataFrame functions only.

A document is cut at newlines. Every two successive lines (``GRAM``) form a gram; in each window of
``window`` successive grams the smallest gram hashes are fingerprints, so every repeated run of
``GRAM + window - 1`` lines holds one in both places. A fingerprint is joined with the first place of
the same gram in the corpus order (id, text, position), where both lines must be equal again. The match
is then extended by up to ``window - 1`` lines both ways. That is enough: any longer part of the run
holds further fingerprints, and grams of ``window`` lines leave no gap between them. All places after
the first are later repeats: their lines are deleted, overlapping runs merged.

A line of over ``LINE_WORDS`` words or ``LINE_CHARS`` characters is a fingerprint by itself, wherever it stands: all its places
after the first are deleted, also a document's only line. Every run of ``GRAM + window - 1`` lines, a gram with its
neighbours, has a first place of its own too: the first place of a frequent gram alone rarely has the same neighbours.

Every deleted line has an equal line at an earlier place, and places are ordered, so a copy of each
line stays. Joining with the first place only, the work is linear in the places of a hot line.

Defined cases: a null text stays null, a text of one short line is never changed; rows equal in id and text
count as one document and are treated alike; a null id sorts last; other columns pass unchanged,
whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import materialize, sheltered, text_key

GRAM = 2
WINDOW = 2
LINE_WORDS = 5
LINE_CHARS = 60


def digest(x: Column) -> Column:
    """60 bits of MD5 as a long, the same in other SQL engines."""
    return F.conv(F.substring(F.md5(x), 1, 15), 16, 10).cast("long")


def line_hashes(text: Column) -> Column:
    return F.transform(F.split(text, "\n"), lambda line: digest(line))


def _smallest_in_a_window(grams: Column, i: Column, window: int) -> Column:
    """Whether gram ``i`` is a minimum of some window that covers it (one shorter window if there are few grams)."""
    size = F.least(F.size(grams), F.lit(window))
    starts = F.sequence(F.greatest(i - size + 1, F.lit(0)), F.least(i, F.size(grams) - size))
    return F.exists(starts, lambda s: F.get(grams, i) <= F.array_min(F.slice(grams, s + 1, size)))


def fingerprints(docs: DataFrame, window: int) -> DataFrame:
    """``(id, key, pos, gram, at, before, after)``: ``at`` holds the gram's lines, the others the lines around it."""
    hashed = docs.where("text is not null").select(F.col("doc_id").alias("id"), text_key().alias("key"), line_hashes(F.col("text")).alias("h"))
    pairs = F.transform(F.sequence(F.lit(0), F.size("h") - GRAM), lambda i: digest(F.concat_ws(":", F.get("h", i), F.get("h", i + 1))))
    grams = hashed.where(F.size("h") >= GRAM).select("id", "key", "h", pairs.alias("g"))
    picked = F.filter(F.sequence(F.lit(0), F.size("g") - 1), lambda i: _smallest_in_a_window(F.col("g"), i, window))
    reach, pos = F.lit(window - 1), F.col("pos")
    left = F.reverse(F.slice("h", F.greatest(pos - reach, F.lit(0)) + 1, F.least(pos, reach)))
    right = F.slice("h", pos + GRAM + 1, reach)
    spread = grams.select("id", "key", "h", "g", F.explode(picked).alias("pos"))
    return spread.select("id", "key", "pos", F.get("g", pos).alias("gram"), F.slice("h", pos + 1, F.lit(GRAM)).alias("at"), left.alias("before"), right.alias("after"))


def long_line(line: Column) -> Column:
    return (F.length(line) > LINE_CHARS) | (F.size(F.split(F.trim(line), r"\s+")) > LINE_WORDS)


def two_digests(x: Column) -> list[Column]:
    """120 bits of MD5 as two longs."""
    return [F.conv(F.substring(F.md5(x), at, 15), 16, 10).cast("long").alias(name) for name, at in (("d1", 1), ("d2", 16))]


def line_marks(docs: DataFrame) -> DataFrame:
    """``(id, key, start, stop, d1, d2)``: one row per long line."""
    lines = docs.where("text is not null").select(F.col("doc_id").alias("id"), text_key().alias("key"), F.posexplode(F.split("text", "\n")).alias("start", "line"))
    return lines.where(long_line(F.col("line"))).select("id", "key", "start", (F.col("start") + 1).alias("stop"), *two_digests(F.col("line")))


def run_marks(docs: DataFrame, size: int) -> DataFrame:
    """``(id, key, start, stop, d1, d2)``: one row per run of ``size`` lines, unless all its lines are long (they are marks already)."""
    lines = F.split("text", "\n")
    cut = docs.where("text is not null").select(F.col("doc_id").alias("id"), text_key().alias("key"), line_hashes(F.col("text")).alias("h"), F.transform(lines, lambda x: ~long_line(x)).alias("short"))
    cut = cut.where(F.size("h") >= size)
    starts = F.filter(F.sequence(F.lit(0), F.size("h") - size), lambda i: F.exists(F.slice("short", i + 1, F.lit(size)), lambda x: x))
    spread = cut.select("id", "key", "h", F.explode(starts).alias("start"))
    # no line holds a newline: a run never has the digest of a line
    run = F.concat(F.lit("\n"), F.concat_ws(":", F.slice("h", F.col("start") + 1, F.lit(size)).cast("array<string>")))
    return spread.select("id", "key", "start", (F.col("start") + size).alias("stop"), *two_digests(run))


def later_places(marks: DataFrame) -> DataFrame:
    """``(id, key, start, stop)``: the places of each digest after its first. ``marks`` is a written table."""
    place = F.struct(F.col("id").isNull().alias("none"), "id", "key", "start")
    first = marks.groupBy("d1", "d2").agg(F.min(place).alias("f_place"), F.count("*").alias("n")).where("n > 1")
    first = materialize(first.select("d1", "d2", "f_place"), "first_places").hint("merge")
    return marks.join(first, ["d1", "d2"]).where(~place.eqNullSafe(F.col("f_place"))).select("id", "key", "start", "stop")


def _same_prefix(a: str, b: str, reach: int) -> Column:
    """Leading elements that are equal in both arrays, at most ``reach``."""
    total, all_same = F.lit(0), F.lit(True)
    for i in range(reach):
        all_same = all_same & F.coalesce(F.get(a, F.lit(i)) == F.get(b, F.lit(i)), F.lit(False))
        total = total + all_same.cast("int")
    return total


def repeated_runs(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``(id, key, runs array<struct<start int, stop int>>)``: merged later repeated runs of each document, ``stop`` exclusive."""
    marks = materialize(fingerprints(docs, window), "fingerprints")
    place = F.struct(F.col("id").isNull().alias("none"), "id", "key", "pos")
    first = marks.groupBy("gram").agg(F.min(F.struct(place.alias("place"), "at", "before", "after")).alias("f"), F.count("*").alias("n")).where("n > 1")
    first = materialize(first.select("gram", *[F.col(f"f.{c}").alias(f"f_{c}") for c in ("place", "at", "before", "after")]), "first")
    met = marks.join(first, "gram").where(~place.eqNullSafe(F.col("f_place")) & (F.col("at") == F.col("f_at")))
    runs = met.select(
        "id",
        "key",
        (F.col("pos") - _same_prefix("before", "f_before", window - 1)).alias("start"),
        (F.col("pos") + GRAM + _same_prefix("after", "f_after", window - 1)).alias("stop"),
    )
    long = line_marks(docs).unionByName(run_marks(docs, GRAM + window - 1))
    runs = runs.unionByName(later_places(materialize(long, "long_marks")))
    by_doc = W.partitionBy("id", "key").orderBy("start")
    reached = F.max("stop").over(by_doc.rowsBetween(W.unboundedPreceding, -1))
    islands = runs.withColumn("new", (F.coalesce(reached, F.lit(-1)) < F.col("start")).cast("int")).withColumn("island", F.sum("new").over(by_doc.rowsBetween(W.unboundedPreceding, 0)))
    merged = islands.groupBy("id", "key", "island").agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
    return merged.groupBy("id", "key").agg(F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("runs"))


def kept_lines(lines: Column, runs: Column) -> Column:
    """The lines outside the runs (sorted, disjoint), in order."""
    n = F.size(runs)

    def gap(i: Column) -> Column:
        start = F.coalesce(F.get(runs, i - 1)["stop"], F.lit(0))
        stop = F.coalesce(F.get(runs, i)["start"], F.size(lines))
        return F.slice(lines, start + 1, stop - start)

    return F.flatten(F.transform(F.sequence(F.lit(0), n), gap))


@sheltered
def dedup_lines(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with ``text`` cut, plus ``__runs`` (null where nothing repeats)."""
    runs = materialize(repeated_runs(docs, window), "runs")
    # texts and runs meet in a shuffle at every size: the runs grow with the corpus
    runs = runs.select(F.col("id").alias("__id"), F.col("key").alias("__key"), F.col("runs").alias("__runs")).hint("merge")
    keyed = docs.withColumn("__text_key", text_key())
    joined = keyed.join(runs, keyed["doc_id"].eqNullSafe(runs["__id"]) & (keyed["__text_key"] == runs["__key"]), "left")
    cut = F.concat_ws("\n", kept_lines(F.split("text", "\n"), F.col("__runs")))
    return joined.withColumn("text", F.when(F.col("__runs").isNull(), F.col("text")).otherwise(cut)).select(*docs.columns, "__runs")


def removed(runs: Column) -> Column:
    return F.coalesce(F.aggregate(runs, F.lit(0), lambda a, r: a + r["stop"] - r["start"]), F.lit(0))


@sheltered
def stage(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with repeated runs of lines deleted; ``n_chars`` follows the text. No row is dropped."""
    out = dedup_lines(docs, window)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col("__runs").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(kind)))
    return out.select(*docs.columns)
