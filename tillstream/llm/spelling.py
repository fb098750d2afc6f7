"""Spelling variants of a corpus vocabulary by edit rows over its sorted list (operator 11).

``words`` counts the vocabulary. ``near_words`` finds all words at one inserted, deleted or replaced code point. Every word
meets candidates in lists of words that agree outside one stretch: if two words are one edit apart, either the first half
of the shorter one is untouched or the rest is, so lists are keyed by length and by the first half, and, spelt backwards, by
the second half. A list with more than ``LIST`` words is cut again by halves of the stretch in which its words may still differ,
until that is one code point long; no list is then longer than the alphabet allows, whatever the corpus holds, and no
pair is lost. Each list is sorted, and searched like this: the words below one shared prefix are one range of the sorted
list, given by the common prefixes of adjacent words. A query's banded edit-matrix row is computed once for a range,
handed on to the ranges one code point deeper, and a range whose row exceeds one edit everywhere is skipped with all
its words. All queries of all lists in a batch step down together.

``variants`` adds each word's form (its most frequent near word, where that is ``FACTOR`` times as frequent) and root (the last form along
the chain; forms grow in frequency, so a chain ends).

Defined cases: a null text has no words; a null id hashes as an empty one; an empty table gives no rows; rows that repeat an id
or a text count each; other columns are not read. Words hold letters up to U+00FF only, whatever their length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

LEAST = 7
FACTOR = 10
#: Words of a list above which it is cut into finer lists.
LIST = 2000
#: Cells (words times length) that are searched at a time.
CELLS = 4_000_000
LETTERS = "[A-Za-zÀ-ÿ]"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
PAIR = "word string, near string, near_n long"


def words(docs: DataFrame, damage: int = 31, least: int = LEAST, times: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(word, n)``: lower-cased runs of letters of at least ``least`` code points that occur ``times`` times or more.

    A run whose CRC-32 with the document's id is divisible by ``damage`` loses one code point first (0: none does).
    """
    runs = F.regexp_extract_all(F.col(text_col), F.lit(f"({LETTERS}{{{least},}})"), F.lit(1))
    found = docs.select(F.col(id_col).cast("string").alias("id"), F.explode(runs).alias("run")).withColumn("run", F.translate("run", UPPER, UPPER.lower()))
    word = F.col("run")
    if damage:
        h = F.crc32(F.concat(F.coalesce("id", F.lit("")), F.lit(":"), "run").cast("binary"))
        at = (h % F.length("run")).cast("int")
        word = F.when(h % damage == 0, F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))).otherwise(word)
    return found.select(word.alias("word")).where(F.length("word") >= least).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= times)


# ---- lists


def _member(base: Column, backward: bool, long: bool) -> Column:
    """One word in one list: ``lo`` to ``hi`` is the stretch where words of the list may differ, in the word as the list spells it
    (from its end, if ``backward``); one code point more for a ``long`` word, which has one letter over the list's length."""
    size = F.length("word") - int(long)
    half = F.floor(size / 2).cast("int")
    spelt = F.reverse("word") if backward else F.col("word")
    fixed = F.substring(spelt, F.lit(1), size - half) if backward else F.substring(spelt, F.lit(1), half)
    kept = (size - half) if backward else half
    return F.struct(
        size.alias("size"), F.lit(backward).alias("backward"), F.lit(long).alias("long"), F.xxhash64(size, F.lit(backward), fixed).alias("key"),
        spelt.alias("spelt"), kept.alias("lo"), size.alias("hi"), base.alias("n"),
    )


def lists(vocabulary: DataFrame) -> DataFrame:
    """Every word as a member of its lists: those of its own length, and those of the length below, where it is the long one."""
    made = F.array(*[_member(F.col("n"), b, long) for long in (False, True) for b in (False, True)])
    return vocabulary.select(F.explode(made).alias("m")).select("m.*").where(F.col("size") > 0)


def _finer(members: DataFrame) -> DataFrame:
    """The members of lists that are too long, by halves of the stretch where they may differ."""
    left = F.col("hi") - F.col("lo")
    mid = F.floor(left / 2).cast("int")
    more = F.col("long").cast("int")

    def child(tail: bool) -> Column:
        # the first `mid` code points of the stretch are equal, or its last ones
        same = F.substring("spelt", F.col("lo") + 1 + mid + more, left - mid) if tail else F.substring("spelt", F.col("lo") + 1, mid)
        lo, hi = (F.col("lo"), F.col("lo") + mid) if tail else (F.col("lo") + mid, F.col("hi"))
        return F.struct("size", "backward", "long", F.xxhash64("key", F.lit(tail), "lo", "hi", same).alias("key"), "spelt", lo.alias("lo"), hi.alias("hi"), "n")

    return members.select(F.explode(F.array(child(False), child(True))).alias("m")).select("m.*")


def bounded_lists(vocabulary: DataFrame, most: int = LIST) -> DataFrame:
    """The members of all lists, after every list of over ``most`` words has been cut as far as it can be."""
    members, done = materialize(lists(vocabulary), "lists"), []
    while True:
        big = members.where("hi - lo > 1").groupBy("size", "backward", "key").agg(F.count("*").alias("__k")).where(F.col("__k") > most).drop("__k")
        big = materialize(big, "big")
        if not big.take(1):
            break
        done.append(members.join(big, ["size", "backward", "key"], "left_anti"))
        members = materialize(_finer(members.join(big, ["size", "backward", "key"], "left_semi")), "finer")
    out = members
    for part in done:
        out = out.unionByName(part)
    return out


# ---- search


def _codes(spelt: list[str], width: int) -> np.ndarray:
    """Words as rows of bytes (their code points are under 256), padded with 0."""
    return np.frombuffer(b"".join(w.encode("latin-1").ljust(width, b"\0") for w in spelt), "u1").reshape(-1, width)


def _prefixes(code: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Common prefix of each row with the row above; -1 where a list begins."""
    differ = code[1:] != code[:-1]
    lcp = np.where(differ.any(1), differ.argmax(1), code.shape[1])
    return np.append(-1, np.where(group[1:] != group[:-1], -1, lcp))


def search(code: np.ndarray, size: np.ndarray, group: np.ndarray, query: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query row, row) of one list that are exactly one edit apart.

    ``code`` holds sorted words of some lists, list after list; ``query`` names the rows that ask. Rows of the edit matrix are
    banded: three cells, for one code point less than read, as many, and one more.
    """
    lcp = _prefixes(code, group)
    n = len(code)
    padded = np.pad(code, ((0, 0), (1, 3)))  # 0, before and behind a word, is no letter
    start = np.flatnonzero(lcp < 0)
    ends = np.append(start[1:], n)
    ask = query
    node = np.searchsorted(start, ask, "right") - 1
    row = np.stack([np.full(len(ask), 9), np.zeros(len(ask)), np.ones(len(ask))], 1).astype("i1")
    begin, depth, asked, found = start, 0, [], []
    while len(ask):
        # ranges one code point deeper: they begin wherever adjacent words share at most `depth` code points
        deeper = np.flatnonzero(lcp <= depth)
        first = np.searchsorted(deeper, begin)
        children = np.searchsorted(deeper, ends) - first
        count = children[node]
        total = int(count.sum())
        child = np.repeat(first[node] - np.cumsum(count) + count, count) + np.arange(total)
        ask, row = np.repeat(ask, count), np.repeat(row, count, 0)
        letter = padded[deeper[child], depth + 1]
        ended = letter == 0
        if ended.any():  # the word of this range ends here: its distance stands in the cell of the query's length
            off = size[ask[ended]] - depth
            good = (off >= -1) & (off <= 1)
            at = row[ended][np.arange(len(off)), np.clip(off, -1, 1) + 1]
            good &= at == 1
            asked.append(ask[ended][good])
            found.append(deeper[child[ended]][good])
        ask, row, child, letter = ask[~ended], row[~ended], child[~ended], letter[~ended]
        near = [(padded[ask, depth + k] != letter).astype("i1") for k in range(3)]
        a = np.minimum(row[:, 0] + near[0], row[:, 1] + 1)
        b = np.minimum(np.minimum(row[:, 1] + near[1], row[:, 2] + 1), a + 1)
        c = np.minimum(row[:, 2] + near[2], b + 1)
        live = np.minimum(np.minimum(a, b), c) <= 1
        ask, row, node = ask[live], np.stack([a, b, c], 1)[live], child[live]
        begin, ends, depth = deeper, np.append(deeper[1:], n), depth + 1
    return (np.concatenate(asked), np.concatenate(found)) if asked else (np.zeros(0, "int64"), np.zeros(0, "int64"))


def _search_lists(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Near pairs of the lists in a sorted partition; a list that a batch cuts is held until it is whole."""
    held = None
    for x in batches:
        x = x if held is None else pd.concat([held, x], ignore_index=True)
        key = x[["size", "backward", "key"]]
        last = (key == key.iloc[-1]).all(1).to_numpy()
        cut = int(last.argmax())  # rows of one list are adjacent
        held = x[cut:]
        yield from _in_blocks(x[:cut])
    if held is not None:
        yield from _in_blocks(held)


def _in_blocks(x: pd.DataFrame) -> Iterator[pd.DataFrame]:
    if not len(x):
        return
    new = np.append(True, np.any([x[c].to_numpy()[1:] != x[c].to_numpy()[:-1] for c in ("size", "backward", "key")], 0))
    group = np.cumsum(new) - 1
    many = np.bincount(group)[group] > 1  # a word alone in its list is near nothing there
    x, group = x[many], group[many]
    edges = np.append(np.flatnonzero(np.diff(group, prepend=-1)), len(x))
    lengths = x["size"].to_numpy()[edges[:-1]]
    at = 0
    while at < len(lengths):
        length = int(lengths[at])
        end = int(np.searchsorted(edges, edges[at] + CELLS // (length + 4), "right")) - 1
        end = max(at + 1, min(end, int(np.searchsorted(lengths, length, "right"))))
        found = _pairs(x[edges[at] : edges[end]], group[edges[at] : edges[end]], length)
        if len(found):
            yield found
        at = end


def _pairs(part: pd.DataFrame, group: np.ndarray, length: int) -> pd.DataFrame:
    """Both directions of every near pair of some whole lists of one length."""
    spelt = part["spelt"].tolist()
    code = _codes(spelt, length + 1)
    long = part["long"].to_numpy(dtype=bool)
    ask, near = search(code, length + long, group, np.flatnonzero(~long))
    n, backward = part["n"].to_numpy(), part["backward"].to_numpy(dtype=bool)
    word = np.array([w[::-1] if b else w for w, b in zip(spelt, backward, strict=True)], object)
    over = long[near]  # two words of equal length both ask; a long word does not
    a, b = np.concatenate([ask, near[over]]), np.concatenate([near, ask[over]])
    return pd.DataFrame({"word": word[a], "near": word[b], "near_n": n[b]})


def near_words(vocabulary: DataFrame, most: int = LIST) -> DataFrame:
    """``(word, near, near_n)``: every ordered pair of words exactly one edit apart, once. ``vocabulary`` is ``(word, n)``, its words distinct."""
    members = bounded_lists(vocabulary, most).repartition("size", "backward", "key").sortWithinPartitions("size", "backward", "key", "spelt")
    pairs = members.mapInPandas(_search_lists, PAIR)
    return pairs.repartition("word").groupBy("word", "near").agg(F.max("near_n").alias("near_n"))  # a pair can meet in two lists


def variants(vocabulary: DataFrame, factor: int = FACTOR, most: int = LIST) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` of every word of ``vocabulary (word, n)``."""
    vocabulary = materialize(vocabulary, "words")
    first = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near")))
    best = near_words(vocabulary, most).groupBy("word").agg(F.count("*").alias("n_near"), first.alias("first"))
    best = best.select("word", "n_near", F.col("first.near").alias("form"), (-F.col("first.less")).alias("form_n"))
    good = F.col("form_n") >= F.col("n") * factor
    out = vocabulary.join(best, "word", "left").select(
        "word", F.when(good, F.col("form")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(good, F.col("form_n")).alias("form_n")
    )
    out = materialize(out, "forms")
    roots = _roots(out.where("form IS NOT NULL").select("word", F.col("form").alias("root")))
    return out.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def _roots(links: DataFrame) -> DataFrame:
    """``(word, root)``: where following ``links`` ends. Each round doubles the steps taken."""
    links = materialize(links, "roots")
    while True:
        on = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = materialize(links.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        links = step.select("word", "root")
        if not step.where("moved").take(1):
            return links
