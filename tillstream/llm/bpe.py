"""BPE encoding and decoding with a contiguous rank array (operator 6).

A text is cut at the special tokens and by the tokenizer's pattern into words. A word holds its part
boundaries as a row of token ids and beside it the ranks of adjacent pairs; the smallest rank is sought,
the boundary at it deleted (the row closes up), and the ranks of its two neighbours looked up again,
until no pair has a rank. Short words run side by side, one column of a matrix each, and a worker keeps
the ids of words that it has seen, up to ``CACHE`` of them. Words over ``SHORT`` bytes merge through a heap over
linked parts, in the same order, in n log n steps.

Texts stream: words are taken about ``WORDS`` at a time, so a very long text needs little more memory than its ids.

Defined cases: a null text counts as empty and has no ids; ids outside the vocabulary do not occur;
bytes that are no UTF-8 after decoding become U+FFFD; rows that repeat an id are encoded one by one;
other columns are not read.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHORT = 64
CACHE = 200_000
WORDS = 50_000
#: Characters of a text, or ids, that are handled at a time.
PIECE = 1 << 18
NONE = np.int32(2**31 - 1)
#: Fixed value: the byte-level split pattern of the tokenizer file's pre-tokenizer.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Bpe:
    """Vocabulary and merges of one tokenizer file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, alphabet = spec["model"]["vocab"], byte_alphabet()
        specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of = [b""] * (max([*vocab.values(), *specials.values()]) + 1)
        for token, i in vocab.items():
            self.bytes_of[i] = bytes(alphabet[c] for c in token)
        for token, i in specials.items():
            self.bytes_of[i] = token.encode()
        self.sizes = np.array([len(x) for x in self.bytes_of])
        self.starts, self.letters = np.cumsum(self.sizes) - self.sizes, np.frombuffer(b"".join(self.bytes_of), "u1")
        self.special = {t: np.array([i], "<u4").tobytes() for t, i in specials.items()}
        self.cut = regex.compile("(" + "|".join(regex.escape(t) for t in sorted(specials, key=len, reverse=True)) + ")") if specials else None
        self.words = regex.compile(PATTERN)
        self.first = np.array([vocab[c] for c, _ in sorted(alphabet.items(), key=lambda x: x[1])], "int32")
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        self.a, self.b, self.made = (np.array([vocab[x] for x in side], "int32") for side in ([m[0] for m in merges], [m[1] for m in merges], [m[0] + m[1] for m in merges]))
        self.ranks = {(x, y): r for r, (x, y) in enumerate(zip(self.a.tolist(), self.b.tolist(), strict=True))}
        self._index()
        self.seen: dict[str, bytes] = dict(self.special)

    def _index(self) -> None:
        """Hash tables pair -> rank: a wide one, and a second one, free of clashes, for the pairs that clash in it."""
        rank = np.arange(len(self.a), dtype="int32")
        self.wide = np.zeros(1 << 21, "int32")
        slot = self._slot(self.a, self.b, 21, 1)
        self.wide[slot[::-1]] = rank[::-1]
        clash = rank[self.wide[slot] != rank]
        for seed in range(1, 1000):
            slot = self._slot(self.a[clash], self.b[clash], 18, seed)
            if len(np.unique(slot)) == len(clash):
                break
        else:
            raise ValueError("no hash without clashes")
        self.seed, self.narrow = seed, np.zeros(1 << 18, "int32")
        self.narrow[slot] = clash

    @staticmethod
    def _slot(a: np.ndarray, b: np.ndarray, bits: int, seed: int) -> np.ndarray:
        mixed = (a.astype("u8") * np.uint64(0x9E3779B97F4A7C15 + 2 * seed)) ^ (b.astype("u8") * np.uint64(0xC2B2AE3D27D4EB4F + 2 * seed))
        return ((mixed * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - bits)).astype("i8")

    def pair_ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        r = self.wide[self._slot(a, b, 21, 1)]
        miss = (self.a[r] != a) | (self.b[r] != b)
        x, y = a[miss], b[miss]
        s = self.narrow[self._slot(x, y, 18, self.seed)]
        r[miss] = np.where((self.a[s] == x) & (self.b[s] == y), s, NONE)
        return r

    def merge_short(self, words: list[bytes]) -> list[bytes]:
        """Ids of words of like length, packed as little-endian 32-bit integers.

        Columns are words; ``low`` packs each pair's rank with its place, so one minimum finds both, the
        leftmost on ties. A merge takes one boundary from every word still at work, so the rows shrink by one.
        """
        size = np.array([len(w) for w in words])
        width = int(size.max())
        raw = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), "u1").reshape(-1, width)
        ids, place = np.ascontiguousarray(self.first[raw].T), np.arange(width)[:, None]
        rank = np.full(ids.shape, NONE)
        inside = place[1:] < size
        rank[:-1][inside] = self.pair_ranks(ids[:-1][inside], ids[1:][inside])
        at_work, out = np.arange(len(words)), [b""] * len(words)
        while len(at_work):
            place = np.arange(len(ids))[:, None]
            low = ((rank.astype("i8") << 7) | place).min(0)
            done = low >= np.int64(NONE) << 7
            if done.any():
                for k in np.flatnonzero(done):
                    out[at_work[k]] = ids[: size[k], k].tobytes()
                live = ~done
                at_work, size, ids, rank, low = at_work[live], size[live], ids[:, live], rank[:, live], low[live]
                if not len(at_work):
                    break
            at, best, col = (low & 127).astype("i8"), low >> 7, np.arange(len(at_work))
            ids[at, col] = self.made[best]
            width = len(ids) - 1
            gone = place != at + 1  # the boundary after `at`, with the rank of the pair that began there
            ids = ids.T[gone.T].reshape(-1, width).T
            rank = rank.T[(place != at).T].reshape(-1, width).T  # places from `at` on now hold the next pair's rank
            size = size - 1
            rank = np.ascontiguousarray(rank)
            ids = np.ascontiguousarray(ids)
            has = np.flatnonzero(at + 1 < size)
            rank[at[has], has] = self.pair_ranks(ids[at[has], has], ids[at[has] + 1, has])
            last = np.flatnonzero((at + 1 >= size) & (at < width))
            rank[at[last], last] = NONE
            has = np.flatnonzero(at > 0)
            rank[at[has] - 1, has] = self.pair_ranks(ids[at[has] - 1, has], ids[at[has], has])
        return out

    def merge_long(self, word: bytes) -> bytes:
        """The same merges for one long word: parts linked both ways, candidate pairs in a heap by rank and place."""
        ids = self.first[np.frombuffer(word, "u1")].tolist()
        n = len(ids)
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(r, i, a, b) for i, (a, b) in enumerate(zip(ids, ids[1:], strict=False)) if (r := self.ranks.get((a, b))) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = right[i] if ids[i] == a else n
            if j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = int(self.made[r]), -1
            right[i] = right[j]
            if right[i] < n:
                left[right[i]] = i
            for x, y in ((left[i], i), (i, right[i])):
                if x >= 0 and y < n and (s := self.ranks.get((ids[x], ids[y]))) is not None:
                    heapq.heappush(heap, (s, x, ids[x], ids[y]))
        return np.array([x for x in ids if x >= 0], "<u4").tobytes()

    def merge(self, words: list[str]) -> dict[str, bytes]:
        """Ids of each word, those of like length side by side."""
        coded = sorted(((w, w.encode("utf-8", "surrogatepass")) for w in words), key=lambda x: len(x[1]))
        out, at = {}, 0
        for limit in (4, 6, 8, 10, 12, 16, 24, 32, SHORT):
            end = at
            while end < len(coded) and len(coded[end][1]) <= limit:
                end += 1
            for k in range(at, end, 8192):
                part = coded[k : min(k + 8192, end)]
                out.update(zip((w for w, _ in part), self.merge_short([b for _, b in part]), strict=True))
            at = end
        out.update((w, self.merge_long(b)) for w, b in coded[at:])
        return out

    def learn(self, words: set[str]) -> None:
        """Encode the words not yet held."""
        if len(self.seen) + len(words) > CACHE:
            self.seen = dict(self.special)
        self.seen.update(self.merge([w for w in words if w not in self.seen]))

    def pieces(self, text: str) -> Iterator[list[str]]:
        """Words of the text in lists; a special token is a list of its own."""
        for k, part in enumerate(self.cut.split(text) if self.cut else [text]):
            if k % 2:
                yield [part]
            elif len(part) <= PIECE:
                yield self.words.findall(part)
            else:
                found = (m.group() for m in self.words.finditer(part))
                while some := list(islice(found, WORDS)):
                    yield some

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers."""
        buffers, held, count = [bytearray() for _ in texts], [], 0
        for buffer, text in zip(buffers, texts, strict=True):
            for words in self.pieces(text):
                held.append((buffer, words))
                count += len(words)
                if count >= WORDS:
                    self._spell(held)
                    held, count = [], 0
        self._spell(held)
        return [bytes(b) for b in buffers]

    def _spell(self, held: list[tuple[bytearray, list[str]]]) -> None:
        self.learn(set().union(*(w for _, w in held)))
        for buffer, words in held:
            buffer += b"".join(map(self.seen.__getitem__, words))

    def decode(self, ids: bytes) -> str:
        found, out = np.frombuffer(ids, "<u4"), bytearray()
        for k in range(0, len(found), PIECE):
            part = found[k : k + PIECE]
            size = self.sizes[part]
            ends = np.cumsum(size)
            if len(ends):
                out += self.letters[np.repeat(self.starts[part] - ends + size, size) + np.arange(ends[-1])].tobytes()
        return out.decode("utf-8", "replace")


@lru_cache(maxsize=4)
def load(path: str) -> Bpe:
    """The tokenizer of a file, read once in each worker."""
    return Bpe(path)


def encode_and_decode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", extra: list[str] | None = None) -> DataFrame:
    """``(doc_id, text, extra columns, ids, decoded)``: ids packed as little-endian unsigned 32-bit integers, and the text they decode to.

    ``path`` names the tokenizer file on the driver and on every executor.
    """

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        bpe = load(path)
        for x in batches:
            ids = bpe.encode([t if isinstance(t, str) else "" for t in x])
            yield pd.DataFrame({"ids": ids, "decoded": [bpe.decode(i) for i in ids]})

    made = F.pandas_udf(run, "ids binary, decoded string")
    kept = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), *(extra or []))
    return kept.withColumn("__made", made(F.col("text"))).select(*kept.columns, "__made.ids", "__made.decoded")
