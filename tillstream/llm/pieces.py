"""SentencePiece encoding and decoding that keeps source offsets (operator 12).

A text is normalised by the model's compiled character map: at each place the longest key of its double-array trie that
begins there is replaced, anything else is copied, and every normalised character records the byte of the source that it
came from. Blanks become U+2581 and the dummy prefix is put in front, as the model says. The normalised text is cut wherever
no piece holds the two characters beside the cut (a merge can never cross there), and each part is merged: of all adjacent
pairs whose joint string is a piece, the best score goes first, the leftmost on ties. Equal parts are gathered first. Parts of up to ``SHORT`` characters run
side by side in numpy, longer ones through a heap; a worker keeps up to ``CACHE`` parts. Characters without a piece fall
back to byte pieces. Every piece is projected through the recorded places to its span of source bytes.

Texts are cut some ``PIECE`` characters or parts at a time, so a very long text needs little more memory than its ids and spans.

Defined cases: a null text counts as empty, and an empty text has no pieces (only the end id); bytes that are no UTF-8 after
decoding become U+FFFD one by one; rows that repeat an id are encoded one by one; other columns are not read. Models of
another kind than BPE, without byte fallback or with user-defined symbols are refused with ``ValueError``.
"""

from __future__ import annotations

import codecs
import heapq
import re
import struct
from collections.abc import Iterator
from functools import lru_cache
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHORT = 32
CACHE = 200_000
#: Characters of a normalised text that are cut into parts at a time, at least.
PIECE = 1 << 18
#: Factor of the hash of a part.
FACTOR = np.uint64(0x9E3779B97F4A7C15)
BLANK = "▁"
NONE = np.int32(2**31 - 1)
#: Piece types and the kind of model in the file format.
UNKNOWN, CONTROL, USER_DEFINED, BYTE, BPE = 2, 3, 4, 6, 2


def _fields(data: bytes) -> Iterator[tuple[int, bytes | int]]:
    """(field number, value) of a protocol-buffer message; fixed 32-bit values stay bytes."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
            continue
        size = varint() if kind == 2 else {1: 8, 5: 4}[kind]
        yield tag >> 3, data[at : at + size]
        at += size


def _message(data: bytes) -> dict[int, bytes | int]:
    return dict(_fields(data))


def distinct(code: np.ndarray, begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct parts of ``code`` as one place among the parts each, and the number of its distinct part for every part.

    Parts are gathered by a 64-bit hash and then compared with their first one, character by character.
    """
    place = np.arange(len(code)) - np.repeat(begin, size)
    power = np.cumprod(np.full(int(size.max()), FACTOR))
    key = np.add.reduceat((code.astype("uint64") + np.uint64(1)) * power[place], begin)
    _, first, same = np.unique(key, return_index=True, return_inverse=True)
    model = first[same]
    if (size[model] == size).all() and (code[np.repeat(begin[model], size) + place] == code).all():
        return first, same
    seen: dict[bytes, int] = {}
    same = np.array([seen.setdefault(code[b : b + n].tobytes(), len(seen)) for b, n in zip(begin.tolist(), size.tolist(), strict=True)])
    return np.unique(same, return_index=True)[1], same


class CharMap:
    """The compiled character map: a double-array trie over UTF-8 bytes, and the replacements it points at."""

    def __init__(self, blob: bytes) -> None:
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist() if blob else []
        self.made = blob[4 + size :] if blob else b""
        firsts = sorted({k.decode("utf-8", "ignore")[:1] for k in self._heads()} - {""}) if blob else []
        self.starts = re.compile("[" + "".join(map(re.escape, firsts)) + "]") if firsts else None

    @staticmethod
    def _offset(unit: int) -> int:
        return (unit >> 10) << ((unit & 512) >> 6)

    def _child(self, node: int, byte: int) -> int:
        """The node under ``node`` by ``byte`` (its offset applied), or -1; a key that ends there shows in ``units``."""
        at = node ^ byte
        if at >= len(self.units) or self.units[at] & 0x800000FF != byte:
            return -1
        return at

    def _heads(self) -> Iterator[bytes]:
        """Bytes of the first characters of the keys (one character each, or less where a key is shorter)."""
        root = self._offset(self.units[0])
        todo = [(root, b"", 0)]
        while todo:
            node, key, left = todo.pop()
            if key and not left:
                yield key
                continue
            for byte in range(1, 256) if not key else range(0x80, 0xC0):
                if (at := self._child(node, byte)) >= 0:
                    more = left - 1 if key else (byte >= 0xC0) + (byte >= 0xE0) + (byte >= 0xF0)
                    todo.append((at ^ self._offset(self.units[at]), key + bytes([byte]), more))

    def longest(self, text: bytes) -> tuple[int, str] | None:
        """Length in bytes of the longest key that ``text`` begins with, and its replacement."""
        node, found = self._offset(self.units[0]), None
        for k, byte in enumerate(text):
            if (at := self._child(node, byte)) < 0:
                break
            unit = self.units[at]
            node = at ^ self._offset(unit)
            if unit >> 8 & 1:
                found = k + 1, self.units[node] & 0x7FFFFFFF
        if not found:
            return None
        return found[0], self.made[found[1] : self.made.index(b"\0", found[1])].decode("utf-8")


class Pieces:
    """Vocabulary, scores and normaliser of one model."""

    def __init__(self, model: bytes) -> None:
        pieces, trainer, rules = [], {}, {}
        for field, value in _fields(model):
            if field == 1:
                pieces.append(_message(value))
            elif field == 2:
                trainer = _message(value)
            elif field == 3:
                rules = _message(value)
        names = [p[1].decode("utf-8") for p in pieces]
        score = [struct.unpack("<f", p[2])[0] if 2 in p else 0.0 for p in pieces]
        kind = np.array([p.get(3, 1) for p in pieces])
        if trainer.get(3, 1) != BPE or not trainer.get(35, 0) or (kind == USER_DEFINED).any():
            raise ValueError("only BPE models with byte fallback and without user-defined symbols are supported")
        self.end_id = trainer.get(42, 2)
        self.suffix, self.prefix, self.squeeze, self.escape = bool(trainer.get(24, 0)), bool(rules.get(3, 1)), bool(rules.get(4, 1)), bool(rules.get(5, 1))
        self.map = CharMap(rules.get(2, b""))
        self._index(names, score, kind)
        unknown = trainer.get(44, " ⁇ ".encode())
        self._letters(names, kind, unknown)
        self.seen: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    # ---- tables

    def _index(self, names: list[str], score: list[float], kind: np.ndarray) -> None:
        normal = {n: i for i, n in enumerate(names) if kind[i] not in (UNKNOWN, CONTROL, BYTE)}
        self.byte_id = np.zeros(256, "int32")
        for i in np.flatnonzero(kind == BYTE):
            self.byte_id[int(names[i][3:5], 16)] = i
        letters = sorted({c for n in normal for c in n})
        #: symbol of every character that occurs in a piece: its id, or a number beyond the vocabulary
        self.symbol = {c: normal.get(c, len(names) + k) for k, c in enumerate(letters)}
        known = normal | {c: s for c, s in self.symbol.items() if c not in normal}
        order = {s: r for r, s in enumerate(sorted({score[i] for i in normal.values()}, reverse=True))}
        pairs = [(known[n[:k]], known[n[k:]], order[score[i]], i) for n, i in normal.items() for k in range(1, len(n)) if n[:k] in known and n[k:] in known]
        self.merges = {(a, b): (r, i) for a, b, r, i in pairs}
        a, b, rank, made = (np.array(x, "int64") for x in zip(*pairs, strict=True)) if pairs else (np.zeros(0, "int64"),) * 4
        at = np.argsort(a << 32 | b)
        self.keys, self.rank, self.made = (a << 32 | b)[at], np.append(rank[at], NONE).astype("int32"), np.append(made[at], 0).astype("<i4")
        # characters as small classes (0: in no piece), and which two may stand beside each other inside a piece
        self.classes = np.zeros(0x110000, "int32")
        self.classes[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        inner = np.array(sorted({(ord(n[k]) << 32) | ord(n[k + 1]) for n in normal for k in range(len(n) - 1)}), "int64")
        n = len(letters) + 1
        self.beside = np.zeros((n, n), bool)
        self.beside[self.classes[inner >> 32], self.classes[inner & 0xFFFFFFFF]] = True
        self.class_symbol = np.append(-1, [self.symbol[c] for c in letters]).astype("<i4")

    def _letters(self, names: list[str], kind: np.ndarray, unknown: bytes) -> None:
        spelt = []
        for i, n in enumerate(names):
            if kind[i] == CONTROL:
                spelt.append(b"")
            elif kind[i] == UNKNOWN:
                spelt.append(unknown)
            else:
                spelt.append(bytes([int(n[3:5], 16)]) if kind[i] == BYTE else n.replace(BLANK, " ").encode())
        self.sizes = np.array([len(x) for x in spelt])
        self.begins, self.spelt = np.cumsum(self.sizes) - self.sizes, np.frombuffer(b"".join(spelt), "u1")
        self.chars = np.where(kind == BYTE, 0, [len(n) for n in names])  # normalised characters of a piece
        self.control, self.blank_first = kind == CONTROL, np.array([n.startswith(BLANK) for n in names]) & (kind != BYTE)
        value = np.full(len(names), -1)
        value[self.byte_id] = np.arange(256)
        self.is_byte, self.tail = kind == BYTE, (value >= 0x80) & (value < 0xC0)

    # ---- normalising

    def normalise(self, text: str) -> tuple[str, np.ndarray]:
        """The normalised text, and for each of its characters (and its end) the byte of ``text`` where its source begins."""
        if not text:
            return "", np.zeros(1, "int64")
        out, src, lead = self._replaced(text)
        if self.squeeze:
            blank = np.frombuffer(out.encode("utf-32-le", "surrogatepass"), "<u4") == 32
            before = np.append(True, blank[:-1])
            kept = ~(lead[0] & before[lead[1]])
            if not kept.any():
                return "", np.zeros(1, "int64")
            first = src[int(kept.argmax())]
            out, src = "".join(compress(out, kept)), np.append(src[:-1][kept], src[-1])
        else:
            first = 0
        if self.escape:
            out = out.replace(" ", BLANK)
        mark = BLANK if self.escape else " "
        if self.prefix and not self.suffix:
            out, src = mark + out, np.append(first, src)
        if self.squeeze:
            size = len(out.rstrip(mark))
            out, src = out[:size], src[: size + 1]
        if self.prefix and self.suffix:
            out, src = out + mark, np.append(src, src[-1])
        return out, src

    def _replaced(self, text: str) -> tuple[str, np.ndarray, tuple[np.ndarray, np.ndarray] | None]:
        """The text after the map, its source bytes, and (where blanks are squeezed) which characters are blanks at the head
        of what one place gave, and where that begins."""
        code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
        at = np.append(0, np.cumsum(1 + (code > 0x7F) + (code > 0x7FF) + (code > 0xFFFF)))  # byte of each character
        if not self.map.starts:
            lead = (code == 32, np.arange(len(code))) if self.squeeze else None
            return text, at, lead
        out, src, heads, begins, done, held = [], [], [], [], 0, 0

        def copy(end: int) -> None:
            nonlocal held
            if end > done:
                out.append(text[done:end])
                src.append(at[done:end])
                heads.append(code[done:end] == 32)
                begins.append(np.arange(held, held + end - done))
                held += end - done

        raw = text.encode("utf-8", "surrogatepass")
        for m in self.map.starts.finditer(text):
            if m.start() < done or not (found := self.map.longest(raw[at[m.start()] : at[m.start()] + 64])):
                continue
            copy(m.start())
            size, made = found
            out.append(made)
            src.append(np.full(len(made), at[m.start()]))
            heads.append(np.arange(len(made)) < len(made) - len(made.lstrip(" ")))
            begins.append(np.full(len(made), held))
            held += len(made)
            done = int(np.searchsorted(at, at[m.start()] + size))
        copy(len(text))
        return "".join(out), np.append(np.concatenate(src), at[-1]), (np.concatenate(heads), np.concatenate(begins))

    # ---- merging

    def _pairs(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Places of the pairs in the merge tables (the last place: no piece)."""
        key = a.astype("int64") << 32 | b
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == key, at, len(self.keys)) if len(self.keys) else np.zeros(len(key), "int64")

    def _merge_short(self, parts: list[str]) -> list[bytes]:
        """Ids of parts of like length, packed as little-endian 32-bit integers; rows are parts."""
        size = np.array([len(p) for p in parts])
        width = int(size.max())
        code = np.zeros((len(parts), width), "int64")
        place = np.arange(width)
        code[place < size[:, None]] = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), "<u4")
        ids = self.class_symbol[self.classes[code]]  # -1: in no piece, left as it is
        rank = np.full(ids.shape, NONE)
        inside = place[1:] < size[:, None]
        rank[:, :-1][inside] = self.rank[self._pairs(ids[:, :-1][inside], ids[:, 1:][inside])]
        work, out = np.arange(len(parts)), [None] * len(parts)
        while len(work):
            row = np.arange(len(work))
            at = rank.argmin(1)
            done = rank[row, at] == NONE
            if done.any():
                plain = ((ids >= 0) & (ids < len(self.sizes)) | (np.arange(ids.shape[1]) >= size[:, None])).all(1)
                for k in np.flatnonzero(done):
                    found = ids[k, : size[k]]
                    out[work[k]] = found.tobytes() if plain[k] else self._spell(parts[work[k]], found)
                live = ~done
                work, ids, rank, size, at = work[live], ids[live], rank[live], size[live], at[live]
                if not len(work):
                    break
                row = np.arange(len(work))
            ids[row, at] = self.made[self._pairs(ids[row, at], ids[row, at + 1])]
            width = ids.shape[1] - 1
            place = np.arange(width + 1)
            ids = ids[place != at[:, None] + 1].reshape(-1, width)
            rank = rank[place != at[:, None]].reshape(-1, width)
            size = size - 1
            right = np.flatnonzero(at + 1 < size)
            rank[right, at[right]] = self.rank[self._pairs(ids[right, at[right]], ids[right, at[right] + 1])]
            last = np.flatnonzero((at + 1 >= size) & (at < width))
            rank[last, at[last]] = NONE
            left = np.flatnonzero(at > 0)
            rank[left, at[left] - 1] = self.rank[self._pairs(ids[left, at[left] - 1], ids[left, at[left]])]
        return out

    def _merge_long(self, part: str) -> np.ndarray:
        """The same merges for one long part: symbols linked both ways, pairs in a heap by score and place."""
        ids = [self.symbol.get(c, -1) for c in part]
        n = len(ids)
        left, right, gone = list(range(-1, n - 1)), list(range(1, n + 1)), [False] * n
        heap = [(m[0], k, a, b) for k, (a, b) in enumerate(zip(ids, ids[1:], strict=False)) if (m := self.merges.get((a, b)))]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = right[i]
            if gone[i] or j >= n or ids[i] != a or ids[j] != b:
                continue
            ids[i], gone[j] = self.merges[a, b][1], True
            right[i] = right[j]
            if right[i] < n:
                left[right[i]] = i
            for x, y in ((left[i], i), (i, right[i])):
                if x >= 0 and y < n and (m := self.merges.get((ids[x], ids[y]))):
                    heapq.heappush(heap, (m[0], x, ids[x], ids[y]))
        return np.array([s for s, dead in zip(ids, gone, strict=True) if not dead])

    def _spell(self, part: str, symbols: np.ndarray) -> bytes:
        """Ids of a part whose merged symbols are given: characters without a piece become byte pieces."""
        out, at = [], 0
        for s in symbols.tolist():
            if 0 <= s < len(self.sizes):
                out.append(s)
                at += int(self.chars[s])
            else:
                out.extend(self.byte_id[list(part[at].encode("utf-8", "surrogatepass"))].tolist())
                at += 1
        return np.array(out, "<u4").tobytes()

    def learn(self, parts: set[str]) -> None:
        """Encode the parts not yet held. When half the cache is full it becomes the older half: what is met again moves on,
        the rest is dropped with it."""
        new = [p for p in parts if p not in self.seen]
        if 2 * (len(self.seen) + len(new)) > CACHE:
            self.older, self.seen = self.seen, {p: self.seen[p] for p in parts if p in self.seen}
        if self.older:
            self.seen.update((p, self.older[p]) for p in new if p in self.older)
            new = [p for p in new if p not in self.seen]
        new.sort(key=len)
        at = 0
        for limit in (1, 3, 5, 7, 9, 11, 14, 18, 24, SHORT):
            end = at
            while end < len(new) and len(new[end]) <= limit:
                end += 1
            for k in range(at, end, 8192):
                some = new[k : min(k + 8192, end)]
                self.seen.update(zip(some, self._merge_short(some), strict=True))
            at = end
        for p in new[at:]:
            self.seen[p] = self._spell(p, self._merge_long(p))

    def parts(self, norm: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The characters of a normalised text, some ``PIECE`` at a time, and where in them the parts begin that no merge can leave."""
        code, held = np.frombuffer(norm.encode("utf-32-le", "surrogatepass"), "<u4"), np.zeros(0, "<u4")
        for k in range(0, len(code), PIECE):
            held = np.concatenate([held, code[k : k + PIECE]])
            kind = self.classes[held]
            cut = np.append(0, np.flatnonzero(~self.beside[kind[:-1], kind[1:]]) + 1)
            if k + PIECE >= len(code):
                yield held, cut
            elif len(cut) > 1:
                yield held[: cut[-1]], cut[:-1]
                held = held[cut[-1] :]

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of each text (no end id), and the source bytes [begin, end) of each id as rows."""
        out, held, count = [], [], 0
        for text in texts:
            norm, src = self.normalise(text)
            out.append(([np.zeros(0, "<u4")], src))
            for code, cut in self.parts(norm):
                held.append((out[-1][0], code, cut))
                count += len(code)
                if count >= 4 * PIECE:
                    self._append(held)
                    held, count = [], 0
        if held:
            self._append(held)
        found = [(np.concatenate(ids).astype("int64"), src) for ids, src in out]
        return [(ids, self._spans(ids, src)) for ids, src in found]

    def _append(self, held: list[tuple[list[np.ndarray], np.ndarray, np.ndarray]]) -> None:
        """Put the ids of each text's parts into its list; a part that occurs several times here is looked up once."""
        code = np.concatenate([c for _, c, _ in held])
        base = np.cumsum([0, *(len(c) for _, c, _ in held)])
        begin = np.concatenate([cut + b for (_, _, cut), b in zip(held, base.tolist(), strict=False)])
        size = np.diff(np.append(begin, len(code)))
        first, same = distinct(code, begin, size)
        text = code.tobytes().decode("utf-32-le", "surrogatepass")
        parts = [text[b : b + n] for b, n in zip(begin[first].tolist(), size[first].tolist(), strict=True)]
        self.learn(set(parts))
        made = [self.seen[p] for p in parts]
        n = np.fromiter(map(len, made), "int64", len(made)) // 4
        at, many = (np.cumsum(n) - n)[same], n[same]
        ends = np.cumsum(many)
        ids = np.frombuffer(b"".join(made), "<u4")[np.repeat(at - ends + many, many) + np.arange(ends[-1])]
        stops = ends[np.cumsum([len(cut) for _, _, cut in held]) - 1].tolist()
        for (out, _, _), a, b in zip(held, [0, *stops], stops, strict=False):
            out.append(ids[a:b])

    def _spans(self, ids: np.ndarray, src: np.ndarray) -> np.ndarray:
        """Source spans: a byte piece has its character's span when it is the last of it, and an empty span before that."""
        size = self.chars[ids]
        byte = self.is_byte[ids]
        if byte.any():
            size = np.where(byte & ~np.append((byte & self.tail[ids])[1:], False), 1, size)
        end = np.cumsum(size)
        return np.stack([src[end - size], src[end]], 1)

    # ---- decoding

    def decode(self, found: np.ndarray) -> str:
        """The text of ids. Control pieces spell nothing, and end a run of byte pieces."""
        out, head = [], self.prefix or self.squeeze
        edges = [0, *(np.flatnonzero(self.control[found]) + 1).tolist(), len(found)]
        for a, b in zip(edges, edges[1:], strict=False):
            spelt = bytearray()
            for k in range(a, b, PIECE):
                part = found[k : min(k + PIECE, b)]
                size, begin = self.sizes[part], self.begins[part]
                if head and not self.control[part[0]]:  # the first piece that is no control piece loses the blank in front
                    head, blank = False, int(self.blank_first[part[0]])
                    size[0], begin[0] = size[0] - blank, begin[0] + blank
                ends = np.cumsum(size)
                spelt += self.spelt[np.repeat(begin - ends + size, size) + np.arange(ends[-1])].tobytes()
            out.append(spelt.decode("utf-8", "one-by-one"))
        return "".join(out)


codecs.register_error("one-by-one", lambda e: ("�", e.start + 1))


@lru_cache(maxsize=4)
def load(path: str) -> Pieces:
    """The model of a file, read once in each worker."""
    with open(path, "rb") as f:
        return Pieces(f.read())


def encode_and_decode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, text, ids, begins, ends, decoded)``: the ids with the end id at last, the source bytes [begin, end) of each
    (the end id has the empty span behind the text), and the decoded text.

    ``path`` names the model file on the driver and on every executor.
    """

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = load(path)
        for x in batches:
            texts = [t or "" for t in x.to_pylist()]
            made = model.encode(texts)
            stops = np.cumsum([0, *(len(i) + 1 for i, _ in made)], dtype="int32")
            ids = np.full(stops[-1], model.end_id, "int32")
            spans = np.empty((stops[-1], 2), "int32")
            for a, b, (i, s), t in zip(stops.tolist(), stops[1:].tolist(), made, texts, strict=False):
                ids[a : b - 1], spans[a : b - 1], spans[b - 1] = i, s, len(t.encode("utf-8", "surrogatepass"))
            lists = [pa.ListArray.from_arrays(stops, np.ascontiguousarray(v)) for v in (ids, spans[:, 0], spans[:, 1])]
            yield pa.StructArray.from_arrays([*lists, pa.array([model.decode(i) for i, _ in made], pa.string())], ["ids", "begins", "ends", "decoded"])

    made = F.arrow_udf(run, "ids array<int>, begins array<int>, ends array<int>, decoded string")
    kept = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return kept.withColumn("__made", made(F.col("text"))).select("doc_id", "text", "__made.ids", "__made.begins", "__made.ends", "__made.decoded")
