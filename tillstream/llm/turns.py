"""Repair of the role structure of conversations by a weighted generalised LR parse (operator 13).

The grammar of a conversation is ``S -> e | s P | P; P -> u a | P u a`` over role initials. Its parse stacks are told apart by
their top alone, so a graph-structured stack has one node per top (``SHIFT`` is the table of shifts, with the reductions done);
at every row each top is extended by the actions keep, rerole, delete and insert, and equal tops are merged by the
smallest (cost, audit). An audit is one letter per action; all audits at a row have used the same rows and end with a row's
action, so none begins another one, and the smaller one stays the smaller whatever follows.

A conversation may be of any length: rows are sorted over the whole table into ranges and numbered; blocks of ``BLOCK``
neighbouring rows are parsed apart, from every top that the block may begin with, and one small row per block and
conversation (costs and audits from top to top) is folded in order. A hot conversation is thus parsed by many tasks;
what meets in one place is its audit, which is a value of the result, and its digest's running state.

Order of a conversation's rows: by turn (null first), then role and the text's MD5. A role or text that is null is one space.
A conversation whose rows are all dropped still has its row of zeros; rows without a conversation id are one conversation;
repeated rows are duplicates; texts of any length are hashed piece by piece; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from .common import materialize

#: Rows that are numbered alike up to 2 ** BLOCK_BITS are parsed by one task.
BLOCK_BITS = 12
#: Bytes of repaired text that are handed on in one row, at most (but for a single longer line).
LINES = 1 << 20
SPACE = " \t\n\x0b\x0c\r"
NAMES = {"u": "user", "a": "assistant"}
#: top -> role initial -> top; tops are the empty stack, s, an open pair, a closed pair
SHIFT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
ACCEPT = (0, 3)
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
FINE, BLANK, DUPLICATE, CUT = 0, 1, 2, 3
COUNTS = ("blank", "duplicate", "truncated", "illegal")

Stack = dict[int, tuple[int, str]]


# ---- rows


def damaged(conversations: DataFrame) -> DataFrame:
    """``(conv_id, turn, role, text, gone)``: every row after the damage that its CRC-32 says; a dropped row is kept as ``gone``, without text."""

    def shown(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    code = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % 20
    text = F.when(code.isin(0, 1), "").when(code == 2, F.translate(shown("text"), ".!?", "")).otherwise(shown("text"))
    rows = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), F.when(code == 4, "user").otherwise(shown("role")).alias("role"), text.alias("text"), code.alias("code"))
    times = F.when(F.col("code") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.withColumn("copy", F.explode(times)).select("conv_id", "turn", "role", "text", (F.col("code") == 0).alias("gone"))


def numbered(rows: DataFrame) -> DataFrame:
    """The rows with ``pos``, a number that grows along each conversation, and what the parse asks of a text."""
    end = F.rtrim(F.col("text"), F.lit(SPACE))
    rows = rows.select(
        "*", F.md5("text").alias("digest"), F.monotonically_increasing_id().alias("salt"),
        F.when(end == "", BLANK).when(~F.substring(end, -1, 1).isin(".", "!", "?"), CUT).otherwise(FINE).alias("fault"),
    )
    order = [F.asc_nulls_first(c) for c in ("conv_id", "turn", "role", "digest", "salt")]  # the salt parts rows that are alike
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("salt")
    return materialize(ranged.withColumn("pos", F.monotonically_increasing_id()), "rows")


def with_faults(rows: DataFrame) -> DataFrame:
    """Numbered rows without texts: a row that is not the first of its role and text in the conversation is a duplicate."""
    firsts = rows.where(f"NOT gone AND fault <> {BLANK}").groupBy("conv_id", "role", "digest").agg(F.min("pos").alias("pos")).select("pos", F.lit(True).alias("first"))
    fault = F.when(F.col("fault") == BLANK, BLANK).when(F.col("first").isNull(), DUPLICATE).otherwise(F.col("fault"))
    small = rows.select("pos", "conv_id", "turn", F.substring("role", 1, 1).alias("initial"), "gone", "fault").join(firsts, "pos", "left")
    return small.select("pos", "conv_id", "turn", "initial", "gone", fault.alias("fault"))


def _block(pos: str = "pos") -> Column:
    return F.shiftright(F.col(pos), BLOCK_BITS).alias("block")


# ---- parse


def _merge(into: Stack, top: int, cost: int, audit: str) -> None:
    held = into.get(top)
    if held is None or (cost, audit) < held:
        into[top] = (cost, audit)


def insert(stack: Stack) -> Stack:
    """The stack with rows put in for nothing: every top reachable by inserts."""
    out, new = dict(stack), dict(stack)
    while new:
        made: Stack = {}
        for top, (cost, audit) in new.items():
            for x, to in SHIFT[top].items():
                if x in NAMES:
                    _merge(made, to, cost + INSERT, audit + "I")
        new = {t: v for t, v in made.items() if t not in out or v < out[t]}
        out.update(new)
    return out


def step(stack: Stack, initial: str, fault: int) -> Stack:
    """The stack after one more row."""
    out: Stack = {}
    extra = TRUNCATED if fault == CUT else 0
    for top, (cost, audit) in insert(stack).items():
        _merge(out, top, cost + DELETE, audit + "D")
        if fault in (BLANK, DUPLICATE):
            continue
        for x, to in SHIFT[top].items():
            if x == initial:
                _merge(out, to, cost + KEEP + extra, audit + "K")
            if x in NAMES:
                _merge(out, to, cost + REROLE + extra, audit + "R")
    return out


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for b in batches:
        yield from zip(*(c.to_pylist() for c in b.columns), strict=True)


def _batches(rows: Iterator[dict], schema: StructType, size: int = 2000, room: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Rows as Arrow batches of at most ``size`` rows and some ``room`` bytes of long values."""
    arrow, held, weight = to_arrow_schema(schema), [], 0
    for r in rows:
        held.append(r)
        weight += sum(len(v) for v in r.values() if isinstance(v, bytes | str))
        if len(held) >= size or weight >= room:
            yield pa.RecordBatch.from_pylist(held, arrow)
            held, weight = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, arrow)


def _chunk(conv: object, block: int, first: int, rows: list[tuple], known: bool) -> dict:
    """What the fold needs of one conversation's rows in one block; ``known``: it begins here, with an empty stack."""
    live = [(i, f, t) for _, _, _, t, i, g, f in rows if not g]
    initials = [i for i, _, _ in live]
    turns = [t for _, _, t in live if t is not None]
    stacks: list[Stack | None] = []
    for entry in range(len(SHIFT)):
        stack: Stack | None = {entry: (0, "")} if entry == 0 or not known else None
        for i, f, _ in live if stack else ():
            stack = step(stack, i, f)
        stacks.append(stack)
    faults = [f for _, f, _ in live]
    return {
        "conv_id": conv, "block": block, "first": first,
        "blank": faults.count(BLANK), "duplicate": faults.count(DUPLICATE), "truncated": faults.count(CUT),
        "illegal": sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False)),
        "head": initials[0] if live else None, "last": initials[-1] if live else None,
        "low": turns[0] if turns else None, "high": turns[-1] if turns else None, "turns": len(set(turns)),
        "moves": [{"entry": e, "top": t, "cost": c, "audit": a} for e, s in enumerate(stacks) if s for t, (c, a) in s.items()],
    }


def _parse(schema: StructType):
    """Rows ``(block, pos, conv_id, turn, initial, gone, fault)`` sorted by block and pos -> one chunk per conversation and block."""

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        held: list[tuple] = []
        known = False
        for r in _rows(batches):
            if held and (r[0], r[2]) != (held[0][0], held[0][2]):
                yield _chunk(held[0][2], held[0][0], held[0][1], held, known)
                known = r[0] == held[0][0]  # another conversation came before in this block
                held = []
            held.append(r)
        if held:
            yield _chunk(held[0][2], held[0][0], held[0][1], held, known)

    return lambda batches: _batches(chunks(batches), schema)


class _Fold:
    """One conversation's chunks, folded in order. A stack is top -> (cost, rank, path): the rank orders the audits of
    the tops, and a path is (path before, chunk, entry, audit), so that paths share what they have in common."""

    def __init__(self, conv: object) -> None:
        self.conv, self.counts, self.chunks = conv, dict.fromkeys(COUNTS, 0), 0
        self.stack: dict[int, tuple[int, int, tuple | None]] = {0: (0, 0, None)}
        self.last = self.low = self.high = None
        self.turns = 0

    def add(self, c: dict) -> None:
        self.chunks += 1
        for k in COUNTS:
            self.counts[k] += c[k]
        if c["head"] is not None:
            if self.last is not None and self.last + c["head"] not in ("su", "ua", "au"):
                self.counts["illegal"] += 1
            self.last = c["last"]
        if c["low"] is not None:
            self.turns += c["turns"] - (self.high == c["low"])
            self.low, self.high = c["low"] if self.low is None else self.low, c["high"]
        best: dict[int, tuple] = {}
        for m in c["moves"]:
            if m["entry"] in self.stack:
                cost, rank, path = self.stack[m["entry"]]
                made = (cost + m["cost"], rank, m["audit"], m["entry"], path)
                if m["top"] not in best or made[:3] < best[m["top"]][:3]:
                    best[m["top"]] = made
        ranked = sorted(best, key=lambda t: best[t][1:3])
        self.stack = {t: (best[t][0], ranked.index(t), (best[t][4], (c["block"], c["first"]), best[t][3], best[t][2])) for t in best}

    def end(self) -> Iterator[dict]:
        """The conversation's result, and the audit of each chunk."""
        ways = []
        for top, (cost, rank, path) in self.stack.items():
            for to, (more, tail) in insert({top: (0, "")}).items():
                if to in ACCEPT:
                    ways.append((cost + more, rank, tail, top, path))
        cost, _, tail, _, path = min(ways, key=lambda w: w[:3])
        found, inserts = [], tail
        while path is not None:
            path, (block, first), entry, audit = path
            found.append((block, first, entry, audit + inserts))
            inserts = ""
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        yield {"conv_id": self.conv, "gaps": gaps, **self.counts, "cost": cost, "audit": "".join(a for *_, a in reversed(found))}
        for block, first, entry, audit in found:
            yield {"conv_id": self.conv, "block": block, "first": first, "entry": entry, "audit": audit, "whole": self.chunks == 1}


def _fold(names: list[str], schema: StructType):
    """Chunks sorted by conversation and place -> a result per conversation (``block`` null) and its chunks' audits."""

    def out(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        fold = None
        for r in _rows(batches):
            c = dict(zip(names, r, strict=True))
            if fold is None or fold.conv != c["conv_id"]:
                if fold:
                    yield from fold.end()
                fold = _Fold(c["conv_id"])
            fold.add(c)
        if fold:
            yield from fold.end()

    return lambda batches: _batches(out(batches), schema)


# ---- repaired texts


def _lines(entry: int, audit: str, rows: Iterator[tuple[str, str]]) -> Iterator[bytes]:
    """The repaired lines of a chunk, each with a line break in front; ``rows`` are its live rows (role, text)."""
    top = entry
    for action in audit:
        role, text = ("", "") if action == "I" else next(rows)
        if action == "D":
            continue
        if action in "IR":
            role = next(NAMES[x] for x in SHIFT[top] if x in NAMES)
        top = SHIFT[top][role[0]]
        yield f"\n{role}:{text}".encode("utf-8", "surrogatepass")


def _spell(schema: StructType):
    """Audits and rows ``(block, pos, kind, conv_id, entry, audit, whole, role, text)`` sorted by block, pos and kind -> digests
    of whole conversations, and pieces of text (with ``first`` and ``part``) of the others."""

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        rows = _rows(batches)
        head = next(rows, None)
        while head is not None:
            _, first, _, conv, entry, audit, whole, _, _ = head
            nxt: list[tuple | None] = [None]

            def live(nxt: list = nxt) -> Iterator[tuple[str, str]]:
                for r in rows:
                    if r[2] == 0:
                        nxt[0] = r
                        return
                    if r[7] is not None:
                        yield r[7], r[8]

            mine = live()
            digest, held, size, part = hashlib.sha256(), [], 0, 0
            begun = False
            for line in _lines(entry, audit, mine):
                if whole:
                    digest.update(line if begun else line[1:])
                    begun = True
                    continue
                held.append(line)
                size += len(line)
                if size >= LINES:
                    yield {"conv_id": conv, "first": first, "part": part, "lines": b"".join(held)}
                    held, size, part = [], 0, part + 1
            for _ in mine:  # to the next chunk
                pass
            if whole:
                yield {"conv_id": conv, "sha256": digest.hexdigest()}
            else:
                yield {"conv_id": conv, "first": first, "part": part, "lines": b"".join(held)}
            head = nxt[0]

    return lambda batches: _batches(chunks(batches), schema, 2000)


def _digest(schema: StructType):
    """Pieces ``(conv_id, lines)`` sorted by conversation and place -> ``(conv_id, sha256)``, with a running state only."""

    def out(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        conv, digest, begun, any_ = None, hashlib.sha256(), False, False
        for c, lines in _rows(batches):
            if any_ and c != conv:
                yield {"conv_id": conv, "sha256": digest.hexdigest()}
                digest, begun = hashlib.sha256(), False
            conv, any_ = c, True
            digest.update(lines if begun else lines[1:])
            begun = begun or bool(lines)
        if any_:
            yield {"conv_id": conv, "sha256": digest.hexdigest()}

    return lambda batches: _batches(out(batches), schema)


def _map(df: DataFrame, made, ddl: str) -> DataFrame:
    """``made(schema)`` over the Arrow batches of ``df``."""
    schema = StructType.fromDDL(ddl)
    return df.mapInArrow(made(schema), schema)


def repair(conversations: DataFrame) -> DataFrame:
    """One row per ``conv_id``: ``gaps``, the faults after damage, the cheapest repair's ``cost`` and ``audit``, and the SHA-256 of its lines."""
    kind = conversations.schema["conv_id"].dataType.simpleString()
    rows = numbered(damaged(conversations.select("conv_id", "turn", "role", "text")))
    parsed = with_faults(rows).select(_block(), "pos", "conv_id", "turn", "initial", "gone", "fault")
    chunk = f"conv_id {kind}, block long, first long, blank long, duplicate long, truncated long, illegal long, head string, last string, low long, high long, turns long, moves array<struct<entry:int,top:int,cost:long,audit:string>>"
    chunks = _map(parsed.repartition("block").sortWithinPartitions("pos"), _parse, chunk)
    result = f"conv_id {kind}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, block long, first long, entry int, whole boolean"
    folded = materialize(_map(chunks.repartition("conv_id").sortWithinPartitions("conv_id", "first"), lambda s: _fold(chunks.columns, s), result), "folded")

    audits = folded.where("block IS NOT NULL").select("block", F.col("first").alias("pos"), F.lit(0).alias("kind"), "conv_id", "entry", "audit", "whole", F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"))
    none = {c: F.lit(None).cast(t).alias(c) for c, t in (("conv_id", kind), ("entry", "int"), ("audit", "string"), ("whole", "boolean"))}
    lines = rows.where("NOT gone").select(_block(), "pos", F.lit(1).alias("kind"), *none.values(), "role", "text")
    spelt = _map(audits.union(lines).repartition("block").sortWithinPartitions("block", "pos", "kind"), _spell, f"conv_id {kind}, first long, part long, lines binary, sha256 string")
    spelt = materialize(spelt, "spelt")
    pieces = spelt.where("sha256 IS NULL").select("conv_id", "lines", "first", "part").repartition("conv_id").sortWithinPartitions("conv_id", "first", "part").select("conv_id", "lines")
    hashed = spelt.where("sha256 IS NOT NULL").select("conv_id", "sha256").union(_map(pieces, _digest, f"conv_id {kind}, sha256 string"))
    hashed = hashed.select(F.col("conv_id").alias("of"), F.col("sha256").alias("repaired_sha256"))
    found = folded.where("block IS NULL")
    return found.join(hashed, found["conv_id"].eqNullSafe(hashed["of"])).select("conv_id", "gaps", *COUNTS, "cost", "audit", "repaired_sha256")
