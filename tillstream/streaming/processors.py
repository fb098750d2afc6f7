"""Keyed stateful processors for ``transformWithStateInPandas`` (D-1, D-2, D-3, D-4, D-6, D-7, D-9).

Each processor keeps the same per-key state as the reference's keyed function and emits the same rows as
the batch form in :mod:`tillstream.operators.state`; state carries across micro-batches (RocksDB state
store, checkpointed). A key's rows arrive in Arrow frames. Processors that keep one row per day reduce
each frame before they put frames together; those keyed by a fact's primary key see its few versions.
Only the is_new correction and the per-record measures hold a key's rows of one micro-batch, whose size
the source's ``maxFilesPerTrigger`` / ``maxOffsetsPerTrigger`` bounds. Optional TTLs mirror the
reference's state TTL in processing time. Nulls stay nulls in state and output.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import pandas as pd
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

DAY_MS = 86_400_000


def _utc_date(ms: pd.Series) -> pd.Series:
    return pd.to_datetime(ms, unit="ms", utc=True).dt.strftime("%Y-%m-%d")


def _sorted(rows: Iterator[pd.DataFrame], order: list[str], day: str | None = None) -> pd.DataFrame:
    """A key's rows in arrival order. With ``day`` (a time column) only the first row of each date, and a
    ``_day`` column; every frame is reduced before the frames meet."""
    frames = []
    for f in rows:
        if not len(f):
            continue
        if day:
            f = f.sort_values(order, kind="mergesort").assign(_day=lambda x: _utc_date(x[day])).drop_duplicates("_day")
        frames.append(f)
    if not frames:
        return pd.DataFrame()
    out = pd.concat(frames, ignore_index=True).sort_values(order, kind="mergesort").reset_index(drop=True)
    return out.drop_duplicates("_day").reset_index(drop=True) if day else out


def _plain(v):
    """A Python value without pandas' missing markers."""
    return None if v is None or v is pd.NA or (isinstance(v, float) and v != v) else v


class _Keyed(StatefulProcessor):
    """One value per key, typed by ``state_type``."""

    state_type: T.DataType = T.StringType()
    ttl_ms: int | None = None

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("value", T.StructType([T.StructField("v", self.state_type)]), self.ttl_ms)

    def read(self):
        return self.state.get()[0] if self.state.exists() else None

    def close(self) -> None:
        pass


class DailyFirst(_Keyed):
    """D-2 / D-5: emit a record when its date differs from the key's last emitted date."""

    def __init__(self, ts: str, order: list[str], out_cols: list[str], ttl_ms: int | None = None):
        self.ts, self.order, self.out_cols, self.ttl_ms = ts, order, out_cols, ttl_ms

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        firsts = _sorted(rows, self.order, self.ts)
        if firsts.empty:
            return
        fresh = firsts[firsts["_day"] != self.read()]
        self.state.update((firsts["_day"].iloc[-1],))
        yield fresh[self.out_cols]


class DailyFlag(_Keyed):
    """D-6: every record, with ``flag`` = 1 on the key's first record of a date (never for a null key)."""

    def __init__(self, ts: str, order: list[str], out_cols: list[str], flag: str = "uv_ct"):
        self.ts, self.order, self.out_cols, self.flag = ts, order, out_cols, flag

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = _sorted(rows, self.order)
        if pdf.empty:
            return
        days = _utc_date(pdf[self.ts])
        first = ~days.duplicated() & (days != self.read()) & (key[0] is not None)
        self.state.update((days.iloc[-1],))
        yield pdf[self.out_cols].assign(**{self.flag: first.astype("int64")})


class IsNewFix(_Keyed):
    """D-1: first record sets the state (its date if new, else the day before); later records claiming to
    be new on another date become '0'. Without a device there is no state."""

    def __init__(self, order: list[str], ts: str = "ts", is_new: str = "is_new", ttl_ms: int | None = None):
        self.order, self.ts, self.is_new, self.ttl_ms = order, ts, is_new, ttl_ms

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = _sorted(rows, self.order)
        if pdf.empty:
            return
        days, fixed = _utc_date(pdf[self.ts]), pdf[self.is_new]
        if key[0] is not None:
            first = self.read()
            if first is None:
                first = days.iloc[0] if fixed.iloc[0] == "1" else _utc_date(pdf[self.ts].iloc[:1] - DAY_MS).iloc[0]
                self.state.update((first,))
            fixed = fixed.mask((fixed == "1") & (days != first), "0")
        yield pd.DataFrame({"mid": key[0], "ts": pdf[self.ts], "is_new": pdf[self.is_new], "is_new_fixed": fixed})


class LoginBack(_Keyed):
    """D-7: per user, uu=1 on a new login date; back=1 when >= ``back_days`` whole days passed since
    midnight of the previous login date (one zone for both directions)."""

    def __init__(self, back_days: int = 8):
        self.back_days = back_days

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        days = _sorted(rows, ["ts"], "ts")
        if days.empty:
            return
        last = self.read()
        days = days[days["_day"] != last]
        if days.empty:
            return
        before = days["_day"].shift(1)
        before.iloc[0] = last
        midnight = pd.to_datetime(before, utc=True)
        passed = (pd.to_datetime(days["ts"], unit="ms", utc=True) - midnight).dt.days
        self.state.update((days["_day"].iloc[-1],))
        back = (passed >= self.back_days).astype("int64")  # no previous date: not back
        yield pd.DataFrame({"uid": key[0], "ts": days["ts"], "cur_date": days["_day"], "uu_ct": 1, "back_ct": back})


class StrictlyNewer(_Keyed):
    """D-9 / D-10: pass a record only if its value beats the key's stored maximum. Until there is a value
    every record passes; afterwards a null value does not."""

    state_type = T.LongType()

    def __init__(self, value: str, order: list[str], out_cols: list[str], ttl_ms: int | None = None):
        self.value, self.order, self.out_cols, self.ttl_ms = value, order, out_cols, ttl_ms

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = _sorted(rows, self.order)
        if pdf.empty:
            return
        value, best = pdf[self.value], self.read()
        before = value.cummax().ffill().shift(1)
        if best is not None:
            before = before.fillna(best).clip(lower=best)
        top = value.max()
        if pd.notna(top) and (best is None or top > best):
            self.state.update((int(top),))
        yield pdf[before.isna() | (value > before)][self.out_cols]


class RetractReplace(_Keyed):
    """D-3: on a new record re-emit the previous one with a negated amount (keeping its own ts), then the
    new one. Columns travel as strings; a null amount stays null when it is negated.

    Rows are handled one at a time in Python: a key is an order detail and sees a handful of versions."""

    def __init__(self, amount: str, order: list[str], out_cols: list[str], ttl_ms: int | None = None):
        self.amount, self.order, self.out_cols, self.ttl_ms = out_cols.index(amount), order, out_cols, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        fields = [T.StructField(c, T.StringType()) for c in self.out_cols]
        self.state = handle.getValueState("previous", T.StructType(fields), self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = _sorted(rows, self.order)
        if pdf.empty:
            return
        prev = list(self.state.get()) if self.state.exists() else None
        out = []
        for rec in pdf[self.out_cols].itertuples(index=False, name=None):
            rec = [None if (v := _plain(x)) is None else str(v) for x in rec]
            if prev is not None:
                neg = list(prev)
                neg[self.amount] = None if prev[self.amount] is None else str(-Decimal(prev[self.amount]))
                out.append([*neg, "-1"])
            out.append([*rec, "1"])
            prev = rec
        self.state.update(tuple(prev))
        yield pd.DataFrame(out, columns=[*self.out_cols, "sign"], dtype=object)


class HoldLatest(StatefulProcessor):
    """D-4: hold a key for ``hold_ms`` of processing time after its first record, then emit the latest
    record held (later or equal ``order`` replaces) and forget the key.

    Each Arrow batch of a key is reduced to one row, and batches are folded in Python: a key is a fact's identity."""

    def __init__(self, order: str, out: T.StructType, hold_ms: int = 5000):
        self.order, self.out, self.hold_ms = order, out, hold_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("held", self.out)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held, at = None, self.out.names.index(self.order)
        if self.state.exists():
            held = tuple(self.state.get())
        else:
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.hold_ms)
        for f in rows:
            if len(f):
                last = f.sort_values(self.order, kind="mergesort").iloc[-1]
                row = tuple(getattr(v, "item", lambda v=v: v)() for v in (_plain(last[c]) for c in self.out.names))
                held = row if held is None or row[at] >= held[at] else held
        self.state.update(held)
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held = tuple(self.state.get())
        self.state.clear()
        yield pd.DataFrame([held], columns=self.out.names)

    def close(self) -> None:
        pass


class ChangelogJoin(StatefulProcessor):
    """Two-sided join state of one key (J-2 ... J-6 as streams, D-12).

    Input rows are ``(k, side, id, ord, op, body)``: a version of row ``id`` of the left ('l') or right ('r') side. The latest version
    per id is held on each side (later or equal ``ord`` replaces; op 'd' leaves a tombstone, so versions may come in any order), for
    ``ttl_ms`` of processing time after its last change. Output is a changelog of joined rows: 'u' puts the pair (l_id, r_id), 'd' takes it back; ``seq`` orders the changes
    of a key. With ``outer`` a left row without a partner is put with an empty right side, and taken back when a partner
    arrives. A micro-batch emits its net effect. What a side's expired row had emitted stays as it is.

    Rows are handled one at a time in Python: a key is a fact's identity and sees a handful of versions.
    """

    def __init__(self, outer: bool = False, ttl_ms: int | None = None):
        self.outer, self.ttl_ms = outer, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        row = T.StructType([T.StructField("ord", T.StringType()), T.StructField("body", T.StringType())])
        key = T.StructType([T.StructField("id", T.StringType())])
        self.sides = {s: handle.getMapState(s, key, row, self.ttl_ms) for s in ("l", "r")}
        self.seq = handle.getValueState("seq", T.StructType([T.StructField("n", T.LongType())]))

    def _pairs(self, l: dict, r: dict) -> dict:
        l, r = ({i: v for i, v in side.items() if v[1] is not None} for side in (l, r))
        if not r and self.outer:
            return {(i, None): (v[1], None) for i, v in l.items()}
        return {(i, j): (v[1], w[1]) for i, v in l.items() for j, w in r.items()}

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held = {s: {k[0]: tuple(v) for k, v in state.iterator()} for s, state in self.sides.items()}
        before = self._pairs(held["l"], held["r"])
        for f in rows:
            for side, ident, order, op, body in zip(f["side"], f["id"], f["ord"], f["op"], f["body"], strict=True):
                old = held[side].get(ident)
                if old is not None and order < old[0]:
                    continue
                held[side][ident] = (order, None if op == "d" else body)
                self.sides[side].updateValue((ident,), held[side][ident])
        after = self._pairs(held["l"], held["r"])
        out = [(*p, "d", *before[p]) for p in before if p not in after] + [(*p, "u", *after[p]) for p in after if before.get(p) != after[p]]
        if not out:
            return
        at = self.seq.get()[0] if self.seq.exists() else 0
        self.seq.update((at + len(out),))
        frame = pd.DataFrame(out, columns=["l_id", "r_id", "op", "l", "r"], dtype=object)
        yield frame.assign(k=key[0], seq=range(at, at + len(out)))[["k", "l_id", "r_id", "op", "seq", "l", "r"]]

    def close(self) -> None:
        pass


class FirstOfKey(_Keyed):
    """W-2's distinct orders: every record, with ``flag`` = 1 on the first one of each value of ``group`` (a window) within the key.

    Corrections (D-3) pass with flag 0 like any later record: what has been counted once is not taken back (N-8).
    """

    def __init__(self, group: str, out_cols: list[str], flag: str = "first", ttl_ms: int | None = None):
        self.group, self.out_cols, self.flag, self.ttl_ms = group, out_cols, flag, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getMapState("seen", T.StructType([T.StructField("g", T.LongType())]), T.StructType([T.StructField("x", T.BooleanType())]), self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        for f in rows:
            if not len(f):
                continue
            groups = f[self.group].astype("int64")
            old = {g for g in groups.unique().tolist() if self.seen.containsKey((g,))}
            for g in set(groups.unique().tolist()) - old:
                self.seen.updateValue((g,), (True,))
            yield f[self.out_cols].assign(**{self.flag: (~groups.duplicated() & ~groups.isin(old)).astype("int64")})


class SeenOnce(StatefulProcessor):
    """D-8 with bounded state: passes the first record of each digest within ``ttl_ms`` of processing time.

    State is a map of digests, not of records; the key is a part of the digest, so a hot user is spread."""

    def __init__(self, digest: str, out_cols: list[str], ttl_ms: int | None = None):
        self.digest, self.out_cols, self.ttl_ms = digest, out_cols, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getMapState("seen", T.StructType([T.StructField("d", T.StringType())]), T.StructType([T.StructField("x", T.BooleanType())]), self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        for f in rows:
            f = f.drop_duplicates(self.digest)
            fresh = [not self.seen.containsKey((d,)) for d in f[self.digest]]
            for d in f[self.digest][fresh]:
                self.seen.updateValue((d,), (True,))
            yield f[self.out_cols][fresh]

    def close(self) -> None:
        pass


class RunningProfile(_Keyed):
    """D-11 as a running aggregate: per user the distinct OS list, the record count, the latest search item and the latest
    time, emitted whenever records change it. The batch form is :func:`tillstream.operators.labels.uid_profile_agg`."""

    state_type = T.StructType([
        T.StructField("os", T.StringType()), T.StructField("n", T.LongType()), T.StructField("item", T.StringType()),
        T.StructField("item_ts", T.LongType()), T.StructField("ts", T.LongType()),
    ])

    def __init__(self, ttl_ms: int | None = None):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("profile", self.state_type, self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        os, n, item, item_ts, ts = tuple(self.state.get()) if self.state.exists() else (None, 0, None, None, None)
        known = set(os.split(",")) if os else set()
        for f in rows:
            if not len(f):
                continue
            known |= set(f["os"].dropna())
            n += len(f)
            searched = f[f["search_item"].notna() & f["ts"].notna()]
            if len(searched):
                last = searched.loc[searched["ts"].idxmax()]
                if item_ts is None or last["ts"] >= item_ts:
                    item, item_ts = str(last["search_item"]), int(last["ts"])
            top = f["ts"].max()
            if pd.notna(top):
                ts = int(top) if ts is None else max(ts, int(top))
        os = ",".join(sorted(known))
        self.state.update((os, n, item, item_ts, ts))
        out = pd.DataFrame([(key[0], os, n, item, ts)], columns=["uid", "os", "n_events", "search_item", "ts"])
        yield out.astype({"os": object, "search_item": object, "ts": "Int64"})


class ProcessingWindow(StatefulProcessor):
    """Tumbling windows of processing time (W-3, W-8): a key's records are reduced as they arrive, and a timer at the window's end
    emits the held value with the window's start (``w_ms``). Records that come when the window is over, but before its
    timer has fired, emit it themselves and open the next one."""

    def __init__(self, held: T.StructType, length_ms: int):
        self.held, self.length_ms = held, length_ms

    def reduce(self, value: tuple | None, frame: pd.DataFrame) -> tuple:
        raise NotImplementedError

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("held", T.StructType([T.StructField("w_ms", T.LongType()), *self.held.fields]))

    def _emit(self, held: tuple) -> pd.DataFrame:
        return pd.DataFrame([held], columns=["w_ms", *self.held.names], dtype=object).astype({"w_ms": "int64"})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentProcessingTimeInMs()
        start = now - now % self.length_ms
        held = tuple(self.state.get()) if self.state.exists() else None
        if held is not None and held[0] != start:
            self.handle.deleteTimer(held[0] + self.length_ms)
            yield self._emit(held)
            held = None
        if held is None:
            self.handle.registerTimer(start + self.length_ms)
        value = held[1:] if held is not None else None
        for f in rows:
            if len(f):
                value = self.reduce(value, f)
        self.state.update((start, *value))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.state.exists():
            held = tuple(self.state.get())
            self.state.clear()
            yield self._emit(held)

    def close(self) -> None:
        pass


class WindowLast(ProcessingWindow):
    """W-8: the last value of the window wins (by ``order``; the later arrival on ties)."""

    def __init__(self, order: str, held: T.StructType, length_ms: int = 120_000):
        super().__init__(held, length_ms)
        self.order, self.at = order, held.names.index(order)

    def reduce(self, value: tuple | None, frame: pd.DataFrame) -> tuple:
        last = frame.sort_values(self.order, kind="mergesort").iloc[-1]
        row = tuple(getattr(v, "item", lambda v=v: v)() for v in (_plain(last[c]) for c in self.held.names))
        return row if value is None or value[self.at] is None or row[self.at] >= value[self.at] else value


class WindowSums(ProcessingWindow):
    """W-3: decimal sums per key and window. The first held column is the key; amounts travel as strings, nulls add nothing."""

    def __init__(self, key: str, sums: list[str], length_ms: int = 10_000):
        super().__init__(T.StructType([T.StructField(c, T.StringType()) for c in (key, *sums)]), length_ms)
        self.key, self.sums = key, sums

    def reduce(self, value: tuple | None, frame: pd.DataFrame) -> tuple:
        out = [str(frame[self.key].iloc[0])]
        for k, c in enumerate(self.sums, 1):
            parts = [Decimal(v) for v in frame[c] if _plain(v) is not None]
            old = value[k] if value is not None else None
            total = sum(parts, Decimal(old) if old is not None else Decimal(0))
            out.append(str(total) if parts or old is not None else None)
        return tuple(out)
