"""Streaming bodies of the keyed-state operators (``transformWithStateInPandas``).

Each processor keeps per-key state in the (RocksDB) state store and processes a
micro-batch's rows of one key sorted by (event time, arrival sequence), so the
result matches the batch body in ``tidemart.operators.dedup`` whatever the
micro-batch boundaries are. Per-key work is a small pandas loop over that key's
rows in the batch; state stays O(1) per key (O(distinct values) for sets).

The processors on the page log and the carts (``Dealt``) meet many keys of a few rows each: there a call a key costs
milliseconds in frames and messages, whatever the rows. Their keys are dealt by hash to ``GROUPS`` groups; a call works
on a group's rows at once, while the state stays one entry a key.

State ends (T6): by an event-time timer once the watermark has left a key's last record ``idle_ms`` behind, or, where
late records must not be dropped and so no watermark is set, by a processing-time TTL.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

DAY_MS = 86_400_000


def _rows(batches: Iterator[pd.DataFrame], order: list[str]) -> pd.DataFrame:
    frames = list(batches)
    if not frames:
        return pd.DataFrame()
    df = pd.concat(frames, ignore_index=True)
    return df.sort_values(order, kind="stable").reset_index(drop=True) if order else df


def _records(batches: Iterator[pd.DataFrame], columns: list[str], order: str | None = None) -> list[tuple]:
    """A key's rows as tuples of ``columns``, by ``order``: for keys of a few rows, where frames cost more than the work."""
    out = [r for f in batches for r in zip(*[f[c].tolist() for c in columns])]
    if order is not None and len(out) > 1:
        at = columns.index(order)
        out.sort(key=lambda r: r[at])
    return out


def _text(record: tuple) -> list:
    return [None if v is None or v != v else str(v) for v in record]


def _moments(ms: list[int]) -> np.ndarray:
    return np.array(ms, "datetime64[ms]")


#: Groups of the keys of a ``Dealt`` processor: a call holds a group's rows of one micro-batch. As with the state's
#: partitions, a checkpoint keeps the number it began with.
GROUPS = 8192
#: The day of records without a time.
NO_DAY = -(1 << 62)


def _days(ms: pd.Series, offset_ms: int = 0) -> np.ndarray:
    """Numbers of the days since 1970."""
    known = ms.notna().to_numpy()
    return np.where(known, (ms.fillna(0).to_numpy().astype("int64") + offset_ms) // DAY_MS, NO_DAY)


def apply(df: DataFrame, keys: list[str], processor: StatefulProcessor, out_schema: str,
          time_mode: str = "None", event_time_column: str = "") -> DataFrame:
    """groupBy(keys).transformWithStateInPandas in append mode; for a ``Dealt`` processor by groups of the keys."""
    if isinstance(processor, Dealt):
        df = (df.withColumn("state_key", F.to_json(F.struct(*keys)))
              .withColumn("state_group", F.pmod(F.xxhash64("state_key"), F.lit(GROUPS))))
        keys = ["state_group"]
    return df.groupBy(*keys).transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=out_schema, outputMode="Append", timeMode=time_mode,
        eventTimeColumnName=event_time_column)


class KeyLife:
    """Lets all state of an idle key go. A key has one timer; when it fires too early, because records came since,
    it is set again for the key's last record plus ``idle_ms``. Without ``idle_ms`` a key lives on."""

    idle_ms: int | None = None

    def live(self, handle: StatefulProcessorHandle, *states) -> None:
        self.handle, self.states = handle, states
        self.seen = handle.getValueState("last_seen", "ms long") if self.idle_ms else None

    def touch(self, newest, timerValues) -> bool:
        """Notes the key's newest record; whether the key is new."""
        if not self.idle_ms:
            return False
        newest = max(0 if pd.isna(newest) else int(newest), timerValues.getCurrentWatermarkInMs())
        seen = self.seen.get()
        if seen is None:
            self.handle.registerTimer(newest + self.idle_ms)
        if seen is None or seen[0] < newest:
            self.seen.update((newest,))
        return seen is None

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        seen = self.seen.get() if self.idle_ms else None
        if seen is not None:
            due = seen[0] + self.idle_ms
            if due > timerValues.getCurrentWatermarkInMs():
                self.handle.registerTimer(due)
            else:
                for state in (*self.states, self.seen):
                    state.clear()
        return iter([])


class Dealt(StatefulProcessor):
    """A processor of many keys at a time: it is called with the rows of a group of keys, each with its key as ``state_key``,
    and keeps a map entry for a key. A group has one timer at a time, noted as ``due``; when it fires, ``ended`` says
    what is left of each entry and when to look again."""

    def open(self, handle: StatefulProcessorHandle, schema: str, ttl_ms: int | None = None) -> None:
        self.handle = handle
        self.entries = handle.getMapState("entries", "k string", schema, ttl_ms)
        self.due = handle.getValueState("due", "ms long")

    def wake(self, at: int, timerValues) -> None:
        """A timer at ``at`` at the earliest, unless one is set for then or before."""
        at, due = max(at, timerValues.getCurrentWatermarkInMs() + 1), self.due.get()
        if due is None or at < due[0]:
            if due is not None:
                self.handle.deleteTimer(due[0])
            self.handle.registerTimer(at)
            self.due.update((at,))

    def ended(self, entry: tuple, mark: int) -> tuple[tuple | None, int]:
        """What is left of an entry at the watermark, and the moment at which that ends."""
        raise NotImplementedError

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        mark, at = timerValues.getCurrentWatermarkInMs(), None
        for k, entry in list(self.entries.iterator()):
            left, end = self.ended(tuple(entry), mark)
            if left is None:
                self.entries.removeKey(tuple(k))
                continue
            at = end if at is None else min(at, end)
            if left != tuple(entry):
                self.entries.updateValue(tuple(k), left)
        self.due.clear()
        if at is not None:
            self.wake(at, timerValues)
        return iter([])

    def close(self) -> None:
        pass


class FirstOfDay(Dealt):
    """The first row of each key per day (``flag=False``), or every row with
    a ``first_flag`` column (``flag=True``). State: the days seen, so that a day
    that comes again out of order is not counted twice. With ``timers`` (event time) a day
    is let go once the watermark has passed its end, as its rows are dropped as late from
    then on; a key without days has no state. Else a processing-time TTL, 1 day by default."""

    def __init__(self, ts: str, order: list[str], columns: list[str], flag: bool = False, tz_offset_ms: int = 0,
                 ttl_ms: int | None = DAY_MS, timers: bool = False):
        self.ts, self.order, self.columns, self.flag = ts, order, columns, flag
        self.tz_offset_ms, self.ttl_ms, self.timers = tz_offset_ms, None if timers else ttl_ms, timers

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.open(handle, "d array<bigint>", self.ttl_ms)

    def _end(self, day: int) -> int:
        return DAY_MS if day == NO_DAY else (day + 1) * DAY_MS - self.tz_offset_ms

    def ended(self, entry: tuple, mark: int) -> tuple[tuple | None, int]:
        left = [d for d in entry[0] if self._end(d) > mark]
        return ((left,), min(map(self._end, left))) if left else (None, 0)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        df = _rows(rows, self.order)
        if df.empty:
            return
        codes, keys = pd.factorize(df["state_key"])
        days = _days(df[self.ts], self.tz_offset_ms)
        first = ~pd.DataFrame({"k": codes, "d": days}).duplicated().to_numpy()
        met: dict[int, list[int]] = {}
        for i in np.flatnonzero(first).tolist():
            met.setdefault(codes[i], []).append(i)
        fresh = []
        for c, at in met.items():
            held = self.entries.getValue((keys[c],))
            known = set(held[0]) if held else set()
            new = {int(days[i]) for i in at} - known
            first[[i for i in at if days[i] in known]] = False
            if new or self.ttl_ms:
                self.entries.updateValue((keys[c],), (sorted(known | new),))
            fresh.extend(new)
        if self.timers and fresh:
            self.wake(self._end(min(fresh)), timerValues)
        out = df[self.columns].copy()
        if self.flag:
            out["first_flag"] = first.astype("int64")
            yield out
        else:
            yield out[first]


class Idle(Dealt):
    """Entries end with the time of the key's last record, ``seen``, and are let go once it lies ``idle_ms`` behind
    the watermark: the key is new from then on. A group is swept for such entries at most eight times in that span, as
    a sweep reads them all. Without ``idle_ms`` a key lives on."""

    idle_ms: int | None = None

    def held(self, key: str, timerValues) -> tuple | None:
        entry = self.entries.getValue((key,))
        if entry is None or (self.idle_ms and entry[-1] + self.idle_ms <= timerValues.getCurrentWatermarkInMs()):
            return None
        return tuple(entry)

    def ended(self, entry: tuple, mark: int) -> tuple[tuple | None, int]:
        end = entry[-1] + self.idle_ms
        return (entry, max(end, mark + self.idle_ms // 8)) if end > mark else (None, 0)

    def newest(self, codes: np.ndarray, n: int, ts: pd.Series, timerValues) -> list[int]:
        """Of each key, the time of its newest record, the watermark at the least."""
        out = np.full(n, max(0, timerValues.getCurrentWatermarkInMs()))
        np.maximum.at(out, codes, ts.fillna(0).to_numpy().astype("int64"))
        return out.tolist()

    def keep(self, key: str, held: tuple | None, value: tuple, newest: int) -> None:
        self.entries.updateValue((key,), (*value, max(newest, held[-1]) if held else newest))

    def sweep(self, newest: list[int], timerValues) -> None:
        if self.idle_ms and self.due.get() is None:
            self.wake(min(newest) + self.idle_ms, timerValues)


class ReturningUser(Idle):
    """The first login of each user and day, with ``back`` = 1 when the login
    day before it lies ``back_days`` or more days back. State: the last login day; a user who stays
    away for longer than ``idle_ms`` comes back as a new one."""

    def __init__(self, back_days: int = 8, idle_ms: int | None = None):
        self.back_days, self.idle_ms = back_days, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.open(handle, "d long, seen long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        df = _rows(rows, ["ts"])
        if df.empty:
            return
        codes, keys = pd.factorize(df["state_key"])
        days, newest = _days(df["ts"]), self.newest(codes, len(keys), df["ts"], timerValues)
        first = ~pd.DataFrame({"k": codes, "d": days}).duplicated().to_numpy()
        met: list[list[int]] = [[] for _ in keys]
        for i in np.flatnonzero(first).tolist():
            met[codes[i]].append(i)
        back = np.zeros(len(df), np.int64)
        for k, at, seen in zip(keys, met, newest):
            held = self.held(k, timerValues)
            last = held[0] if held else None
            for i in at:
                if last is None or days[i] > last:
                    back[i] = last is not None and int(df["ts"].iat[i]) - last * DAY_MS >= self.back_days * DAY_MS
                    last = int(days[i]) if days[i] != NO_DAY else None
                else:
                    first[i] = False
            self.keep(k, held, (last,), seen)
        self.sweep(newest, timerValues)
        out = df[["uid", "ts", "et"]].copy()
        out["back"] = back
        yield out[first]


class FixIsNew(Idle):
    """The first record of a mid fixes its visit day (its date if it says
    new, else the day before); later 'new' records on another date become old. A mid that is idle for ``idle_ms`` of
    event time, or ``ttl_ms`` of processing time, is met as a new one."""

    def __init__(self, columns: list[str], ttl_ms: int | None = None, idle_ms: int | None = None):
        self.columns, self.ttl_ms, self.idle_ms = columns, ttl_ms, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.open(handle, "d long, seen long", self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        df = _rows(rows, ["ts", "offset"])
        if df.empty:
            return
        codes, keys = pd.factorize(df["state_key"])
        days, newest = _days(df["ts"]), self.newest(codes, len(keys), df["ts"], timerValues)
        isnew = (df["is_new"] == "1").to_numpy()
        starts = np.unique(codes, return_index=True)[1]
        fixed = np.full(len(keys), NO_DAY)
        for c, i in enumerate(starts.tolist()):
            held = self.held(keys[c], timerValues)
            day = held[0] if held else None
            if day is None and days[i] != NO_DAY:
                day = int(days[i]) - (0 if isnew[i] else 1)
            if day is not None:
                fixed[c] = day
            self.keep(keys[c], held, (day,), newest[c])
        self.sweep(newest, timerValues)
        day = fixed[codes]
        out = df[self.columns].copy()
        out["is_new"] = df["is_new"].where(~(isnew & (day != NO_DAY) & (day != days)), "0")
        yield out


class StrictlyNewer(KeyLife, StatefulProcessor):
    """Pass a row only when its time is greater than every earlier one of the key."""

    def __init__(self, ts: str, seq: str, columns: list[str], ttl_ms: int | None = None, idle_ms: int | None = None):
        self.ts, self.seq, self.columns, self.ttl_ms, self.idle_ms = ts, seq, columns, ttl_ms, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.max_ts = handle.getValueState("max_ts", "m long", self.ttl_ms)
        self.live(handle, self.max_ts)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        df = _rows(rows, [self.seq])
        if df.empty:
            return
        m = (self.max_ts.get() or [None])[0]
        keep = []
        for t in df[self.ts]:
            ok = m is None or t > m
            if ok:
                m = int(t)
            keep.append(ok)
        self.max_ts.update((m,))
        self.touch(df[self.ts].max(), timerValues)
        yield df.loc[keep, self.columns]

    def close(self) -> None:
        pass


class RetractVersions(StatefulProcessor):
    """On a new version emit the previous one with negated amounts, then the new one.

    With ``window_ms`` (event time, ``ts`` in millis) rows carry their event time ``et``: a retraction has that of the
    row it takes back, and is dropped as late if that row's window has closed (Q8); the amount then stays counted. A
    version is remembered until the watermark is ``idle_ms`` past it."""

    def __init__(self, seq: str, columns: list[str], amount: str, ts: str | None = None, window_ms: int | None = None,
                 idle_ms: int | None = None):
        self.seq, self.columns, self.amount = seq, columns, amount
        self.ts, self.window_ms, self.idle_ms = ts, window_ms, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", ", ".join(f"{c} string" for c in self.columns))

    def _event_time(self, ms: int, mark: int) -> int | None:
        """After the watermark, but in the same window; none if that has closed."""
        return None if ms - ms % self.window_ms + self.window_ms <= mark + 1 else max(ms, mark + 1)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        records = _records(rows, self.columns, self.seq)
        if not records:
            return
        prev = self.last.get()
        if self.idle_ms and prev is None:
            self.handle.registerTimer(self._due(records[-1], timerValues))
        out, times = [], []
        mark = max(0, timerValues.getCurrentWatermarkInMs())
        idx = self.columns.index(self.amount)
        at = self.columns.index(self.ts) if self.ts else None
        for rec in map(_text, records):
            for row, back in ((prev, True), (rec, False)):
                if row is None:
                    continue
                if back:
                    row = [*row[:idx], None if row[idx] is None else _negate(row[idx]), *row[idx + 1:]]
                if self.window_ms:
                    et = self._event_time(int(row[at]), mark)
                    if et is None:
                        continue
                    times.append(et)
                out.append([*row, back])
            prev = rec
        self.last.update(tuple(prev))
        got = pd.DataFrame(out, columns=[*self.columns, "is_retraction"])
        if self.window_ms:
            got["et"] = _moments(times)
        yield got

    def _due(self, version, timerValues) -> int:
        return max(int(version[self.columns.index(self.ts)]), timerValues.getCurrentWatermarkInMs()) + self.idle_ms

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        last = self.last.get()
        if last is not None:
            due = int(last[self.columns.index(self.ts)]) + self.idle_ms
            if due > timerValues.getCurrentWatermarkInMs():
                self.handle.registerTimer(due)
            else:
                self.last.clear()
        return iter([])

    def close(self) -> None:
        pass


def _negate(x: str) -> str:
    from decimal import Decimal
    return str((-Decimal(x)).quantize(Decimal("0.01")))


class FirstInWindow(StatefulProcessor):
    """A4: each row with ``first`` = 1 when its key had no row in the same tumbling window of ``et`` before, else 0; so
    a sum of ``first`` by window is the exact number of distinct keys, with no set of them anywhere. State: the windows
    with rows; a window's end is a timer that lets it go."""

    def __init__(self, window_ms: int, columns: list[str]):
        self.window_ms, self.columns = window_ms, columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", "w array<bigint>")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        df = pd.concat(list(rows), ignore_index=True)
        known = set((self.open.get() or [()])[0])
        first, fresh = [], False
        for ms in df["et"].to_numpy().astype("datetime64[ms]").astype("int64").tolist():
            start = ms - ms % self.window_ms
            first.append(int(start not in known))
            if start not in known:
                known.add(start)
                fresh = True
                self.handle.registerTimer(max(start + self.window_ms, timerValues.getCurrentWatermarkInMs() + 1))
        if fresh:
            self.open.update((sorted(known),))
        out = df[self.columns].copy()
        out["first"] = first
        yield out

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if (held := self.open.get()) is not None:
            mark = timerValues.getCurrentWatermarkInMs()
            known = [w for w in held[0] if w + self.window_ms > mark]
            if known:
                self.open.update((known,))
            else:
                self.open.clear()
        return iter([])

    def close(self) -> None:
        pass


class FirstArrival(KeyLife, StatefulProcessor):
    """T14, exact: the first row of a key; nothing more while the key is remembered. State: its last time alone."""

    def __init__(self, seq: str, ts: str, columns: list[str], idle_ms: int):
        self.seq, self.ts, self.columns, self.idle_ms = seq, ts, columns, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.live(handle)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        records = _records(rows, self.columns, self.seq)
        at = self.columns.index(self.ts)
        if records and self.touch(max(r[at] for r in records), timerValues):
            yield pd.DataFrame(records[:1], columns=self.columns)

    def close(self) -> None:
        pass


class BloomFirst(StatefulProcessor):
    """T14 by a scalable Bloom filter: rows whose hash pair (bloom_h1, bloom_h2) no filter of the key's series holds. Filter g holds
    ``expected`` * 2^g hashes at a rate of ``fpp`` / 2^(g+1), so the series stays below ``fpp``."""

    def __init__(self, seq: str, columns: list[str], expected: int, fpp: float):
        self.seq, self.columns, self.expected, self.fpp = seq, columns, max(1, expected), fpp

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.bits = handle.getMapState("bits", "g int", "b binary")
        self.count = handle.getValueState("count", "last int, n long")

    def shape(self, g: int) -> tuple[int, int, int]:
        """Bits (a multiple of 8), hashes a key and keys of filter ``g``."""
        n, p = self.expected << g, self.fpp / 2 ** (g + 1)
        m = -(-math.ceil(-n * math.log(p) / math.log(2) ** 2) // 8) * 8
        return m, max(1, round(m / n * math.log(2))), n

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        df = _rows(rows, [self.seq])
        if df.empty:
            return
        last, n = self.count.get() if self.count.exists() else (0, 0)
        filters = [np.frombuffer(self.bits.getValue((g,))[0], np.uint8).copy() if self.bits.containsKey((g,))
                   else np.zeros(self.shape(g)[0] // 8, np.uint8) for g in range(last + 1)]
        h1, h2 = (df[c].to_numpy(np.int64).view(np.uint64) for c in ("bloom_h1", "bloom_h2"))
        at, touched = [self._places(h1, h2, g) for g in range(last + 1)], {last}
        keep = np.zeros(len(df), bool)
        for i in range(len(df)):
            if any(((f[a[i] >> np.uint64(3)] >> (a[i] & np.uint64(7)).astype(np.uint8)) & 1).all() for f, a in zip(filters, at)):
                continue
            keep[i] = True
            if n == self.shape(last)[2]:
                last, n = last + 1, 0
                filters.append(np.zeros(self.shape(last)[0] // 8, np.uint8))
                at.append(self._places(h1, h2, last))
                touched.add(last)
            np.bitwise_or.at(filters[last], at[last][i] >> np.uint64(3), np.uint8(1) << (at[last][i] & np.uint64(7)).astype(np.uint8))
            n += 1
        for g in touched:
            self.bits.updateValue((g,), (filters[g].tobytes(),))
        self.count.update((last, n))
        yield df.loc[keep, self.columns]

    def _places(self, h1: np.ndarray, h2: np.ndarray, g: int) -> np.ndarray:
        m, k, _ = self.shape(g)
        return (h1[:, None] + np.arange(k, dtype=np.uint64) * (h2[:, None] | np.uint64(1))) % np.uint64(m)

    def close(self) -> None:
        pass


class LatestAfterWait(StatefulProcessor):
    """Keep the latest version per key (max time as text, ties to the later
    arrival) and emit it when a timer ``wait_ms`` after the first version fires, then forget it. The clock is event time
    (``ts``), or with ``processing`` the machine's, as in the reference. With ``stamped`` a row carries the moment its
    timer was set for as ``et``."""

    def __init__(self, ts: str, seq: str, columns: list[str], wait_ms: int = 5000, processing: bool = False,
                 stamped: bool = False):
        self.ts, self.seq, self.columns, self.wait_ms = ts, seq, columns, wait_ms
        self.processing, self.stamped = processing, stamped

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", ", ".join(f"{c} string" for c in self.columns))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        cur = self.last.get()
        ts_i = self.columns.index(self.ts)
        for rec in map(_text, _records(rows, self.columns, self.seq)):
            if cur is None:
                now = timerValues.getCurrentProcessingTimeInMs() if self.processing else int(rec[ts_i])
                self.handle.registerTimer(now + self.wait_ms)
                cur = rec
            elif rec[ts_i] >= cur[ts_i]:
                cur = rec
        if cur is not None:
            self.last.update(tuple(cur))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if (held := self.last.get()) is not None:
            rec = list(held)
            self.last.clear()
            out = pd.DataFrame([rec], columns=self.columns)
            if self.stamped:
                out["et"] = _moments([expiredTimerInfo.getExpiryTimeInMs()])
            yield out

    def close(self) -> None:
        pass


class ClockWindowSums(StatefulProcessor):
    """Sums of decimal columns per key in tumbling windows of the machine's clock; a window comes out by a
    processing-time timer at its end. State: the sums of the open windows, as text."""

    def __init__(self, window_ms: int, columns: list[str]):
        self.window_ms, self.columns = window_ms, columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.sums = handle.getMapState("sums", "w bigint", ", ".join(f"{c} string" for c in self.columns))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        from decimal import Decimal
        df = _rows(rows, [])
        if df.empty:
            return iter([])
        now = timerValues.getCurrentProcessingTimeInMs()
        start = now - now % self.window_ms
        if self.sums.containsKey((start,)):
            total = [Decimal(x) for x in self.sums.getValue((start,))]
        else:
            total = [Decimal(0)] * len(self.columns)
            self.handle.registerTimer(start + self.window_ms)
        for i, c in enumerate(self.columns):
            total[i] += sum((Decimal(x) for x in df[c] if x is not None), Decimal(0))
        self.sums.updateValue((start,), tuple(str(x) for x in total))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        from decimal import Decimal
        start = expiredTimerInfo.getExpiryTimeInMs() - self.window_ms
        if self.sums.containsKey((start,)):
            total = [Decimal(x) for x in self.sums.getValue((start,))]
            self.sums.removeKey((start,))
            yield pd.DataFrame([[start, key[0], *total]])

    def close(self) -> None:
        pass


class RunningProfile(StatefulProcessor):
    """Running record count and sorted distinct value sets per uid, in the order of ``order``."""

    FIELDS = ["os", "ch", "md", "ba", "search_item"]

    def __init__(self, order: list[str]):
        self.order = order

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.pv = handle.getValueState("pv", "n long")
        self.sets = handle.getMapState("sets", "field string", "vals array<string>")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        df = _rows(rows, self.order)
        if df.empty:
            return
        pv = self.pv.get()[0] if self.pv.exists() else 0
        sets = {f: set(self.sets.getValue((f,))[0]) if self.sets.containsKey((f,)) else set() for f in self.FIELDS}
        out = []
        for r in df.itertuples(index=False):
            pv += 1
            for f in self.FIELDS:
                v = getattr(r, f)
                if v is not None and not (isinstance(v, float) and pd.isna(v)):
                    sets[f].add(v)
            out.append((key[0], int(r.ts), pv, *[",".join(sorted(sets[f])) for f in self.FIELDS]))
        self.pv.update((pv,))
        for f in self.FIELDS:
            self.sets.updateValue((f,), (sorted(sets[f]),))
        yield pd.DataFrame(out, columns=["uid", "ts_ms", "pv", *self.FIELDS])

    def close(self) -> None:
        pass
