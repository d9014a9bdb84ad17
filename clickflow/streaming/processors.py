"""Keyed stateful processors (transformWithState, pandas flavour).

Used where the result depends on per-key state plus event-time timers (E10),
on the watermark seen by each element (P11), or as the keyed-processor forms of
E5 and K8 (the registered streams use state-free plans for those).  State per
key is one value (pending ticks / timer times as short arrays), so each key
costs a few state calls per micro-batch; rows arrive as pandas batches.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql.streaming.stateful_processor import (
    ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues,
)

from clickflow.operators.changelog import INSERT, UPDATE_AFTER, UPDATE_BEFORE

CHANGELOG_SCHEMA = "seq long, pos int, op string, url string, n long"
TIMER_SCHEMA = "user_id long, kind string, at_ms long"
PERIODIC_SCHEMA = "user_id long, tick long, pv long"


def _concat(rows: Iterator[pd.DataFrame]) -> pd.DataFrame:
    parts = list(rows)
    return parts[0] if len(parts) == 1 else pd.concat(parts, ignore_index=True)


class ChangelogCounter(StatefulProcessor):
    """K8: per key a running count; each input row emits ``+I`` (first) or
    ``-U`` old / ``+U`` new, in arrival (``seq``) order."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.count = handle.getValueState("count", "n long")

    def handleInputRows(self, key, rows, timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        pdf = _concat(rows).sort_values("seq", kind="stable")
        base = (self.count.get() or (0,))[0]
        n = base + np.arange(1, len(pdf) + 1, dtype="int64")
        seq = pdf["seq"].to_numpy()
        after = pd.DataFrame({"seq": seq, "pos": np.where(n > 1, 1, 0).astype("int32"),
                              "op": np.where(n == 1, INSERT, UPDATE_AFTER), "url": key[0], "n": n})
        m = n > 1
        before = pd.DataFrame({"seq": seq[m], "pos": np.zeros(m.sum(), dtype="int32"),
                               "op": UPDATE_BEFORE, "url": key[0], "n": n[m] - 1})
        self.count.update((int(n[-1]),))
        yield pd.concat([before, after], ignore_index=True)

    def close(self) -> None:
        pass


class TimerPerEvent(StatefulProcessor):
    """E5: emit each arrival and fire an event-time timer at ts + delay (one
    per distinct time and key).

    Pending timer times are kept sorted in one value state and only the
    earliest is registered with Spark; a firing walks every pending time up to
    the watermark.  Output equals one registered timer per element, with a
    handful of state calls per key and batch instead of one per element.
    """

    def __init__(self, delay_ms: int):
        self.delay_ms = delay_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.pending = handle.getValueState("pending", "times array<long>, armed long")

    def handleInputRows(self, key, rows, timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        pdf = _concat(rows)
        ms = pdf["ms"].to_numpy(dtype="int64")
        old, armed = self.pending.get() or ([], None)
        times = np.union1d(np.asarray(old or [], dtype="int64"), ms + self.delay_ms)
        first = int(times[0])
        if armed is None or first < armed:
            if armed is not None:
                self.handle.deleteTimer(int(armed))
            self.handle.registerTimer(first)
            armed = first
        self.pending.update((times.tolist(), armed))
        yield pd.DataFrame({"user_id": key[0], "kind": "data", "at_ms": ms})

    def handleExpiredTimer(self, key, timerValues: TimerValues,
                           expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        wm = max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs())
        times, _ = self.pending.get()
        times = np.asarray(times, dtype="int64")
        due, rest = times[times <= wm], times[times > wm]
        if len(rest):
            self.handle.registerTimer(int(rest[0]))
            self.pending.update((rest.tolist(), int(rest[0])))
        else:
            self.pending.clear()
        yield pd.DataFrame({"user_id": key[0], "kind": "timer", "at_ms": due})

    def close(self) -> None:
        pass


class PeriodicCount(StatefulProcessor):
    """Cumulative clicks per key reported every ``period_ms`` from the
    key's first click.

    Timers fire once per micro-batch, after the batch's rows, so the reference
    loop (fire, print the count, re-arm +period) would report counts that
    include later clicks and only one tick per batch.  Instead each click is
    filed under the first tick at or after it; a firing timer walks every tick
    up to the watermark, emits the running total, drops those ticks and
    re-arms once.  All of it lives in one value state (pending ticks are
    those past the watermark, a short array), so each key costs a few state
    calls per batch.
    """

    def __init__(self, period_ms: int):
        self.period = period_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState(
            "state", "first long, next long, total long, ticks array<long>, counts array<long>")

    def handleInputRows(self, key, rows, timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        st = self.state.get()                  # None for a key seen for the first time
        if st is not None:
            first, nxt, total, ticks, counts = st
            chunks = rows                      # known key: fold rows in chunk by chunk
        else:
            chunks = list(rows)                # new key: its earliest click anchors the ticks
            first = int(min(int(c["ms"].min()) for c in chunks))
            nxt, total, ticks, counts = first + self.period, 0, [], []
            self.handle.registerTimer(nxt)
        pending = pd.Series(np.asarray(counts or [], dtype="int64"), index=np.asarray(ticks or [], dtype="int64"))
        for pdf in chunks:
            ms = pdf["ms"].to_numpy(dtype="int64")
            w = pdf["n"].to_numpy(dtype="int64") if "n" in pdf else np.ones(len(ms), dtype="int64")
            k = np.maximum(np.ceil((ms - first) / self.period), 1).astype("int64")
            new_t, inv = np.unique(first + k * self.period, return_inverse=True)
            new_c = np.bincount(inv, weights=w).astype("int64")
            pending = pending.add(pd.Series(new_c, index=new_t), fill_value=0)
        pending = pending.sort_index()
        self.state.update((first, nxt, total, pending.index.astype("int64").tolist(),
                           pending.to_numpy(dtype="int64").tolist()))
        return iter([])

    def handleExpiredTimer(self, key, timerValues: TimerValues,
                           expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        wm = max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs())
        first, t, total, ticks, counts = self.state.get()
        pending = dict(zip(ticks or [], counts or []))
        t = expiredTimerInfo.getExpiryTimeInMs()
        out_t, out_pv = [], []
        while t <= wm:
            total += pending.pop(t, 0)
            out_t.append(t)
            out_pv.append(total)
            t += self.period
        rest = sorted(pending.items())
        self.state.update((first, t, total, [a for a, _ in rest], [b for _, b in rest]))
        self.handle.registerTimer(t)
        yield pd.DataFrame({"user_id": key[0], "tick": out_t, "pv": out_pv})

    def close(self) -> None:
        pass


ELEMENT_WM_SCHEMA = "seq long, user_id long, ms long, watermark_ms long"


class ElementWatermark(StatefulProcessor):
    """Each element with its event time and the event-time watermark in
    force when it was processed (Spark advances it once per micro-batch).
    Keeps no state, so it can be grouped by any spreading key (a hash bucket),
    not by a possibly hot user."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        pass

    def handleInputRows(self, key, rows, timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        wm = timerValues.getCurrentWatermarkInMs()
        for pdf in rows:
            yield pd.DataFrame({"seq": pdf["seq"], "user_id": pdf["user_id"], "ms": pdf["ms"], "watermark_ms": wm})

    def close(self) -> None:
        pass


def combine_per_ms(stream_df, key: str = "user_id"):
    """Map-side combine before a keyed processor: each input partition's
    clicks become (key, ms, n) counts (stateless ``mapInPandas``), so a hot
    key's rows reach its state task as counts, not one row per click."""
    from pyspark.sql import functions as F

    def combine(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                yield pdf.groupby([key, "ms"], sort=False).size().reset_index(name="n")

    out = stream_df.select(key, "ms").mapInPandas(combine, f"{key} long, ms long, n long")
    return out.withColumn("ts", F.timestamp_millis("ms"))
