"""Keyed state of the stream indicators.

This module imports nothing from the package: it travels to the workers by value, so the package need
not be installed there.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle


# A backlog is emitted in frames of so many rows; the closes a frame needs are carried over.
FRAME_ROWS = 10_000
# Candles wait in buckets of so much open time: 60 candles of a minute, which a trigger that adds one to them writes anew.
BUCKET_MS = 3_600_000


class Lengths(NamedTuple):
    """Frame lengths in candles, and how many earlier candles the values of the next one depend on."""

    sma_short: int
    sma_long: int
    rsi: int
    fast: int
    slow: int
    signal: int
    history: int


def _means(values: np.ndarray, length: int) -> np.ndarray:
    """Mean of the last `length` values at every position, over the values that exist."""
    padded = np.concatenate([np.full(length - 1, np.nan), values])
    windows = np.lib.stride_tricks.sliding_window_view(padded, length)
    present = ~np.isnan(windows)
    counts = present.sum(axis=1)
    totals = np.where(present, windows, 0.0).sum(axis=1)
    return np.divide(totals, counts, out=np.full(len(values), np.nan), where=counts > 0)


def indicator_values(closes: np.ndarray, n: Lengths) -> dict[str, np.ndarray]:
    """All indicators for a run of closes, oldest first."""
    diff = np.concatenate([[np.nan], np.diff(closes)])[: len(closes)]
    gain = _means(np.where(diff > 0, diff, 0.0), n.rsi)
    loss = _means(np.where(diff < 0, -diff, 0.0), n.rsi)
    with np.errstate(divide="ignore", invalid="ignore"):
        rsi = np.where(loss == 0, 100.0, 100.0 - 100.0 / (1.0 + gain / loss))
    macd = _means(closes, n.fast) - _means(closes, n.slow)
    signal = _means(macd, n.signal)
    return {
        "sma7": _means(closes, n.sma_short), "sma25": _means(closes, n.sma_long), "rsi14": rsi,
        "macd": macd, "macd_signal": signal, "macd_hist": macd - signal,
    }


def _event_ms(open_time: int) -> int:
    return open_time // 1000 * 1000


class IndicatorProcessor(StatefulProcessor):
    """Waits until the watermark passes a candle, then emits candles in time order.

    Candles wait in buckets of BUCKET_MS of open time, so a timer reads the buckets it can emit from and leaves the rest of
    a backlog unread. `past` holds the closes that the next values depend on and the open time of the last of them; a symbol
    may start with those of its history.
    """

    def __init__(self, lengths: Lengths, bucket_ms: int = BUCKET_MS) -> None:
        self.lengths, self.bucket_ms = tuple(lengths), bucket_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.past = handle.getValueState("past", "closes array<double>, last bigint")
        self.waiting = handle.getMapState("waiting", "bucket bigint", "open_times array<bigint>, closes array<double>")
        self.buckets = handle.getValueState("buckets", "numbers array<bigint>")

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        closes, last = initialState["closes"].iloc[0], initialState["last"].iloc[0]
        self.past.update(([None if c is None or np.isnan(c) else float(c) for c in closes], int(last)))

    def _numbers(self) -> list[int]:
        return list(self.buckets.get()[0]) if self.buckets.exists() else []

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        after = timerValues.getCurrentWatermarkInMs()
        last = self.past.get()[1] if self.past.exists() else -1
        new: dict[int, tuple[list, list]] = {}
        for pdf in rows:
            # Spark filters late rows by the previous batch's watermark, so look again.
            pdf = pdf[(pdf["open_time"] // 1000 * 1000 > after) & (pdf["open_time"] > last)]
            for bucket, part in pdf.groupby(pdf["open_time"] // self.bucket_ms, sort=False):
                times, closes = new.setdefault(int(bucket), ([], []))
                times += part["open_time"].tolist()
                closes += [None if np.isnan(c) else c for c in part["close_price"].astype("float64").tolist()]
        if not new:
            return iter([])
        numbers = self._numbers()
        known = set(numbers)
        for bucket, (times, closes) in new.items():
            if bucket in known:
                held_times, held_closes = self.waiting.getValue((bucket,))
                times, closes = [*held_times, *times], [*held_closes, *closes]
            self.waiting.updateValue((bucket,), (times, closes))
        if not known.issuperset(new):
            self.buckets.update((sorted(known.union(new)),))
        self._wake_after(_event_ms(min(min(times) for times, _ in new.values())))
        return iter([])

    def _wake_after(self, event_ms: int) -> None:
        due = event_ms + 1
        for timer in list(self.handle.listTimers()):
            if timer <= due:
                return
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(due)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs()
        numbers, ready, done = self._numbers(), [], 0
        left: dict[int, float | None] = {}
        for bucket in numbers:
            if _event_ms(bucket * self.bucket_ms) > watermark:
                break
            # Of a candle that came more than once the last one counts.
            held = dict(zip(*self.waiting.getValue((bucket,))))
            ready += sorted((t, c) for t, c in held.items() if _event_ms(t) <= watermark)
            left = {t: c for t, c in held.items() if _event_ms(t) > watermark}
            if left:
                self.waiting.updateValue((bucket,), (list(left), list(left.values())))
                break
            self.waiting.removeKey((bucket,))
            done += 1
            while len(ready) >= FRAME_ROWS:
                yield self._emit(key, ready[:FRAME_ROWS])
                ready = ready[FRAME_ROWS:]
        for first in range(0, len(ready), FRAME_ROWS):
            yield self._emit(key, ready[first:first + FRAME_ROWS])
        if done < len(numbers):
            if done:
                self.buckets.update((numbers[done:],))
            # Of a bucket that is not read yet only the start is known; a timer there finds what it holds.
            due = _event_ms(min(left) if left else numbers[done] * self.bucket_ms) + 1
            if due not in list(self.handle.listTimers()):
                self.handle.registerTimer(due)
        else:
            self.buckets.clear()

    def _emit(self, key, ready) -> pd.DataFrame:
        past = list(self.past.get()[0]) if self.past.exists() else []
        closes = np.array(past + [close for _, close in ready], dtype="float64")
        values = indicator_values(closes, Lengths(*self.lengths))
        n = len(ready)
        kept = [None if np.isnan(c) else float(c) for c in closes[-Lengths(*self.lengths).history:]]
        self.past.update((kept, ready[-1][0]))
        out = pd.DataFrame({
            "symbol": [key[0]] * n, "open_time": [t for t, _ in ready], "close_price": closes[-n:],
            **{name: column[-n:] for name, column in values.items()}})
        return out.astype(object).where(out.notna(), None) if out.isna().to_numpy().any() else out

    def close(self) -> None:
        pass
