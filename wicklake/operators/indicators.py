"""Technical indicators over closed candles.

All means take the rows that exist, so the first rows of a series are not NULL. RSI uses plain
means of gains and losses; MACD is a difference of two plain means.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from wicklake.functions.time import interval_seconds
from wicklake.operators import rolling
from wicklake.operators.rows import dedup_latest, latest_by

# Frame lengths in candles.
SMA_SHORT = 7
SMA_LONG = 25
RSI_LENGTH = 14
MACD_FAST = 12
MACD_SLOW = 26
MACD_SIGNAL = 9

SERIES = ("symbol", "interval")
INDICATOR_COLUMNS = ["sma7", "sma25", "rsi14", "macd", "macd_signal", "macd_hist"]

# Rows before a candle that its values depend on.
SMA_HISTORY = SMA_LONG - 1
RSI_HISTORY = RSI_LENGTH
MACD_HISTORY = (MACD_SLOW - 1) + (MACD_SIGNAL - 1)

ROWS_PER_CHUNK = 1440
_NO_FIXED_LENGTH_SECONDS = 2_592_000


def closed_candles(df: DataFrame, key: Sequence[str] = (*SERIES, "open_time")) -> DataFrame:
    """Finished candles, one per key."""
    return dedup_latest(df.where("is_closed"), key)


class _Series:
    """Window expressions over one series."""

    def __init__(self, window):
        self.window = window

    def mean(self, value: str | Column, length: int) -> Column:
        """Mean over the current and the `length` - 1 preceding rows, as far as they exist."""
        return F.avg(value).over(self.window.rowsBetween(1 - length, 0))

    def price_diff(self) -> Column:
        """Difference to the previous candle. A two-row frame was measurably faster here than `lag`."""
        pair = self.window.rowsBetween(-1, 0)
        has_previous = F.count(F.lit(1)).over(pair) > 1
        return F.when(has_previous, F.col("close_price") - F.first("close_price").over(pair))


def _over_series(
    df: DataFrame, history: int, build: Callable[[DataFrame, _Series], DataFrame],
    keys: Sequence[str], rows_per_chunk: int | None,
) -> DataFrame:
    """Run `build` on the series in `df`; `rows_per_chunk=None` uses one window task per series."""
    if rows_per_chunk is None:
        return build(df, _Series(rolling.series_window(keys, "open_time", chunked=False)))
    if "interval" in keys:
        step = F.coalesce(interval_seconds(F.col("interval")), F.lit(_NO_FIXED_LENGTH_SECONDS))
    else:
        step = F.lit(60)
    width = step.cast("bigint") * 1000 * rows_per_chunk
    parts = rolling.with_history(
        df, keys, "open_time", ["close_price"], history, rolling.by_time("open_time", width))
    built = build(parts, _Series(rolling.series_window(keys, "open_time", chunked=True)))
    return built.where(~F.col(rolling.HISTORY)).drop(rolling.HISTORY, rolling.CHUNK)


def _gain() -> Column:
    return F.when(F.col("price_diff") > 0, F.col("price_diff")).otherwise(0.0)


def _loss() -> Column:
    return F.when(F.col("price_diff") < 0, F.abs("price_diff")).otherwise(0.0)


def _rsi(gain: Column, loss: Column) -> Column:
    return F.when(loss == 0, 100.0).otherwise(100.0 - F.try_divide(F.lit(100.0), 1.0 + F.try_divide(gain, loss)))


def sma(df: DataFrame, keys: Sequence[str] = SERIES, rows_per_chunk: int | None = ROWS_PER_CHUNK) -> DataFrame:
    def build(rows, series):
        return rows.select(
            "*", series.mean("close_price", SMA_SHORT).alias("sma7"),
            series.mean("close_price", SMA_LONG).alias("sma25"))
    return _over_series(df, SMA_HISTORY, build, keys, rows_per_chunk)


def price_diff(df: DataFrame, keys: Sequence[str] = SERIES, rows_per_chunk: int | None = ROWS_PER_CHUNK) -> DataFrame:
    def build(rows, series):
        return rows.select("*", series.price_diff().alias("price_diff"))
    return _over_series(df, 1, build, keys, rows_per_chunk)


def rsi(df: DataFrame, keys: Sequence[str] = SERIES, rows_per_chunk: int | None = ROWS_PER_CHUNK) -> DataFrame:
    def build(rows, series):
        diff = rows.select("*", series.price_diff().alias("price_diff"))
        means = diff.select(
            "*", series.mean(_gain(), RSI_LENGTH).alias("avg_gain"),
            series.mean(_loss(), RSI_LENGTH).alias("avg_loss"))
        return means.withColumn("rsi14", _rsi(F.col("avg_gain"), F.col("avg_loss")))
    return _over_series(df, RSI_HISTORY, build, keys, rows_per_chunk)


def macd(df: DataFrame, keys: Sequence[str] = SERIES, rows_per_chunk: int | None = ROWS_PER_CHUNK) -> DataFrame:
    def build(rows, series):
        means = rows.select(
            "*", series.mean("close_price", MACD_FAST).alias("sma12"),
            series.mean("close_price", MACD_SLOW).alias("sma26"))
        line = means.withColumn("macd", F.col("sma12") - F.col("sma26"))
        signal = line.withColumn("macd_signal", series.mean("macd", MACD_SIGNAL))
        return signal.withColumn("macd_hist", F.col("macd") - F.col("macd_signal"))
    return _over_series(df, MACD_HISTORY, build, keys, rows_per_chunk)


def technical_indicators(
    df: DataFrame, keys: Sequence[str] = SERIES, rows_per_chunk: int | None = ROWS_PER_CHUNK,
) -> DataFrame:
    """Every indicator in two window passes over one shuffle and one sort.

    `df` holds closed candles, unique per `(keys, open_time)` (see `closed_candles`).
    """
    def build(rows, series):
        first = rows.select(
            "*",
            series.mean("close_price", SMA_SHORT).alias("sma7"),
            series.mean("close_price", SMA_LONG).alias("sma25"),
            series.mean("close_price", MACD_FAST).alias("_fast"),
            series.mean("close_price", MACD_SLOW).alias("_slow"),
            series.price_diff().alias("price_diff"))
        line = first.withColumn("macd", F.col("_fast") - F.col("_slow"))
        second = line.select(
            "*",
            series.mean(_gain(), RSI_LENGTH).alias("_gain"),
            series.mean(_loss(), RSI_LENGTH).alias("_loss"),
            series.mean("macd", MACD_SIGNAL).alias("macd_signal"))
        return (
            second.withColumn("rsi14", _rsi(F.col("_gain"), F.col("_loss")))
            .withColumn("macd_hist", F.col("macd") - F.col("macd_signal"))
            .drop("_fast", "_slow", "_gain", "_loss", "price_diff"))
    narrow = df.select(*keys, "open_time", "close_price")
    built = _over_series(narrow, MACD_HISTORY, build, keys, rows_per_chunk)
    return built.select(*keys, "open_time", "close_price", *INDICATOR_COLUMNS)


def newest_indicators(df: DataFrame, keys: Sequence[str] = SERIES) -> DataFrame:
    """Every indicator of the newest candle of each series, from the candles it depends on.

    Spark drops all older candles in every task before the shuffle, so the history costs a scan.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("open_time").desc()))
    tail = df.select(*keys, "open_time", "close_price").withColumn("_rank", rank).where(F.col("_rank") <= MACD_HISTORY + 1)
    values = technical_indicators(tail.drop("_rank"), keys, rows_per_chunk=None)
    return latest_by(values, keys, "open_time").select(*keys, "open_time", "close_price", *INDICATOR_COLUMNS)
