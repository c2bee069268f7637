"""Daily figures."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, functions as F

from wicklake.operators.clean import on_day


def daily_summary(df: DataFrame, keys: Sequence[str] = ("trade_date", "symbol", "interval")) -> DataFrame:
    """Open, high, low, close, volume and derived measures per day and series.

    Open and close belong to the first and last candle, also when they are NULL there.
    """
    days = df.groupBy(*keys).agg(
        F.min_by("open_price", "open_time").alias("open_price"),
        F.max("high_price").alias("high_price"),
        F.min("low_price").alias("low_price"),
        F.max_by("close_price", "open_time").alias("close_price"),
        F.sum("volume").alias("total_volume"),
        F.count(F.lit(1)).alias("number_of_candles"),
    )
    change = F.col("close_price") - F.col("open_price")
    return days.select(
        *keys, "open_price", "high_price", "low_price", "close_price", "total_volume",
        change.alias("price_change"),
        (F.try_divide(change, F.col("open_price")) * 100.0).alias("price_change_pct"),
        (F.col("high_price") - F.col("low_price")).alias("daily_range"),
        "number_of_candles",
    )


def day_row_counts(df: DataFrame, day: date | str) -> DataFrame:
    """Run report: rows per symbol on one day, by symbol."""
    counts = on_day(df, day).groupBy("symbol").agg(F.count(F.lit(1)).alias("row_count"))
    return counts.orderBy("symbol")


def day_total(df: DataFrame, day: date | str) -> DataFrame:
    return on_day(df, day).agg(F.count(F.lit(1)).alias("row_count"))
