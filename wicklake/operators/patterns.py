"""Candlestick patterns. Works on batch and streaming frames alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wicklake.functions import candle


def candle_geometry(df: DataFrame) -> DataFrame:
    return df.select(
        "*", candle.body().alias("body"), candle.full_range().alias("full_range"),
        candle.lower_shadow().alias("lower_shadow"), candle.upper_shadow().alias("upper_shadow"))


def classify(df: DataFrame) -> DataFrame:
    return df.withColumn("pattern_type", candle.pattern_type())


def pattern_alerts(df: DataFrame) -> DataFrame:
    """Closed candles with a real range that show one of the two patterns."""
    hits = df.where(
        F.col("is_closed") & (F.col("high_price") > F.col("low_price"))
        & (candle.is_doji() | candle.is_hammer()))
    return classify(hits)
