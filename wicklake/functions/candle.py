"""Shape of a single candle."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Pattern names and thresholds.
DOJI = "DOJI"
HAMMER = "HAMMER"
UNKNOWN = "UNKNOWN"
DOJI_BODY_SHARE = 0.1
HAMMER_LOWER_MULTIPLE = 2
HAMMER_UPPER_SHARE = 0.1


def body() -> Column:
    return F.abs(F.col("close_price") - F.col("open_price"))


def full_range() -> Column:
    return F.col("high_price") - F.col("low_price")


def lower_shadow() -> Column:
    return F.least("open_price", "close_price") - F.col("low_price")


def upper_shadow() -> Column:
    return F.col("high_price") - F.greatest("open_price", "close_price")


def is_doji() -> Column:
    return body() <= full_range() * DOJI_BODY_SHARE


def is_hammer() -> Column:
    return (lower_shadow() >= body() * HAMMER_LOWER_MULTIPLE) & (upper_shadow() <= body() * HAMMER_UPPER_SHARE)


def pattern_type() -> Column:
    return F.when(is_doji(), DOJI).when(is_hammer(), HAMMER).otherwise(UNKNOWN)
