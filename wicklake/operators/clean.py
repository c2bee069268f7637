"""Bronze candles to silver rows, and the filters used on candles."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, functions as F

from wicklake.functions import time as tm
from wicklake.operators.rows import dedup_latest
from wicklake.schemas import SILVER


def clean_bronze(df: DataFrame) -> DataFrame:
    """Typed rows with derived times; rows lacking a key part or the close are dropped.

    Text that does not parse becomes NULL.
    """
    typed = {name: F.col(name).try_cast(kind) for name, kind in SILVER.columns if name in df.columns}
    # Through text first: an ISO-8601 string and a timestamp are both accepted.
    typed["ingest_ts"] = F.try_to_timestamp(F.col("ingest_ts").cast("string"))
    rows = df.select(*[value.alias(name) for name, value in typed.items()])
    derived = rows.select(
        "*", tm.ts_seconds(F.col("open_time")).alias("open_ts"),
        tm.ts_seconds(F.col("close_time")).alias("close_ts"),
    ).withColumn("trade_date", F.to_date("open_ts"))
    return derived.dropna(subset=list(SILVER.not_null)).select(*SILVER.names)


def silver_rows(bronze: DataFrame) -> DataFrame:
    """What goes into the silver table: clean rows, newest per key."""
    return dedup_latest(clean_bronze(bronze), SILVER.key)


def on_day(df: DataFrame, day: date | str, column: str = "trade_date") -> DataFrame:
    return df.where(F.col(column) == F.lit(tm.parse_day(day)))


def of_interval(df: DataFrame, code: str) -> DataFrame:
    return df.where(F.col("interval") == code)


def of_symbols(df: DataFrame, names: list[str]) -> DataFrame:
    return df.where(F.col("symbol").isin(names))


def in_days(df: DataFrame, start: date | str, end: date | str, column: str = "trade_date") -> DataFrame:
    return df.where(tm.in_day_range(F.col(column), start, end))


def lookback(df: DataFrame, as_of: datetime | str, hours: int | None = 48, column: str = "open_time") -> DataFrame:
    """Rows at most `hours` older than `as_of`, by epoch milliseconds; without `hours` all rows."""
    if hours is None:
        return df
    return df.where(F.col(column) >= F.lit(tm.as_of_ms(as_of) - hours * tm.HOUR_MS))


def since_hours(ts: Column, as_of: datetime | str, hours: int = 24) -> Column:
    return ts >= tm.as_of_ts(as_of) - F.make_dt_interval(hours=F.lit(hours))
