"""Star schema: dimension rows and fact rows as frames.

Joins to dimensions carry no broadcast hint. Spark broadcasts a dimension as long as its size is
below `spark.sql.autoBroadcastJoinThreshold`, and otherwise uses a shuffled join with skew handling.
A dimension narrowed to one literal value is a scalar subquery, not a join.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from wicklake.functions import text, time as tm
from wicklake.operators.clean import lookback
from wicklake.operators.ids import assign_ids
from wicklake.operators.merge import absent_rows, merge_rows
from wicklake.operators.summary import daily_summary
from wicklake.schemas import (
    DIM_DATA_SOURCE, DIM_DATE, DIM_INTERVAL, DIM_PATTERN_TYPE, DIM_SYMBOL, FACT_ALERT, FACT_DAILY,
    FACT_INDICATOR, FACT_KLINE,
)

# Source codes, and the default market of a symbol.
BATCH_SOURCE = "batch_silver"
HOT_SOURCE = "speed_hot"
MARKET_TYPE = "spot"
MONTH_DAYS = 30

# Columns a hot refresh changes on a candle that is not final yet.
HOT_KLINE_COLUMNS = [
    "date_id", "open_ts", "close_time", "close_ts", "open_price", "high_price", "low_price",
    "close_price", "volume", "data_source_id", "updated_at",
]
# Columns a refresh changes on an indicator row; date_id and open_ts stay.
INDICATOR_UPDATE_COLUMNS = [
    "close_price", "sma7", "sma25", "rsi14", "macd", "macd_signal", "macd_hist", "updated_at",
]


def largest(dim: DataFrame, column: str) -> Column:
    return dim.agg(F.max(column)).scalar()


def id_of(dim: DataFrame, column: str, code_column: str, code: str) -> Column:
    """Id of one code as a scalar subquery; NULL where the dimension lacks it."""
    return dim.where(F.col(code_column) == code).agg(F.max(column)).scalar()


# --- dimensions ----------------------------------------------------------------------------------

def _numbered(rows: DataFrame, dim: DataFrame, id_column: str, key: str) -> DataFrame:
    """Ids for new rows after the largest existing one, in key order. Equal starts share a level."""
    levelled = rows.withColumn("_start", F.left(F.col(key), F.lit(2)))
    return assign_ids(levelled, id_column, largest(dim, id_column), ["_start"], [key]).drop("_start")


def _numbered_codes(rows: DataFrame, dim: DataFrame, id_column: str, key: str) -> DataFrame:
    """The same for codes spelled out by the caller, which fit into one task by their nature."""
    place = F.row_number().over(Window.orderBy(key)).cast("bigint")
    return rows.withColumn(id_column, place + F.coalesce(largest(dim, id_column), F.lit(0)))


def symbol_rows(names: DataFrame) -> DataFrame:
    symbol = F.col("symbol")
    return names.select("symbol").where(symbol.isNotNull()).distinct().select(
        "symbol", text.base_asset(symbol).alias("base_asset"), text.quote_asset(symbol).alias("quote_asset"))


def new_symbols(dim: DataFrame, names: DataFrame, as_of: datetime | str, exchange: str | None = None) -> DataFrame:
    """Rows for the symbols the dimension lacks, with the column defaults filled in."""
    fresh = symbol_rows(names).join(dim.select("symbol"), "symbol", "left_anti")
    return _numbered(fresh, dim, "symbol_id", "symbol").withColumns({
        "exchange": F.lit(exchange).cast("string"), "market_type": F.lit(MARKET_TYPE),
        "is_active": F.lit(True), "created_at": tm.as_of_ts(as_of),
    }).select(*DIM_SYMBOL.names)


def upsert_symbols(dim: DataFrame, names: DataFrame, as_of: datetime | str, exchange: str | None = None) -> DataFrame:
    """The whole dimension after a batch upsert: known symbols get their assets and active flag again."""
    named = symbol_rows(names).withColumn("is_active", F.lit(True))
    source = named.select(*[
        F.col(c) if c in named.columns else F.lit(None).cast(kind).alias(c) for c, kind in DIM_SYMBOL.columns])
    known = merge_rows(
        dim, source.join(dim.select("symbol"), "symbol", "left_semi").select(*DIM_SYMBOL.names),
        DIM_SYMBOL.key, update=["base_asset", "quote_asset", "is_active"])
    return known.unionByName(new_symbols(dim, names, as_of, exchange))


def date_rows(dates: DataFrame, column: str = "date_id") -> DataFrame:
    day = F.col("date_id")
    weekday = (F.weekday(day) + 1).cast("int")
    return dates.select(F.col(column).cast("date").alias("date_id")).where(day.isNotNull()).distinct().select(
        "date_id", F.year(day).alias("year"), F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"), F.quarter(day).alias("quarter"),
        weekday.alias("day_of_week"), weekday.isin(6, 7).alias("is_weekend"))


def upsert_dates(dim: DataFrame, dates: DataFrame, column: str = "date_id") -> DataFrame:
    return merge_rows(dim, date_rows(dates, column), DIM_DATE.key)


def new_dates(dim: DataFrame, dates: DataFrame, column: str = "date_id") -> DataFrame:
    return absent_rows(date_rows(dates, column), dim, DIM_DATE.key)


def new_intervals(spark: SparkSession, dim: DataFrame, codes: Sequence[str]) -> DataFrame:
    """Rows for new interval codes. A calendar month has no fixed length and counts as 30 days here."""
    code = F.col("interval_code")
    days = F.when(code.endswith("M"), F.regexp_replace(code, "M$", "d"))
    months = tm.interval_seconds(days) * MONTH_DAYS
    named = spark.createDataFrame([(c,) for c in sorted(set(codes))], "interval_code string")
    rows = named.withColumn(
        "interval_seconds", F.coalesce(tm.interval_seconds(code), months))
    fresh = rows.join(dim.select("interval_code"), "interval_code", "left_anti")
    return _numbered_codes(fresh, dim, "interval_id", "interval_code").select(*DIM_INTERVAL.names)


def new_sources(spark: SparkSession, dim: DataFrame) -> DataFrame:
    rows = spark.createDataFrame(
        [(BATCH_SOURCE, "Final history from the silver table"), (HOT_SOURCE, "Recent rows from the stream")],
        "source_code string, description string")
    fresh = rows.join(dim.select("source_code"), "source_code", "left_anti")
    return _numbered_codes(fresh, dim, "data_source_id", "source_code").select(*DIM_DATA_SOURCE.names)


def new_patterns(dim: DataFrame, alerts: DataFrame) -> DataFrame:
    rows = alerts.select("pattern_type").where(F.col("pattern_type").isNotNull()).distinct()
    fresh = rows.join(dim.select("pattern_type"), "pattern_type", "left_anti")
    return _numbered(fresh, dim, "pattern_type_id", "pattern_type").withColumn(
        "description", F.lit(None).cast("string")).select(*DIM_PATTERN_TYPE.names)


# --- facts ---------------------------------------------------------------------------------------

def _with_ids(rows: DataFrame, dim_symbol: DataFrame, dim_interval: DataFrame) -> DataFrame:
    codes = dim_interval.select("interval_id", F.col("interval_code").alias("interval"))
    return rows.join(dim_symbol.select("symbol_id", "symbol"), "symbol").join(codes, "interval")


def kline_facts(
    silver: DataFrame, dim_symbol: DataFrame, dim_interval: DataFrame, dim_source: DataFrame,
    as_of: datetime | str,
) -> DataFrame:
    """Final candles from silver."""
    return _with_ids(silver, dim_symbol, dim_interval).withColumns({
        "date_id": F.col("trade_date"),
        "data_source_id": id_of(dim_source, "data_source_id", "source_code", BATCH_SOURCE),
        "is_final": F.lit(True),
        "updated_at": tm.as_of_ts(as_of),
    }).select(*FACT_KLINE.names)


def daily_facts(
    silver: DataFrame, dim_symbol: DataFrame, dim_interval: DataFrame, as_of: datetime | str,
) -> DataFrame:
    return _with_ids(daily_summary(silver), dim_symbol, dim_interval).withColumns({
        "date_id": F.col("trade_date"), "updated_at": tm.as_of_ts(as_of),
    }).select(*FACT_DAILY.names)


def _hot_ids(rows: DataFrame, dim_symbol: DataFrame, dim_interval: DataFrame, interval: str) -> DataFrame:
    joined = rows.join(dim_symbol.select("symbol_id", "symbol"), "symbol").withColumn(
        "interval_id", id_of(dim_interval, "interval_id", "interval_code", interval))
    return joined.where(F.col("interval_id").isNotNull())


def hot_kline_facts(
    hot: DataFrame, dim_symbol: DataFrame, dim_interval: DataFrame, dim_source: DataFrame,
    as_of: datetime | str, hours: int | None = 48, interval: str = "1m",
) -> DataFrame:
    """Candles from the stream: not final, and without the measures only the batch knows."""
    padded = {
        name: F.lit(None).cast(kind) for name, kind in FACT_KLINE.columns
        if name in ("quote_asset_volume", "number_of_trades", "taker_buy_base_volume", "taker_buy_quote_volume")}
    recent = lookback(hot, as_of, hours)
    return _hot_ids(recent, dim_symbol, dim_interval, interval).withColumns({
        "date_id": tm.utc_date(F.col("open_time")),
        "open_ts": tm.ts_millis(F.col("open_time")),
        "close_ts": tm.ts_millis(F.col("close_time")),
        "data_source_id": id_of(dim_source, "data_source_id", "source_code", HOT_SOURCE),
        "is_final": F.lit(False),
        "updated_at": tm.as_of_ts(as_of),
        **padded,
    }).select(*FACT_KLINE.names)


def indicator_facts(
    hot: DataFrame, dim_symbol: DataFrame, dim_interval: DataFrame,
    as_of: datetime | str, hours: int | None = 48, interval: str = "1m",
) -> DataFrame:
    recent = lookback(hot, as_of, hours)
    return _hot_ids(recent, dim_symbol, dim_interval, interval).withColumns({
        "date_id": tm.utc_date(F.col("open_time")),
        "open_ts": tm.ts_millis(F.col("open_time")),
        "updated_at": tm.as_of_ts(as_of),
    }).select(*FACT_INDICATOR.names)


def alert_rows(
    alerts: DataFrame, dim_symbol: DataFrame, dim_pattern: DataFrame, as_of: datetime | str, hours: int | None = 48,
) -> DataFrame:
    """Alert facts still without an id; without `hours` all of them."""
    recent = lookback(alerts, as_of, hours, "close_time")
    joined = recent.join(dim_symbol.select("symbol_id", "symbol"), "symbol").join(
        dim_pattern.select("pattern_type_id", "pattern_type"), "pattern_type")
    return joined.withColumns({
        "date_id": tm.utc_date(F.col("close_time")),
        "close_ts": tm.ts_millis(F.col("close_time")),
        "created_at": tm.as_of_ts(as_of),
    }).select(*[c for c in FACT_ALERT.names if c != "alert_id"])


def new_alerts(rows: DataFrame, fact: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Alerts whose key is new, numbered by date, symbol, time, pattern and price.

    `existing` narrows the key lookup to part of the fact table, `fact` gives the largest id.
    """
    fresh = absent_rows(rows, fact if existing is None else existing, FACT_ALERT.key)
    return assign_ids(
        fresh, "alert_id", largest(fact, "alert_id"), ["date_id", "symbol_id"],
        ["close_time", "pattern_type_id", "close_price"]).select(*FACT_ALERT.names)
