"""The four serving queries over the star schema."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from wicklake.functions import time as tm
from wicklake.operators.clean import since_hours
from wicklake.operators.rows import latest_by


def kline_unified(fact: DataFrame, dim_symbol: DataFrame, dim_interval: DataFrame, dim_source: DataFrame) -> DataFrame:
    return (
        fact.join(dim_symbol.select("symbol_id", "symbol"), "symbol_id")
        .join(dim_interval.select("interval_id", "interval_code"), "interval_id")
        .join(dim_source.select("data_source_id", "source_code"), "data_source_id", "left")
        .select(
            "symbol", "interval_code", F.col("date_id").alias("trade_date"), "open_time", "open_ts",
            "close_time", "close_ts", "open_price", "high_price", "low_price", "close_price", "volume",
            "quote_asset_volume", "number_of_trades", F.col("source_code").alias("data_source"),
            "is_final", "updated_at"))


def daily_market_summary(fact: DataFrame, dim_symbol: DataFrame, dim_interval: DataFrame) -> DataFrame:
    return (
        fact.join(dim_symbol.select("symbol_id", "symbol"), "symbol_id")
        .join(dim_interval.select("interval_id", "interval_code"), "interval_id")
        .select(
            F.col("date_id").alias("trade_date"), "symbol", "interval_code", "open_price", "high_price",
            "low_price", "close_price", "total_volume", "price_change", "price_change_pct",
            "daily_range", "number_of_candles", "updated_at"))


def latest_snapshot(
    fact: DataFrame, dim_symbol: DataFrame, dim_interval: DataFrame, dim_source: DataFrame,
    indicators: DataFrame,
) -> DataFrame:
    """Latest candle of every series with its indicators, which are found by series and open time.

    `fact` and `indicators` are the facts, or the tables that the jobs keep beside them: the newest candles and their indicators,
    which give the same rows and have one a series.
    """
    keys = ["symbol_id", "interval_id"]
    latest = latest_by(
        fact, keys, "open_time",
        ["date_id", "open_ts", "close_price", "volume", "data_source_id", "is_final", "updated_at"])
    values = indicators.select(*keys, "open_time", "sma7", "sma25", "rsi14", "macd", "macd_signal", "macd_hist")
    return (
        latest.join(values, [*keys, "open_time"], "left")
        .join(dim_symbol.select("symbol_id", "symbol"), "symbol_id")
        .join(dim_interval.select("interval_id", "interval_code"), "interval_id")
        .join(dim_source.select("data_source_id", "source_code"), "data_source_id", "left")
        .select(
            "symbol", "interval_code", "open_time", "open_ts", "close_price", "volume",
            F.col("source_code").alias("data_source"), "is_final", "sma7", "sma25", "rsi14", "macd",
            "macd_signal", "macd_hist", "updated_at"))


def recent_alerts(
    fact: DataFrame, dim_symbol: DataFrame, dim_date: DataFrame, dim_pattern: DataFrame,
    as_of: datetime | str, hours: int = 24,
) -> DataFrame:
    """Alerts of the last hours. The date bound follows from the time bound and prunes partitions."""
    first_day = F.to_date(tm.as_of_ts(as_of) - F.make_dt_interval(hours=F.lit(hours)))
    recent = fact.where(since_hours(F.col("close_ts"), as_of, hours) & (F.col("date_id") >= first_day))
    return (
        recent.join(dim_symbol.select("symbol_id", "symbol"), "symbol_id")
        .join(dim_date.select("date_id"), "date_id")
        .join(dim_pattern.select("pattern_type_id", "pattern_type"), "pattern_type_id")
        .select(
            "symbol", F.col("date_id").alias("trade_date"), "pattern_type", "close_time", "close_ts",
            "close_price", "created_at"))


def create(spark: SparkSession, gold: str) -> None:
    """The four queries as views of the catalog, beside the tables; the recent alerts move with the clock."""
    symbol = f"JOIN {gold}.dim_symbol s USING (symbol_id)"
    interval = f"JOIN {gold}.dim_interval i USING (interval_id)"
    source = f"LEFT JOIN {gold}.dim_data_source d USING (data_source_id)"
    spark.sql(f"""CREATE OR REPLACE VIEW {gold}.vw_kline_unified AS
        SELECT symbol, interval_code, date_id AS trade_date, open_time, open_ts, close_time, close_ts, open_price, high_price, low_price,
               close_price, volume, quote_asset_volume, number_of_trades, source_code AS data_source, is_final, updated_at
        FROM {gold}.fact_kline {symbol} {interval} {source}""")
    spark.sql(f"""CREATE OR REPLACE VIEW {gold}.vw_daily_market_summary AS
        SELECT date_id AS trade_date, symbol, interval_code, open_price, high_price, low_price, close_price, total_volume, price_change,
               price_change_pct, daily_range, number_of_candles, updated_at
        FROM {gold}.fact_daily_market_summary {symbol} {interval}""")
    spark.sql(f"""CREATE OR REPLACE VIEW {gold}.vw_latest_market_snapshot AS
        SELECT symbol, interval_code, open_time, f.open_ts, f.close_price, volume, source_code AS data_source, is_final, sma7, sma25, rsi14,
               macd, macd_signal, macd_hist, f.updated_at
        FROM {gold}.latest_kline f
        LEFT JOIN {gold}.latest_indicator USING (symbol_id, interval_id, open_time) {symbol} {interval} {source}""")
    spark.sql(f"""CREATE OR REPLACE VIEW {gold}.vw_pattern_alerts_recent AS
        SELECT symbol, date_id AS trade_date, pattern_type, close_time, close_ts, close_price, a.created_at
        FROM {gold}.fact_pattern_alert a {symbol} JOIN {gold}.dim_date USING (date_id)
        JOIN {gold}.dim_pattern_type USING (pattern_type_id)
        WHERE close_ts >= current_timestamp() - INTERVAL 24 HOURS AND date_id >= to_date(current_timestamp() - INTERVAL 24 HOURS)""")


def register(spark: SparkSession, gold: str, as_of: datetime | str) -> None:
    """The four queries as temporary views over the tables of a gold namespace."""
    t = {name: spark.table(f"{gold}.{name}") for name in (
        "dim_symbol", "dim_interval", "dim_date", "dim_data_source", "dim_pattern_type", "fact_kline", "latest_kline",
        "fact_daily_market_summary", "latest_indicator", "fact_pattern_alert")}
    kline_unified(t["fact_kline"], t["dim_symbol"], t["dim_interval"], t["dim_data_source"]) \
        .createOrReplaceTempView("vw_kline_unified")
    daily_market_summary(t["fact_daily_market_summary"], t["dim_symbol"], t["dim_interval"]) \
        .createOrReplaceTempView("vw_daily_market_summary")
    latest_snapshot(
        t["latest_kline"], t["dim_symbol"], t["dim_interval"], t["dim_data_source"],
        t["latest_indicator"]).createOrReplaceTempView("vw_latest_market_snapshot")
    recent_alerts(t["fact_pattern_alert"], t["dim_symbol"], t["dim_date"], t["dim_pattern_type"], as_of) \
        .createOrReplaceTempView("vw_pattern_alerts_recent")
