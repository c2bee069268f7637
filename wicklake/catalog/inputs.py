"""Candles and other inputs derived from the given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wicklake.functions import time as tm
from wicklake.operators.indicators import closed_candles, technical_indicators
from wicklake.operators.patterns import pattern_alerts
from wicklake.plans import star
from wicklake.schemas import (
    BRONZE, DIM_DATA_SOURCE, DIM_DATE, DIM_INTERVAL, DIM_PATTERN_TYPE, DIM_SYMBOL, SILVER, STREAM_CANDLE,
)
from wicklake.session import staged
from wicklake.sources.decode import EVENT_FIELDS, PAGE_ELEMENTS

AS_OF = "2024-01-31T00:00:00"
TARGET_END_MS = 1_705_708_800_000    # 2024-01-20
SOURCE_START_MS = 1_705_276_800_000  # 2024-01-15
EXCHANGE = "exchange"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def candles(spark: SparkSession, sf: str, step_ms: int = tm.HOUR_MS, code: str = "1h") -> DataFrame:
    """Silver candles from the event table: one symbol per event type."""
    suffix = F.when(F.col("event_type") == "error", "BTC").otherwise("USDT")
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    events = table(spark, sf, "events").select(
        F.concat(F.upper("event_type"), suffix).alias("symbol"),
        (ms - F.pmod(ms, F.lit(step_ms))).alias("open_time"), "event_id", "value", "ts")
    even = F.when(F.col("event_id") % 2 == 0, F.col("value")).otherwise(0.0)
    grouped = events.groupBy("symbol", "open_time").agg(
        F.min_by("value", "event_id").alias("open_price"),
        F.max("value").alias("high_price"),
        F.min("value").alias("low_price"),
        F.max_by("value", "event_id").alias("close_price"),
        F.round(F.sum("value"), 4).alias("volume"),
        F.round(F.sum(F.col("value") * 2), 4).alias("quote_asset_volume"),
        F.count(F.lit(1)).alias("number_of_trades"),
        F.round(F.sum(even), 4).alias("taker_buy_base_volume"),
        F.round(F.sum(even * 2), 4).alias("taker_buy_quote_volume"),
        F.max("ts").cast("timestamp").alias("ingest_ts"))
    close_time = F.col("open_time") + step_ms - 1
    return grouped.withColumns({
        # No plain literal: a stored column would not be one either.
        "interval": F.when(F.col("open_time").isNotNull(), code),
        "close_time": close_time,
        "open_ts": tm.ts_seconds(F.col("open_time")),
        "close_ts": tm.ts_seconds(close_time),
        "is_closed": tm.whole_div(F.col("open_time"), step_ms) % 10 != 0,
        "trade_date": tm.utc_date(F.col("open_time")),
        "source": F.lit("fixture"),
    }).select(*SILVER.names)


def closed(spark: SparkSession, sf: str, step_ms: int = tm.HOUR_MS, code: str = "1h") -> DataFrame:
    return closed_candles(candles(spark, sf, step_ms, code))


def bronze(rows: DataFrame) -> DataFrame:
    """Silver candles in the shape of bronze files."""
    iso = F.date_format("ingest_ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")
    return rows.withColumn("ingest_ts", iso).select(*BRONZE.names)


def dirty(rows: DataFrame) -> DataFrame:
    """Bronze rows as text, some without a symbol and some with a close that is no number."""
    hour = tm.whole_div(F.col("open_time"), tm.HOUR_MS)
    text = bronze(rows)
    return text.select(*[
        F.when(hour % 97 != 0, F.col(c)).alias(c) if c == "symbol"
        else F.when(hour % 89 == 0, "bad").otherwise(F.col(c).cast("string")).alias(c) if c == "close_price"
        else F.col(c).cast("string").alias(c) if c not in ("is_closed",) else F.col(c)
        for c in text.columns])


def target(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("open_time") < TARGET_END_MS)


def source(rows: DataFrame) -> DataFrame:
    later = rows.where(F.col("open_time") >= SOURCE_START_MS)
    return later.withColumn("close_price", F.col("close_price") + 1)


def pages(rows: DataFrame) -> DataFrame:
    """One page per symbol and day. The last candle of a page comes twice, the second time altered."""
    def element(name: str, close: Column) -> Column:
        if name == "ignore":
            return F.lit("0")
        return (close if name == "close_price" else F.col(name)).cast("string")

    def row(close: Column) -> Column:
        return F.array(*[element(name, close) for name in PAGE_ELEMENTS])

    plain, altered = row(F.col("close_price")), row(F.col("close_price") + 1000)
    lists = rows.groupBy("symbol", "interval", "trade_date").agg(
        F.sort_array(F.collect_list(F.struct("open_time", plain.alias("row"), altered.alias("again")))).alias("rows"))
    body = F.concat(
        F.transform("rows", lambda r: r["row"]),
        F.transform(F.slice("rows", -1, 1), lambda r: r["again"]))
    return lists.select(
        "symbol", "interval", F.unix_date("trade_date").cast("bigint").alias("page_no"), F.to_json(body).alias("body"))


def event_kind(rows: DataFrame) -> Column:
    """What kind of event a candle becomes: `garbage`, `bad` price, `trade` or a good `kline`."""
    n = tm.whole_div(F.col("open_time"), tm.HOUR_MS)
    return (
        F.when(n % 50 == 0, "garbage").when(n % 60 == 1, "bad").when(n % 70 == 2, "trade").otherwise("kline"))


def events_json(rows: DataFrame) -> DataFrame:
    """Nested exchange events with prices as text."""
    kind = event_kind(rows)
    names = {column: field for field, column in EVENT_FIELDS.items()}

    def value(column: str) -> Column:
        if column == "close_price":
            return F.when(kind == "bad", "n/a").otherwise(F.col(column).cast("string"))
        return F.col(column).cast("string") if column.endswith("price") or column == "volume" else F.col(column)

    nested = F.struct(*[value(column).alias(field) for column, field in names.items()])
    event = F.struct(
        F.when(kind == "trade", "trade").otherwise("kline").alias("e"), F.col("symbol").alias("s"), nested.alias("k"))
    # Two fields differ only in case, which a struct keeps and JSON shows.
    return rows.select(F.when(kind == "garbage", "{garbage").otherwise(F.to_json(event)).alias("value"))


def loose_json(rows: DataFrame) -> DataFrame:
    """Flat candle records: some are garbage, some have a text close, some lack the open time."""
    kind = event_kind(rows)
    record = F.to_json(F.struct(
        "symbol", F.when(kind != "trade", F.col("open_time")).alias("open_time"), "close_time", "open_price",
        "high_price", "low_price", F.when(kind != "bad", F.col("close_price")).alias("close_price"),
        "volume", "is_closed"))
    broken = F.replace(record, F.lit('"volume"'), F.lit('"close_price":"x","volume"'))
    return rows.select(
        F.when(kind == "garbage", "{garbage").when(kind == "bad", broken).otherwise(record).alias("value"))


def stream_rows(rows: DataFrame) -> DataFrame:
    return rows.select(*STREAM_CANDLE.names)


# --- star schema over candles --------------------------------------------------------------------

class Star:
    """Dimensions built from all candles, starting from empty tables.

    Those that need the candles are written to the shared folder at their first use, as the tables they
    stand for would be.
    """

    def __init__(self, spark: SparkSession, rows: DataFrame):
        self.spark, self.rows = spark, rows
        self.interval = star.new_intervals(spark, DIM_INTERVAL.empty(spark), ["1h"])
        self.source = star.new_sources(spark, DIM_DATA_SOURCE.empty(spark))

    @cached_property
    def symbol(self) -> DataFrame:
        return staged(star.new_symbols(DIM_SYMBOL.empty(self.spark), self.rows, AS_OF, EXCHANGE))

    @cached_property
    def date(self) -> DataFrame:
        return staged(star.new_dates(DIM_DATE.empty(self.spark), self.rows, "trade_date"))

    @cached_property
    def pattern(self) -> DataFrame:
        return staged(star.new_patterns(DIM_PATTERN_TYPE.empty(self.spark), pattern_alerts(self.rows)))


def batch_facts(rows: DataFrame, dims: Star, part: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """Final candle facts from the older part of the candles, or from what `part` takes of them."""
    return star.kline_facts(part(target(rows)), dims.symbol, dims.interval, dims.source, AS_OF)


def hot_facts(rows: DataFrame, dims: Star, part: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """Stream candle facts from the newer part; the lookback reaches its start."""
    hours = (tm.as_of_ms(AS_OF) - SOURCE_START_MS) // tm.HOUR_MS
    return star.hot_kline_facts(
        stream_rows(part(source(rows))), dims.symbol, dims.interval, dims.source, AS_OF, hours, "1h")


def indicator_facts(rows: DataFrame, dims: Star, hours: int | None = 48) -> DataFrame:
    values = technical_indicators(closed_candles(rows)).drop("interval")
    return star.indicator_facts(values, dims.symbol, dims.interval, AS_OF, hours, "1h")


def alerts(rows: DataFrame) -> DataFrame:
    return pattern_alerts(rows).select("symbol", "close_time", "pattern_type", "close_price")
