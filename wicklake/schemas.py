"""Columns, partitioning and keys of every table."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Layout:
    """Column types of one table, how it is partitioned and what identifies a row.

    `small_partitions` says that a partition holds one day of one symbol, so one task can write it. `find_by` are columns that
    single values are looked up by: files get Bloom filters on them and short pages, so that a reader skips the rest.
    """

    columns: tuple[tuple[str, str], ...]
    partition_by: tuple[str, ...] = ()
    key: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()
    sort_by: tuple[str, ...] = ()
    small_partitions: bool = False
    find_by: tuple[str, ...] = ()

    @property
    def names(self) -> list[str]:
        return [name for name, _ in self.columns]

    @property
    def ddl(self) -> str:
        return ", ".join(f"`{name}` {kind}" for name, kind in self.columns)

    def empty(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([], self.ddl)


def _columns(text: str) -> tuple[tuple[str, str], ...]:
    return tuple(tuple(item.split()) for item in text.replace("\n", " ").split(",") if item.strip())


# Column names and types below are fixed values: they are the public shape of the tables.

BRONZE = Layout(
    _columns("""
        symbol string, interval string, open_time bigint, open_price double, high_price double,
        low_price double, close_price double, volume double, close_time bigint,
        quote_asset_volume double, number_of_trades bigint, taker_buy_base_volume double,
        taker_buy_quote_volume double, is_closed boolean, ingest_ts string, source string"""),
    partition_by=("interval", "symbol", "year", "month", "day"),
    key=("symbol", "interval", "open_time"),
    small_partitions=True,
)

SILVER = Layout(
    _columns("""
        symbol string, interval string, open_time bigint, open_ts timestamp, close_time bigint,
        close_ts timestamp, open_price double, high_price double, low_price double,
        close_price double, volume double, quote_asset_volume double, number_of_trades bigint,
        taker_buy_base_volume double, taker_buy_quote_volume double, is_closed boolean,
        trade_date date, ingest_ts timestamp, source string"""),
    partition_by=("trade_date", "symbol"),
    key=("symbol", "interval", "open_time"),
    not_null=("symbol", "interval", "open_time", "close_price"),
    sort_by=("interval", "open_time"),
    small_partitions=True,
)

STREAM_CANDLE = Layout(
    _columns("""
        symbol string, open_time bigint, close_time bigint, open_price double, high_price double,
        low_price double, close_price double, volume double, is_closed boolean"""),
    key=("symbol", "open_time"),
)

STREAM_ALERT = Layout(
    _columns("symbol string, close_time bigint, pattern_type string, close_price double"),
    key=("symbol", "close_time"),
)

STREAM_INDICATOR = Layout(
    _columns("""
        symbol string, open_time bigint, close_price double, sma7 double, sma25 double,
        rsi14 double, macd double, macd_signal double, macd_hist double"""),
    key=("symbol", "open_time"),
)

# The stream appends to a log; the newest entry of a key is the row. `batch_id`, `arrival_ts`,
# `arrival_at` and `arrival_seq` order the entries.
_LOG_COLUMNS = _columns("""
    trade_date date, batch_id bigint, arrival_ts timestamp, arrival_at string, arrival_seq bigint""")


def as_log(layout: Layout) -> Layout:
    return replace(layout, columns=layout.columns + _LOG_COLUMNS, partition_by=("trade_date",))


HOT_CANDLE = as_log(STREAM_CANDLE)
HOT_ALERT = as_log(STREAM_ALERT)
HOT_INDICATOR = as_log(STREAM_INDICATOR)

DIM_SYMBOL = Layout(
    _columns("""
        symbol_id bigint, symbol string, base_asset string, quote_asset string, exchange string,
        market_type string, is_active boolean, created_at timestamp"""),
    key=("symbol",), not_null=("symbol_id", "symbol"),
)

DIM_INTERVAL = Layout(
    _columns("interval_id bigint, interval_code string, interval_seconds int"),
    key=("interval_code",), not_null=("interval_id", "interval_code", "interval_seconds"),
)

DIM_DATE = Layout(
    _columns("""
        date_id date, year int, month int, day int, quarter int, day_of_week int,
        is_weekend boolean"""),
    key=("date_id",),
    not_null=("date_id", "year", "month", "day", "quarter", "day_of_week", "is_weekend"),
)

DIM_DATA_SOURCE = Layout(
    _columns("data_source_id bigint, source_code string, description string"),
    key=("source_code",), not_null=("data_source_id", "source_code"),
)

DIM_PATTERN_TYPE = Layout(
    _columns("pattern_type_id bigint, pattern_type string, description string"),
    key=("pattern_type",), not_null=("pattern_type_id", "pattern_type"),
)

FACT_KLINE = Layout(
    _columns("""
        symbol_id bigint, interval_id bigint, date_id date, open_time bigint, open_ts timestamp,
        close_time bigint, close_ts timestamp, open_price double, high_price double,
        low_price double, close_price double, volume double, quote_asset_volume double,
        number_of_trades bigint, taker_buy_base_volume double, taker_buy_quote_volume double,
        data_source_id bigint, is_final boolean, updated_at timestamp"""),
    partition_by=("date_id",),
    key=("symbol_id", "interval_id", "open_time"),
    not_null=("symbol_id", "interval_id", "date_id", "open_time", "open_ts", "is_final", "updated_at"),
    sort_by=("symbol_id", "-open_time"),
    find_by=("symbol_id",),
)

# The newest candle of every series, kept beside the fact so that the snapshot need not read it.
LATEST_KLINE = Layout(
    FACT_KLINE.columns, key=("symbol_id", "interval_id"),
    not_null=("symbol_id", "interval_id", "date_id", "open_time", "open_ts", "is_final", "updated_at"),
)

FACT_DAILY = Layout(
    _columns("""
        date_id date, symbol_id bigint, interval_id bigint, open_price double, high_price double,
        low_price double, close_price double, total_volume double, price_change double,
        price_change_pct double, daily_range double, number_of_candles bigint,
        updated_at timestamp"""),
    partition_by=("date_id",),
    key=("date_id", "symbol_id", "interval_id"),
    not_null=("date_id", "symbol_id", "interval_id", "updated_at"),
    sort_by=("symbol_id",),
)

FACT_INDICATOR = Layout(
    _columns("""
        symbol_id bigint, interval_id bigint, date_id date, open_time bigint, open_ts timestamp,
        close_price double, sma7 double, sma25 double, rsi14 double, macd double,
        macd_signal double, macd_hist double, updated_at timestamp"""),
    partition_by=("date_id",),
    key=("symbol_id", "interval_id", "open_time"),
    not_null=("symbol_id", "interval_id", "date_id", "open_time", "open_ts", "updated_at"),
    sort_by=("symbol_id", "-open_time"),
    find_by=("symbol_id",),
)

# The indicators of those candles, as far as there are any.
LATEST_INDICATOR = Layout(FACT_INDICATOR.columns, key=("symbol_id", "interval_id"), not_null=FACT_INDICATOR.not_null)

FACT_ALERT = Layout(
    _columns("""
        alert_id bigint, symbol_id bigint, date_id date, pattern_type_id bigint,
        close_time bigint, close_ts timestamp, close_price double, created_at timestamp"""),
    partition_by=("date_id",),
    key=("symbol_id", "pattern_type_id", "close_time", "close_price"),
    not_null=("alert_id", "symbol_id", "date_id", "pattern_type_id", "close_time", "close_ts", "created_at"),
    sort_by=("symbol_id", "-close_time"),
    find_by=("symbol_id",),
)

GOLD = {
    "dim_symbol": DIM_SYMBOL,
    "dim_interval": DIM_INTERVAL,
    "dim_date": DIM_DATE,
    "dim_data_source": DIM_DATA_SOURCE,
    "dim_pattern_type": DIM_PATTERN_TYPE,
    "fact_kline": FACT_KLINE,
    "latest_kline": LATEST_KLINE,
    "fact_daily_market_summary": FACT_DAILY,
    "fact_technical_indicator": FACT_INDICATOR,
    "latest_indicator": LATEST_INDICATOR,
    "fact_pattern_alert": FACT_ALERT,
}

HOT = {"candle": HOT_CANDLE, "alert": HOT_ALERT, "indicator": HOT_INDICATOR}

# (table, column, referenced table): the foreign keys of the star schema.
FOREIGN_KEYS = [
    (fact, column, dim)
    for fact, layout in GOLD.items() if fact.startswith("fact_")
    for column, dim in (
        ("symbol_id", "dim_symbol"), ("interval_id", "dim_interval"), ("date_id", "dim_date"),
        ("data_source_id", "dim_data_source"), ("pattern_type_id", "dim_pattern_type"),
    )
    if column in layout.names
]
