"""The batch jobs: pages to bronze, bronze to silver, silver and hot tables to gold."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from wicklake.functions import time as tm
from wicklake.functions.text import symbol_list
from wicklake.operators import clean, summary
from wicklake.operators.checks import duplicate_keys, missing_references, not_null_counts, require_empty
from wicklake.operators.merge import absent_rows
from wicklake.operators.rows import latest_by
from wicklake.plans import star
from wicklake.schemas import (
    FACT_ALERT, FACT_DAILY, FACT_INDICATOR, FACT_KLINE, FOREIGN_KEYS, GOLD, HOT, LATEST_INDICATOR, LATEST_KLINE, SILVER,
)
from wicklake.session import staged
from wicklake.sources import tables
from wicklake.sources.bronze import existing_partitions, read_bronze, write_bronze
from wicklake.sources.decode import decode_events, decode_pages, publish
from wicklake.sources.external import read_external
from wicklake.streaming.sinks import PLAIN, TIME, follow_hot, read_hot

# (session, place, table, as_of, hours) -> current rows of a stream table.
HotReader = Callable[..., DataFrame]


def external_reader(fmt: str, options: dict[str, str]) -> HotReader:
    """Reads stream tables behind a Spark data source. `{table}` in an option stands for the table's name."""
    def read(spark: SparkSession, hot: str, name: str, as_of: datetime | str | None = None, hours: int = 48) -> DataFrame:
        named = {k: v.replace("{table}", f"{hot}.{name}" if hot else name) for k, v in options.items()}
        return read_external(spark, PLAIN[name], fmt, named, TIME[name], as_of, hours)
    return read


MODES = ("bootstrap", "merge", "overwrite-day")
PAGE_SCHEMA = "symbol string, interval string, page_no bigint, body string, day date"


@dataclass(frozen=True)
class Places:
    """Where a deployment keeps its layers."""

    bronze: str
    silver: str
    gold: str
    hot: str
    pages: str | None = None


def land_pages(
    spark: SparkSession, pages: str, bronze: str, symbols: str, interval: str,
    start: date | str, end: date | str, ingest_ts: datetime | str, overwrite: bool = False,
    source: str = "rest_api",
) -> None:
    """Decode landed page files (JSON lines) of some symbols and days into bronze.

    Pages lie in folders `day=`, also `interval=` and `symbol=` if there are many, of which only those of the range are read.
    Pages outside of such folders have no day and are read always.
    """
    start, end = tm.check_range(start, end)
    landed = spark.read.schema(PAGE_SCHEMA).json(pages)
    days = F.col("day").isNull() | tm.in_day_range(F.col("day"), start, end)
    wanted = landed.where(days & (F.col("interval") == interval) & F.col("symbol").isin(symbol_list(symbols)))
    stamp = F.lit(datetime.fromtimestamp(tm.as_of_ms(ingest_ts) / 1000, tz=tm.timezone.utc).isoformat())
    candles = decode_pages(wanted, stamp, source)
    low, high = tm.as_of_ms(start.isoformat()), tm.as_of_ms(end.isoformat())
    write_bronze(
        candles.where((F.col("open_time") >= low) & (F.col("open_time") < high)), bronze, overwrite,
        existing_partitions(spark, bronze, interval, start, end))


def bronze_to_silver(
    spark: SparkSession, bronze: str, silver: str, day: date | str, interval: str = "1m", mode: str = "merge",
    allow_empty: bool = False,
) -> DataFrame:
    """One day of one interval into silver; returns the row counts of that day.

    `overwrite-day` refuses a day without bronze files before anything is changed, unless `allow_empty` says that the day
    may be emptied.
    """
    if mode not in MODES:
        raise ValueError(f"mode {mode!r} is none of {MODES}")
    tables.ensure_silver(spark, silver)
    required = mode == "overwrite-day" and not allow_empty
    rows = clean.silver_rows(read_bronze(spark, bronze, interval, day, required=required))
    if mode == "bootstrap":
        tables.append(rows, SILVER, silver)
    elif mode == "overwrite-day":
        tables.replace_day(rows, SILVER, silver, day)
    else:
        tables.upsert(rows, SILVER, silver, unique=True)
    return summary.day_row_counts(spark.table(silver), day)


def backfill(
    spark: SparkSession, bronze: str, silver: str, start: date | str, end: date | str, interval: str = "1m",
) -> None:
    """Merge a half-open day range into silver as one job. It gives what one merge per day gives."""
    tm.check_range(start, end)
    tables.ensure_silver(spark, silver)
    rows = clean.silver_rows(read_bronze(spark, bronze, interval, start, end))
    tables.upsert(rows, SILVER, silver, unique=True)


def _dim(spark: SparkSession, gold: str, name: str) -> DataFrame:
    return tables.read_table(spark, GOLD[name], f"{gold}.{name}")


def _add(spark: SparkSession, gold: str, name: str, rows: DataFrame) -> None:
    tables.append(tables.checked(rows, GOLD[name], f"{gold}.{name}"), GOLD[name], f"{gold}.{name}")


def ensure_static(spark: SparkSession, gold: str, intervals: list[str]) -> None:
    tables.ensure_gold(spark, gold)
    _add(spark, gold, "dim_interval", star.new_intervals(
        spark, _dim(spark, gold, "dim_interval"), intervals))
    _add(spark, gold, "dim_data_source", star.new_sources(spark, _dim(spark, gold, "dim_data_source")))


def _batch_symbols(spark: SparkSession, gold: str, names: DataFrame, as_of: datetime | str, exchange: str | None) -> None:
    """Append new symbols; where a known one differs from what its name says, swap in a corrected dimension.

    The dimension is whole at every moment, so a crash in between loses no id and a second run goes on from there. An empty
    dimension under a filled fact has been lost, and numbering it anew would give its ids to other symbols.
    """
    if _dim(spark, gold, "dim_symbol").isEmpty() and not _dim(spark, gold, "fact_kline").isEmpty():
        raise ValueError(f"{gold}.dim_symbol is empty but {gold}.fact_kline is not")
    _add(spark, gold, "dim_symbol", star.new_symbols(_dim(spark, gold, "dim_symbol"), names, as_of, exchange))
    known = _dim(spark, gold, "dim_symbol")
    corrected = staged(star.upsert_symbols(known, names, as_of, exchange))
    if not corrected.exceptAll(known).isEmpty():
        tables.swap(corrected, GOLD["dim_symbol"], f"{gold}.dim_symbol")


def _refresh_latest(spark: SparkSession, gold: str, changed: DataFrame) -> None:
    """Bring the newest candle per series up to date with the partitions of the fact that `changed` rows went to."""
    fact = tables.touched(_dim(spark, gold, "fact_kline"), changed, FACT_KLINE.partition_by)
    keys = list(LATEST_KLINE.key)
    new = latest_by(fact, keys, "open_time").select(*LATEST_KLINE.names)
    known = _dim(spark, gold, "latest_kline")
    # Of one candle the fact has the newer version.
    older = known.join(new.select(*keys, F.col("open_time").alias("_t")), keys, "left").where(
        F.col("_t").isNull() | (F.col("open_time") > F.col("_t"))).select(*LATEST_KLINE.names)
    tables.swap(latest_by(older.unionByName(new), keys, "open_time"), LATEST_KLINE, f"{gold}.latest_kline")


def _refresh_latest_indicators(spark: SparkSession, gold: str, *changed: DataFrame) -> None:
    """Bring the indicators of the newest candles up to date for the series that `changed` facts belong to.

    Of the indicator fact only the days of those candles are read.
    """
    keys = list(LATEST_INDICATOR.key)
    series = reduce(DataFrame.unionByName, [c.select(*keys) for c in changed]).distinct()
    moved = staged(_dim(spark, gold, "latest_kline").join(series, keys, "left_semi").select(
        *keys, "open_time", tm.utc_date(F.col("open_time")).alias("date_id")))
    fact = tables.touched(_dim(spark, gold, "fact_technical_indicator"), moved, FACT_INDICATOR.partition_by)
    found = fact.join(moved, [*keys, "open_time", "date_id"], "left_semi")
    others = _dim(spark, gold, "latest_indicator").join(moved, keys, "left_anti")
    tables.swap(others.unionByName(found), LATEST_INDICATOR, f"{gold}.latest_indicator")


def load_batch(
    spark: SparkSession, silver: str, gold: str, day: date | str, interval: str, as_of: datetime | str,
    exchange: str | None = None,
) -> bool:
    """One day of silver into the dimensions and the two batch facts; False if the day is empty."""
    rows = staged(clean.of_interval(clean.on_day(tables.read_table(spark, SILVER, silver), day), interval))
    if rows.isEmpty():
        return False
    _batch_symbols(spark, gold, rows, as_of, exchange)
    _add(spark, gold, "dim_date", star.new_dates(_dim(spark, gold, "dim_date"), rows, "trade_date"))
    symbols, intervals = _dim(spark, gold, "dim_symbol"), _dim(spark, gold, "dim_interval")
    require_empty(missing_references(rows, "symbol", symbols), "symbols without a dimension row")
    require_empty(missing_references(rows, "interval", intervals, "interval_code"), "intervals without a dimension row")
    facts = star.kline_facts(rows, symbols, intervals, _dim(spark, gold, "dim_data_source"), as_of)
    tables.upsert(facts, FACT_KLINE, f"{gold}.fact_kline")
    _refresh_latest(spark, gold, facts)
    _refresh_latest_indicators(spark, gold, facts)
    daily = star.daily_facts(rows, symbols, intervals, as_of)
    tables.upsert(daily, FACT_DAILY, f"{gold}.fact_daily_market_summary")
    return True


def _add_keys(
    spark: SparkSession, gold: str, names: DataFrame, dates: DataFrame, time: str,
    as_of: datetime | str, exchange: str | None,
) -> None:
    _add(spark, gold, "dim_symbol", star.new_symbols(_dim(spark, gold, "dim_symbol"), names, as_of, exchange))
    days = dates.select(tm.utc_date(F.col(time)).alias("date_id"))
    _add(spark, gold, "dim_date", star.new_dates(_dim(spark, gold, "dim_date"), days))


def _hot_candles(
    spark: SparkSession, gold: str, candles: DataFrame, as_of: datetime | str, hours: int, interval: str, exchange: str | None,
) -> None:
    _add_keys(spark, gold, candles, candles, "open_time", as_of, exchange)
    facts = star.hot_kline_facts(
        candles, _dim(spark, gold, "dim_symbol"), _dim(spark, gold, "dim_interval"),
        _dim(spark, gold, "dim_data_source"), as_of, hours, interval)
    tables.upsert(
        facts, FACT_KLINE, f"{gold}.fact_kline", update=star.HOT_KLINE_COLUMNS, keep_if="is_final")
    _refresh_latest(spark, gold, facts)
    _refresh_latest_indicators(spark, gold, facts)


def _hot_indicators(
    spark: SparkSession, gold: str, indicators: DataFrame, as_of: datetime | str, hours: int, interval: str, exchange: str | None,
) -> None:
    _add_keys(spark, gold, indicators, indicators, "open_time", as_of, exchange)
    facts = star.indicator_facts(
        indicators, _dim(spark, gold, "dim_symbol"), _dim(spark, gold, "dim_interval"), as_of, hours, interval)
    tables.upsert(
        facts, FACT_INDICATOR, f"{gold}.fact_technical_indicator", update=star.INDICATOR_UPDATE_COLUMNS)
    _refresh_latest_indicators(spark, gold, facts)


def _hot_alerts(
    spark: SparkSession, gold: str, names: DataFrame, recent: DataFrame, as_of: datetime | str, hours: int, exchange: str | None,
) -> None:
    """`names` has the symbols, whatever their date; dates and facts come from the `recent` alerts."""
    _add_keys(spark, gold, names, recent, "close_time", as_of, exchange)
    rows = staged(star.alert_rows(
        recent, _dim(spark, gold, "dim_symbol"), _dim(spark, gold, "dim_pattern_type"), as_of, hours))
    fact = _dim(spark, gold, "fact_pattern_alert")
    nearby = tables.touched(fact, rows, FACT_ALERT.partition_by)
    fresh = star.new_alerts(staged(absent_rows(rows, nearby, FACT_ALERT.key)), fact, FACT_ALERT.empty(spark))
    _add(spark, gold, "fact_pattern_alert", fresh)


def refresh_hot(
    spark: SparkSession, hot: str, gold: str, as_of: datetime | str, hours: int = 48,
    interval: str = "1m", exchange: str | None = None, read: HotReader = read_hot,
) -> None:
    """Recent stream tables into gold. Final candles stay as they are.

    `read` gives the current rows of a stream table; `external_reader` makes one for tables outside the catalog.
    `load_new_hot` does the same for tables of the catalog without reading the lookback again.
    """
    _hot_candles(spark, gold, clean.lookback(read(spark, hot, "candle", as_of, hours), as_of, hours), as_of, hours, interval, exchange)
    _hot_indicators(spark, gold, clean.lookback(read(spark, hot, "indicator", as_of, hours), as_of, hours), as_of, hours, interval, exchange)

    # Symbols and pattern types come from all alerts, dates and facts from the recent ones. Only a type
    # that is new somewhere in the log makes it worth finding the current alerts of the whole history.
    log = tables.read_table(spark, HOT["alert"], f"{hot}.alert") if read is read_hot else read(spark, hot, "alert")
    patterns = _dim(spark, gold, "dim_pattern_type")
    if not star.new_patterns(patterns, log).isEmpty():
        _add(spark, gold, "dim_pattern_type", star.new_patterns(patterns, read(spark, hot, "alert")))
    recent = clean.lookback(read(spark, hot, "alert", as_of, hours), as_of, hours, "close_time")
    _hot_alerts(spark, gold, log, recent, as_of, hours, exchange)


def load_new_hot(
    spark: SparkSession, hot: str, gold: str, checkpoint: str, as_of: datetime | str, hours: int = 48,
    interval: str = "1m", exchange: str | None = None, max_files: int | None = None,
) -> dict[str, int]:
    """What the stream tables have got since the last run, into gold; gives how many entries were read of each.

    The log of a table is read as a stream of files with a checkpoint below `checkpoint`, so each entry is read once and a run
    without new files reads nothing. `newer_rows` settles which of the new entries are the newest of their key. A run that breaks
    off is repeated from its checkpoint, with the same rows in the end. `updated_at` changes for new rows only, where `refresh_hot`
    sets it for the whole lookback. `max_files` bounds one step of a first run over a long log.
    """
    def load(name: str, rows: DataFrame) -> None:
        session = rows.sparkSession
        recent = clean.lookback(rows, as_of, hours, TIME[name])
        if name == "candle":
            _hot_candles(session, gold, recent, as_of, hours, interval, exchange)
        elif name == "indicator":
            _hot_indicators(session, gold, recent, as_of, hours, interval, exchange)
        else:
            _add(session, gold, "dim_pattern_type", star.new_patterns(_dim(session, gold, "dim_pattern_type"), rows))
            _hot_alerts(session, gold, rows, recent, as_of, hours, exchange)

    read = {}
    for name in ("candle", "indicator", "alert"):
        query = follow_hot(spark, hot, name, f"{checkpoint}/{name}", load, max_files)
        query.awaitTermination()
        read[name] = sum(p["numInputRows"] for p in query.recentProgress)
    # The streams wrote in sessions of their own, which this one cannot notice.
    for table in GOLD:
        spark.catalog.refreshTable(f"{gold}.{table}")
    return read


def silver_to_gold(
    spark: SparkSession, silver: str, hot: str, gold: str, day: date | str, as_of: datetime | str,
    interval: str = "1m", hours: int = 48, exchange: str | None = None, read: HotReader = read_hot,
    hot_checkpoint: str | None = None,
) -> None:
    """Batch day into gold, then the recent stream rows on top; with `hot_checkpoint` only those that are new since the last run."""
    ensure_static(spark, gold, [interval])
    load_batch(spark, silver, gold, day, interval, as_of, exchange)
    if hot_checkpoint:
        load_new_hot(spark, hot, gold, hot_checkpoint, as_of, hours, interval, exchange)
    else:
        refresh_hot(spark, hot, gold, as_of, hours, interval, exchange, read)


def publish_events(
    spark: SparkSession, fmt: str, options: dict[str, str], out_fmt: str, out_options: dict[str, str], checkpoint: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Raw exchange events of a source (`kafka`, or `text` files) onto the candle topic, as they come."""
    events = spark.readStream.format(fmt).options(**options).load().select(F.col("value").cast("string").alias("value"))
    return (
        decode_events(events).writeStream.foreachBatch(lambda batch, _: publish(batch, out_fmt, out_options))
        .option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "0 seconds"})).start())


def run_day(
    spark: SparkSession, places: Places, run_date: date | str, as_of: datetime | str, symbols: str | None = None,
    interval: str = "1m", hours: int = 48,
) -> None:
    """The daily chain for the day before `run_date`: land, merge into silver, load gold."""
    day = tm.previous_day(run_date)
    if places.pages and symbols:
        land_pages(
            spark, places.pages, places.bronze, symbols, interval, day, tm.parse_day(run_date), as_of)
    bronze_to_silver(spark, places.bronze, places.silver, day, interval, "merge")
    silver_to_gold(spark, places.silver, places.hot, places.gold, day, as_of, interval, hours)


def check_gold(spark: SparkSession, gold: str) -> None:
    """NOT NULL, key and reference rules on every gold table; raises on the first violation."""
    for name, layout in GOLD.items():
        df = _dim(spark, gold, name)
        require_empty(not_null_counts(df, layout.not_null).where("null_count > 0"), f"NULL in {name}")
        require_empty(duplicate_keys(df, layout.key), f"key of {name} repeats")
    for fact, column, dim in FOREIGN_KEYS:
        require_empty(
            missing_references(_dim(spark, gold, fact), column, _dim(spark, gold, dim)), f"{fact}.{column}")
