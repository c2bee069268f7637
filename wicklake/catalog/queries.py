"""One query per operator, over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wicklake.catalog import inputs, tables as scratch
from wicklake.catalog.inputs import AS_OF
from wicklake.functions import text, time as tm
from wicklake.operators import clean, indicators, patterns, rows as by_key, summary
from wicklake.operators.checks import duplicate_keys, missing_references, not_null_counts
from wicklake.operators.merge import unify
from wicklake.plans import jobs, star, views
from wicklake.schemas import (
    DIM_DATE, DIM_SYMBOL, FACT_ALERT, FACT_INDICATOR, FACT_KLINE, SILVER, STREAM_CANDLE,
)
from wicklake.session import configure, fresh_dir, staged
from wicklake.sources import bronze as bronze_files, decode, export, tables
from wicklake.streaming import sinks, speed_layer
from wicklake.streaming.indicators import recent_closes
from wicklake.streaming.source import read_candle_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

DAY = "2024-01-15"
NOW = {"availableNow": True}


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return fn(configure(spark), sf)
    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    QUERIES[fn.__name__] = run
    return run


def _r(name: str, digits: int = 6) -> Column:
    return F.round(name, digits).alias(name)


def _ms(name: str, alias: str | None = None) -> Column:
    return tm.epoch_ms(F.col(name)).alias(alias or name)


def _day(name: str) -> Column:
    return F.col(name).cast("string").alias(name)


# --- scans and filters ---------------------------------------------------------------------------

@query
def bronze_day_counts(spark, sf):
    rows = inputs.candles(spark, sf)
    root = fresh_dir(spark, "bronze")
    bronze_files.write_bronze(inputs.bronze(rows), root)
    back = bronze_files.read_bronze(spark, root, "1h", "2024-01-05", "2024-01-25")
    day = F.date_format(tm.utc_date(F.col("open_time")), "yyyy-MM-dd")
    return back.groupBy("symbol", day.alias("trade_date")).agg(
        F.count(F.lit(1)).alias("row_count"), F.round(F.sum("volume"), 4).alias("volume"))


@query
def silver_day_scan(spark, sf):
    rows = clean.of_interval(clean.on_day(inputs.candles(spark, sf), DAY), "1h")
    return rows.select("symbol", "interval", "open_time", "close_price", "volume", _day("trade_date"))


@query
def day_range_scan(spark, sf):
    rows = clean.in_days(inputs.candles(spark, sf), "2024-01-10", "2024-01-13")
    return rows.select("symbol", "open_time", "close_price", F.date_add("trade_date", 1).cast("string").alias("next_day"))


@query
def symbol_filter(spark, sf):
    rows = clean.of_symbols(inputs.candles(spark, sf), text.symbol_list(" clickusdt, ,errorbtc "))
    listed = text.symbols_in(F.concat_ws(",", F.lower("symbol"), F.lit("  "), F.lit(" viewusdt ")))
    return rows.select("symbol", "open_time", "close_price", F.array_join(listed, "|").alias("listed"))


@query
def hot_lookback(spark, sf):
    rows = clean.lookback(inputs.stream_rows(inputs.candles(spark, sf)), AS_OF, 48)
    return rows.select("symbol", "open_time", "close_time", "close_price", "is_closed")


@query
def bronze_partition_path(spark, sf):
    rows = inputs.candles(spark, sf)
    path = tm.partition_path("bronze/kline", F.col("symbol"), F.col("interval"), F.col("trade_date"))
    return rows.select(path.alias("path")).distinct()


# --- scalars -------------------------------------------------------------------------------------

@query
def epoch_conversions(spark, sf):
    rows = inputs.candles(spark, sf)
    t = F.col("close_time")
    return rows.select(
        "symbol", "open_time", tm.epoch_ms(tm.ts_seconds(t)).alias("whole_seconds_ms"),
        tm.epoch_ms(tm.ts_millis(t)).alias("millis_ms"), tm.utc_date(t).cast("string").alias("trade_date"),
        tm.epoch_ms(tm.utc_date(t)).alias("day_ms"))


@query
def interval_seconds(spark, sf):
    unit = F.element_at(F.split(F.lit("s,m,h,d,w,M"), ","), (F.col("p_partkey") % 6 + 1).cast("int"))
    codes = inputs.table(spark, sf, "part").select(F.concat(F.col("p_size").cast("string"), unit).alias("code"))
    return codes.distinct().select("code", tm.interval_seconds(F.col("code")).cast("bigint").alias("seconds"))


@query
def symbol_assets(spark, sf):
    """Base and quote of symbols that hold the quote text in several places."""
    names = inputs.table(spark, sf, "customer").select(
        F.concat(
            F.when(F.col("c_custkey") % 3 == 0, "USDT").otherwise(""), F.upper("c_mktsegment"),
            F.when(F.col("c_custkey") % 2 == 0, "USDT").otherwise("BTC")).alias("symbol")).distinct()
    return star.symbol_rows(names)


# --- cleaning and decoding -----------------------------------------------------------------------

@query
def silver_clean(spark, sf):
    rows = clean.silver_rows(inputs.dirty(inputs.candles(spark, sf)))
    return rows.select(
        "symbol", "interval", "open_time", "close_time", _ms("open_ts"), _ms("close_ts"), "open_price",
        "high_price", "low_price", "close_price", "volume", "quote_asset_volume", "number_of_trades",
        "taker_buy_base_volume", "taker_buy_quote_volume", "is_closed", _day("trade_date"),
        F.unix_micros("ingest_ts").alias("ingest_us"), "source")


@query
def dedup_latest(spark, sf):
    rows = by_key.dedup_latest(inputs.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], "l_shipdate")
    return rows.withColumn("l_shipdate", F.date_format("l_shipdate", "yyyy-MM-dd"))


@query
def rest_page_decode(spark, sf):
    pages = inputs.pages(inputs.candles(spark, sf))
    return decode.decode_pages(pages, F.lit("2024-01-31T00:00:00+00:00"))


@query
def event_decode(spark, sf):
    return decode.decode_events(inputs.events_json(inputs.candles(spark, sf)))


@query
def event_encode(spark, sf):
    encoded = decode.encode_candles(inputs.candles(spark, sf))
    return decode.decode_candles(encoded, keep=["key"]).withColumnRenamed("key", "message_key")


@query
def json_tolerant_parse(spark, sf):
    rows = decode.decode_candles(inputs.loose_json(inputs.candles(spark, sf)))
    return rows.select("symbol", "open_time", "close_price", "volume", "is_closed")


@query
def csv_export(spark, sf):
    path = fresh_dir(spark, "csv")
    export.export_csv(inputs.candles(spark, sf), path)
    return spark.read.schema(
        "symbol string, interval string, open_time string, open double, high double, low double, close double, volume double",
    ).option("header", True).csv(path)


# --- aggregates ----------------------------------------------------------------------------------

@query
def daily_summary(spark, sf):
    days = summary.daily_summary(inputs.candles(spark, sf))
    return days.select(
        _day("trade_date"), "symbol", "interval", "open_price", "high_price", "low_price", "close_price",
        _r("total_volume", 4), _r("price_change", 4), _r("price_change_pct", 4), _r("daily_range", 4),
        "number_of_candles")


@query
def day_row_counts(spark, sf):
    return summary.day_row_counts(inputs.candles(spark, sf), DAY)


@query
def day_total(spark, sf):
    return summary.day_total(inputs.candles(spark, sf), DAY)


@query
def latest_per_symbol(spark, sf):
    return by_key.latest_by(
        inputs.candles(spark, sf), ["symbol", "interval"], "open_time",
        ["close_time", "close_price", "volume", "number_of_trades", "is_closed"])


# --- indicators and patterns ---------------------------------------------------------------------

@query
def sma(spark, sf):
    return indicators.sma(inputs.closed(spark, sf)).select("symbol", "open_time", "close_price", _r("sma7"), _r("sma25"))


@query
def price_diff(spark, sf):
    return indicators.price_diff(inputs.closed(spark, sf)).select("symbol", "open_time", _r("price_diff"))


@query
def rsi(spark, sf):
    return indicators.rsi(inputs.closed(spark, sf)).select(
        "symbol", "open_time", _r("avg_gain"), _r("avg_loss"), _r("rsi14"))


@query
def macd(spark, sf):
    return indicators.macd(inputs.closed(spark, sf)).select(
        "symbol", "open_time", _r("sma12"), _r("sma26"), _r("macd"), _r("macd_signal"), _r("macd_hist"))


def _indicator_output(df: DataFrame) -> DataFrame:
    return df.select("symbol", "open_time", "close_price", *[_r(c) for c in indicators.INDICATOR_COLUMNS])


@query
def technical_indicators(spark, sf):
    return _indicator_output(indicators.technical_indicators(inputs.closed(spark, sf)))


@query
def technical_indicators_minute(spark, sf):
    return _indicator_output(indicators.technical_indicators(inputs.closed(spark, sf, 60_000, "1m")))


@query
def candle_geometry(spark, sf):
    rows = patterns.candle_geometry(inputs.candles(spark, sf))
    return rows.select("symbol", "open_time", _r("body"), _r("full_range"), _r("lower_shadow"), _r("upper_shadow"))


@query
def pattern_classify(spark, sf):
    return patterns.classify(inputs.candles(spark, sf)).select("symbol", "open_time", "pattern_type")


@query
def pattern_alerts(spark, sf):
    return inputs.alerts(inputs.candles(spark, sf))


# --- table writers -------------------------------------------------------------------------------

def _silver_output(df: DataFrame) -> DataFrame:
    """All columns of a silver table."""
    kinds = {"trade_date": _day("trade_date"), "open_ts": _ms("open_ts"), "close_ts": _ms("close_ts"),
             "ingest_ts": F.unix_micros("ingest_ts").alias("ingest_us")}
    return df.select(*[kinds.get(c, F.col(c)) for c in SILVER.names])


@query
def merge_upsert(spark, sf):
    rows = inputs.candles(spark, sf)
    table = scratch.filled(spark, SILVER, inputs.target(rows), "kline")
    tables.upsert(inputs.source(rows), SILVER, table)
    return _silver_output(spark.table(table))


@query
def replace_day(spark, sf):
    """Day 2024-01-15 is replaced by rows of one symbol, so the other symbols of that day are gone."""
    rows = inputs.candles(spark, sf)
    table = scratch.filled(spark, SILVER, inputs.target(rows), "kline")
    day = clean.on_day(inputs.source(rows), DAY).where("symbol = 'CLICKUSDT'")
    tables.replace_day(day, SILVER, table, DAY)
    return _silver_output(spark.table(table))


def _fact_output(df: DataFrame) -> DataFrame:
    """All columns of a candle fact."""
    kinds = {"date_id": _day("date_id"), **{c: _ms(c) for c in ("open_ts", "close_ts", "updated_at")}}
    return df.select(*[kinds.get(c, F.col(c)) for c in FACT_KLINE.names])


@query
def hot_guarded_upsert(spark, sf):
    """The older candles are final where they closed; hot rows change the others only."""
    rows = inputs.candles(spark, sf)
    dims = inputs.Star(spark, rows)
    batch = star.kline_facts(inputs.target(rows), dims.symbol, dims.interval, dims.source, AS_OF)
    final = tm.whole_div(F.col("open_time"), tm.HOUR_MS) % 10 != 0
    table = scratch.filled(spark, FACT_KLINE, batch.withColumn("is_final", final), "fact_kline")
    tables.upsert(
        inputs.hot_facts(rows, dims), FACT_KLINE, table, update=star.HOT_KLINE_COLUMNS, keep_if="is_final")
    return _fact_output(spark.table(table))


@query
def unify_batch_hot(spark, sf):
    rows = inputs.candles(spark, sf)
    dims = inputs.Star(spark, rows)
    return _fact_output(unify(
        inputs.batch_facts(rows, dims), inputs.hot_facts(rows, dims), FACT_KLINE.key, star.HOT_KLINE_COLUMNS))


@query
def fact_indicator_upsert(spark, sf):
    """Older values of the last 48 hours are there first and then all of them are refreshed."""
    rows = inputs.candles(spark, sf)
    dims = inputs.Star(spark, rows)
    fresh = inputs.indicator_facts(rows, dims, None)
    stale = fresh.withColumns({c: F.lit(0.0) for c in indicators.INDICATOR_COLUMNS}) \
        .where(F.col("open_time") < tm.as_of_ms(AS_OF) - 48 * tm.HOUR_MS)
    table = scratch.filled(spark, FACT_INDICATOR, stale, "fact_indicator")
    tables.upsert(
        inputs.indicator_facts(rows, dims), FACT_INDICATOR, table, update=star.INDICATOR_UPDATE_COLUMNS)
    return spark.table(table).select(
        "symbol_id", "interval_id", _day("date_id"), "open_time", _ms("open_ts"), "close_price",
        *[_r(c) for c in indicators.INDICATOR_COLUMNS])


@query
def alert_insert_absent(spark, sf):
    """Alerts up to the 20th are there already; a run over all of them adds the rest once."""
    rows = inputs.candles(spark, sf)
    dims = inputs.Star(spark, rows)
    found = inputs.alerts(rows)
    every = star.alert_rows(found.unionByName(found), dims.symbol, dims.pattern, AS_OF, None)
    old = every.where(F.col("close_time") < inputs.TARGET_END_MS)
    known = star.new_alerts(old, FACT_ALERT.empty(spark))
    table = scratch.filled(spark, FACT_ALERT, known, "fact_alert")
    fact = spark.table(table)
    tables.append(star.new_alerts(every, fact), FACT_ALERT, table)
    return spark.table(table).select(
        "alert_id", "symbol_id", _day("date_id"), "pattern_type_id", "close_time", _ms("close_ts"), "close_price")


# --- star schema ---------------------------------------------------------------------------------

@query
def dim_symbol(spark, sf):
    """The USDT symbols exist; an upsert of all symbols keeps their ids and adds the other one."""
    rows = inputs.candles(spark, sf)
    known = star.new_symbols(
        DIM_SYMBOL.empty(spark), rows.where(F.col("symbol").endswith("USDT")), AS_OF, inputs.EXCHANGE)
    stale = known.withColumns({"base_asset": F.lit("?"), "is_active": F.lit(False)})
    return star.upsert_symbols(stale, rows, AS_OF, inputs.EXCHANGE).select(
        "symbol_id", "symbol", "base_asset", "quote_asset", "exchange", "market_type", "is_active", _ms("created_at"))


def _date_output(df: DataFrame) -> DataFrame:
    return df.select(_day("date_id"), "year", "month", "day", "quarter", "day_of_week", "is_weekend")


@query
def dim_date(spark, sf):
    return _date_output(star.upsert_dates(
        star.new_dates(DIM_DATE.empty(spark), inputs.candles(spark, sf), "trade_date"),
        inputs.table(spark, sf, "orders"), "o_orderdate"))


@query
def dim_static(spark, sf):
    """Intervals and data sources with the number of candles that refer to them. A second insert adds nothing."""
    rows = inputs.candles(spark, sf)
    dims = inputs.Star(spark, rows)
    sources = dims.source.unionByName(star.new_sources(spark, dims.source))
    facts = inputs.batch_facts(rows, dims).unionByName(inputs.hot_facts(rows, dims))
    per_interval = rows.groupBy(F.col("interval").alias("interval_code")).agg(F.count(F.lit(1)).alias("row_count"))
    per_source = facts.groupBy("data_source_id").agg(F.count(F.lit(1)).alias("row_count"))
    return dims.interval.join(per_interval, "interval_code").select(
        F.lit("interval").alias("dim"), F.col("interval_id").alias("id"), F.col("interval_code").alias("code"),
        F.col("interval_seconds").cast("bigint").alias("seconds"), F.lit(None).cast("string").alias("description"), "row_count",
    ).unionByName(sources.join(per_source, "data_source_id").select(
        F.lit("source").alias("dim"), F.col("data_source_id").alias("id"), F.col("source_code").alias("code"),
        F.lit(0).cast("bigint").alias("seconds"), "description", "row_count"))


@query
def dim_insert_absent(spark, sf):
    """Symbols, dates and pattern types of the newer candles, added to dimensions of the older ones."""
    rows = inputs.candles(spark, sf)
    old, new = inputs.target(rows), inputs.source(rows)
    dates = star.new_dates(DIM_DATE.empty(spark), old, "trade_date")
    more_dates = star.new_dates(dates, new, "trade_date")
    dims = inputs.Star(spark, rows)
    return dates.unionByName(more_dates).select(F.lit("date").alias("dim"), F.col("date_id").cast("string").alias("code")) \
        .unionByName(dims.symbol.select(F.lit("symbol").alias("dim"), F.col("symbol").alias("code"))) \
        .unionByName(star.new_symbols(dims.symbol, new, AS_OF).select(F.lit("again").alias("dim"), F.col("symbol").alias("code"))) \
        .unionByName(dims.pattern.select(F.lit("pattern").alias("dim"), F.col("pattern_type").alias("code")))


@query
def fact_kline_batch(spark, sf):
    rows = inputs.candles(spark, sf)
    dims = inputs.Star(spark, rows)
    return _fact_output(star.kline_facts(rows, dims.symbol, dims.interval, dims.source, AS_OF))


@query
def fact_daily_summary(spark, sf):
    rows = inputs.candles(spark, sf)
    dims = inputs.Star(spark, rows)
    return star.daily_facts(rows, dims.symbol, dims.interval, AS_OF).select(
        _day("date_id"), "symbol_id", "interval_id", "open_price", "high_price", "low_price", "close_price",
        _r("total_volume", 4), _r("price_change", 4), _r("price_change_pct", 4), _r("daily_range", 4),
        "number_of_candles", _ms("updated_at"))


# --- serving -------------------------------------------------------------------------------------

def _unified(rows: DataFrame, dims: inputs.Star, part: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """`part` takes rows of each layer; the newest of both layers have the newest of all among them."""
    return unify(inputs.batch_facts(rows, dims, part), inputs.hot_facts(rows, dims, part), FACT_KLINE.key, star.HOT_KLINE_COLUMNS)


@query
def vw_kline_unified(spark, sf):
    rows = inputs.candles(spark, sf)
    dims = inputs.Star(spark, rows)
    view = views.kline_unified(_unified(rows, dims), dims.symbol, dims.interval, dims.source)
    return view.select(
        "symbol", "interval_code", _day("trade_date"), "open_time", _ms("open_ts"), "close_time", _ms("close_ts"),
        "open_price", "high_price", "low_price", "close_price", "volume", "quote_asset_volume", "number_of_trades",
        "data_source", "is_final", _ms("updated_at"))


@query
def vw_daily_market_summary(spark, sf):
    rows = inputs.candles(spark, sf)
    dims = inputs.Star(spark, rows)
    view = views.daily_market_summary(
        star.daily_facts(rows, dims.symbol, dims.interval, AS_OF), dims.symbol, dims.interval)
    return view.select(
        _day("trade_date"), "symbol", "interval_code", "open_price", "high_price", "low_price", "close_price",
        _r("total_volume", 4), _r("price_change", 4), _r("price_change_pct", 4), _r("daily_range", 4), "number_of_candles",
        _ms("updated_at"))


@query
def vw_latest_snapshot(spark, sf):
    """From the newest candles of both layers and their indicators, as the jobs keep them beside the facts."""
    rows = inputs.candles(spark, sf)
    dims = inputs.Star(spark, rows)
    newest = _unified(rows, dims, lambda df: by_key.latest_by(df, indicators.SERIES, "open_time"))
    values = indicators.newest_indicators(indicators.closed_candles(rows)).drop("interval")
    view = views.latest_snapshot(
        newest, dims.symbol, dims.interval, dims.source,
        star.indicator_facts(values, dims.symbol, dims.interval, AS_OF, None, "1h"))
    return view.select(
        "symbol", "interval_code", "open_time", _ms("open_ts"), "close_price", "volume", "data_source", "is_final",
        *[_r(c) for c in indicators.INDICATOR_COLUMNS], _ms("updated_at"))


@query
def vw_pattern_alerts_recent(spark, sf):
    rows = inputs.candles(spark, sf)
    dims = inputs.Star(spark, rows)
    fact = star.alert_rows(inputs.alerts(rows), dims.symbol, dims.pattern, AS_OF, None)
    view = views.recent_alerts(fact, dims.symbol, dims.date, dims.pattern, AS_OF)
    return view.select("symbol", _day("trade_date"), "pattern_type", "close_time", _ms("close_ts"), "close_price")


@query
def symbol_point_read(spark, sf):
    """The candles of one symbol, newest first, from a fact table whose files let a reader skip the other symbols."""
    rows = inputs.candles(spark, sf)
    dims = inputs.Star(spark, rows)
    table = scratch.filled(spark, FACT_KLINE, star.kline_facts(rows, dims.symbol, dims.interval, dims.source, AS_OF), "fact_kline")
    wanted = dims.symbol.where("symbol = 'CLICKUSDT'").agg(F.max("symbol_id")).scalar()
    return _fact_output(spark.table(table).where(F.col("symbol_id") == wanted).orderBy(F.desc("open_time")))


# --- integrity -----------------------------------------------------------------------------------

@query
def check_not_null(spark, sf):
    rows = clean.clean_bronze(inputs.bronze(inputs.candles(spark, sf)))
    broken = inputs.dirty(rows).select("symbol", "interval", "open_time", F.col("close_price").try_cast("double").alias("close_price"))
    return not_null_counts(broken, SILVER.not_null)


@query
def check_unique(spark, sf):
    return duplicate_keys(inputs.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def check_foreign_key(spark, sf):
    """Event users that are no supplier, with their number of events."""
    return missing_references(
        inputs.table(spark, sf, "events"), "user_id", inputs.table(spark, sf, "supplier"), "s_suppkey")


# --- jobs ----------------------------------------------------------------------------------------

@query
def backfill_equals_loop(spark, sf):
    """Two overlapping backfill jobs and a loop of daily merges over bronze that holds an older version of every
    candle too. Every row of silver with the number of the two tables that have it."""
    rows = inputs.candles(spark, sf)
    root = fresh_dir(spark, "bronze")
    older = rows.withColumns({"close_price": F.col("close_price") + 5, "ingest_ts": F.col("ingest_ts") - F.make_dt_interval(F.lit(1))})
    bronze_files.write_bronze(inputs.bronze(rows).unionByName(inputs.bronze(older)), root)
    once, loop = (f"{scratch.namespace(spark, name)}.kline" for name in ("once", "loop"))
    for start, end in (("2024-01-10", "2024-01-13"), ("2024-01-12", "2024-01-15")):
        jobs.backfill(spark, root, once, start, end, "1h")
    for day in range(10, 15):
        jobs.bronze_to_silver(spark, root, loop, f"2024-01-{day}", "1h", "merge")
    both = _silver_output(spark.table(once)).unionAll(_silver_output(spark.table(loop)))
    return both.groupBy(*both.columns).agg(F.count(F.lit(1)).alias("tables"))


@query
def bootstrap_days(spark, sf):
    """Two days are appended to an empty silver table, one of them twice, and one that bronze lacks adds no rows but keeps the types."""
    rows = inputs.candles(spark, sf)
    root, table = fresh_dir(spark, "bronze"), f"{scratch.namespace(spark, 'silver')}.kline"
    bronze_files.write_bronze(inputs.bronze(rows), root)
    for day in (DAY, "2024-01-16", "2020-01-01", DAY):
        jobs.bronze_to_silver(spark, root, table, day, "1h", "bootstrap")
    none = clean.silver_rows(bronze_files.read_bronze(spark, root, "1h", "2020-01-01"))
    return _silver_output(spark.table(table).select(*SILVER.names).unionByName(none))


@query
def overwrite_day_guard(spark, sf):
    """Day 2024-01-15 is overwritten from bronze; day 2024-01-10, which bronze lacks, is refused and stays."""
    rows = inputs.candles(spark, sf)
    table = scratch.filled(spark, SILVER, inputs.target(rows), "kline")
    root = fresh_dir(spark, "bronze")
    bronze_files.write_bronze(inputs.bronze(inputs.source(rows)), root)
    jobs.bronze_to_silver(spark, root, table, DAY, "1h", "overwrite-day")
    try:
        jobs.bronze_to_silver(spark, root, table, "2024-01-10", "1h", "overwrite-day")
    except FileNotFoundError:
        return _silver_output(spark.table(table))
    raise AssertionError("a day without bronze files was overwritten")


@query
def daily_chain(spark, sf):
    """Pages to bronze, silver and gold for one day, then the stream rows since; the unified view."""
    rows = inputs.candles(spark, sf)
    pages = fresh_dir(spark, "pages")
    inputs.pages(rows).withColumn("day", F.date_from_unix_date(F.col("page_no").cast("int"))).write.partitionBy("day").json(pages)
    silver, gold, hot = (scratch.namespace(spark, n) for n in ("silver", "gold", "hot"))
    tables.ensure_hot(spark, hot)
    sinks.write_batch(inputs.stream_rows(inputs.source(rows)), 0, "candle", hot)
    sinks.write_batch(indicators.technical_indicators(inputs.closed(spark, sf)).drop("interval"), 0, "indicator", hot)
    sinks.write_batch(patterns.pattern_alerts(inputs.stream_rows(inputs.source(rows))), 0, "alert", hot)
    places = jobs.Places(fresh_dir(spark, "bronze"), f"{silver}.kline", gold, hot, pages)
    names = ",".join(r.symbol.lower() for r in rows.select("symbol").distinct().collect())
    jobs.run_day(spark, places, "2024-01-16", "2024-01-17T00:00:00", names, "1h", 24)
    view = views.kline_unified(*[spark.table(f"{gold}.{t}") for t in (
        "fact_kline", "dim_symbol", "dim_interval", "dim_data_source")])
    return view.select(
        "symbol", "interval_code", _day("trade_date"), "open_time", "close_price", "number_of_trades", "data_source", "is_final")


@query
def hot_refresh_incremental(spark, sf):
    """A final day, then the stream tables in two loads: the second brings corrected candles, and the first ones once more,
    which count no longer. A third load has nothing to read."""
    rows = inputs.candles(spark, sf)
    silver, gold, hot = (scratch.namespace(spark, n) for n in ("silver", "gold", "hot"))
    tables.ensure_silver(spark, f"{silver}.kline")
    tables.append(clean.on_day(rows, DAY), SILVER, f"{silver}.kline")
    tables.ensure_hot(spark, hot)
    jobs.ensure_static(spark, gold, ["1h"])
    jobs.load_batch(spark, f"{silver}.kline", gold, DAY, "1h", AS_OF, inputs.EXCHANGE)
    values = indicators.technical_indicators(inputs.closed(spark, sf)).drop("interval")
    first, second = inputs.stream_rows(inputs.target(rows)), inputs.stream_rows(inputs.source(rows))
    found = patterns.pattern_alerts(inputs.stream_rows(rows))

    def write(batch_id, candles, alerts, value_rows):
        for name, batch in (("candle", candles), ("alert", alerts), ("indicator", value_rows)):
            sinks.write_batch(batch, batch_id, name, hot)

    def load() -> dict[str, int]:
        return jobs.load_new_hot(spark, hot, gold, state, AS_OF, 31 * 24, "1h", inputs.EXCHANGE)

    state = fresh_dir(spark, "state")
    write(0, first, inputs.target(found), inputs.target(values))
    load()
    write(1, second, found, values)
    write(0, first, inputs.target(found), inputs.target(values))
    load()
    if any(again := load().values()):
        raise AssertionError(f"a load without new files read {again}")
    t = {name: spark.table(f"{gold}.{name}") for name in (
        "fact_kline", "fact_technical_indicator", "fact_pattern_alert", "dim_symbol", "dim_interval", "dim_data_source", "dim_pattern_type")}
    candles = views.kline_unified(t["fact_kline"], t["dim_symbol"], t["dim_interval"], t["dim_data_source"])
    named = t["dim_symbol"].select("symbol_id", "symbol")
    return candles.select(F.col("data_source").alias("kind"), "symbol", F.col("open_time").alias("time"), _r("close_price")) \
        .unionByName(t["fact_technical_indicator"].join(named, "symbol_id").select(
            F.lit("indicator").alias("kind"), "symbol", F.col("open_time").alias("time"), F.round("rsi14", 6).alias("close_price"))) \
        .unionByName(t["fact_pattern_alert"].join(named, "symbol_id").join(t["dim_pattern_type"], "pattern_type_id").select(
            F.col("pattern_type").alias("kind"), "symbol", F.col("close_time").alias("time"), _r("close_price")))


# --- streaming -----------------------------------------------------------------------------------

def _landed(spark: SparkSession, rows: DataFrame) -> str:
    folder = fresh_dir(spark, "landed")
    scratch.land_json(rows, folder)
    return folder


def _run(spark: SparkSession, folder: str, hot: str, checkpoints: str) -> None:
    speed_layer.drain(speed_layer.run_speed_layer(
        spark, "text", {"path": folder}, hot, checkpoints, trigger=NOW,
        state_partitions=spark.sparkContext.defaultParallelism))


@query
def stream_raw_upsert(spark, sf):
    """All candles arrive, then the newer part arrives again with corrected closes."""
    rows = inputs.candles(spark, sf)
    folder, hot, state = _landed(spark, rows), scratch.namespace(spark, "hot"), fresh_dir(spark, "state")
    tables.ensure_hot(spark, hot)
    for attempt in range(2):
        stream = read_candle_stream(spark, "text", {"path": folder})
        speed_layer.drain([speed_layer.start_raw_and_alerts(stream, hot, state, NOW)])
        if attempt == 0:
            scratch.land_json(inputs.source(rows), folder)
    return sinks.read_hot(spark, hot, "candle").select(*STREAM_CANDLE.names)


@query
def stream_restart_newest(spark, sf):
    """All candles arrive in several batches, the newer part again with corrected closes to a stream that starts over; then a
    day is compacted. The corrected closes stay."""
    rows = inputs.stream_rows(inputs.candles(spark, sf))
    hot = scratch.namespace(spark, "hot")
    tables.ensure_hot(spark, hot)
    first, second = fresh_dir(spark, "landed"), fresh_dir(spark, "landed")
    for part in range(3):
        scratch.land_json(rows.where(F.pmod(tm.whole_div(F.col("open_time"), tm.HOUR_MS), F.lit(3)) == part).coalesce(1), first)
    scratch.land_json(inputs.source(rows), second)
    for folder, options in ((first, {"maxFilesPerTrigger": "1"}), (second, {})):
        stream = read_candle_stream(spark, "text", {"path": folder, **options})
        speed_layer.drain([speed_layer.start_raw_and_alerts(stream, hot, fresh_dir(spark, "state"), NOW)])
    sinks.compact(spark, hot, "candle", DAY)
    return sinks.read_hot(spark, hot, "candle").select(*STREAM_CANDLE.names)


@query
def stream_pattern_alerts(spark, sf):
    rows = inputs.candles(spark, sf)
    folder, hot = _landed(spark, rows), scratch.namespace(spark, "hot")
    tables.ensure_hot(spark, hot)
    stream = read_candle_stream(spark, "text", {"path": folder})
    speed_layer.drain([speed_layer.start_raw_and_alerts(stream, hot, fresh_dir(spark, "state"), NOW)])
    return sinks.read_hot(spark, hot, "alert")


def _run_indicators(spark: SparkSession, folder: str, hot: str, checkpoints: str, history: DataFrame | None = None) -> None:
    stream = read_candle_stream(spark, "text", {"path": folder})
    speed_layer.drain([speed_layer.start_indicators(
        stream, hot, checkpoints, NOW, state_partitions=spark.sparkContext.defaultParallelism, history=history)])


@query
def stream_indicators(spark, sf):
    rows = inputs.stream_rows(inputs.candles(spark, sf))
    folder, hot = _landed(spark, rows), scratch.namespace(spark, "hot")
    tables.ensure_hot(spark, hot)
    scratch.land_json(scratch.sentinel(rows), folder)
    _run_indicators(spark, folder, hot, fresh_dir(spark, "state"))
    return _indicator_output(sinks.read_hot(spark, hot, "indicator"))


@query
def stream_warm_start(spark, sf):
    """A stream of the newer candles and some before them goes on from the older ones, which are in silver: its values are the
    end of those over all candles."""
    rows = inputs.candles(spark, sf)
    silver = scratch.filled(spark, SILVER, rows.where(F.col("open_time") < inputs.SOURCE_START_MS), "kline")
    history = recent_closes(indicators.closed_candles(clean.of_interval(spark.table(silver), "1h")))
    late = inputs.stream_rows(rows.where(F.col("open_time") >= inputs.SOURCE_START_MS - 5 * tm.HOUR_MS))
    folder, hot = _landed(spark, late), scratch.namespace(spark, "hot")
    tables.ensure_hot(spark, hot)
    scratch.land_json(scratch.sentinel(late), folder)
    _run_indicators(spark, folder, hot, fresh_dir(spark, "state"), history)
    return _indicator_output(sinks.read_hot(spark, hot, "indicator"))


@query
def stream_late_drop(spark, sf):
    """After the older candles were emitted, altered copies of them arrive too late to count."""
    rows = inputs.stream_rows(inputs.candles(spark, sf))
    older, newer = inputs.target(rows), rows.where(F.col("open_time") >= inputs.TARGET_END_MS)
    folder, hot, state = _landed(spark, older), scratch.namespace(spark, "hot"), fresh_dir(spark, "state")
    tables.ensure_hot(spark, hot)
    _run_indicators(spark, folder, hot, state)
    late = older.where(F.col("open_time") < inputs.SOURCE_START_MS)
    scratch.land_json(late.withColumn("close_price", F.col("close_price") + 1000), folder)
    scratch.land_json(newer, folder)
    scratch.land_json(scratch.sentinel(rows), folder)
    _run_indicators(spark, folder, hot, state)
    return _indicator_output(sinks.read_hot(spark, hot, "indicator"))


@query
def stream_replay_idempotent(spark, sf):
    """The whole input runs twice into the same tables, the second time from a new checkpoint."""
    rows = inputs.stream_rows(inputs.candles(spark, sf))
    folder, hot = _landed(spark, rows), scratch.namespace(spark, "hot")
    scratch.land_json(scratch.sentinel(rows), folder)
    for _ in range(2):
        _run(spark, folder, hot, fresh_dir(spark, "state"))
    real = F.col("symbol") != "SENTINEL"
    candles = sinks.read_hot(spark, hot, "candle").where(real)
    values = sinks.read_hot(spark, hot, "indicator")
    alerts = sinks.read_hot(spark, hot, "alert")
    return candles.select(F.lit("candle").alias("kind"), "symbol", F.col("open_time").alias("time"), _r("close_price")) \
        .unionByName(values.select(F.lit("indicator").alias("kind"), "symbol", F.col("open_time").alias("time"), F.round("rsi14", 6).alias("close_price"))) \
        .unionByName(alerts.select(F.col("pattern_type").alias("kind"), "symbol", F.col("close_time").alias("time"), _r("close_price")))
