"""The same results in plain SQL (DuckDB), written independently of the Spark code."""

from __future__ import annotations

AS_OF = 1_706_659_200_000
TARGET_END = 1_705_708_800_000
SOURCE_START = 1_705_276_800_000
HOUR = 3_600_000

ORACLES: dict[str, str] = {}


def candles(step: int = HOUR, unit: str = "hour", code: str = "1h") -> str:
    return f"""
ev AS (
  SELECT upper(event_type) || CASE WHEN event_type = 'error' THEN 'BTC' ELSE 'USDT' END AS symbol,
         epoch_ms(date_trunc('{unit}', ts)) AS open_time, event_id, value, ts
  FROM events),
candles AS (
  SELECT symbol, '{code}' AS "interval", open_time, open_time + {step - 1} AS close_time,
         arg_min_null(value, event_id) AS open_price, max(value) AS high_price, min(value) AS low_price,
         arg_max_null(value, event_id) AS close_price, round(sum(value), 4) AS volume,
         round(sum(value * 2), 4) AS quote_asset_volume, CAST(count(*) AS BIGINT) AS number_of_trades,
         round(sum(CASE WHEN event_id % 2 = 0 THEN value ELSE 0 END), 4) AS taker_buy_base_volume,
         round(sum(CASE WHEN event_id % 2 = 0 THEN value * 2 ELSE 0 END), 4) AS taker_buy_quote_volume,
         (open_time // {step}) % 10 <> 0 AS is_closed, epoch_us(max(ts)) AS ingest_us, 'fixture' AS source,
         strftime(make_timestamp(open_time * 1000), '%Y-%m-%d') AS trade_date
  FROM ev GROUP BY symbol, open_time)"""


CANDLES = "WITH " + candles()

CHAIN = """
i1 AS (
  SELECT *,
    avg(close_price) OVER (PARTITION BY symbol ORDER BY open_time ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS sma7,
    avg(close_price) OVER (PARTITION BY symbol ORDER BY open_time ROWS BETWEEN 24 PRECEDING AND CURRENT ROW) AS sma25,
    avg(close_price) OVER (PARTITION BY symbol ORDER BY open_time ROWS BETWEEN 11 PRECEDING AND CURRENT ROW) AS sma12,
    avg(close_price) OVER (PARTITION BY symbol ORDER BY open_time ROWS BETWEEN 25 PRECEDING AND CURRENT ROW) AS sma26,
    close_price - lag(close_price) OVER (PARTITION BY symbol ORDER BY open_time) AS price_diff
  FROM {source} WHERE is_closed),
i2 AS (
  SELECT *, CASE WHEN price_diff > 0 THEN price_diff ELSE 0.0 END AS gain,
         CASE WHEN price_diff < 0 THEN abs(price_diff) ELSE 0.0 END AS loss, sma12 - sma26 AS macd FROM i1),
i3 AS (
  SELECT *,
    avg(CAST(gain AS DOUBLE)) OVER (PARTITION BY symbol ORDER BY open_time ROWS BETWEEN 13 PRECEDING AND CURRENT ROW) AS avg_gain,
    avg(CAST(loss AS DOUBLE)) OVER (PARTITION BY symbol ORDER BY open_time ROWS BETWEEN 13 PRECEDING AND CURRENT ROW) AS avg_loss,
    avg(macd) OVER (PARTITION BY symbol ORDER BY open_time ROWS BETWEEN 8 PRECEDING AND CURRENT ROW) AS macd_signal
  FROM i2),
ind AS (
  SELECT *, CASE WHEN avg_loss = 0 THEN 100.0 ELSE 100.0 - 100.0 / (1.0 + avg_gain / avg_loss) END AS rsi14,
         macd - macd_signal AS macd_hist FROM i3)"""

INDICATORS = CANDLES + "," + CHAIN.replace("{source}", "candles")
SIX = ("round(sma7, 6) AS sma7, round(sma25, 6) AS sma25, round(rsi14, 6) AS rsi14, round(macd, 6) AS macd, "
       "round(macd_signal, 6) AS macd_signal, round(macd_hist, 6) AS macd_hist")
INDICATOR_OUT = f"SELECT symbol, open_time, close_price, {SIX} FROM ind"

GEOMETRY = """
geo AS (
  SELECT *, abs(close_price - open_price) AS body, high_price - low_price AS full_range,
         least(open_price, close_price) - low_price AS lower_shadow,
         high_price - greatest(open_price, close_price) AS upper_shadow FROM candles),
pat AS (
  SELECT *, CASE WHEN body <= full_range * 0.1 THEN 'DOJI'
                 WHEN lower_shadow >= 2 * body AND upper_shadow <= 0.1 * body THEN 'HAMMER'
                 ELSE 'UNKNOWN' END AS pattern_type FROM geo),
alerts AS (
  SELECT symbol, close_time, pattern_type, close_price FROM pat
  WHERE is_closed AND high_price > low_price AND pattern_type <> 'UNKNOWN')"""

PATTERNS = CANDLES + "," + GEOMETRY

DAILY = """
daily AS (
  SELECT trade_date, symbol, "interval", arg_min_null(open_price, open_time) AS open_price,
         max(high_price) AS high_price, min(low_price) AS low_price,
         arg_max_null(close_price, open_time) AS close_price, sum(volume) AS total_volume,
         CAST(count(*) AS BIGINT) AS number_of_candles
  FROM candles GROUP BY trade_date, symbol, "interval"),
days AS (
  SELECT trade_date, symbol, "interval", open_price, high_price, low_price, close_price,
         round(total_volume, 4) AS total_volume, round(close_price - open_price, 4) AS price_change,
         round((close_price - open_price) / nullif(open_price, 0) * 100.0, 4) AS price_change_pct,
         round(high_price - low_price, 4) AS daily_range, number_of_candles
  FROM daily)"""

IDS = """
sym AS (SELECT symbol, row_number() OVER (ORDER BY symbol) AS symbol_id FROM (SELECT DISTINCT symbol FROM candles))"""

# The older candles and the newer ones with changed closes.
PAIR = f"""
tgt AS (SELECT * FROM candles WHERE open_time < {TARGET_END}),
src AS (SELECT * REPLACE (close_price + 1 AS close_price) FROM candles WHERE open_time >= {SOURCE_START})"""

SILVER_OUT = """symbol, "interval", open_time, close_time, open_time // 1000 * 1000 AS open_ts,
       close_time // 1000 * 1000 AS close_ts, open_price, high_price, low_price, close_price, volume, quote_asset_volume,
       number_of_trades, taker_buy_base_volume, taker_buy_quote_volume, is_closed, trade_date, ingest_us, source"""

FACT_OUT = f"""
SELECT s.symbol_id, CAST(1 AS BIGINT) AS interval_id, u.trade_date AS date_id, u.open_time, u.open_ms AS open_ts,
       u.close_time, u.close_ms AS close_ts, u.open_price, u.high_price, u.low_price, u.close_price, u.volume,
       u.quote_asset_volume, u.number_of_trades, u.taker_buy_base_volume, u.taker_buy_quote_volume,
       CAST(u.data_source_id AS BIGINT) AS data_source_id, u.is_final, CAST({AS_OF} AS BIGINT) AS updated_at
FROM u JOIN sym s USING (symbol)"""


def _unified(final: str) -> str:
    """Batch rows and hot rows by key; `final` says which batch rows are final."""
    return f"""
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY symbol, open_time ORDER BY prio) AS rn,
         max(CASE WHEN origin = 'b' THEN number_of_trades END) OVER (PARTITION BY symbol, open_time) AS trades,
         max(CASE WHEN origin = 'b' THEN quote_asset_volume END) OVER (PARTITION BY symbol, open_time) AS quote,
         max(CASE WHEN origin = 'b' THEN taker_buy_base_volume END) OVER (PARTITION BY symbol, open_time) AS taker_base,
         max(CASE WHEN origin = 'b' THEN taker_buy_quote_volume END) OVER (PARTITION BY symbol, open_time) AS taker_quote
  FROM (
    SELECT *, 'b' AS origin, {final} AS is_final, CASE WHEN {final} THEN 0 ELSE 2 END AS prio FROM tgt
    UNION ALL SELECT *, 'h' AS origin, FALSE AS is_final, 1 AS prio FROM src)),
u AS (
  SELECT symbol, "interval", trade_date, open_time, close_time, open_price, high_price, low_price, close_price, volume,
         quote AS quote_asset_volume, trades AS number_of_trades, taker_base AS taker_buy_base_volume,
         taker_quote AS taker_buy_quote_volume, is_final,
         CASE WHEN origin = 'b' THEN 1 ELSE 2 END AS data_source_id,
         CASE WHEN origin = 'b' THEN open_time // 1000 * 1000 ELSE open_time END AS open_ms,
         CASE WHEN origin = 'b' THEN close_time // 1000 * 1000 ELSE close_time END AS close_ms
  FROM ranked WHERE rn = 1)"""


# --- scans and filters ---------------------------------------------------------------------------

ORACLES["bronze_day_counts"] = CANDLES + """
SELECT symbol, trade_date, CAST(count(*) AS BIGINT) AS row_count, round(sum(volume), 4) AS volume FROM candles
WHERE trade_date >= '2024-01-05' AND trade_date < '2024-01-25' GROUP BY symbol, trade_date"""

ORACLES["silver_day_scan"] = CANDLES + """
SELECT symbol, "interval", open_time, close_price, volume, trade_date FROM candles WHERE trade_date = '2024-01-15'"""

ORACLES["day_range_scan"] = CANDLES + """
SELECT symbol, open_time, close_price, strftime(CAST(trade_date AS DATE) + 1, '%Y-%m-%d') AS next_day
FROM candles WHERE trade_date >= '2024-01-10' AND trade_date < '2024-01-13'"""

ORACLES["symbol_filter"] = CANDLES + """
SELECT symbol, open_time, close_price, symbol || '|VIEWUSDT' AS listed
FROM candles WHERE symbol IN ('CLICKUSDT', 'ERRORBTC')"""

ORACLES["hot_lookback"] = CANDLES + f"""
SELECT symbol, open_time, close_time, close_price, is_closed FROM candles WHERE open_time >= {AS_OF} - 48 * {HOUR}"""

ORACLES["bronze_partition_path"] = CANDLES + """
SELECT DISTINCT 'bronze/kline/interval=1h/symbol=' || symbol || '/year=' || substr(trade_date, 1, 4)
  || '/month=' || substr(trade_date, 6, 2) || '/day=' || substr(trade_date, 9, 2)
  || '/part-' || symbol || '-1h-' || trade_date || '.parquet' AS path FROM candles"""

# --- scalars -------------------------------------------------------------------------------------

ORACLES["epoch_conversions"] = CANDLES + """
SELECT symbol, open_time, close_time // 1000 * 1000 AS whole_seconds_ms, close_time AS millis_ms, trade_date,
       epoch_ms(CAST(trade_date AS TIMESTAMP)) AS day_ms FROM candles"""

ORACLES["interval_seconds"] = """
SELECT DISTINCT p_size || unit AS code,
  CAST(p_size * CASE unit WHEN 's' THEN 1 WHEN 'm' THEN 60 WHEN 'h' THEN 3600 WHEN 'd' THEN 86400
                          WHEN 'w' THEN 604800 END AS BIGINT) AS seconds
FROM (SELECT p_size, ['s', 'm', 'h', 'd', 'w', 'M'][CAST(p_partkey % 6 AS INTEGER) + 1] AS unit FROM part)"""

ORACLES["symbol_assets"] = """
SELECT symbol, CASE WHEN symbol LIKE '%USDT' THEN replace(symbol, 'USDT', '') ELSE symbol END AS base_asset,
       CASE WHEN symbol LIKE '%USDT' THEN 'USDT' END AS quote_asset
FROM (SELECT DISTINCT CASE WHEN c_custkey % 3 = 0 THEN 'USDT' ELSE '' END || upper(c_mktsegment)
        || CASE WHEN c_custkey % 2 = 0 THEN 'USDT' ELSE 'BTC' END AS symbol FROM customer)"""

# --- cleaning and decoding -----------------------------------------------------------------------

ORACLES["silver_clean"] = CANDLES + """
SELECT symbol, "interval", open_time, close_time, open_time // 1000 * 1000 AS open_ts,
       close_time // 1000 * 1000 AS close_ts, open_price, high_price, low_price, close_price, volume,
       quote_asset_volume, number_of_trades, taker_buy_base_volume, taker_buy_quote_volume, is_closed, trade_date,
       ingest_us, source
FROM candles WHERE (open_time // 3600000) % 97 <> 0 AND (open_time // 3600000) % 89 <> 0"""

ORACLES["dedup_latest"] = """
SELECT * EXCLUDE (rn) REPLACE (strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate) FROM (
  SELECT *, row_number() OVER (
    PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate DESC NULLS LAST, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
             l_returnflag, l_linestatus) AS rn FROM lineitem)
WHERE rn = 1"""

ORACLES["rest_page_decode"] = CANDLES + """
SELECT symbol, "interval", open_time, open_price, high_price, low_price, close_price, volume, close_time,
       quote_asset_volume, number_of_trades, taker_buy_base_volume, taker_buy_quote_volume, TRUE AS is_closed,
       '2024-01-31T00:00:00+00:00' AS ingest_ts, 'rest_api' AS source FROM candles"""

_KIND = """
CASE WHEN (open_time // 3600000) % 50 = 0 THEN 'garbage' WHEN (open_time // 3600000) % 60 = 1 THEN 'bad'
     WHEN (open_time // 3600000) % 70 = 2 THEN 'trade' ELSE 'kline' END"""
_STREAM = "symbol, open_time, close_time, open_price, high_price, low_price, close_price, volume, is_closed"

ORACLES["event_decode"] = CANDLES + f"SELECT {_STREAM} FROM candles WHERE {_KIND} = 'kline'"

ORACLES["event_encode"] = CANDLES + f"SELECT {_STREAM}, symbol AS message_key FROM candles"

ORACLES["json_tolerant_parse"] = CANDLES + f"""
SELECT symbol, open_time, CASE WHEN {_KIND} = 'bad' THEN NULL ELSE close_price END AS close_price, volume, is_closed
FROM candles WHERE {_KIND} IN ('kline', 'bad')"""

ORACLES["csv_export"] = CANDLES + """
SELECT symbol, "interval", strftime(make_timestamp(open_time * 1000), '%Y-%m-%d %H:%M:%S') AS open_time, open_price AS open,
       high_price AS high, low_price AS low, close_price AS close, volume FROM candles"""

# --- aggregates ----------------------------------------------------------------------------------

ORACLES["daily_summary"] = CANDLES + "," + DAILY + " SELECT * FROM days"

ORACLES["day_row_counts"] = CANDLES + """
SELECT symbol, CAST(count(*) AS BIGINT) AS row_count FROM candles WHERE trade_date = '2024-01-15'
GROUP BY symbol"""

ORACLES["day_total"] = CANDLES + """
SELECT CAST(count(*) AS BIGINT) AS row_count FROM candles WHERE trade_date = '2024-01-15'"""

ORACLES["latest_per_symbol"] = CANDLES + """
SELECT symbol, "interval", open_time, close_time, close_price, volume, number_of_trades, is_closed FROM (
  SELECT *, row_number() OVER (PARTITION BY symbol, "interval" ORDER BY open_time DESC) AS rn FROM candles)
WHERE rn = 1"""

# --- indicators and patterns ---------------------------------------------------------------------

ORACLES["sma"] = INDICATORS + """
SELECT symbol, open_time, close_price, round(sma7, 6) AS sma7, round(sma25, 6) AS sma25 FROM ind"""

ORACLES["price_diff"] = INDICATORS + " SELECT symbol, open_time, round(price_diff, 6) AS price_diff FROM ind"

ORACLES["rsi"] = INDICATORS + """
SELECT symbol, open_time, round(avg_gain, 6) AS avg_gain, round(avg_loss, 6) AS avg_loss, round(rsi14, 6) AS rsi14
FROM ind"""

ORACLES["macd"] = INDICATORS + """
SELECT symbol, open_time, round(sma12, 6) AS sma12, round(sma26, 6) AS sma26, round(macd, 6) AS macd,
       round(macd_signal, 6) AS macd_signal, round(macd_hist, 6) AS macd_hist FROM ind"""

ORACLES["technical_indicators"] = INDICATORS + INDICATOR_OUT

ORACLES["technical_indicators_minute"] = (
    "WITH " + candles(60_000, "minute", "1m") + "," + CHAIN.replace("{source}", "candles") + INDICATOR_OUT)

ORACLES["candle_geometry"] = PATTERNS + """
SELECT symbol, open_time, round(body, 6) AS body, round(full_range, 6) AS full_range,
       round(lower_shadow, 6) AS lower_shadow, round(upper_shadow, 6) AS upper_shadow FROM geo"""

ORACLES["pattern_classify"] = PATTERNS + " SELECT symbol, open_time, pattern_type FROM pat"

ORACLES["pattern_alerts"] = PATTERNS + " SELECT * FROM alerts"

# --- table writers -------------------------------------------------------------------------------

ORACLES["merge_upsert"] = CANDLES + "," + PAIR + f"""
SELECT {SILVER_OUT} FROM (
  SELECT *, row_number() OVER (PARTITION BY symbol, "interval", open_time ORDER BY prio) AS rn
  FROM (SELECT *, 0 AS prio FROM src UNION ALL SELECT *, 1 AS prio FROM tgt))
WHERE rn = 1"""

ORACLES["replace_day"] = CANDLES + "," + PAIR + f"""
SELECT {SILVER_OUT} FROM tgt WHERE trade_date <> '2024-01-15'
UNION ALL SELECT {SILVER_OUT} FROM src WHERE trade_date = '2024-01-15' AND symbol = 'CLICKUSDT'"""

ORACLES["hot_guarded_upsert"] = CANDLES + "," + PAIR + "," + IDS + "," + _unified("is_closed").replace(
    "SELECT *, 'b' AS origin", "SELECT * EXCLUDE (is_closed), 'b' AS origin").replace(
    "SELECT *, 'h' AS origin", "SELECT * EXCLUDE (is_closed), 'h' AS origin") + FACT_OUT

ORACLES["unify_batch_hot"] = CANDLES + "," + PAIR + "," + IDS + "," + _unified("TRUE") + FACT_OUT

ORACLES["fact_indicator_upsert"] = INDICATORS + "," + IDS + f"""
SELECT s.symbol_id, CAST(1 AS BIGINT) AS interval_id, trade_date AS date_id, open_time, open_time AS open_ts,
       close_price, {', '.join(
           f"CASE WHEN open_time >= {AS_OF} - 48 * {HOUR} THEN round({c}, 6) ELSE 0.0 END AS {c}"
           for c in ("sma7", "sma25", "rsi14", "macd", "macd_signal", "macd_hist"))}
FROM ind JOIN sym s USING (symbol)"""

ORACLES["alert_insert_absent"] = PATTERNS + "," + IDS + f""",
pt AS (SELECT pattern_type, row_number() OVER (ORDER BY pattern_type) AS pattern_type_id
       FROM (SELECT DISTINCT pattern_type FROM alerts)),
rows_ AS (
  SELECT s.symbol_id, strftime(make_timestamp(close_time * 1000), '%Y-%m-%d') AS date_id, p.pattern_type_id,
         close_time, close_time AS close_ts, close_price, CASE WHEN close_time < {TARGET_END} THEN 0 ELSE 1 END AS run
  FROM alerts JOIN sym s USING (symbol) JOIN pt p USING (pattern_type))
SELECT row_number() OVER (ORDER BY run, date_id, symbol_id, close_time, pattern_type_id, close_price) AS alert_id,
       symbol_id, date_id, pattern_type_id, close_time, close_ts, close_price FROM rows_"""

# --- star schema ---------------------------------------------------------------------------------

ORACLES["dim_symbol"] = CANDLES + f"""
SELECT row_number() OVER (ORDER BY symbol NOT LIKE '%USDT', symbol) AS symbol_id, symbol,
       CASE WHEN symbol LIKE '%USDT' THEN replace(symbol, 'USDT', '') ELSE symbol END AS base_asset,
       CASE WHEN symbol LIKE '%USDT' THEN 'USDT' END AS quote_asset, 'exchange' AS exchange, 'spot' AS market_type,
       TRUE AS is_active, CAST({AS_OF} AS BIGINT) AS created_at
FROM (SELECT DISTINCT symbol FROM candles)"""

ORACLES["dim_date"] = CANDLES + """
SELECT strftime(d, '%Y-%m-%d') AS date_id, CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month,
       CAST(day(d) AS INTEGER) AS day, CAST((month(d) - 1) // 3 + 1 AS INTEGER) AS quarter,
       CAST(isodow(d) AS INTEGER) AS day_of_week, isodow(d) IN (6, 7) AS is_weekend
FROM (SELECT CAST(trade_date AS DATE) AS d FROM candles UNION SELECT CAST(o_orderdate AS DATE) FROM orders)"""

ORACLES["dim_static"] = CANDLES + "," + PAIR + """
SELECT 'interval' AS dim, CAST(1 AS BIGINT) AS id, "interval" AS code, CAST(3600 AS BIGINT) AS seconds,
       CAST(NULL AS VARCHAR) AS description, CAST(count(*) AS BIGINT) AS row_count FROM candles GROUP BY "interval"
UNION ALL SELECT 'source', 1, 'batch_silver', 0, 'Final history from the silver table', count(*) FROM tgt
UNION ALL SELECT 'source', 2, 'speed_hot', 0, 'Recent rows from the stream', count(*) FROM src"""

ORACLES["dim_insert_absent"] = PATTERNS + """
SELECT DISTINCT 'date' AS dim, trade_date AS code FROM candles
UNION ALL SELECT DISTINCT 'symbol', symbol FROM candles
UNION ALL SELECT DISTINCT 'pattern', pattern_type FROM alerts"""

ORACLES["fact_kline_batch"] = CANDLES + "," + IDS + """,
u AS (SELECT *, open_time // 1000 * 1000 AS open_ms, close_time // 1000 * 1000 AS close_ms, 1 AS data_source_id,
             TRUE AS is_final FROM candles)""" + FACT_OUT

ORACLES["fact_daily_summary"] = CANDLES + "," + DAILY + "," + IDS + f"""
SELECT trade_date AS date_id, s.symbol_id, CAST(1 AS BIGINT) AS interval_id, open_price, high_price, low_price,
       close_price, total_volume, price_change, price_change_pct, daily_range, number_of_candles,
       CAST({AS_OF} AS BIGINT) AS updated_at
FROM days JOIN sym s USING (symbol)"""

# --- serving -------------------------------------------------------------------------------------

ORACLES["vw_kline_unified"] = CANDLES + "," + PAIR + "," + _unified("TRUE") + f"""
SELECT symbol, "interval" AS interval_code, trade_date, open_time, open_ms AS open_ts, close_time, close_ms AS close_ts,
       open_price, high_price, low_price, close_price, volume, quote_asset_volume, number_of_trades,
       CASE data_source_id WHEN 1 THEN 'batch_silver' ELSE 'speed_hot' END AS data_source, is_final,
       CAST({AS_OF} AS BIGINT) AS updated_at FROM u"""

ORACLES["vw_daily_market_summary"] = CANDLES + "," + DAILY + f"""
SELECT trade_date, symbol, "interval" AS interval_code, open_price, high_price, low_price, close_price, total_volume,
       price_change, price_change_pct, daily_range, number_of_candles, CAST({AS_OF} AS BIGINT) AS updated_at FROM days"""

ORACLES["vw_latest_snapshot"] = INDICATORS + "," + PAIR + "," + _unified("TRUE") + f""",
last AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY open_time DESC) AS n FROM u) WHERE n = 1)
SELECT l.symbol, l."interval" AS interval_code, l.open_time, l.open_ms AS open_ts, l.close_price, l.volume,
       CASE l.data_source_id WHEN 1 THEN 'batch_silver' ELSE 'speed_hot' END AS data_source, l.is_final, {SIX},
       CAST({AS_OF} AS BIGINT) AS updated_at
FROM last l LEFT JOIN ind i ON i.symbol = l.symbol AND i.open_time = l.open_time"""

ORACLES["vw_pattern_alerts_recent"] = PATTERNS + f"""
SELECT symbol, strftime(make_timestamp(close_time * 1000), '%Y-%m-%d') AS trade_date, pattern_type, close_time,
       close_time AS close_ts, close_price FROM alerts WHERE close_time >= {AS_OF} - 24 * {HOUR}"""

ORACLES["symbol_point_read"] = ORACLES["fact_kline_batch"] + " WHERE symbol = 'CLICKUSDT'"

# --- integrity -----------------------------------------------------------------------------------

ORACLES["check_not_null"] = CANDLES + """
SELECT 'symbol' AS column_name, CAST(count(*) AS BIGINT) AS null_count FROM candles WHERE (open_time // 3600000) % 97 = 0
UNION ALL SELECT 'interval', 0 UNION ALL SELECT 'open_time', 0
UNION ALL SELECT 'close_price', count(*) FROM candles WHERE (open_time // 3600000) % 89 = 0"""

ORACLES["check_unique"] = """
SELECT l_orderkey, l_linenumber, CAST(count(*) AS BIGINT) AS row_count FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1"""

ORACLES["check_foreign_key"] = """
SELECT user_id, CAST(count(*) AS BIGINT) AS row_count FROM events
WHERE user_id NOT IN (SELECT s_suppkey FROM supplier) GROUP BY user_id"""

# --- jobs ----------------------------------------------------------------------------------------

ORACLES["backfill_equals_loop"] = CANDLES + f"""
SELECT {SILVER_OUT}, CAST(2 AS BIGINT) AS tables FROM candles WHERE trade_date >= '2024-01-10' AND trade_date < '2024-01-15'"""

ORACLES["bootstrap_days"] = CANDLES + f"""
SELECT {SILVER_OUT} FROM candles WHERE trade_date IN ('2024-01-15', '2024-01-16')
UNION ALL SELECT {SILVER_OUT} FROM candles WHERE trade_date = '2024-01-15'"""

ORACLES["overwrite_day_guard"] = CANDLES + "," + PAIR + f"""
SELECT {SILVER_OUT} FROM tgt WHERE trade_date <> '2024-01-15'
UNION ALL SELECT {SILVER_OUT} FROM src WHERE trade_date = '2024-01-15'"""

ORACLES["daily_chain"] = CANDLES + "," + PAIR + """
SELECT symbol, '1h' AS interval_code, trade_date, open_time, close_price, number_of_trades,
       'batch_silver' AS data_source, TRUE AS is_final FROM candles WHERE trade_date = '2024-01-15'
UNION ALL
SELECT symbol, '1h', trade_date, open_time, close_price, NULL, 'speed_hot', FALSE
FROM src WHERE open_time >= epoch_ms(TIMESTAMP '2024-01-16')"""

ORACLES["hot_refresh_incremental"] = INDICATORS + "," + GEOMETRY + "," + PAIR + """
SELECT 'batch_silver' AS kind, symbol, open_time AS time, round(close_price, 6) AS close_price FROM candles WHERE trade_date = '2024-01-15'
UNION ALL SELECT 'speed_hot', symbol, open_time, round(close_price, 6) FROM src WHERE trade_date <> '2024-01-15'
UNION ALL SELECT 'speed_hot', t.symbol, t.open_time, round(t.close_price, 6) FROM tgt t ANTI JOIN src s USING (symbol, open_time)
UNION ALL SELECT 'indicator', symbol, open_time, round(rsi14, 6) FROM ind
UNION ALL SELECT pattern_type, symbol, close_time, round(close_price, 6) FROM alerts"""

# --- streaming -----------------------------------------------------------------------------------

ORACLES["stream_raw_upsert"] = CANDLES + f"""
SELECT symbol, open_time, close_time, open_price, high_price, low_price,
       CASE WHEN open_time >= {SOURCE_START} THEN close_price + 1 ELSE close_price END AS close_price, volume, is_closed
FROM candles"""

ORACLES["stream_restart_newest"] = ORACLES["stream_raw_upsert"]
ORACLES["stream_pattern_alerts"] = ORACLES["pattern_alerts"]
ORACLES["stream_indicators"] = ORACLES["technical_indicators"]
ORACLES["stream_late_drop"] = ORACLES["technical_indicators"]
ORACLES["stream_warm_start"] = f"SELECT * FROM ({ORACLES['technical_indicators']}) WHERE open_time >= {SOURCE_START}"

ORACLES["stream_replay_idempotent"] = INDICATORS + "," + GEOMETRY + """
SELECT 'candle' AS kind, symbol, open_time AS time, round(close_price, 6) AS close_price FROM candles
UNION ALL SELECT 'indicator', symbol, open_time, round(rsi14, 6) FROM ind
UNION ALL SELECT pattern_type, symbol, close_time, round(close_price, 6) FROM alerts"""
