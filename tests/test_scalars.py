from datetime import date

import pytest
from pyspark.sql import functions as F

from wicklake.functions import candle, text, time as tm
from wicklake.operators import patterns, summary
from wicklake.plans import star
from wicklake.schemas import DIM_INTERVAL


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_epoch_keeps_or_cuts_milliseconds(spark):
    ms = F.lit(1700000059999)
    assert one(spark, tm.ts_seconds(ms).cast("string")) == "2023-11-14 22:14:19"
    assert one(spark, tm.ts_millis(ms).cast("string")) == "2023-11-14 22:14:19.999"
    assert one(spark, tm.utc_date(ms)) == date(2023, 11, 14)


def test_interval_seconds(spark):
    codes = ["1s", "1m", "5m", "1h", "1d", "1w", "1M", "", "m", "x1m", None]
    df = spark.createDataFrame([(c,) for c in codes], "c string").select("c", tm.interval_seconds(F.col("c")).alias("s"))
    assert {r.c: r.s for r in df.collect()} == {
        "1s": 1, "1m": 60, "5m": 300, "1h": 3600, "1d": 86400, "1w": 604800, "1M": None, "": None, "m": None,
        "x1m": None, None: None}


def test_interval_dimension(spark):
    rows = star.new_intervals(spark, DIM_INTERVAL.empty(spark), ["1m", "1M", "1h", "1m"])
    assert {r.interval_code: (r.interval_id, r.interval_seconds) for r in rows.collect()} == {
        "1M": (1, 2592000), "1h": (2, 3600), "1m": (3, 60)}
    more = star.new_intervals(spark, rows, ["5m", "1h"])
    assert [(r.interval_code, r.interval_id) for r in more.collect()] == [("5m", 4)]


def test_symbol_list(spark):
    assert text.symbol_list(" btcusdt, ,ethusdt ") == ["BTCUSDT", "ETHUSDT"]
    assert one(spark, text.symbols_in(F.lit(" btcusdt, ,ethusdt "))) == ["BTCUSDT", "ETHUSDT"]


def test_assets(spark):
    df = star.symbol_rows(spark.createDataFrame([("BTCUSDT",), ("ETHBTC",), ("USDTUSDT",), (None,)], "symbol string"))
    assert {r.symbol: (r.base_asset, r.quote_asset) for r in df.collect()} == {
        "BTCUSDT": ("BTC", "USDT"), "ETHBTC": ("ETHBTC", None), "USDTUSDT": ("", "USDT")}


def test_weekday_of_dim_date(spark):
    df = star.date_rows(spark.createDataFrame([(date(2024, 1, 7),), (date(2024, 12, 30),)], "date_id date"))
    assert {r.date_id: (r.quarter, r.day_of_week, r.is_weekend) for r in df.collect()} == {
        date(2024, 1, 7): (1, 7, True), date(2024, 12, 30): (4, 1, False)}


def test_day_range_is_half_open_and_checked():
    assert tm.check_range("2024-01-01", "2024-01-02") == (date(2024, 1, 1), date(2024, 1, 2))
    with pytest.raises(ValueError):
        tm.check_range("2024-01-02", "2024-01-02")
    assert tm.previous_day("2024-03-01") == date(2024, 2, 29)


def test_as_of_reads_naive_values_as_utc():
    assert tm.as_of_ms("2024-01-31T00:00:00") == 1706659200000
    assert tm.as_of_ms("2024-01-31T02:00:00+02:00") == 1706659200000


PATTERNS = [
    (1, 100.0, 110.0, 90.0, 101.0, True, candle.DOJI),
    (2, 100.0, 102.1, 95.0, 102.0, True, candle.HAMMER),
    (3, 100.0, 105.0, 99.0, 104.0, True, None),
    (4, 100.0, 100.0, 100.0, 100.0, True, None),
    (5, 100.0, 100.5, 90.0, 100.5, True, candle.DOJI),
    (6, 100.0, 110.0, 90.0, 101.0, False, None),
    (7, 100.0, None, 90.0, 101.0, True, None),
    (8, 102.0, 102.1, 95.0, 100.0, True, candle.HAMMER),
    (9, 100.0, 105.0, 95.0, 101.0, True, candle.DOJI),
]


def test_pattern_golden_rows(spark):
    columns = "id int, open_price double, high_price double, low_price double, close_price double, is_closed boolean"
    df = spark.createDataFrame([p[:6] for p in PATTERNS], columns)
    found = {r.id: r.pattern_type for r in patterns.pattern_alerts(df).collect()}
    assert found == {p[0]: p[6] for p in PATTERNS if p[6]}
    assert patterns.classify(df).where("id = 3").first().pattern_type == candle.UNKNOWN


def test_daily_summary_keeps_null_and_survives_zero_open(spark):
    columns = ("trade_date date, symbol string, interval string, open_time bigint, open_price double, "
               "high_price double, low_price double, close_price double, volume double")
    day = date(2024, 1, 1)
    df = spark.createDataFrame([
        (day, "A", "1m", 1, None, 5.0, 1.0, 2.0, 1.0), (day, "A", "1m", 2, 3.0, 6.0, 2.0, 4.0, 1.0),
        (day, "Z", "1m", 1, 0.0, 5.0, 1.0, 2.0, 1.0)], columns)
    rows = {r.symbol: r for r in summary.daily_summary(df).collect()}
    assert rows["A"].open_price is None and rows["A"].close_price == 4.0 and rows["A"].price_change is None
    assert rows["Z"].price_change == 2.0 and rows["Z"].price_change_pct is None
