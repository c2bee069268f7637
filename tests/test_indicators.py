import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from wicklake.operators import indicators, rolling
from wicklake.session import runtime_conf
from wicklake.streaming.indicators import LENGTHS
from wicklake.streaming.processor import indicator_values

COLUMNS = indicators.INDICATOR_COLUMNS


def series(spark, closes, symbol="A", step=60_000, start=1_700_000_000_000 // 60_000 * 60_000):
    rows = [(symbol, "1m", start + i * step, c) for i, c in enumerate(closes)]
    return spark.createDataFrame(rows, "symbol string, interval string, open_time bigint, close_price double")


def collected(df):
    return sorted(map(tuple, df.select("symbol", "open_time", "close_price", *COLUMNS).collect()), key=lambda r: r[:2])


SHORT = [10.0, 12.0, 10.0, 12.0, 9.0, 9.0, 9.0, 15.0]
SHORT_WANTED = [
    (10, 10, 100), (11, 11, 100), (10.666667, 10.666667, 50), (11, 11, 66.666667), (10.6, 10.6, 44.444444),
    (10.333333, 10.333333, 44.444444), (10.142857, 10.142857, 44.444444), (10.857143, 10.75, 66.666667)]


@pytest.mark.parametrize("rows_per_chunk", [None, 3, 1440])
def test_short_golden_rows(spark, rows_per_chunk):
    got = collected(indicators.technical_indicators(series(spark, SHORT), rows_per_chunk=rows_per_chunk))
    assert [tuple(round(v, 6) for v in r[3:6]) for r in got] == SHORT_WANTED
    assert all(abs(v) < 1e-12 for r in got for v in r[6:])


LONG = [100.0 + (37 * i) % 11 for i in range(1, 37)]
LONG_WANTED = {
    13: (108, 105.428571, 105.153846, 53.333333, 0.096154, 0.010684, 0.08547),
    26: (105, 104, 104.96, 50.704225, 0.076923, -0.068613, 0.145536),
    36: (101, 104.714286, 104.92, 50.704225, -0.064103, -0.032764, -0.031339)}


def test_long_golden_rows(spark):
    got = collected(indicators.technical_indicators(series(spark, LONG)))
    for i, want in LONG_WANTED.items():
        assert tuple(round(v, 6) for v in got[i - 1][2:]) == want


def test_history_length_is_exactly_enough(spark):
    full = collected(indicators.technical_indicators(series(spark, LONG)))[-1][3:]
    start = 1_700_000_000_000 // 60_000 * 60_000
    for dropped, equal in ((2, True), (3, False)):
        part = series(spark, LONG[dropped:], start=start + dropped * 60_000)
        assert (collected(indicators.technical_indicators(part))[-1][3:] == full) is equal
    assert len(LONG) - 2 - 1 == indicators.MACD_HISTORY


def ragged(spark, seed):
    """Series of very different lengths with gaps of up to many chunks, and a missing close here and there."""
    rng = random.Random(seed)
    rows = []
    for symbol, n in (("HOT", 1500), ("A", 200), ("B", 40), ("C", 1)):
        t = 1_700_000_000_000 // 60_000
        for _ in range(n):
            t += rng.choice([1, 1, 1, 1, 2, 7, rng.choice([40, 400, 4000])])
            close = None if rng.random() < 0.02 else round(rng.uniform(1, 50), 2)
            rows.append((symbol, "1m", t * 60_000, close))
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "symbol string, interval string, open_time bigint, close_price double")


@pytest.mark.parametrize("rows_per_chunk,group", [(1, 2), (7, 3), (50, 256), (1440, 256)])
def test_chunked_equals_one_window_per_series(spark, monkeypatch, rows_per_chunk, group):
    monkeypatch.setattr(rolling, "GROUP", group)
    df = ragged(spark, rows_per_chunk)
    plain = collected(indicators.technical_indicators(df, rows_per_chunk=None))
    assert collected(indicators.technical_indicators(df, rows_per_chunk=rows_per_chunk)) == plain


@pytest.mark.parametrize("advisory", ["1b", "2k", "64m"])
def test_chunked_survives_uneven_coalescing(spark, advisory):
    """Rows and history are read from different shuffles, which adaptive execution may coalesce differently."""
    df = ragged(spark, 5)
    plain = collected(indicators.technical_indicators(df, rows_per_chunk=None))
    with runtime_conf(spark, "spark.sql.adaptive.advisoryPartitionSizeInBytes", advisory), \
            runtime_conf(spark, "spark.sql.adaptive.coalescePartitions.minPartitionSize", "1b"), \
            runtime_conf(spark, "spark.sql.adaptive.coalescePartitions.parallelismFirst", "false"):
        assert collected(indicators.technical_indicators(df, rows_per_chunk=20)) == plain


@pytest.mark.parametrize("operator,columns", [
    (indicators.sma, ["sma7", "sma25"]), (indicators.price_diff, ["price_diff"]),
    (indicators.rsi, ["avg_gain", "avg_loss", "rsi14"]), (indicators.macd, ["macd", "macd_signal", "macd_hist"])])
def test_single_operators_chunked(spark, operator, columns):
    df = ragged(spark, 3).withColumn("note", F.concat("symbol", F.lit("!")))

    def rows(n):
        out = operator(df, rows_per_chunk=n).select("symbol", "open_time", "note", *columns)
        return sorted(map(tuple, out.collect()), key=lambda r: r[:2])
    assert rows(11) == rows(None)


def test_one_scan_and_one_wide_shuffle(spark, small):
    """Both branches of a chunked window read the same shuffle of the input."""
    from wicklake.catalog import inputs
    rows = inputs.candles(spark, small).select("symbol", "interval", "open_time", "close_price")
    df = indicators.technical_indicators(rows)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert final.count("FileScan") == 1
    assert final.count("ReusedExchange") == 2


def test_duplicated_closed_candle_counts_once(spark):
    df = series(spark, SHORT).withColumns({"is_closed": F.lit(True), "ingest_ts": F.lit(1)})
    twice = df.unionByName(df).unionByName(df.withColumn("is_closed", F.lit(False)).withColumn("close_price", F.lit(0.0)))
    once = collected(indicators.technical_indicators(series(spark, SHORT)))
    assert collected(indicators.technical_indicators(indicators.closed_candles(twice))) == once


def test_stream_values_equal_batch(spark):
    closes = [c for c in LONG] + [None, 101.0, 99.5, None, 98.0]
    got = indicator_values(np.array([np.nan if c is None else c for c in closes]), LENGTHS)
    batch = collected(indicators.technical_indicators(series(spark, closes)))
    for i, row in enumerate(batch):
        for name, want in zip(COLUMNS, row[3:]):
            value = got[name][i]
            assert (want is None and np.isnan(value)) or abs(value - want) < 1e-9


def test_empty_input(spark):
    none = spark.createDataFrame([], "symbol string, interval string, open_time bigint, close_price double")
    assert collected(indicators.technical_indicators(none)) == []
