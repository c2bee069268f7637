"""State of the stream indicators: what a timer reads and what a checkpoint holds."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from test_streaming import NOW, candle, hot_namespace, land, run_indicators

from wicklake.operators.indicators import technical_indicators
from wicklake.session import fresh_dir
from wicklake.streaming import processor, sinks, speed_layer
from wicklake.streaming.indicators import LENGTHS, recent_closes
from wicklake.streaming.source import read_candle_stream

MINUTE = 60_000


class Value:
    def __init__(self):
        self.held = None

    def exists(self):
        return self.held is not None

    def get(self):
        return self.held

    def update(self, value):
        self.held = value

    def clear(self):
        self.held = None


class Map:
    """Counts the candles that are read and written."""

    def __init__(self):
        self.held, self.read, self.written = {}, 0, 0

    def getValue(self, key):
        self.read += len(self.held[key][0])
        return self.held[key]

    def updateValue(self, key, value):
        self.written += len(value[0])
        self.held[key] = value

    def removeKey(self, key):
        del self.held[key]


class Handle:
    def __init__(self):
        self.timers, self.states = [], {}

    def getValueState(self, name, schema):
        return self.states.setdefault(name, Value())

    def getMapState(self, name, key, value):
        return self.states.setdefault(name, Map())

    def listTimers(self):
        return iter(list(self.timers))

    def registerTimer(self, at):
        self.timers.append(at)

    def deleteTimer(self, at):
        self.timers.remove(at)


class Clock:
    def __init__(self, watermark):
        self.watermark = watermark

    def getCurrentWatermarkInMs(self):
        return self.watermark


def started():
    handle, held = Handle(), processor.IndicatorProcessor(LENGTHS)
    held.init(handle)
    return handle, held


def fed(held, times, closes, watermark=0):
    frame = pd.DataFrame({"symbol": "A", "open_time": times, "close_price": closes})
    assert list(held.handleInputRows(("A",), iter([frame]), Clock(watermark))) == []


def fire(handle, held, watermark):
    out = []
    while due := [t for t in handle.timers if t <= watermark]:
        handle.timers.remove(due[0])
        out += held.handleExpiredTimer(("A",), Clock(watermark), None)
    return pd.concat(out) if out else pd.DataFrame({"open_time": []})


def test_a_timer_reads_only_what_it_can_emit():
    """A million candles of one symbol wait and are emitted in ten steps of a tenth."""
    n = 1_000_000
    handle, held = started()
    times = np.arange(n, dtype=np.int64) * MINUTE
    closes = 100.0 + (np.arange(n) * 37 % 101)
    fed(held, times, closes, -1)
    waiting, bucket = handle.states["waiting"], processor.BUCKET_MS // MINUTE
    values = []
    for step in range(1, 11):
        before = waiting.read
        out = fire(handle, held, int(times[n * step // 10 - 1]))
        assert out["open_time"].tolist() == times[n * (step - 1) // 10:n * step // 10].tolist()
        assert waiting.read - before <= len(out) + 2 * bucket
        values.append(out)
    assert waiting.held == {} and not handle.states["buckets"].exists() and handle.timers == []
    whole = processor.indicator_values(closes, LENGTHS)
    for name in ("sma25", "rsi14", "macd_signal"):
        assert np.allclose(pd.concat(values)[name].to_numpy(), whole[name])


def test_a_new_candle_writes_only_its_bucket():
    handle, held = started()
    fed(held, np.arange(10_000, dtype=np.int64) * MINUTE, np.ones(10_000), -1)
    waiting = handle.states["waiting"]
    waiting.read = waiting.written = 0
    fed(held, [9_999 * MINUTE + 1000], [2.0], -1)
    assert waiting.read <= 60 and waiting.written <= 61


def test_out_of_order_gaps_and_repeats():
    rng = np.random.default_rng(3)
    handle, held = started()
    times = rng.permutation(np.unique(rng.integers(1, 5_000_000, 400)) * 1000)
    closes = dict(zip(times.tolist(), rng.random(len(times)).tolist()))
    got, watermark = [], 0
    for part in np.array_split(np.sort(times), 23):
        part = rng.permutation(part)
        fed(held, part, [closes[t] + 1 for t in part.tolist()], watermark)
        fed(held, part, [closes[t] for t in part.tolist()], watermark)
        # The watermark may stop anywhere, in empty buckets too.
        watermark = max(watermark, int(part.max()) - int(rng.integers(0, 40_000_000)))
        got.append(fire(handle, held, watermark))
    got.append(fire(handle, held, int(times.max())))
    out = pd.concat([g for g in got if len(g)])
    assert out["open_time"].tolist() == sorted(t for t in times.tolist() if t in set(out["open_time"]))
    assert out["open_time"].is_unique and out["close_price"].tolist() == [closes[t] for t in out["open_time"].tolist()]
    assert len(out) > 350


def test_history_goes_before_the_first_candle(spark):
    times = [1_000_000 + i * MINUTE for i in range(120)]
    rows = [(s, t, 50.0 + (t // 1000 * 37 + len(s)) % 23) for s in ("A", "BB") for t in times]
    frame = spark.createDataFrame(rows, "symbol string, open_time bigint, close_price double")
    history = recent_closes(frame.where(F.col("open_time") < times[80]))
    assert {(r.symbol, len(r.closes), r["last"]) for r in history.collect()} == {("A", 33, times[79]), ("BB", 33, times[79])}
    folder, hot = fresh_dir(spark, "in"), hot_namespace(spark)
    # The stream begins inside the history, and one symbol has none.
    land(folder, 0, [candle(s, t, c) for s, t, c in rows if t >= times[70]] + [candle("NEW", t, 7.0) for t in times[110:]])
    land(folder, 1, [candle("Z", 90_000_000, 1.0, closed=False)])
    stream = read_candle_stream(spark, "text", {"path": folder})
    speed_layer.drain([speed_layer.start_indicators(stream, hot, fresh_dir(spark, "state"), NOW, history=history)])
    key = lambda r: (r.symbol, r.open_time, *[round(r[c], 9) for c in ("sma7", "sma25", "rsi14", "macd", "macd_signal")])
    got = {key(r) for r in sinks.read_hot(spark, hot, "indicator").collect()}
    want = {key(r) for r in technical_indicators(frame, keys=["symbol"]).where(F.col("open_time") >= times[80]).collect()}
    assert {g for g in got if g[0] != "NEW"} == want and len([g for g in got if g[0] == "NEW"]) == 10


def state_rows(spark, state, name, **options):
    reader = spark.read.format("statestore").option("path", state).option("stateVarName", name)
    for key, value in options.items():
        reader = reader.option(key, value)
    return reader.load()


def test_checkpoint_holds_only_what_changed(spark):
    """The second run brings candles of one symbol of three: the state of the others is not written again."""
    folder, hot, state = fresh_dir(spark, "in"), hot_namespace(spark), fresh_dir(spark, "state")
    land(folder, 0, [candle(s, 1_000_000 + i * MINUTE, 100.0 + i) for s in ("A", "B", "C") for i in range(50)])
    land(folder, 1, [candle("Z", 90_000_000, 1.0, closed=False)])
    run_indicators(spark, folder, hot, state)
    (first,) = spark.read.format("state-metadata").load(state).selectExpr("max(maxBatchId) AS last").collect()

    def changed(name, since):
        feed = state_rows(spark, state, name, readChangeFeed="true", changeStartBatchId=since)
        return {r.symbol for r in feed.selectExpr("key.symbol AS symbol").collect()}

    held = state_rows(spark, state, "past").selectExpr("key.symbol AS symbol", "size(value.closes) AS closes", "value.last AS last")
    assert {tuple(r) for r in held.collect()} == {(s, 33, 1_000_000 + 49 * MINUTE) for s in ("A", "B", "C")}
    assert state_rows(spark, state, "buckets").count() == 0 and changed("past", 0) == {"A", "B", "C"}
    land(folder, 2, [candle("B", 90_000_000 + i * MINUTE, 5.0) for i in range(1, 4)])
    run_indicators(spark, folder, hot, state)
    assert changed("buckets", first["last"] + 1) == {"B"} and changed("past", first["last"] + 1) <= {"B"}
    waiting = state_rows(spark, state, "buckets").selectExpr("key.symbol AS symbol", "value.numbers AS numbers").collect()
    assert [(r.symbol, r.numbers) for r in waiting] in ([("B", [25])], [])
