import json
import os
import time

import pytest
from pyspark.sql import functions as F

from wicklake.catalog import inputs, tables as scratch
from wicklake.operators.indicators import technical_indicators
from wicklake.schemas import HOT
from wicklake.session import fresh_dir
from wicklake.sources import tables
from wicklake.streaming import sinks, speed_layer
from wicklake.streaming.source import read_candle_stream

NOW = {"availableNow": True}


def candle(symbol, open_time, close, closed=True, volume=1.0):
    return {
        "symbol": symbol, "open_time": open_time, "close_time": open_time + 59_999, "open_price": 100.0,
        "high_price": 110.0, "low_price": 90.0, "close_price": close, "volume": volume, "is_closed": closed}


def land(folder, number, records):
    os.makedirs(folder, exist_ok=True)
    path = f"{folder}/{number:03d}.json"
    with open(path, "w") as out:
        out.writelines((r if isinstance(r, str) else json.dumps(r)) + "\n" for r in records)
    os.utime(path, (time.time() + number, time.time() + number))


def hot_namespace(spark):
    hot = scratch.namespace(spark, "hot")
    tables.ensure_hot(spark, hot)
    return hot


def run_indicators(spark, folder, hot, state, per_trigger=1):
    stream = read_candle_stream(spark, "text", {"path": folder, "maxFilesPerTrigger": str(per_trigger)})
    speed_layer.drain([speed_layer.start_indicators(stream, hot, state, NOW)])


def run_raw(spark, folder, hot, state, as_upsert=False, per_trigger=1):
    stream = read_candle_stream(spark, "text", {"path": folder, "maxFilesPerTrigger": str(per_trigger)})
    speed_layer.drain([speed_layer.start_raw_and_alerts(stream, hot, state, NOW, as_upsert)])


def test_late_rows_are_dropped_by_the_current_watermark(spark):
    folder, hot = fresh_dir(spark, "in"), hot_namespace(spark)
    for i, times in enumerate([[1000, 61000], [121000], [1500, 181000], [62000, 115000, 241000]]):
        land(folder, i, [candle("A", t, 100.0 + t % 7) for t in times])
    run_indicators(spark, folder, hot, fresh_dir(spark, "state"))
    times = [r.open_time for r in sinks.read_hot(spark, hot, "indicator").orderBy("open_time").collect()]
    assert times == [1000, 61000, 121000, 181000]


def test_out_of_order_stream_equals_batch(spark):
    """Shuffled within the watermark delay, in files of their own, with open candles in between."""
    folder, hot = fresh_dir(spark, "in"), hot_namespace(spark)
    times = [1_000_000 + i * 2000 for i in range(120)]
    records = [candle(s, t, 50.0 + (t // 2000 * 37 + len(s)) % 23) for t in times for s in ("A", "BB")]
    files = [records[i:i + 24] for i in range(0, len(records), 24)]
    for i, part in enumerate(files):
        part = part[:12] + part[12:][::-1]
        land(folder, i, part + [candle("A", part[0]["open_time"], 1.0, closed=False)] + ["{broken", '{"symbol": "A"}'])
    # An open candle moves the watermark past the rest.
    land(folder, 99, [candle("Z", 9_000_000, 1.0, closed=False)])
    run_indicators(spark, folder, hot, fresh_dir(spark, "state"), per_trigger=2)
    frame = spark.createDataFrame([(r["symbol"], r["open_time"], r["close_price"]) for r in records],
                                  "symbol string, open_time bigint, close_price double")
    want = technical_indicators(frame, keys=["symbol"], rows_per_chunk=None)

    def rounded(df):
        return sorted(
            (r.symbol, r.open_time, *[round(r[c], 6) for c in ("sma7", "sma25", "rsi14", "macd", "macd_signal", "macd_hist")])
            for r in df.collect())
    assert rounded(sinks.read_hot(spark, hot, "indicator")) == rounded(want)


def test_restart_continues_from_state(spark):
    folder, hot, state = fresh_dir(spark, "in"), hot_namespace(spark), fresh_dir(spark, "state")
    times = [1_000_000 + i * 60_000 for i in range(60)]
    closes = [100.0 + (37 * i) % 11 for i in range(60)]
    for number, cut in enumerate([(0, 25), (25, 60)]):
        land(folder, number, [candle("A", t, c) for t, c in list(zip(times, closes))[slice(*cut)]])
        run_indicators(spark, folder, hot, state)
    land(folder, 9, [candle("Z", 90_000_000, 1.0, closed=False)])
    run_indicators(spark, folder, hot, state)
    got = {r.open_time: round(r.macd_signal, 9) for r in sinks.read_hot(spark, hot, "indicator").collect()}
    frame = spark.createDataFrame([("A", t, c) for t, c in zip(times, closes)],
                                  "symbol string, open_time bigint, close_price double")
    want = technical_indicators(frame, keys=["symbol"])
    assert got == {r.open_time: round(r.macd_signal, 9) for r in want.collect()}


@pytest.mark.parametrize("as_upsert", [False, True])
def test_raw_table_keeps_the_last_write(spark, as_upsert):
    folder, hot = fresh_dir(spark, "in"), hot_namespace(spark)
    t = 1_700_000_040_000
    land(folder, 0, [candle("A", t, 1.0, False), candle("A", t, 2.0, True, 9.0), candle("B", t, 5.0)])
    land(folder, 1, [candle("A", t, 3.0, False, 0.5), "garbage", candle("A", t + 60_000, 4.0, False)])
    run_raw(spark, folder, hot, fresh_dir(spark, "state"), as_upsert)
    got = {(r.symbol, r.open_time): r.close_price for r in sinks.read_hot(spark, hot, "candle").collect()}
    assert got == {("A", t): 3.0, ("B", t): 5.0, ("A", t + 60_000): 4.0}


def test_replay_and_compaction_change_nothing(spark, small):
    rows = inputs.stream_rows(inputs.candles(spark, small))
    folder, hot = fresh_dir(spark, "in"), hot_namespace(spark)
    scratch.land_json(rows, folder)

    def state(name):
        return sorted(map(tuple, sinks.read_hot(spark, hot, name).collect()))
    run_raw(spark, folder, hot, fresh_dir(spark, "state"), per_trigger=100)
    first = {n: state(n) for n in ("candle", "alert")}
    run_raw(spark, folder, hot, fresh_dir(spark, "state"), per_trigger=100)
    assert {n: state(n) for n in first} == first and len(first["candle"]) == 3385
    assert spark.table(f"{hot}.candle").count() == 2 * 3385
    sinks.compact(spark, hot, "candle", "2024-01-15")
    day = spark.table(f"{hot}.candle").where("trade_date = date'2024-01-15'")
    assert day.count() == 113
    assert {n: state(n) for n in first} == first


def test_compaction_keeps_what_arrives_meanwhile(spark, small, monkeypatch):
    rows = inputs.stream_rows(inputs.candles(spark, small))
    hot = hot_namespace(spark)
    sinks.write_batch(rows, 0, "candle", hot)
    sinks.write_batch(rows, 1, "candle", hot)
    late = rows.where("open_time >= 1705276800000 and open_time < 1705363200000").withColumn("close_price", F.lit(-7.0))
    real, calls = sinks.staged, []

    def meanwhile(df):
        out = real(df)
        # Once the files are listed.
        if not calls:
            sinks.write_batch(late, 2, "candle", hot)
        calls.append(df)
        return out

    monkeypatch.setattr(sinks, "staged", meanwhile)
    sinks.compact(spark, hot, "candle", "2024-01-15")
    day = sinks.read_hot(spark, hot, "candle").where("open_time >= 1705276800000 and open_time < 1705363200000")
    assert {r.close_price for r in day.collect()} == {-7.0} and day.count() == late.count()
    assert tables.read_table(spark, HOT["candle"], f"{hot}.candle").where("trade_date = date'2024-01-15'").count() == 2 * late.count()


def test_compaction_of_many_files(spark, small, monkeypatch):
    """Names come to the driver a few at a time, and the newest entries stay."""
    monkeypatch.setattr(sinks, "DELETED_AT_ONCE", 7)
    hot = hot_namespace(spark)
    rows = inputs.stream_rows(inputs.candles(spark, small)).where("open_time >= 1705276800000 and open_time < 1705363200000")
    for batch_id in range(5):
        changed = rows.withColumn("close_price", F.col("close_price") + batch_id)
        tables.append(sinks.log_rows(changed, batch_id, "candle").repartition(12), HOT["candle"], f"{hot}.candle")
    with monkeypatch.context() as patch:
        patch.setattr(tables, "gathered", lambda df, layout: df.repartition(12))
        sinks.write_batch(rows.withColumn("close_price", F.col("close_price") + 5), 5, "candle", hot)

    def files():
        return {r[0] for r in tables.read_table(spark, HOT["candle"], f"{hot}.candle").select(F.input_file_name()).distinct().collect()}

    before, kept = files(), sorted(map(tuple, sinks.read_hot(spark, hot, "candle").collect()))
    assert len(before) > 14
    sinks.compact(spark, hot, "candle", "2024-01-15")
    assert not files() & before and sorted(map(tuple, sinks.read_hot(spark, hot, "candle").collect())) == kept
    assert tables.read_table(spark, HOT["candle"], f"{hot}.candle").count() == rows.count()


def test_backlog_is_emitted_in_frames(spark, monkeypatch):
    from wicklake.streaming import processor

    monkeypatch.setattr(processor, "FRAME_ROWS", 7)
    folder, hot = fresh_dir(spark, "in"), hot_namespace(spark)
    land(folder, 0, [candle("A", 1_000_000 + i * 60_000, 100.0 + i % 9) for i in range(100)])
    land(folder, 1, [candle("Z", 90_000_000_000, 1.0, closed=False)])
    run_indicators(spark, folder, hot, fresh_dir(spark, "state"))
    got = sinks.read_hot(spark, hot, "indicator").orderBy("open_time").collect()
    closes = [100.0 + i % 9 for i in range(100)]
    assert len(got) == 100
    for i, row in enumerate(got):
        assert abs(row.sma25 - sum(closes[max(0, i - 24):i + 1]) / min(i + 1, 25)) < 1e-9


def test_statement_set_fills_three_tables(spark):
    folder, hot, state = fresh_dir(spark, "in"), scratch.namespace(spark, "hot"), fresh_dir(spark, "state")
    land(folder, 0, [candle("A", 1_000_000 + i * 60_000, 100.5 if i % 2 else 109.0) for i in range(40)])
    land(folder, 1, [candle("Z", 90_000_000, 1.0, closed=False)])
    speed_layer.drain(speed_layer.run_speed_layer(spark, "text", {"path": folder}, hot, state, trigger=NOW))
    assert sinks.read_hot(spark, hot, "candle").count() == 41
    assert sinks.read_hot(spark, hot, "alert").count() == 20
    assert sinks.read_hot(spark, hot, "indicator").count() == 40


def test_lookback_reads_only_its_days(spark, small):
    hot = hot_namespace(spark)
    sinks.write_batch(inputs.stream_rows(inputs.candles(spark, small)), 0, "candle", hot)
    recent = sinks.read_hot(spark, hot, "candle", "2024-01-31T00:00:00", 24)
    assert {str(r.d) for r in recent.select(F.to_date(F.timestamp_millis("open_time")).alias("d")).distinct().collect()} == {"2024-01-30"}
    assert "PartitionFilters: [isnotnull(trade_date" in recent._jdf.queryExecution().executedPlan().toString()


def test_a_file_stream_cannot_start_late(spark):
    with pytest.raises(ValueError):
        read_candle_stream(spark, "text", {"path": fresh_dir(spark, "in")}, start="latest")


def test_a_batch_is_read_once_for_both_tables(spark):
    folder, hot = fresh_dir(spark, "in"), hot_namespace(spark)
    for number in range(3):
        land(folder, number, [candle("A", 1_000_000 + (40 * number + i) * 60_000, 100.5 if i % 2 else 109.0) for i in range(40)])
    stream = read_candle_stream(spark, "text", {"path": folder, "maxFilesPerTrigger": "1"})
    query = speed_layer.start_raw_and_alerts(stream, hot, fresh_dir(spark, "state"), NOW)
    speed_layer.drain([query])
    assert [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]] == [40, 40, 40]
    assert sinks.read_hot(spark, hot, "candle").count() == 120
    assert sinks.read_hot(spark, hot, "alert").count() == 60
    assert spark.sparkContext._jsc.getPersistentRDDs().isEmpty()
