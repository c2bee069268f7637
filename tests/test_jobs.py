import pytest
from pyspark.sql import functions as F

from wicklake.catalog import inputs, tables as scratch
from wicklake.operators.indicators import closed_candles, newest_indicators, technical_indicators
from wicklake.operators import patterns, summary
from wicklake.operators.checks import duplicate_keys
from wicklake.plans import jobs, views
from wicklake.schemas import BRONZE, GOLD, SILVER
from wicklake.session import fresh_dir, staged
from wicklake.sources import bronze, decode, export, tables
from wicklake.streaming import sinks

DAY = "2024-01-15"


@pytest.fixture(scope="module")
def candles(spark, small):
    return inputs.candles(spark, small)


@pytest.fixture(scope="module")
def root(spark, candles):
    path = fresh_dir(spark, "bronze")
    bronze.write_bronze(inputs.bronze(candles), path)
    return path


def silver_table(spark):
    return scratch.namespace(spark, "silver") + ".kline"


def silver_rows(spark, table):
    return sorted(map(tuple, tables.read_table(spark, SILVER, table).collect()), key=repr)


@pytest.mark.parametrize("mode", jobs.MODES)
def test_bronze_to_silver_modes(spark, root, candles, mode):
    table = silver_table(spark)
    report = jobs.bronze_to_silver(spark, root, table, DAY, "1h", mode)
    assert [r.row_count for r in report.collect()] == [
        r["count"] for r in candles.where(f"trade_date = '{DAY}'").groupBy("symbol").count().orderBy("symbol").collect()]
    jobs.bronze_to_silver(spark, root, table, DAY, "1h", mode)
    repeated = duplicate_keys(spark.table(table), SILVER.key).count()
    assert repeated == (113 if mode == "bootstrap" else 0)


def test_overwrite_day_takes_other_intervals_along(spark, root, candles):
    table = silver_table(spark)
    tables.ensure_silver(spark, table)
    other = candles.where(f"trade_date = '{DAY}'").withColumn("interval", F.lit("5m"))
    tables.append(other, SILVER, table)
    jobs.bronze_to_silver(spark, root, table, DAY, "1h", "overwrite-day")
    assert {r.interval for r in spark.table(table).select("interval").distinct().collect()} == {"1h"}


def test_unknown_mode_and_empty_day(spark, root):
    table = silver_table(spark)
    with pytest.raises(ValueError):
        jobs.bronze_to_silver(spark, root, table, DAY, "1h", "replace")
    for mode in ("bootstrap", "merge"):
        assert jobs.bronze_to_silver(spark, root, table, "2020-01-01", "1h", mode).count() == 0


def test_overwrite_day_refuses_a_day_without_files(spark, root, candles):
    table = silver_table(spark)
    tables.ensure_silver(spark, table)
    tables.append(candles.withColumn("trade_date", F.lit("2020-01-01").cast("date")).limit(34), SILVER, table)
    before = silver_rows(spark, table)
    with pytest.raises(FileNotFoundError):
        jobs.bronze_to_silver(spark, root, table, "2020-01-01", "1h", "overwrite-day")
    assert silver_rows(spark, table) == before != []
    jobs.bronze_to_silver(spark, root, table, "2020-01-01", "1h", "overwrite-day", allow_empty=True)
    assert silver_rows(spark, table) == []


def test_report_has_every_symbol(spark, candles):
    many = candles.where(f"trade_date = '{DAY}'").limit(1).select(
        *[c for c in candles.columns if c != "symbol"], F.explode(F.transform(F.sequence(F.lit(1), F.lit(150)), lambda n: n.cast("string"))).alias("symbol"))
    assert summary.day_row_counts(many, DAY).count() == 150


def test_backfill_equals_day_loop(spark, root):
    whole, loop = silver_table(spark), silver_table(spark)
    jobs.backfill(spark, root, whole, "2024-01-10", "2024-01-13", "1h")
    for day in ("2024-01-10", "2024-01-11", "2024-01-12"):
        jobs.bronze_to_silver(spark, root, loop, day, "1h")
    assert silver_rows(spark, whole) == silver_rows(spark, loop) != []
    jobs.backfill(spark, root, whole, "2024-01-10", "2024-01-13", "1h")
    assert silver_rows(spark, whole) == silver_rows(spark, loop)
    with pytest.raises(ValueError):
        jobs.backfill(spark, root, whole, "2024-01-13", "2024-01-13", "1h")


def test_land_pages(spark, candles):
    pages, path = fresh_dir(spark, "pages"), fresh_dir(spark, "bronze")
    inputs.pages(candles).write.json(pages)
    jobs.land_pages(spark, pages, path, " clickusdt, viewusdt,", "1h", DAY, "2024-01-17", "2024-01-31T00:00:00")
    got = bronze.read_bronze(spark, path, "1h", "2024-01-01", "2024-02-01")
    want = candles.where("symbol in ('CLICKUSDT', 'VIEWUSDT') and trade_date in ('2024-01-15', '2024-01-16')")
    assert got.count() == want.count()
    assert got.columns == BRONZE.names
    assert {r.ingest_ts for r in got.select("ingest_ts").distinct().collect()} == {"2024-01-31T00:00:00+00:00"}


@pytest.fixture(scope="module")
def loaded(spark, root, candles):
    """Two batch days in gold with stream rows from the second day on."""
    silver, gold, hot = silver_table(spark), scratch.namespace(spark, "gold"), scratch.namespace(spark, "hot")
    tables.ensure_hot(spark, hot)
    recent = candles.where("trade_date >= '2024-01-16'")
    sinks.write_batch(inputs.stream_rows(recent).withColumn("close_price", F.col("close_price") + 1), 0, "candle", hot)
    values = technical_indicators(closed_candles(candles)).drop("interval")
    sinks.write_batch(values, 0, "indicator", hot)
    sinks.write_batch(inputs.alerts(candles), 0, "alert", hot)
    for day, as_of in ((DAY, "2024-01-16T12:00:00"), ("2024-01-16", "2024-01-17T12:00:00")):
        jobs.bronze_to_silver(spark, root, silver, day, "1h")
        jobs.silver_to_gold(spark, silver, hot, gold, day, as_of, "1h", 24, "exchange")
    return silver, gold, hot


def test_gold_rules_hold(spark, loaded):
    jobs.check_gold(spark, loaded[1])


def test_final_candles_survive_the_hot_refresh(spark, loaded, candles):
    _, gold, _ = loaded
    fact = spark.table(f"{gold}.fact_kline")
    batch = candles.where("trade_date in ('2024-01-15', '2024-01-16')")
    assert fact.where("is_final").count() == batch.count()
    final = {(r.open_time, r.close_price) for r in fact.where("is_final").collect()}
    assert final == {(r.open_time, r.close_price) for r in batch.collect()}
    hot = fact.where("not is_final")
    assert hot.where("number_of_trades is not null").count() == 0
    assert hot.count() == candles.where("trade_date >= '2024-01-17'").count()


def test_gold_is_stable_when_run_again(spark, loaded):
    silver, gold, hot = loaded
    names = ("dim_symbol", "dim_interval", "dim_date", "dim_data_source", "dim_pattern_type", "fact_kline",
             "fact_daily_market_summary", "fact_technical_indicator", "fact_pattern_alert")
    before = {n: sorted(map(tuple, spark.table(f"{gold}.{n}").collect()), key=repr) for n in names}
    jobs.silver_to_gold(spark, silver, hot, gold, "2024-01-16", "2024-01-17T12:00:00", "1h", 24, "exchange")
    for name in names:
        assert sorted(map(tuple, spark.table(f"{gold}.{name}").collect()), key=repr) == before[name], name


def test_dimensions_survive_an_interrupted_load(spark, loaded, monkeypatch):
    silver, gold, _ = loaded
    view = lambda: sorted(map(tuple, views.kline_unified(*[tables.read_table(spark, GOLD[t], f"{gold}.{t}") for t in (
        "fact_kline", "dim_symbol", "dim_interval", "dim_data_source")]).collect()), key=repr)
    before = view()
    stale = tables.read_table(spark, GOLD["dim_symbol"], f"{gold}.dim_symbol").withColumn("base_asset", F.lit("?"))
    tables.swap(stale, GOLD["dim_symbol"], f"{gold}.dim_symbol")

    def broken(*_):
        raise RuntimeError("interrupted")

    with monkeypatch.context() as patch, pytest.raises(RuntimeError):
        patch.setattr(jobs.tables, "swap", broken)
        jobs.load_batch(spark, silver, gold, "2024-01-16", "1h", "2024-01-17T12:00:00")
    assert view() == before
    jobs.load_batch(spark, silver, gold, "2024-01-16", "1h", "2024-01-17T12:00:00")
    assert [r[:-1] for r in view()] == [r[:-1] for r in before]
    assert tables.read_table(spark, GOLD["dim_symbol"], f"{gold}.dim_symbol").where("base_asset = '?'").count() == 0


def test_lost_dimension_is_not_numbered_anew(spark, loaded):
    silver, gold, _ = loaded
    held = staged(tables.read_table(spark, GOLD["dim_symbol"], f"{gold}.dim_symbol"))
    tables.swap(held.limit(0), GOLD["dim_symbol"], f"{gold}.dim_symbol")
    with pytest.raises(ValueError, match="dim_symbol is empty"):
        jobs.load_batch(spark, silver, gold, "2024-01-16", "1h", "2024-01-17T12:00:00")
    tables.swap(held, GOLD["dim_symbol"], f"{gold}.dim_symbol")


def test_hot_refresh_without_a_batch_day(spark, loaded):
    _, _, hot = loaded
    gold, silver = scratch.namespace(spark, "gold"), silver_table(spark)
    tables.ensure_silver(spark, silver)
    jobs.silver_to_gold(spark, silver, hot, gold, DAY, "2024-01-30T00:00:00", "1h", 24)
    assert spark.table(f"{gold}.fact_daily_market_summary").count() == 0
    assert spark.table(f"{gold}.fact_kline").where("is_final").count() == 0
    assert spark.table(f"{gold}.fact_kline").count() > 0
    jobs.check_gold(spark, gold)


def test_registered_views(spark, loaded, candles):
    _, gold, _ = loaded
    views.register(spark, gold, "2024-01-31T00:00:00")
    assert spark.table("vw_kline_unified").count() == spark.table(f"{gold}.fact_kline").count()
    latest = {r.symbol: r.open_time for r in spark.table("vw_latest_market_snapshot").collect()}
    assert latest == {r.symbol: r.t for r in candles.groupBy("symbol").agg(F.max("open_time").alias("t")).collect()}
    assert spark.table("vw_daily_market_summary").count() == 10
    assert spark.sql("select * from vw_pattern_alerts_recent").count() == 7


def test_created_views_equal_the_queries(spark, loaded):
    _, gold, _ = loaded
    views.create(spark, gold)
    views.register(spark, gold, "2024-01-31T00:00:00")
    for name in ("vw_kline_unified", "vw_daily_market_summary", "vw_latest_market_snapshot"):
        stored, query = spark.table(f"{gold}.{name}"), spark.table(name)
        assert stored.columns == query.columns
        assert sorted(map(tuple, stored.collect()), key=repr) == sorted(map(tuple, query.collect()), key=repr) != []
    recent = spark.table(f"{gold}.vw_pattern_alerts_recent")
    assert recent.columns == spark.table("vw_pattern_alerts_recent").columns and recent.count() == 0


def test_hot_tables_from_outside_the_catalog(spark, loaded, candles):
    _, _, hot = loaded
    gold, silver, root = scratch.namespace(spark, "gold"), silver_table(spark), fresh_dir(spark, "outside")
    tables.ensure_silver(spark, silver)
    for name in sinks.PLAIN:
        sinks.read_hot(spark, hot, name).write.parquet(f"{root}/{name}")
    read = jobs.external_reader("parquet", {"path": root + "/{table}"})
    inside = scratch.namespace(spark, "gold")
    jobs.silver_to_gold(spark, silver, "", gold, DAY, "2024-01-30T00:00:00", "1h", 24, read=read)
    jobs.silver_to_gold(spark, silver, hot, inside, DAY, "2024-01-30T00:00:00", "1h", 24)
    for name in GOLD:
        a, b = (sorted(map(tuple, spark.table(f"{g}.{name}").collect()), key=repr) for g in (gold, inside))
        assert a == b, name


def test_pages_are_read_by_day(spark, candles):
    pages, out = fresh_dir(spark, "pages"), fresh_dir(spark, "bronze")
    inputs.pages(candles).withColumn("day", F.date_from_unix_date(F.col("page_no").cast("int"))).write.partitionBy("day").json(pages)
    landed = spark.read.schema(jobs.PAGE_SCHEMA).json(pages)
    plan = landed.where(landed.day.isNull() | (landed.day == F.lit(DAY).cast("date")))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [(isnull(day" in plan
    jobs.land_pages(spark, pages, out, "clickusdt", "1h", DAY, "2024-01-16", "2024-01-20T00:00:00")
    assert bronze.read_bronze(spark, out, "1h", DAY).count() == candles.where(f"trade_date = '{DAY}' and symbol = 'CLICKUSDT'").count()


def test_events_are_published_as_candles(spark, candles):
    raw, topic = fresh_dir(spark, "raw"), fresh_dir(spark, "topic")
    inputs.events_json(candles).write.text(raw)
    jobs.publish_events(spark, "text", {"path": raw}, "text", {"path": topic}, fresh_dir(spark, "state"), {"availableNow": True}).awaitTermination()
    sent = decode.decode_candles(spark.read.text(topic))
    assert sent.exceptAll(decode.decode_events(spark.read.text(raw))).isEmpty() and sent.count() > 3000


def test_newest_candles_equal_the_whole_fact(spark, loaded):
    _, gold, _ = loaded
    t = {n: tables.read_table(spark, GOLD[n], f"{gold}.{n}") for n in GOLD}
    rest = [t[n] for n in ("dim_symbol", "dim_interval", "dim_data_source", "fact_technical_indicator")]
    kept, whole = (sorted(map(tuple, views.latest_snapshot(f, *rest).collect()), key=repr) for f in (t["latest_kline"], t["fact_kline"]))
    assert kept == whole and len(whole) == 5
    assert set(map(tuple, t["latest_kline"].collect())) <= set(map(tuple, t["fact_kline"].collect()))
    plan = views.latest_snapshot(t["latest_kline"], *rest)._jdf.queryExecution().executedPlan().toString()
    assert "fact_kline" not in plan


def test_newest_indicators_equal_the_whole_fact(spark, loaded):
    _, gold, _ = loaded
    t = {n: tables.read_table(spark, GOLD[n], f"{gold}.{n}") for n in GOLD}
    dims = [t[n] for n in ("dim_symbol", "dim_interval", "dim_data_source")]
    kept, whole = (views.latest_snapshot(t["latest_kline"], *dims, t[n]) for n in ("latest_indicator", "fact_technical_indicator"))
    rows = sorted(map(tuple, kept.collect()), key=repr)
    assert rows == sorted(map(tuple, whole.collect()), key=repr) and len(rows) == 5
    assert 0 < kept.where("sma25 is not null").count() == t["latest_indicator"].count()
    assert "fact_" not in kept._jdf.queryExecution().executedPlan().toString()


def test_newest_indicators_move_with_the_candles(spark, loaded, monkeypatch):
    """Only the days of the newest candles are read; a series without a change keeps its row."""
    silver, _, hot = loaded
    gold = scratch.namespace(spark, "gold")
    for day, as_of in ((DAY, "2024-01-16T12:00:00"), ("2024-01-16", "2024-01-17T12:00:00")):
        jobs.silver_to_gold(spark, silver, hot, gold, day, as_of, "1h", 24, "exchange")
    read = []
    real = tables.touched
    monkeypatch.setattr(tables, "touched", lambda *a: read.append(a) or real(*a))
    one = tables.read_table(spark, GOLD["fact_kline"], f"{gold}.fact_kline").limit(1)
    before = sorted(map(tuple, tables.read_table(spark, GOLD["latest_indicator"], f"{gold}.latest_indicator").collect()), key=repr)
    jobs._refresh_latest_indicators(spark, gold, one)
    assert sorted(map(tuple, tables.read_table(spark, GOLD["latest_indicator"], f"{gold}.latest_indicator").collect()), key=repr) == before
    (_, moved, parts), = read
    assert parts == ("date_id",) and moved.count() == 1


def test_newest_indicators_operator(spark, candles):
    closed = closed_candles(candles)
    last = closed.groupBy("symbol", "interval").agg(F.max("open_time").alias("open_time"))
    want = technical_indicators(closed).join(last, ["symbol", "interval", "open_time"], "left_semi")
    assert sorted(map(tuple, newest_indicators(closed).collect())) == sorted(map(tuple, want.collect()))


def test_incremental_load_equals_a_full_refresh(spark, loaded, candles):
    """Three loads of what is new, with corrections, a replay and a compacted day, and one refresh of everything."""
    silver, _, _ = loaded
    hot = scratch.namespace(spark, "hot")
    tables.ensure_hot(spark, hot)
    new, full, state = scratch.namespace(spark, "gold"), scratch.namespace(spark, "gold"), fresh_dir(spark, "state")
    stream = inputs.stream_rows(candles)
    values = technical_indicators(closed_candles(candles)).drop("interval")
    as_of, hours = "2024-01-31T00:00:00", 17 * 24

    def write(batch_id, rows):
        sinks.write_batch(rows, batch_id, "candle", hot)
        sinks.write_batch(patterns.pattern_alerts(rows), batch_id, "alert", hot)
        times = rows.select("symbol", "open_time")
        sinks.write_batch(values.join(times, ["symbol", "open_time"], "left_semi"), batch_id, "indicator", hot)

    jobs.ensure_static(spark, new, ["1h"])
    jobs.load_batch(spark, silver, new, DAY, "1h", as_of)
    first = stream.where("open_time < 1705708800000")
    write(0, first)
    read = [jobs.load_new_hot(spark, hot, new, state, as_of, hours, "1h")]
    write(1, stream.where("open_time >= 1705276800000").withColumn("close_price", F.col("close_price") + 2))
    sinks.compact(spark, hot, "candle", "2024-01-17")
    read.append(jobs.load_new_hot(spark, hot, new, state, as_of, hours, "1h", max_files=3))
    write(0, first)
    read.append(jobs.load_new_hot(spark, hot, new, state, as_of, hours, "1h"))
    assert jobs.load_new_hot(spark, hot, new, state, as_of, hours, "1h") == {"candle": 0, "indicator": 0, "alert": 0}
    assert all(n > 0 for r in read for n in r.values()) and read[0]["candle"] == first.count() == read[2]["candle"]

    jobs.ensure_static(spark, full, ["1h"])
    jobs.load_batch(spark, silver, full, DAY, "1h", as_of)
    jobs.refresh_hot(spark, hot, full, as_of, hours, "1h")
    for name in ("fact_kline", "latest_kline", "fact_technical_indicator", "latest_indicator"):
        a, b = (sorted(map(tuple, tables.read_table(spark, GOLD[name], f"{g}.{name}").drop("updated_at").collect()), key=repr) for g in (new, full))
        assert a == b != [], name
    a, b = ({(r.symbol_id, r.close_time) for r in tables.read_table(spark, GOLD["fact_pattern_alert"], f"{g}.fact_pattern_alert").collect()}
            for g in (new, full))
    assert a >= b != set()


def test_latest_snapshot_joins_by_series_and_time(spark, loaded):
    """Also an indicator whose date is not the day of its open time."""
    _, gold, _ = loaded
    t = [spark.table(f"{gold}.{n}") for n in (
        "fact_kline", "dim_symbol", "dim_interval", "dim_data_source", "fact_technical_indicator")]
    odd = t[4].withColumn("date_id", F.date_add("date_id", 3))
    plain, moved = (sorted(map(tuple, views.latest_snapshot(*t[:4], x).collect()), key=repr) for x in (t[4], odd))
    assert plain == moved


def test_export_csv(spark, candles):
    path = fresh_dir(spark, "csv")
    day = candles.where(f"trade_date = '{DAY}' and symbol in ('CLICKUSDT', 'VIEWUSDT')")
    export.export_csv(day, path)
    back = spark.read.option("header", True).csv(path)
    assert back.columns == ["open_time", "open", "high", "low", "close", "volume", "symbol", "interval"]
    assert {r.open_time[:10] for r in back.collect()} == {DAY}
    counts = {r.symbol: r["count"] for r in back.groupBy("symbol").count().collect()}
    assert counts == {r.symbol: r["count"] for r in day.groupBy("symbol").count().collect()}
