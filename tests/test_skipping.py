"""What a point read of a fact table reads, and what a write refuses."""

import pytest
from pyspark.sql import functions as F

from wicklake.catalog import inputs, tables as scratch
from wicklake.operators.checks import not_null_counts
from wicklake.plans import jobs, star
from wicklake.schemas import FACT_KLINE, GOLD, SILVER
from wicklake.sources import tables


def scanned(df):
    """Rows that the scans of an executed frame have put out."""
    df.collect()
    plan, rows = [df._jdf.queryExecution().executedPlan()], 0
    while plan:
        node = plan.pop()
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            plan.append(node.executedPlan())
            continue
        if node.nodeName().startswith("Scan parquet"):
            rows += node.metrics().apply("numOutputRows").value()
        children = node.children()
        plan += [children.apply(i) for i in range(children.size())]
        if "QueryStage" in node.nodeName():
            plan.append(node.plan())
    return rows


def many_symbols(spark, symbols=300, candles=200):
    rows = spark.range(symbols * candles).select(
        (F.col("id") % symbols).alias("symbol_id"), F.lit(1).cast("bigint").alias("interval_id"),
        (F.lit(1_705_276_800_000) + F.floor(F.col("id") / symbols) * 60_000).alias("open_time"))
    filled = {"date_id": F.lit("2024-01-15").cast("date"), "open_ts": F.timestamp_millis("open_time"), "is_final": F.lit(True),
              "updated_at": F.timestamp_millis("open_time")}
    others = {c: F.lit(None).cast(kind) for c, kind in FACT_KLINE.columns if c not in rows.columns and c not in filled}
    return rows.withColumns({**filled, **others}).select(*FACT_KLINE.names)


def test_a_point_read_skips_other_symbols(spark):
    table = scratch.filled(spark, FACT_KLINE, many_symbols(spark), "fact_kline")
    one = spark.table(table).where("symbol_id = 7").orderBy(F.desc("open_time"))
    assert one.count() == 200
    assert 200 <= scanned(one) <= 3 * tables.PAGE_ROWS
    # The value may come from another table, as in a lookup by name.
    wanted = spark.createDataFrame([(7, "A")], "symbol_id bigint, symbol string").where("symbol = 'A'").agg(F.max("symbol_id")).scalar()
    assert scanned(spark.table(table).where(F.col("symbol_id") == wanted)) <= 3 * tables.PAGE_ROWS
    # In files that hold no such symbol the filter on the column spares all rows, though the value lies within their range.
    even = scratch.filled(spark, FACT_KLINE, many_symbols(spark).where("symbol_id % 2 = 0"), "fact_kline")
    assert scanned(spark.table(even).where("symbol_id = 7")) == 0


def test_options_are_those_of_the_table(spark):
    table = scratch.filled(spark, FACT_KLINE, many_symbols(spark, 3, 3), "fact_kline")
    shown = spark.sql(f"SHOW CREATE TABLE {table}").first()[0]
    assert "parquet.bloom.filter.enabled#symbol_id" in shown and "parquet.page.row.count.limit" in shown
    assert tables.file_options(FACT_KLINE, "iceberg") == {} and tables.file_options(SILVER) == {}


def test_null_stops_a_write_before_the_table_changes(spark):
    table = scratch.filled(spark, FACT_KLINE, many_symbols(spark, 3, 3), "fact_kline")
    before = sorted(map(tuple, tables.read_table(spark, FACT_KLINE, table).collect()), key=repr)
    bad = many_symbols(spark, 4, 3).withColumn("updated_at", F.when(F.col("symbol_id") != 3, F.col("updated_at")))
    for write in (lambda: tables.upsert(bad, FACT_KLINE, table), lambda: tables.insert_absent(bad, FACT_KLINE, table),
                  lambda: tables.replace_day(bad, FACT_KLINE, table, "2024-01-15")):
        with pytest.raises(ValueError, match="updated_at': 3"):
            write()
        assert sorted(map(tuple, tables.read_table(spark, FACT_KLINE, table).collect()), key=repr) == before
    counts = {r.column_name: r.null_count for r in not_null_counts(bad, FACT_KLINE.not_null).collect()}
    assert {c: n for c, n in counts.items() if n} == {"updated_at": 3}


def test_bad_silver_rows_stop_the_batch_load(spark, small):
    rows = inputs.candles(spark, small).where("trade_date = '2024-01-15'")
    silver, gold = scratch.namespace(spark, "silver") + ".kline", scratch.namespace(spark, "gold")
    tables.ensure_silver(spark, silver)
    tables.append(rows, SILVER, silver)
    jobs.ensure_static(spark, gold, ["1h"])
    jobs.load_batch(spark, silver, gold, "2024-01-15", "1h", "2024-01-16T00:00:00")
    # A candle without its times, which a writer other than the jobs has put into silver.
    tables.append(rows.limit(1).withColumns({"open_time": F.lit(1).cast("bigint"), "open_ts": F.lit(None).cast("timestamp")}), SILVER, silver)

    def facts():
        names = ("fact_kline", "latest_kline", "latest_indicator", "fact_daily_market_summary")
        return {n: sorted(map(tuple, tables.read_table(spark, GOLD[n], f"{gold}.{n}").collect()), key=repr) for n in names}

    before = facts()
    with pytest.raises(ValueError, match="open_ts"):
        jobs.load_batch(spark, silver, gold, "2024-01-15", "1h", "2024-01-17T00:00:00")
    assert facts() == before and len(before["fact_kline"]) == 113


def test_repeated_keys_stop_a_write(spark):
    table = scratch.filled(spark, FACT_KLINE, many_symbols(spark, 3, 3), "fact_kline")
    twice = many_symbols(spark, 3, 3).unionAll(many_symbols(spark, 1, 1))
    with pytest.raises(ValueError, match="repeats keys"):
        tables.upsert(twice, FACT_KLINE, table)
    assert spark.table(table).count() == 9


def test_references_are_found_before_the_facts(spark, small):
    rows = inputs.candles(spark, small).where("trade_date = '2024-01-15'")
    dims = inputs.Star(spark, rows)
    facts = star.kline_facts(rows, dims.symbol.where("symbol <> 'CLICKUSDT'"), dims.interval, dims.source, inputs.AS_OF)
    assert facts.where("symbol_id IS NULL").count() == 0 and facts.count() < rows.count()
