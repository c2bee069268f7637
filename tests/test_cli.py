import pytest

from wicklake import cli
from wicklake.catalog import inputs, tables as scratch
from wicklake.schemas import STREAM_CANDLE
from wicklake.session import fresh_dir
from wicklake.sources.external import read_external
from wicklake.streaming import sinks


def test_jobs_from_the_command_line(spark, small, capsys):
    candles = inputs.candles(spark, small)
    pages, bronze, landed = (fresh_dir(spark, n) for n in ("pages", "bronze", "landed"))
    inputs.pages(candles).write.json(pages)
    scratch.land_json(inputs.stream_rows(candles), landed)
    silver, gold, hot = scratch.namespace(spark, "silver") + ".kline", scratch.namespace(spark, "gold"), scratch.namespace(spark, "hot")

    def run(line, **values):
        cli.main(line.format(**values).split(), spark)
    run("land --pages {p} --bronze {b} --symbols clickusdt,viewusdt --interval 1h --start-date 2024-01-14"
        " --end-date 2024-01-17 --as-of 2024-01-20T00:00:00", p=pages, b=bronze)
    run("bronze-to-silver --bronze {b} --silver {s} --process-date 2024-01-14 --interval 1h", b=bronze, s=silver)
    assert "CLICKUSDT" in capsys.readouterr().out
    run("backfill --bronze {b} --silver {s} --start-date 2024-01-14 --end-date 2024-01-16 --interval 1h", b=bronze, s=silver)
    run("stream --hot {h} --checkpoints {c} --format text --option path={l} --once --history {s} --interval 1h",
        h=hot, c=fresh_dir(spark, "c"), l=landed, s=silver)
    run("silver-to-gold --silver {s} --hot {h} --gold {g} --process-date 2024-01-15 --interval 1h"
        " --as-of 2024-01-31T00:00:00 --hot-lookback-hours 24 --hot-checkpoint {c}", s=silver, h=hot, g=gold, c=fresh_dir(spark, "c"))
    run("clean-table --table {g}.fact_kline", g=gold)
    assert "folders removed" in capsys.readouterr().out
    run("compact --hot {h} --table candle --date 2024-01-15", h=hot)
    out = fresh_dir(spark, "csv")
    run("export-csv --silver {s} --symbols clickusdt --start-date 2024-01-15 --end-date 2024-01-16 --interval 1h --out {o}",
        s=silver, o=out)
    day = candles.where("trade_date = '2024-01-15' and symbol in ('CLICKUSDT', 'VIEWUSDT')")
    fact = spark.table(f"{gold}.fact_kline")
    assert fact.where("is_final").count() == day.count()
    assert fact.where("not is_final").count() == candles.where("trade_date = '2024-01-30'").count()
    assert sinks.read_hot(spark, hot, "candle").count() == candles.count()
    assert spark.read.option("header", True).csv(out).count() == day.where("symbol = 'CLICKUSDT'").count()


def test_run_day_from_the_command_line(spark, small):
    candles = inputs.candles(spark, small)
    pages = fresh_dir(spark, "pages")
    inputs.pages(candles).write.json(pages)
    silver, gold, hot = scratch.namespace(spark, "silver") + ".kline", scratch.namespace(spark, "gold"), scratch.namespace(spark, "hot")
    sinks.tables.ensure_hot(spark, hot)
    cli.main([
        "run-day", "--bronze", fresh_dir(spark, "bronze"), "--silver", silver, "--hot", hot, "--gold", gold, "--pages", pages,
        "--symbols", "CLICKUSDT", "--run-date", "2024-01-16", "--interval", "1h", "--as-of", "2024-01-16T01:00:00"], spark)
    assert spark.table(f"{gold}.fact_daily_market_summary").count() == 1


def test_arguments_are_checked():
    with pytest.raises(SystemExit):
        cli.parser().parse_args(["bronze-to-silver", "--bronze", "b", "--silver", "s", "--process-date", "d", "--mode", "x"])


def test_external_table(spark, small):
    path = fresh_dir(spark, "external")
    inputs.stream_rows(inputs.candles(spark, small)).write.parquet(path)
    df = read_external(spark, STREAM_CANDLE, "parquet", {"path": path}, as_of="2024-01-31T00:00:00", hours=48)
    assert df.count() == 224
    assert "GreaterThanOrEqual(open_time" in df._jdf.queryExecution().executedPlan().toString()
