"""Command line: `python -m wicklake.cli <job> ...`, also under spark-submit."""

from __future__ import annotations

import argparse
from datetime import datetime, timezone

from pyspark.sql import SparkSession

from wicklake.functions.text import symbol_list
from wicklake.functions.time import in_day_range
from wicklake.operators.clean import of_interval, of_symbols
from wicklake.operators.indicators import closed_candles
from wicklake.plans import jobs, views
from wicklake.session import drop_staged, spark_session
from wicklake.sources import tables
from wicklake.sources.export import export_csv
from wicklake.schemas import SILVER
from wicklake.streaming import sinks, speed_layer
from wicklake.streaming.indicators import recent_closes


# Lines of the run report that are shown.
SHOWN = 100


def _pairs(items: list[str]) -> dict[str, str]:
    return dict(item.split("=", 1) for item in items)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="wicklake")
    sub = top.add_subparsers(dest="job", required=True)

    def job(name: str, *arguments: str) -> argparse.ArgumentParser:
        p = sub.add_parser(name)
        for argument in arguments:
            p.add_argument(f"--{argument}", required=True)
        p.add_argument("--interval", default="1m")
        return p

    def as_of(p: argparse.ArgumentParser) -> None:
        p.add_argument("--as-of", default=None, help="moment of the run, UTC (default: now)")

    land = job("land", "pages", "bronze", "symbols", "start-date", "end-date")
    land.add_argument("--overwrite", action="store_true")
    land.add_argument("--source", default="rest_api")
    as_of(land)

    silver = job("bronze-to-silver", "bronze", "silver", "process-date")
    silver.add_argument("--mode", default="merge", choices=jobs.MODES)
    silver.add_argument("--allow-empty", action="store_true", help="let overwrite-day empty a day without bronze files")

    gold = job("silver-to-gold", "silver", "hot", "gold", "process-date")
    gold.add_argument("--hot-lookback-hours", type=int, default=48)
    gold.add_argument("--exchange", default=None)
    gold.add_argument("--hot-format", default=None, help="read the stream tables behind this data source")
    gold.add_argument("--hot-option", action="append", default=[], help="key=value; {table} stands for the table's name")
    gold.add_argument("--hot-checkpoint", default=None, help="read only what the stream tables have got since the last run")
    as_of(gold)

    day = job("run-day", "bronze", "silver", "hot", "gold", "run-date")
    day.add_argument("--pages", default=None)
    day.add_argument("--symbols", default=None)
    day.add_argument("--hot-lookback-hours", type=int, default=48)
    as_of(day)

    job("backfill", "bronze", "silver", "start-date", "end-date")

    stream = job("stream", "hot", "checkpoints")
    stream.add_argument("--format", default="kafka")
    stream.add_argument("--option", action="append", default=[], help="key=value, passed to the source")
    stream.add_argument("--start", default="earliest", choices=["earliest", "latest"])
    stream.add_argument("--state-partitions", type=int, default=None)
    stream.add_argument("--once", action="store_true", help="process what is there and stop")
    stream.add_argument("--history", default=None, help="silver table whose last closes, of --interval, the indicators go on from")
    stream.add_argument("--upsert", action="store_true", help="merge into the tables instead of appending")

    compact = job("compact", "hot", "date")
    compact.add_argument("--table", default="candle", choices=sorted(sinks.PLAIN))

    events = job("publish-events", "checkpoint", "to")
    events.add_argument("--format", default="kafka")
    events.add_argument("--option", action="append", default=[], help="key=value, passed to the source")
    events.add_argument("--to-option", action="append", default=[], help="key=value, passed to the sink of format --to")
    events.add_argument("--once", action="store_true", help="process what is there and stop")

    job("check-gold", "gold")
    job("create-views", "gold")
    job("clean-table", "table")

    job("export-csv", "silver", "symbols", "start-date", "end-date", "out")
    return top


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    a = parser().parse_args(argv)
    spark = spark or spark_session(f"wicklake-{a.job}")
    as_of = getattr(a, "as_of", None) or datetime.now(timezone.utc)
    if a.job == "land":
        jobs.land_pages(
            spark, a.pages, a.bronze, a.symbols, a.interval, a.start_date, a.end_date, as_of, a.overwrite, a.source)
    elif a.job == "bronze-to-silver":
        report = jobs.bronze_to_silver(spark, a.bronze, a.silver, a.process_date, a.interval, a.mode, a.allow_empty)
        report.show(SHOWN, False)
        if (lines := report.count()) > SHOWN:
            print(f"the first {SHOWN} of {lines} symbols")
    elif a.job == "silver-to-gold":
        jobs.silver_to_gold(
            spark, a.silver, a.hot, a.gold, a.process_date, as_of, a.interval, a.hot_lookback_hours, a.exchange,
            jobs.external_reader(a.hot_format, _pairs(a.hot_option)) if a.hot_format else jobs.read_hot, a.hot_checkpoint)
    elif a.job == "run-day":
        places = jobs.Places(a.bronze, a.silver, a.gold, a.hot, a.pages)
        jobs.run_day(spark, places, a.run_date, as_of, a.symbols, a.interval, a.hot_lookback_hours)
    elif a.job == "backfill":
        jobs.backfill(spark, a.bronze, a.silver, a.start_date, a.end_date, a.interval)
    elif a.job == "stream":
        trigger = {"availableNow": True} if a.once else None
        history = None
        if a.history:
            history = recent_closes(closed_candles(of_interval(tables.read_table(spark, SILVER, a.history), a.interval)))
        speed_layer.drain(speed_layer.run_speed_layer(
            spark, a.format, _pairs(a.option), a.hot, a.checkpoints, a.start, trigger, a.upsert,
            a.state_partitions, history))
    elif a.job == "publish-events":
        trigger = {"availableNow": True} if a.once else None
        jobs.publish_events(
            spark, a.format, _pairs(a.option), a.to, _pairs(a.to_option), a.checkpoint, trigger).awaitTermination()
    elif a.job == "check-gold":
        jobs.check_gold(spark, a.gold)
    elif a.job == "create-views":
        views.create(spark, a.gold)
    elif a.job == "clean-table":
        print(f"{tables.remove_unused(spark, a.table)} folders removed")
    elif a.job == "compact":
        sinks.compact(spark, a.hot, a.table, a.date)
    elif a.job == "export-csv":
        rows = of_interval(tables.read_table(spark, SILVER, a.silver), a.interval)
        days = rows.where(in_day_range(rows["trade_date"], a.start_date, a.end_date))
        export_csv(of_symbols(days, symbol_list(a.symbols)), a.out)
    drop_staged(spark)


if __name__ == "__main__":
    main()
