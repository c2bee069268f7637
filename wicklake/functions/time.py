"""Epoch, date and interval expressions. The session zone is UTC."""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, functions as F

DAY_MS = 86_400_000
HOUR_MS = 3_600_000

# Length of one unit of an interval code. `M` is a calendar month and has no length.
UNIT_SECONDS = {"s": 1, "m": 60, "h": 3600, "d": 86400, "w": 604800}


def ts_seconds(ms: Column) -> Column:
    """Epoch milliseconds to a timestamp, cut to whole seconds."""
    return F.timestamp_seconds(whole_div(ms, 1000))


def ts_millis(ms: Column) -> Column:
    """Epoch milliseconds to a timestamp, milliseconds kept."""
    return F.timestamp_millis(ms)


def whole_div(value: Column, by: int | Column) -> Column:
    """Whole-number division, cut towards zero."""
    by = by if isinstance(by, Column) else F.lit(by)
    return F.call_function("div", value.cast("bigint"), by.cast("bigint"))


def utc_date(ms: Column) -> Column:
    return F.to_date(ts_millis(ms))


def epoch_ms(ts: Column) -> Column:
    return F.unix_millis(ts.cast("timestamp"))


def as_of_ms(as_of: datetime | str) -> int:
    """The reference moment of a run; text and naive values are read as UTC."""
    if isinstance(as_of, str):
        as_of = datetime.fromisoformat(as_of)
    if as_of.tzinfo is None:
        as_of = as_of.replace(tzinfo=timezone.utc)
    return int(as_of.timestamp() * 1000)


def as_of_ts(as_of: datetime | str) -> Column:
    return F.timestamp_millis(F.lit(as_of_ms(as_of)))


def interval_seconds(code: Column) -> Column:
    """Seconds of a code such as `1m`, `5m`, `1h`; NULL where the code has no fixed length."""
    length = F.create_map(*[F.lit(x) for item in UNIT_SECONDS.items() for x in item])
    count = F.substr(code, F.lit(1), F.length(code) - 1).try_cast("bigint")
    seconds = count * F.try_element_at(length, F.right(code, F.lit(1)))
    return F.when(code.rlike("^[0-9]+[a-zA-Z]$"), seconds).cast("int")


def parse_day(day: date | str) -> date:
    return date.fromisoformat(day) if isinstance(day, str) else day


def previous_day(run_day: date | str) -> date:
    return parse_day(run_day) - timedelta(days=1)


def check_range(start: date | str, end: date | str) -> tuple[date, date]:
    """Half-open day range; an empty or reversed one is an error."""
    start, end = parse_day(start), parse_day(end)
    if end <= start:
        raise ValueError(f"end {end} must be after start {start}")
    return start, end


def in_day_range(day: Column, start: date | str, end: date | str) -> Column:
    start, end = check_range(start, end)
    return (day >= F.lit(start)) & (day < F.lit(end))


def partition_path(prefix: str, symbol: Column, interval: Column, day: Column) -> Column:
    """Object path of the candle file of one symbol, interval and day."""
    return F.concat(
        F.lit(prefix), F.lit("/interval="), interval, F.lit("/symbol="), symbol,
        F.date_format(day, "'/year='yyyy'/month='MM'/day='dd'/'"),
        F.lit("part-"), symbol, F.lit("-"), interval, F.lit("-"),
        F.date_format(day, "yyyy-MM-dd"), F.lit(".parquet"),
    )
