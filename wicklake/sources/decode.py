"""Landed text to candle rows, and candle rows to event text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from wicklake.operators.rows import first_row
from wicklake.schemas import BRONZE, STREAM_CANDLE

# Element order of one exchange page row. The twelfth element is not used.
PAGE_ELEMENTS = [
    "open_time", "open_price", "high_price", "low_price", "close_price", "volume", "close_time",
    "quote_asset_volume", "number_of_trades", "taker_buy_base_volume", "taker_buy_quote_volume",
    "ignore",
]

# Field of the nested candle object -> column.
EVENT_FIELDS = {
    "t": "open_time", "T": "close_time", "o": "open_price", "h": "high_price", "l": "low_price",
    "c": "close_price", "v": "volume", "x": "is_closed",
}


def decode_pages(
    pages: DataFrame, ingest_ts: Column, source: str = "rest_api", order: Sequence[str] = ("page_no",),
) -> DataFrame:
    """Exchange pages (`symbol, interval, page_no, body`) to bronze candles.

    `body` is a JSON array of positional arrays. Overlapping pages repeat candles; the first copy in
    page order stays.
    """
    rows = pages.select(
        "symbol", "interval", *order,
        F.posexplode(F.from_json("body", "array<array<string>>")).alias("_pos", "_row"))
    kinds = dict(BRONZE.columns)
    typed = rows.select(
        "symbol", "interval", *order, "_pos",
        *[F.get("_row", F.lit(i)).try_cast(kinds[name]).alias(name)
          for i, name in enumerate(PAGE_ELEMENTS) if name in kinds])
    once = first_row(typed, BRONZE.key, [F.col(c).asc() for c in (*order, "_pos")])
    return once.withColumns({
        "is_closed": F.lit(True), "ingest_ts": ingest_ts.cast("string"), "source": F.lit(source),
    }).select(*BRONZE.names)


def decode_events(events: DataFrame, value: str = "value") -> DataFrame:
    """Raw exchange events to stream candles. Other event types and broken events are dropped.

    The nested object is read as a map, because two of its fields differ only in case.
    """
    parsed = events.withColumn("_m", F.from_json(value, "e string, s string, k map<string,string>"))
    kinds = dict(STREAM_CANDLE.columns)
    fields = [F.col("_m.k")[field].try_cast(kinds[name]).alias(name) for field, name in EVENT_FIELDS.items()]
    rows = parsed.where(F.col("_m.e") == "kline").select(F.col("_m.s").alias("symbol"), *fields)
    return rows.dropna().select(*STREAM_CANDLE.names)


def decode_candles(records: DataFrame, value: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """JSON candle records to rows. A bad field is NULL, a record without its key is dropped."""
    parsed = records.select(F.from_json(F.col(value).cast("string"), STREAM_CANDLE.ddl).alias("_r"), *keep)
    rows = parsed.select("_r.*", *keep)
    return rows.where(F.col("symbol").isNotNull() & F.col("open_time").isNotNull())


def encode_candles(candles: DataFrame, value: str = "value") -> DataFrame:
    """One JSON text per candle, with the symbol as the message key."""
    return candles.select(
        F.col("symbol").alias("key"),
        F.to_json(F.struct(*STREAM_CANDLE.names), {"ignoreNullFields": "false"}).alias(value))


def publish(candles: DataFrame, fmt: str, options: dict[str, str]) -> None:
    """Write encoded candles to a message sink (`kafka`) or as JSON lines (`text`)."""
    encoded = encode_candles(candles)
    if fmt == "text":
        encoded = encoded.select("value")
    encoded.write.format(fmt).options(**options).mode("append").save()
