"""CSV export of candles."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wicklake.functions.time import ts_millis

# Column -> header of the export.
EXPORT_COLUMNS = {
    "open_price": "open", "high_price": "high", "low_price": "low", "close_price": "close",
    "volume": "volume",
}


def export_frame(candles: DataFrame) -> DataFrame:
    """Series, readable open time and the five measures."""
    return candles.select(
        "symbol", "interval",
        F.date_format(ts_millis(F.col("open_time")), "yyyy-MM-dd HH:mm:ss").alias("open_time"),
        *[F.col(name).try_cast("double").alias(header) for name, header in EXPORT_COLUMNS.items()])


def export_csv(candles: DataFrame, path: str) -> None:
    """CSV with header, a folder per symbol and interval, in time order inside and across the files of a folder."""
    ordered = export_frame(candles).repartitionByRange("symbol", "interval", "open_time").sortWithinPartitions("symbol", "interval", "open_time")
    ordered.write.mode("overwrite").option("header", True).partitionBy("symbol", "interval").csv(path)
