"""Candle streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from wicklake.functions.time import ts_seconds
from wicklake.sources.decode import decode_candles

# Fixed value: how long a late candle is waited for.
WATERMARK = "10 seconds"

ARRIVAL = ["arrival_ts", "arrival_at", "arrival_seq"]


def read_candle_stream(
    spark: SparkSession, fmt: str, options: dict[str, str], start: str = "earliest", watermark: str = WATERMARK,
) -> DataFrame:
    """JSON candle records from a message topic (`kafka`) or from JSON-lines files (`text`).

    Adds the event time `ts` with its watermark, and where the record stood in the input.
    """
    reader = spark.readStream.format(fmt).options(**options)
    if fmt == "kafka":
        records = reader.option("startingOffsets", start).load().select(
            "value", F.col("timestamp").alias("arrival_ts"), F.col("partition").cast("string").alias("arrival_at"),
            F.col("offset").alias("arrival_seq"))
    elif start == "earliest":
        records = reader.load().select(
            "value", F.col("_metadata.file_modification_time").alias("arrival_ts"),
            F.col("_metadata.file_path").alias("arrival_at"),
            F.col("_metadata.file_block_start").alias("arrival_seq"))
    else:
        raise ValueError(f"a {fmt} stream can only start at the earliest record")
    candles = decode_candles(records, keep=ARRIVAL)
    return candles.withColumn("ts", ts_seconds(F.col("open_time"))).withWatermark("ts", watermark)
