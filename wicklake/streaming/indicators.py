"""Technical indicators on a stream.

`ROWS` frames are not available on streams, so every symbol keeps the closes its next candle needs
and the candles the watermark has not passed yet.
"""

from __future__ import annotations

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window, functions as F

from wicklake.operators import indicators as batch
from wicklake.schemas import STREAM_INDICATOR
from wicklake.streaming import processor

LENGTHS = processor.Lengths(
    sma_short=batch.SMA_SHORT, sma_long=batch.SMA_LONG, rsi=batch.RSI_LENGTH, fast=batch.MACD_FAST,
    slow=batch.MACD_SLOW, signal=batch.MACD_SIGNAL, history=batch.MACD_HISTORY)

cloudpickle.register_pickle_by_value(processor)


def recent_closes(candles: DataFrame) -> DataFrame:
    """(symbol, closes, last) of each symbol: the closes that the values of its next candle depend on, oldest first, and the
    open time of the newest.

    `candles` are closed ones of one interval, such as silver. Spark keeps the newest of each symbol in every task before the
    shuffle, so a long history costs a scan.
    """
    rank = F.row_number().over(Window.partitionBy("symbol").orderBy(F.col("open_time").desc()))
    newest = candles.select("symbol", "open_time", "close_price").withColumn("_rank", rank).where(F.col("_rank") <= batch.MACD_HISTORY)
    held = F.sort_array(F.collect_list(F.struct("open_time", "close_price")))
    return newest.groupBy("symbol").agg(held.alias("held"), F.max("open_time").alias("last")).select(
        "symbol", F.transform("held", lambda c: c["close_price"]).alias("closes"), "last")


def stream_indicators(stream: DataFrame, history: DataFrame | None = None) -> DataFrame:
    """Indicators of the closed candles of a stream that has a watermark on `ts`.

    With `history` (see `recent_closes`) a symbol goes on from there: its first candle has the values it has in a batch over the
    whole series, and candles up to the end of the history are left out. Only the first start of a query reads it.
    """
    # Open candles move the watermark too. A plain filter would be pushed below the watermark; naming
    # the event time in the predicate keeps it above.
    closed = stream.where(F.col("is_closed") == F.col("ts").isNotNull()).select(
        "symbol", "open_time", "close_price", "ts")
    return closed.groupBy("symbol").transformWithStateInPandas(
        statefulProcessor=processor.IndicatorProcessor(LENGTHS), outputStructType=STREAM_INDICATOR.ddl,
        outputMode="Append", timeMode="EventTime", initialState=history.groupBy("symbol") if history is not None else None)
