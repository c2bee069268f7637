"""The stream job: one source, three tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from wicklake.session import runtime_conf
from wicklake.sources import tables
from wicklake.streaming import sinks
from wicklake.streaming.indicators import stream_indicators
from wicklake.streaming.source import read_candle_stream

# How often the tables are written. Candles and alerts go out as soon as the batch before is done, so an alert
# waits for nothing and a batch has what has arrived meanwhile.
TRIGGERS = {"rows": "0 seconds", "indicator": "1 second"}
# The tables of one batch in the order they are written.
ROW_TABLES = ("alert", "candle")


def start_raw_and_alerts(
    stream: DataFrame, hot: str, checkpoint: str, trigger: dict, as_upsert: bool = False,
) -> StreamingQuery:
    """The alert and the candle table of a stream, as one query that reads the source once."""
    return (
        stream.writeStream.foreachBatch(sinks.writer(ROW_TABLES, hot, as_upsert))
        .option("checkpointLocation", f"{checkpoint}/rows").trigger(**trigger).start())


def start_indicators(
    stream: DataFrame, hot: str, checkpoint: str, trigger: dict, as_upsert: bool = False,
    state_partitions: int | None = None, history: DataFrame | None = None,
) -> StreamingQuery:
    """`state_partitions` is how many tasks share the symbols; `history` is what they go on from (`recent_closes`).

    The first start of a query fixes both.
    """
    spark = stream.sparkSession
    tasks = state_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    with runtime_conf(spark, "spark.sql.shuffle.partitions", str(tasks)):
        return (
            stream_indicators(stream, history).writeStream.outputMode("append")
            .foreachBatch(sinks.writer(("indicator",), hot, as_upsert))
            .option("checkpointLocation", checkpoint).trigger(**trigger).start())


def run_speed_layer(
    spark: SparkSession, fmt: str, options: dict[str, str], hot: str, checkpoints: str,
    start: str = "earliest", trigger: dict | None = None, as_upsert: bool = False,
    state_partitions: int | None = None, history: DataFrame | None = None,
) -> list[StreamingQuery]:
    """Start the two stream queries: candles with their alerts need no state, indicators keep state per symbol.

    They have checkpoints of their own, so the source is read twice. `trigger={"availableNow": True}` processes what is there
    and stops.
    """
    def each(name: str) -> dict:
        return trigger or {"processingTime": TRIGGERS[name]}

    tables.ensure_hot(spark, hot)
    rows = start_raw_and_alerts(
        read_candle_stream(spark, fmt, options, start), hot, checkpoints, each("rows"), as_upsert)
    values = start_indicators(
        read_candle_stream(spark, fmt, options, start), hot, f"{checkpoints}/indicator", each("indicator"), as_upsert,
        state_partitions, history)
    return [rows, values]


def drain(queries: list[StreamingQuery]) -> None:
    for query in queries:
        query.awaitTermination()
