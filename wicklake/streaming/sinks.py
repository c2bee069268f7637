"""Stream tables: an append-only log per table, read as the newest entry per key.

A trigger only appends, whatever the size of the table, and a replayed batch adds entries that the
reader collapses. `compact` rewrites a past day as its newest entries. With `as_upsert` a trigger
merges into the table instead.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime, timedelta, timezone
from itertools import batched

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from wicklake.functions import time as tm
from wicklake.operators.clean import on_day
from wicklake.operators.patterns import pattern_alerts
from wicklake.operators.rows import first_row
from wicklake.schemas import HOT, STREAM_ALERT, STREAM_CANDLE, STREAM_INDICATOR, Layout
from wicklake.session import runtime_conf, staged
from wicklake.sources import tables

PLAIN = {"candle": STREAM_CANDLE, "alert": STREAM_ALERT, "indicator": STREAM_INDICATOR}
# Files of a compacted day are deleted by so many threads, and so many names are held at once.
DELETERS = 8
DELETED_AT_ONCE = 1_000
TIME = {"candle": "open_time", "alert": "close_time", "indicator": "open_time"}


def _newest_first(columns: list[str]) -> list:
    """Later arrival at the source; of candles that arrived together the closed one is the later.

    A batch number says nothing across checkpoints, where it starts at 0 again, so it comes last. Rows that carry no
    place in the source have the start of their run as arrival and their batch as place.
    """
    closed = ["is_closed"] if "is_closed" in columns else []
    order = ["arrival_ts", *closed, "arrival_at", "arrival_seq", "batch_id"]
    return [F.col(c).desc_nulls_last() for c in order]


def newest(log: DataFrame, name: str) -> DataFrame:
    return first_row(log, PLAIN[name].key, _newest_first(log.columns))


def log_rows(batch: DataFrame, batch_id: int, name: str, run: datetime | None = None) -> DataFrame:
    """One log entry per key of a micro-batch; `run` is when the stream was started."""
    layout: Layout = HOT[name]
    placed = "arrival_seq" in batch.columns
    # Rows of a file know where their block starts; they are counted from there on. A row takes a byte at least.
    in_block = F.when(F.col("arrival_at").contains("/"), F.monotonically_increasing_id().bitwiseAND(F.lit(2**33 - 1))).otherwise(0)
    rows = batch.withColumns({
        "trade_date": tm.utc_date(F.col(TIME[name])), "batch_id": F.lit(batch_id).cast("bigint"),
        **({"arrival_seq": F.col("arrival_seq") + in_block} if placed else {
            "arrival_ts": F.lit(run).cast("timestamp"), "arrival_at": F.lit(None).cast("string"),
            "arrival_seq": F.lit(batch_id).cast("bigint")}),
    })
    return newest(rows.select(*layout.names), name)


def write_batch(
    batch: DataFrame, batch_id: int, name: str, hot: str, as_upsert: bool = False, run: datetime | None = None,
) -> None:
    rows = log_rows(batch, batch_id, name, run)
    table = f"{hot}.{name}"
    if as_upsert:
        layout = HOT[name]
        keyed = Layout(layout.columns, layout.partition_by, PLAIN[name].key)
        tables.upsert(rows, keyed, table)
    else:
        tables.append(rows, HOT[name], table)


def read_hot(
    spark: SparkSession, hot: str, name: str, as_of: datetime | str | None = None, hours: int = 48,
) -> DataFrame:
    """Current rows of a stream table; with `as_of`, only the days the lookback reaches are read."""
    log = tables.read_table(spark, HOT[name], f"{hot}.{name}")
    if as_of is not None:
        moment = datetime.fromtimestamp(tm.as_of_ms(as_of) / 1000, tz=tm.timezone.utc)
        log = log.where(F.col("trade_date") >= F.lit((moment - timedelta(hours=hours)).date()))
    return newest(log, name).select(*PLAIN[name].names)


def newer_rows(batch: DataFrame, name: str, hot: str) -> DataFrame:
    """The rows that new entries of a log bring: those that are the newest of their key.

    The newest entries are kept beside the log, so that an entry that comes again or late, or a file that `compact` has
    rewritten, is compared with what is known without reading the log. Only days that the new entries belong to are read and
    replaced. An entry that is known already counts as new, so a repeated batch gives the same rows.
    """
    spark, layout, table = batch.sparkSession, HOT[name], f"{hot}.current_{name}"
    tables.create_table(spark, layout, table)
    new = staged(newest(batch.select(*layout.names), name))
    known = tables.touched(tables.read_table(spark, layout, table), new, layout.partition_by)
    # Of equal entries the new one wins, since it is not old.
    both = known.withColumn("_old", F.lit(True)).unionByName(new.withColumn("_old", F.lit(False)))
    kept = staged(newest(both, name))
    tables.replace_partitions(kept.select(*layout.names), layout, table, new)
    return kept.where(~F.col("_old")).select(*PLAIN[name].names)


def follow_hot(
    spark: SparkSession, hot: str, name: str, checkpoint: str, use: Callable[[str, DataFrame], None], max_files: int | None = None,
) -> StreamingQuery:
    """A query that calls `use` with the newer rows of the files that a log has got since the last start, and stops.

    The table is a log that streams append to, not one that they merge into (`as_upsert`).
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        use(name, newer_rows(batch, name, hot))

    # Files of any age are read. One that `compact` removes before it is read has its newest entries in a newer file.
    options = {"maxFileAge": "36500d", **({"maxFilesPerTrigger": str(max_files)} if max_files else {})}
    with runtime_conf(spark, "spark.sql.files.ignoreMissingFiles", "true"):
        return (spark.readStream.options(**options).table(f"{hot}.{name}").writeStream.foreachBatch(write)
                .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def compact(spark: SparkSession, hot: str, name: str, day: date | str) -> None:
    """Keep only the newest entries of one day.

    The entries of the files that are there now are appended once more, each newest one, and then those files go. What a
    stream appends meanwhile lies in other files and stays. Readers see entries twice for a moment, which they collapse
    anyway, and so they do after a crash in between. A day may have very many files: their names are found by a scan, staged,
    joined with the entries, and reach the driver a part at a time as they are deleted.
    """
    table = f"{hot}.{name}"
    spark.catalog.refreshTable(table)
    log = on_day(spark.table(table), day).withColumn("_file", F.col("_metadata.file_path"))
    files = staged(log.select("_file").distinct())
    if files.isEmpty():
        return
    known = log.join(files, "_file", "left_semi").select(*HOT[name].names)
    tables.append(staged(newest(known, name)), HOT[name], table)
    with ThreadPoolExecutor(DELETERS) as pool:
        # The names of one part of the staged list at a time.
        for part in batched(files.toLocalIterator(), DELETED_AT_ONCE):
            list(pool.map(lambda r: _delete(spark, r["_file"]), part))
    spark.catalog.refreshTable(table)


def _delete(spark: SparkSession, file: str) -> None:
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, False)


def writer(names: Sequence[str], hot: str, as_upsert: bool = False):
    """`foreachBatch` function that writes one micro-batch to several tables; alerts are found in its candles.

    The batch is held while it is written, so the source is read and parsed once for all tables. What an executor takes along
    when it is lost is read from the source again, whose part of a batch is fixed.
    """
    run = datetime.now(timezone.utc)

    def write(batch: DataFrame, batch_id: int) -> None:
        held = batch.persist() if len(names) > 1 else batch
        try:
            for name in names:
                rows = pattern_alerts(held) if name == "alert" else held
                write_batch(rows, batch_id, name, hot, as_upsert, run)
        finally:
            if len(names) > 1:
                held.unpersist()
    return write
