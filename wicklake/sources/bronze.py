"""Bronze candle files: `interval=/symbol=/year=/month=/day=` parquet."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameReader, SparkSession, functions as F

from wicklake.functions import time as tm
from wicklake.schemas import BRONZE
from wicklake.session import runtime_conf
from wicklake.sources.tables import gathered

_FILE_SCHEMA = BRONZE.ddl + ", year int, month int, day int"


def _days_glob(root: str, interval: str, start: date, end: date) -> str:
    """One glob for the days of the range, so only their folders are listed, and once."""
    days: dict[tuple[int, int], list[str]] = {}
    current = start
    while current < end:
        days.setdefault((current.year, current.month), []).append(f"{current.day:02d}")
        current += timedelta(days=1)
    months = [f"year={y:04d}/month={m:02d}/day={{{','.join(found)}}}" for (y, m), found in days.items()]
    return f"{root}/interval={interval}/symbol=*/{{{','.join(months)}}}"


def _load(reader: DataFrameReader, fmt: str, path: str) -> DataFrame | None:
    """What lies at a path or glob; None if nothing does."""
    try:
        return reader.format(fmt).load(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def read_bronze(
    spark: SparkSession, root: str, interval: str, start: date | str, end: date | str | None = None, required: bool = False,
) -> DataFrame:
    """Candles of one interval for one day, or for the half-open range `start`..`end`.

    Only the folders of the range are listed and read. A day without files gives no rows, or is an error if its files are
    `required`; files without rows are none.
    """
    start = tm.parse_day(start)
    start, end = tm.check_range(start, end if end is not None else start + timedelta(days=1))
    reader = spark.read.schema(_FILE_SCHEMA).option("basePath", root)
    files = _load(reader, "parquet", _days_glob(root, interval, start, end))
    if files is None:
        if required:
            raise FileNotFoundError(f"no {interval} files from {start} to {end} in {root}")
        return BRONZE.empty(spark)
    day = F.make_date("year", "month", "day")
    return files.where((F.col("interval") == interval) & tm.in_day_range(day, start, end)).select(*BRONZE.names)


def existing_partitions(
    spark: SparkSession, root: str, interval: str | None = None,
    start: date | str | None = None, end: date | str | None = None,
) -> DataFrame:
    """The partitions that hold files, from the file listing alone; no file is opened.

    With an interval and a day range only the folders of the range are listed.
    """
    keys = list(BRONZE.partition_by)
    where = root if interval is None else _days_glob(root, interval, *tm.check_range(start, end))
    kinds = "interval string, symbol string, year int, month int, day int"
    none = spark.createDataFrame([], kinds).select(*keys)
    files = _load(spark.read.option("pathGlobFilter", "*.parquet").option("basePath", root), "binaryFile", where)
    if files is None or not set(keys) <= set(files.columns):  # no folders, or folders without files
        return none
    return files.select(
        F.col("interval").cast("string"), F.col("symbol").cast("string"),
        *[F.col(c).cast("int") for c in ("year", "month", "day")]).distinct()


def write_bronze(
    candles: DataFrame, root: str, overwrite: bool = False, existing: DataFrame | None = None,
) -> None:
    """One file set per interval, symbol and day. A partition that exists is left alone unless `overwrite`.

    `existing` are the partitions that are there, if the caller knows where to look.
    """
    spark = candles.sparkSession
    keys = list(BRONZE.partition_by)
    day = tm.utc_date(F.col("open_time"))
    rows = candles.select(*BRONZE.names, F.year(day).alias("year"), F.month(day).alias("month"), F.dayofmonth(day).alias("day"))
    if not overwrite:
        there = existing_partitions(spark, root) if existing is None else existing
        rows = rows.join(there, keys, "left_anti")
    padded = rows.withColumns({c: F.lpad(F.col(c).cast("string"), 2, "0") for c in ("month", "day")})
    with runtime_conf(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
        gathered(padded, BRONZE).write.mode("overwrite" if overwrite else "append") \
            .option("compression", "snappy").partitionBy(*keys).parquet(root)
