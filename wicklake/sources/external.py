"""Stream tables that live outside the catalog, for example in a database."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from wicklake.operators.clean import lookback
from wicklake.schemas import Layout


def read_external(
    spark: SparkSession, layout: Layout, fmt: str, options: dict[str, str], time: str = "open_time",
    as_of: datetime | str | None = None, hours: int = 48,
) -> DataFrame:
    """Rows of a candle, alert or indicator table behind any Spark data source (`jdbc`, `parquet`, ...).

    Connection settings come from the caller. The lookback is a plain comparison, which the source gets
    pushed down.
    """
    table = spark.read.format(fmt).options(**options).load()
    rows = table.select(*[F.col(name).cast(kind).alias(name) for name, kind in layout.columns])
    return rows if as_of is None else lookback(rows, as_of, hours, time)
