"""Scratch namespaces and streams for the queries that write."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from wicklake.schemas import Layout
from wicklake.session import fresh_dir
from wicklake.sources import tables
from wicklake.sources.decode import publish


def namespace(spark: SparkSession, name: str) -> str:
    """A new namespace in the shared folder."""
    unique = f"{name}_{uuid.uuid4().hex}"
    tables.create_namespace(spark, unique, fresh_dir(spark, unique))
    return unique


def filled(spark: SparkSession, layout: Layout, rows: DataFrame, name: str) -> str:
    """A new table that holds `rows`."""
    table = f"{namespace(spark, name)}.{name}"
    tables.create_table(spark, layout, table)
    tables.append(rows, layout, table)
    return table


def land_json(rows: DataFrame, folder: str) -> None:
    """Append stream candles to a folder of JSON-lines files."""
    publish(rows, "text", {"path": folder})


def sentinel(rows: DataFrame) -> DataFrame:
    """An open candle a month after the last one: it moves the watermark past all others."""
    last = rows.agg(F.max("open_time").alias("t"))
    later = F.col("t") + 30 * 86_400_000
    prices = [F.lit(1.0).alias(c) for c in ("open_price", "high_price", "low_price", "close_price", "volume")]
    return last.select(
        F.lit("SENTINEL").alias("symbol"), later.alias("open_time"), (later + 59_999).alias("close_time"),
        *prices, F.lit(False).alias("is_closed"))
