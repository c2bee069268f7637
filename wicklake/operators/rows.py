"""One row per key: newest, first, latest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def first_row(df: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of every key in `order`.

    Ties are settled by all columns outside the key, so the result does not depend on how the
    input is split. Rows that cannot win are dropped before the shuffle (WindowGroupLimit), hence
    a key with very many copies reaches its task as at most one row per upstream task.
    """
    ties = [F.col(c).asc_nulls_last() for c in df.columns if c not in key]
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(*order, *ties))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def dedup_latest(df: DataFrame, key: Sequence[str], recency: str = "ingest_ts") -> DataFrame:
    """Newest row per key; rows without a recency lose."""
    return first_row(df, key, [F.col(recency).desc_nulls_last()])


def latest_by(df: DataFrame, key: Sequence[str], order: str, keep: Sequence[str] | None = None) -> DataFrame:
    """The row with the largest `order` per key, for input where `(key, order)` is unique.

    A plain aggregate: with numeric, date and boolean columns it runs as a partial hash aggregate,
    so only one row per key and task is shuffled and nothing is sorted.
    """
    keep = list(keep) if keep is not None else [c for c in df.columns if c not in key and c != order]
    values = [F.max_by(c, order).alias(c) for c in keep if c not in key and c != order]
    return df.groupBy(*key).agg(F.max(order).alias(order), *values)
