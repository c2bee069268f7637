"""Integrity rules as queries. Each returns the violations (or their counts)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def not_null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column: how many NULLs it holds."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "column_name", "null_count")


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with the number of rows."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("row_count")).where("row_count > 1")


def missing_references(df: DataFrame, column: str, dim: DataFrame, dim_column: str | None = None) -> DataFrame:
    """Values of `column` that the dimension lacks, with the number of rows; NULL refers to nothing.

    Rows are counted per value first, so a frequent value is one row by the time it is joined.
    """
    used = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("row_count"))
    known = dim.select(F.col(dim_column or column).alias(column))
    return used.join(known, column, "left_anti")


def require_empty(df: DataFrame, message: str) -> None:
    """Raise when the check found something; the message shows a few of the rows."""
    found = df.limit(5).collect()
    if found:
        raise ValueError(f"{message}: {[row.asDict() for row in found]}")
