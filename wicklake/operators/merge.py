"""Keyed merges of a target and a source frame, as one full outer join.

`source` must hold at most one row per key; `duplicate_keys` in `checks` finds the others.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

_NEW = "_new_"


def merge_rows(
    target: DataFrame, source: DataFrame, key: Sequence[str],
    update: Sequence[str] | None = None, keep_if: str | None = None,
) -> DataFrame:
    """Target after the upsert of source.

    `update` lists the columns a match changes (default: all). A target row whose boolean column
    `keep_if` is true stays as it is. New keys take every column from the source.
    """
    update = set(target.columns if update is None else update)
    old = target.withColumn("_old", F.lit(True))
    new = source.select(
        *key, *[F.col(c).alias(_NEW + c) for c in target.columns if c not in key],
        F.lit(True).alias("_newer"))
    joined = old.join(new, list(key), "full")
    matched = F.col("_old") & F.col("_newer")
    if keep_if:
        matched = matched & ~F.coalesce(F.col(keep_if), F.lit(False))
    inserted = F.col("_old").isNull()

    def value(name: str) -> Column:
        if name in key:
            return F.col(name)
        takes = (matched | inserted) if name in update else inserted
        return F.when(takes, F.col(_NEW + name)).otherwise(F.col(name)).alias(name)

    return joined.select(*[value(c) for c in target.columns])


def absent_rows(source: DataFrame, target: DataFrame, key: Sequence[str], order: Sequence[Column] = ()) -> DataFrame:
    """Source rows whose key the target lacks, one per key."""
    ties = [F.col(c).asc_nulls_last() for c in source.columns if c not in key]
    ranked = source.withColumn(
        "_rank", F.row_number().over(Window.partitionBy(*key).orderBy(*(list(order) + ties or [F.lit(1)]))))
    return ranked.where("_rank = 1").drop("_rank").join(target.select(*key), list(key), "left_anti")


def unify(batch: DataFrame, hot: DataFrame, key: Sequence[str], hot_columns: Sequence[str]) -> DataFrame:
    """Batch rows and hot rows together: a final row beats a hot one, otherwise hot is newer."""
    return merge_rows(batch, hot, key, update=hot_columns, keep_if="is_final")
