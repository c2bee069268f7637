"""Surrogate ids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def assign_ids(df: DataFrame, name: str, base: Column | int, levels: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Number the rows from `base` + 1 in the order of `levels`, then `order`.

    Rows are counted per level value, the running totals of those counts give each group its start,
    and the rows are numbered inside their group. So the rows themselves are never brought into
    one task; only the counts of the first level are.
    """
    inside = Window.partitionBy(*levels).orderBy(*order)
    numbered = df.withColumn("_id", F.row_number().over(inside).cast("bigint"))
    for depth in range(len(levels)):
        above, level = list(levels[:depth]), levels[depth]
        counts = df.groupBy(*above, level).agg(F.count(F.lit(1)).alias("_n"))
        earlier = Window.partitionBy(*above).orderBy(level).rowsBetween(Window.unboundedPreceding, -1)
        starts = counts.select(*above, level, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
        numbered = (
            numbered.join(starts, [*above, level])
            .withColumn("_id", F.col("_id") + F.col("_before")).drop("_before"))
    base = base if isinstance(base, Column) else F.lit(base)
    return numbered.withColumn(name, F.col("_id") + F.coalesce(base, F.lit(0)).cast("bigint")).drop("_id")
