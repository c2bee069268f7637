"""Windows over the last n rows of a series, without putting a whole series into one task.

A series is cut by time into chunks. A `ROWS n PRECEDING` frame at the start of a chunk needs up to
n rows from before it, so each chunk gets a copy of the n rows that precede it (its history) and the
copies are dropped after the window ran. Every frame then holds the rows it would hold over the whole
series, in the same order, which makes the results equal to the last bit.

The history of a chunk is found from chunk tails (the last n rows of each chunk). It lies within the
n preceding non-empty chunks, since each holds at least one row. The search runs inside groups of
chunks first and then across groups, so the step that sees a whole series handles n rows per
`GROUP` chunks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

GROUP = 256
HISTORY = "_history"
CHUNK = "_chunk"


def _last(rows: Column, n: int) -> Column:
    size = F.size(rows)
    return F.slice(rows, F.greatest(size - n, F.lit(0)) + 1, F.lit(n))


def _carried(tails: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    """Per chunk the last n rows of the chunks before it, as an array `_before`."""
    grouped = tails.withColumn("_group", F.floor(F.col(CHUNK) / GROUP))
    in_group = Window.partitionBy(*keys, "_group").orderBy(CHUNK)
    inner = grouped.select(
        *keys, "_group", CHUNK,
        _last(F.flatten(F.collect_list("_tail").over(in_group.rowsBetween(-n, -1))), n).alias("_inner"),
        _last(F.flatten(F.collect_list("_tail").over(in_group.rowsBetween(-n, 0))), n).alias("_upto"),
        F.lead(CHUNK).over(in_group).isNull().alias("_closes"),
    )
    across = Window.partitionBy(*keys).orderBy("_group").rowsBetween(-n, -1)
    outer = inner.where("_closes").select(
        *keys, "_group", _last(F.flatten(F.collect_list("_upto").over(across)), n).alias("_outer"))
    # Every group has an outer row. A left join, because an inner one would add not-null filters to one
    # branch only, and the branches would no longer share their shuffle.
    joined = inner.join(outer, [*keys, "_group"], "left")
    return joined.select(*keys, CHUNK, _last(F.concat("_outer", "_inner"), n).alias("_before"))


def with_history(
    df: DataFrame, keys: Sequence[str], order: str, values: Sequence[str], n: int, chunk: Column,
) -> DataFrame:
    """`df` plus the n preceding rows of every chunk, flagged in `_history`.

    `(keys, order)` must be unique and `chunk` must not decrease along `order`. The result is already
    partitioned for windows over `(keys, _chunk)`: the input is shuffled once, tails are a fraction
    n / (rows per chunk) of it. Rows without a key or a time belong to no series and are left out; saying
    so here also keeps the branches below alike, so that they share that one shuffle.
    """
    parts = df.withColumn(CHUNK, chunk)
    for column in (*keys, order, CHUNK):
        parts = parts.where(F.col(column).isNotNull())
    parts = parts.repartition(*keys, CHUNK)
    newest = Window.partitionBy(*keys, CHUNK).orderBy(F.col(order).desc())
    tails = (
        parts.select(*keys, CHUNK, order, *values)
        .withColumn("_back", F.row_number().over(newest)).where(F.col("_back") <= n)
        .groupBy(*keys, CHUNK)
        .agg(F.sort_array(F.collect_list(F.struct(order, *values))).alias("_tail"))
    )
    history = (
        _carried(tails, keys, n)
        .select(*keys, CHUNK, F.inline("_before"))
        .withColumn(HISTORY, F.lit(True))
        .repartition(*keys, CHUNK)
    )
    return parts.withColumn(HISTORY, F.lit(False)).unionByName(history, allowMissingColumns=True)


def by_time(order: str, width_ms: Column | int) -> Column:
    """Chunk number of a row: its time divided by the width, rounded down."""
    return F.floor(F.col(order) / width_ms)


def series_window(keys: Sequence[str], order: str, chunked: bool):
    """Rows of a series (or of one chunk of it, with its history) in time order."""
    return Window.partitionBy(*keys, *([CHUNK] if chunked else [])).orderBy(order)
