"""Operator 4: mix sources to target weights by systematic sampling. Built-in functions only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wicklake.llm.common import WORD, staged

WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
# Sources are named with "=" before them; rows without one go by this.
NULL_SOURCE = "-"


def text_size(text: Column) -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _cells(rows: int) -> int:
    """Odd number of cells a stratum of a source is dealt to: neither the cells of a source nor the rows of a cell
    grow faster than the root of the table."""
    return 2 * (math.isqrt(rows) // 2) + 1


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most_copies: int = MOST_COPIES) -> DataFrame:
    """One row per source (source_key, words): its place by code point with null last, weight, size and target.

    The whole of all sizes is shared by weight. A target stops at `most_copies` times its source's size and what
    is left over is shared again by weight. In the order of size per weight the sources that stop come first, and
    the level (words per unit of weight) of the rest is the largest of the levels reached on the way.
    """
    by_place = Window.orderBy(F.col("source_key") == NULL_SOURCE, "source_key")
    everything = Window.partitionBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = (Window.orderBy(F.col("words") / F.col("weight"), "place")
              .rowsBetween(Window.unboundedPreceding, -1))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.col("place") - 1) % len(weights) + 1).cast("int"))
    placed = sizes.withColumn("place", F.row_number().over(by_place)).withColumn("weight", weight)
    level = ((F.sum("words").over(everything) - F.coalesce(F.sum(F.col("words") * most_copies).over(before), F.lit(0)))
             / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))))
    return (placed.withColumn("level", level).withColumn("level", F.max("level").over(everything))
            .withColumn("target", F.least((F.col("words") * most_copies).cast("double"), F.col("level") * F.col("weight")))
            .select("source_key", "place", F.col("words").alias("source_size"), "target"))


def copies(rows: DataFrame, seed: int = 0, weights: tuple[int, ...] = WEIGHTS, most_copies: int = MOST_COPIES) -> DataFrame:
    """`rows` (doc_id, source, size, tie and any payload) with source_size, target and copies.

    Systematic sampling: a document's expected copies are target / size of its source. They are summed along an
    order of the source's documents, one offset per source is added, and a document gives one copy per whole
    number its stretch crosses. The order goes by the number of binary digits of the size, then by cell, size and
    doc_id, so that the words taken come near the target as well as the copies.

    The running sum never meets in one task: a stratum of a source is dealt to about sqrt(rows) cells, rows are
    numbered inside cells, and cells are offset by the counts of the cells before them. A source with a third of
    all rows, or a third of all rows with one size, is as many cells as any other share of that size would be.

    Null sources are a source of their own, the last. A size of 0 takes part and yields 0 words. Repeated rows are
    each counted. A null doc_id counts as id 0 in the order. No rows give no rows.
    """
    cells = _cells(rows.count())
    cell = ["source_key", "stratum", "cell"]
    # Never null, so that the join below finds rows where the window has put them and moves no text again.
    dealt = (rows.withColumn("source_key", F.coalesce(F.concat(F.lit("="), "source"), F.lit(NULL_SOURCE)))
             .withColumn("stratum", F.length(F.bin("size")))
             .withColumn("cell", F.pmod(F.coalesce("doc_id", F.lit(0)), F.lit(cells).cast("long"))))
    counted = staged(dealt.groupBy(*cell).agg(F.count("*").alias("n"), F.sum("size").alias("words")), "cells")
    sources = source_targets(counted.groupBy("source_key").agg(F.sum("words").alias("words")), weights, most_copies)
    earlier = Window.partitionBy("source_key").orderBy("stratum", "cell").rowsBetween(Window.unboundedPreceding, -1)
    offset = (F.col("place") * 40503 + seed) % 65536 / F.lit(65536.0)
    starts = (counted.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))).alias("c")
              .join(sources.alias("s"), F.expr("c.source_key = s.source_key"))
              .select("c.source_key", "stratum", "cell", "before", "source_size", "target", offset.alias("offset")))
    within = Window.partitionBy(*cell).orderBy("size", F.coalesce("doc_id", F.lit(0)), "tie")
    rank = F.col("before") + F.col("rank")
    each = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    crossed = F.floor(rank * F.col("each") + F.col("offset")) - F.floor((rank - 1) * F.col("each") + F.col("offset"))
    return (dealt.withColumn("rank", F.row_number().over(within)).alias("d")
            .join(starts.alias("t"), F.expr("d.source_key = t.source_key AND d.stratum = t.stratum AND d.cell = t.cell"))
            .select("d.*", "t.before", "t.source_size", "t.target", "t.offset")
            .withColumn("each", each).withColumn("copies", F.least(crossed, F.lit(most_copies)))
            .drop("source_key", "stratum", "cell", "rank", "before", "offset", "each"))


def _slim(docs: DataFrame, *payload: Column) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                       text_size(F.col("text")).alias("size"), F.xxhash64("text").alias("tie"), *payload)


def mixture(docs: DataFrame, seed: int = 0) -> DataFrame:
    """(doc_id, size, source_size, target, taken) for every row of `docs` (doc_id, source, text, ...)."""
    return (copies(staged(_slim(docs), "sizes"), seed)
            .select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")))


def mix(docs: DataFrame, seed: int = 0) -> DataFrame:
    """The mix itself: each row of `docs`, with all its columns, as often as it has copies."""
    planned = copies(_slim(docs, F.struct("*").alias("payload")), seed).filter("copies > 0")
    return planned.select("payload", F.explode(F.expr("sequence(1L, copies)")).alias("copy")).select("payload.*")
