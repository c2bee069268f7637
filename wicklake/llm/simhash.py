"""Operator 3: SimHash near-dedup by meet-in-the-middle ball hashing."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wicklake.llm.common import LAST_ID, staged, text_batches
from wicklake.llm.components import connected_components

SHINGLE = 3
RADIUS = 2
BITS = 64
_LANES = np.uint64(0x0101010101010101)
_SHINGLES_AT_ONCE = 1 << 18


def _bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the 64-bit numbers have each bit set, lowest bit first.

    Byte lanes: a shift and a mask leave one bit in each of eight bytes, and 255 such numbers can be added before
    a byte overflows.
    """
    blocks = -(-len(hashes) // 255)
    padded = np.zeros(blocks * 255, np.uint64)
    padded[:len(hashes)] = hashes
    out = np.zeros(BITS, np.int64)
    for bit in range(8):
        lanes = ((padded >> np.uint64(bit)) & _LANES).reshape(blocks, 255).sum(axis=1, dtype=np.uint64)
        out[bit::8] = lanes.astype("<u8").view(np.uint8).reshape(blocks, 8).sum(axis=0, dtype=np.int64)
    return out


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Unsigned SimHash of a text: bit b is set if it is set in over half of the shingle hashes (XXH64, seed 42).

    Words are runs of anything but ASCII white space, with A-Z in lower case. A text of fewer words than a
    shingle has is one shingle; a null text and one without words give 0.
    """
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    ones = np.zeros(BITS, np.int64)
    for first in range(0, n, _SHINGLES_AT_ONCE):
        part = words[first:min(first + _SHINGLES_AT_ONCE, n) + shingle - 1]
        grams = map(b" ".join, zip(*(part[i:] for i in range(shingle)))) if len(part) >= shingle else iter([b" ".join(part)])
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(42)), np.uint64)
        ones += _bit_counts(hashes)
    return int(sum(1 << b for b in range(BITS) if 2 * ones[b] > n))


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, keys: dict[str, Column] | None = None) -> DataFrame:
    """(doc_id, fingerprint as signed long) of every row of `docs` (doc_id, text, ...), or other keys of type long than doc_id."""
    text_batches(docs.sparkSession)
    keys = keys or {"doc_id": F.col("doc_id").cast("long")}
    names = [*keys, "fingerprint"]

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(t, shingle) for t in batch["text"].to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([*(batch[k] for k in names[:-1]), pa.array(prints.view(np.int64))], names)

    return docs.select(*(c.alias(k) for k, c in keys.items()), "text").mapInArrow(of, ", ".join(f"{n} long" for n in names))


def _ball(print_: Column, radius: int) -> Column:
    """All 64-bit numbers within `radius` bits of a fingerprint, each once, with their distance: array of structs."""
    ball = F.array(F.struct(print_.alias("variant"), F.lit(0).alias("off"), F.lit(-1).alias("bit")))
    shell = ball
    for off in range(1, radius + 1):
        shell = F.flatten(F.transform(shell, lambda x, off=off: F.transform(
            F.filter(F.sequence(F.lit(0), F.lit(BITS - 1)), lambda b: b > x["bit"]),
            lambda b: F.struct(x["variant"].bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), b)).alias("variant"),
                               F.lit(off).alias("off"), b.alias("bit")))))
        ball = F.concat(ball, shell)
    return ball


def links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Pairs (a, b) of different fingerprints at `radius` or fewer differing bits that connect whatever such pairs connect.

    `prints` (fingerprint) holds each fingerprint once. Every fingerprint emits its variants within half the
    radius, rounded up; the variants are shuffled, and those that meet in a variant collide. Two fingerprints
    within the radius meet in the middle between them, at a distance rounded up on one side and down on the other.
    A variant's group is no larger than a ball, however many documents there are, since fingerprints are distinct.
    In each group everyone is paired with the smallest member of the near half, which keeps the group connected
    without listing all its pairs; each pair is then verified by its differing bits.
    """
    far, near = -(-radius // 2), radius // 2
    # Spread first: every row becomes a whole ball.
    tasks = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    variants = prints.repartition(tasks, "fingerprint").select("fingerprint", F.explode(_ball(F.col("fingerprint"), far)).alias("v")).select("fingerprint", "v.variant", "v.off")
    group = Window.partitionBy("variant")
    met = variants.withColumn("hub", F.min(F.when(F.col("off") <= near, F.col("fingerprint"))).over(group))
    pairs = met.filter(F.col("hub") != F.col("fingerprint")).select(
        F.least("hub", "fingerprint").alias("a"), F.greatest("hub", "fingerprint").alias("b")).distinct()
    return pairs.filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)


def _rooted(prints: DataFrame, least: Column, radius: int) -> DataFrame:
    """(fingerprint, least, component) of each fingerprint: the smallest `least` of its rows, and the fingerprint its group is named by."""
    nodes = staged(prints.groupBy("fingerprint").agg(F.min(least).alias("least")), "nodes")
    parts = connected_components(links(nodes.select("fingerprint"), radius)).select(F.col("node").alias("fingerprint"), "component")
    return nodes.join(parts, "fingerprint", "left").withColumn("component", F.coalesce("component", "fingerprint"))


def groups(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row: the smallest doc_id that links lead to, itself included.

    Documents with one fingerprint are one node, so a group of copies of any size is a single row in the link
    search. Texts without words have fingerprint 0 and are linked like any other. A null doc_id counts as the
    largest id and is null in the result where nothing smaller is linked. Repeated rows are answered each; columns
    besides doc_id and text are not read. No rows give no rows.
    """
    prints = staged(fingerprints(docs, shingle), "fingerprints")
    rooted = _rooted(prints, F.coalesce("doc_id", F.lit(LAST_ID)), radius)
    least = rooted.groupBy("component").agg(F.min("least").alias("component_id"))
    named = rooted.join(least, "component").select("fingerprint", F.nullif("component_id", F.lit(LAST_ID)).alias("component_id"))
    return prints.join(named, "fingerprint").select("doc_id", "fingerprint", "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """`docs` with one row of each group: that with the smallest doc_id, the first by hash of the text if rows share the id.

    Groups are told apart by their fingerprints, not by their smallest id: rows of different groups that share an id, or have
    none, stay each. A row is found again by its id and 128 bits of hash of its text; rows that agree in both are copies.
    """
    keys = {"keep_id": F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)), "tie": F.xxhash64("text"), "tie2": F.xxhash64(F.lit(1), "text")}
    prints = staged(fingerprints(docs, shingle, keys), "fingerprints")
    kept = _rooted(prints, F.struct(*keys), radius).groupBy("component").agg(F.min("least").alias("least")).select("least.*")
    held = docs.select(F.struct("*").alias("row"), *(c.alias(k) for k, c in keys.items()))
    first = Window.partitionBy(*keys).orderBy(F.col("row.doc_id").asc_nulls_last())
    return (held.join(kept, [*keys], "left_semi").withColumn("nth", F.row_number().over(first))
            .filter("nth = 1").select("row.*"))
