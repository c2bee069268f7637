"""Operator 9: embedding near-dedup by counting collisions of one-dimensional projections."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wicklake.llm.common import staged
from wicklake.llm.components import connected_components

SIMILARITY = 0.95
PROJECTIONS = 32
# Half the width of a window, in typical differences of two vectors at the threshold.
WINDOW = 0.6
# Share of the pairs at the threshold that must pass the count.
RECALL = 0.99
# Cells: about so many vectors each, around pivots taken from the table, at most so many.
CELL_ROWS = 512
MOST_PIVOTS = 16384
# A vector also goes to pivots that are nearly as close as the closest one.
MARGIN = 0.06
# A cell with more rows is compared block by block.
BLOCK_ROWS = 2048


def _directions(dims: int, projections: int, seed: int = 9) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((dims, projections))


def collision_count(similarity: float, projections: int, window: float, recall: float) -> int:
    """Collisions that a pair at the threshold reaches with probability `recall`.

    The projections of two unit vectors differ by a normal variable whose deviation is the distance of the vectors, so at
    the threshold a projection collides with probability P(|N(0,1)| <= window), and the count is binomial.
    """
    p = math.erf(window / math.sqrt(2))
    below = 0.0
    for count in range(projections + 1):
        below += math.comb(projections, count) * p**count * (1 - p)**(projections - count)
        if below > 1 - recall:
            return count
    return projections


def colliding_pairs(vectors: np.ndarray, queries: int, similarity: float = SIMILARITY, projections: int = PROJECTIONS,
                    window: float = WINDOW, recall: float = RECALL) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j), i < j and i < queries, of unit vectors whose cosine is `similarity` or more, as far as counted.

    Each projection is sorted. The window of a query is what lies within a fixed distance of its own projection, a slice
    of the order; the slices of all projections are counted per vector, and vectors with enough collisions are verified.
    """
    n, dims = vectors.shape
    need = collision_count(similarity, projections, window, recall)
    half = window * math.sqrt(2 - 2 * similarity)
    places = vectors @ _directions(dims, projections)
    order = np.argsort(places, axis=0, kind="stable")
    low, high = np.empty((queries, projections), np.int64), np.empty((queries, projections), np.int64)
    columns = []
    for k in range(projections):
        line = places[order[:, k], k]
        low[:, k] = np.searchsorted(line, places[:queries, k] - half, side="left")
        high[:, k] = np.searchsorted(line, places[:queries, k] + half, side="right")
        columns.append(order[:, k].astype(np.int32))
    left, right = [], []
    for i in range(queries):
        counts = np.bincount(np.concatenate([columns[k][low[i, k]:high[i, k]] for k in range(projections)]), minlength=n)
        near = np.flatnonzero(counts[i + 1:] >= need) + i + 1
        if len(near):
            near = near[vectors[near] @ vectors[i] >= similarity]
            left.append(np.full(len(near), i))
            right.append(near)
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *left]), np.concatenate([none, *right])


def _cells(vectors: np.ndarray, pivots: np.ndarray, margin: float) -> list[np.ndarray]:
    """For each vector the pivots whose cosine is within `margin` of the closest one's."""
    close = vectors @ pivots.T
    return [np.flatnonzero(row >= row.max() - margin) for row in close]


def groups(embeddings: DataFrame, similarity: float = SIMILARITY, projections: int = PROJECTIONS, window: float = WINDOW, recall: float = RECALL,
           margin: float = MARGIN, cell_rows: int = CELL_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of `embeddings` (vec_id, embedding, ...).

    Vectors link at cosine `similarity` or more in double precision, as found; none below it. `n_links` counts the other
    rows linked directly, `component_id` is the smallest vec_id reachable, `kept` says whether that is the row's own.

    Equal vectors are one class from the start; a class of any size is one row in the search. Classes are dealt to cells
    around pivots, a sample of at most MOST_PIVOTS of them taken by hash: each to its closest pivot and to those nearly as
    close. A cell with more than `block_rows` classes is cut to blocks by hash, and every two of its blocks are compared
    by one task, so no cell is capped. Inside, collisions of projections are counted (`colliding_pairs`). A pair that shares
    several cells counts in the first one only. Counts of links are summed, and each task gives a spanning forest of its
    links, not the links, to the search for components.

    Null vectors, zero vectors, and vectors with null or non-finite components link with nothing: n_links 0, their own
    component, kept. Vectors of different length link with nothing of another length. Rows without an id take part; as
    ids they count as larger than any. Rows that share an id are rows of one class at least and answered each. Other
    columns are not read. No rows give no rows.
    """
    spark = embeddings.sparkSession
    values = F.transform(F.col("embedding"), lambda x: x.cast("double"))
    sound = (F.col("v").isNotNull() & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
             & F.exists("v", lambda x: x != 0))
    rows = (embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), values.alias("v"))
            .withColumn("v", F.when(F.coalesce(sound, F.lit(False)), F.transform("v", lambda x: x + F.lit(0.0)))))
    keyed = staged(rows.withColumn("key", F.when(F.col("v").isNotNull(), F.md5(F.to_json(F.struct("v"))))), "vectors")
    last = F.lit(2**63 - 1)
    classes = staged(keyed.filter("v IS NOT NULL").groupBy("key").agg(
        F.first("v").alias("v"), F.count("*").alias("rows"), F.min(F.coalesce("vec_id", last)).alias("least"))
        .withColumn("node", F.xxhash64("key")), "classes")
    n = classes.count()
    counted, edges = _search(classes, n, similarity, projections, window, recall, margin, cell_rows, block_rows)
    parts = connected_components(edges).select("node", F.col("component"))
    rooted = (classes.select("key", "node", "rows", "least").join(counted, "node", "left").join(parts, "node", "left")
              .withColumn("component", F.coalesce("component", "node")))
    least = rooted.groupBy("component").agg(F.min("least").alias("component_id"))
    answers = rooted.join(least, "component").select(
        "key", (F.col("rows") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id")
    own = F.coalesce("vec_id", last)
    return (keyed.select("vec_id", "key").join(answers, "key", "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.nullif(F.coalesce("component_id", own), last).alias("component_id"),
                    (F.coalesce("component_id", own) == own).alias("kept")))


def _search(classes: DataFrame, n: int, similarity: float, projections: int, window: float, recall: float, margin: float,
            cell_rows: int, block_rows: int) -> tuple[DataFrame, DataFrame]:
    """Links per class, weighted by the rows of the other classes, and edges that connect what links connect."""
    spark = classes.sparkSession
    if n == 0:
        return spark.createDataFrame([], "node long, links long"), spark.createDataFrame([], "a long, b long")
    wanted = min(MOST_PIVOTS, -(-n // cell_rows))
    taken = classes.filter(F.pmod(F.xxhash64(F.col("node"), F.lit(1)), F.lit(1 << 30)) < F.lit(int(min(1.0, 2.0 * wanted / n) * (1 << 30)) + 1))
    pivots: dict[int, list[np.ndarray]] = {}
    for row in taken.select("v", "node").orderBy(F.xxhash64("node", F.lit(2))).limit(wanted).collect():
        v = np.array(row["v"])
        pivots.setdefault(len(v), []).append(_unit(v[None])[0])
    known = {dims: np.array(p) for dims, p in pivots.items()}

    def place(batches):
        for batch in batches:
            out = {"node": [], "rows": [], "v": [], "cells": []}
            nodes, weights, raw = batch["node"].to_numpy(), batch["rows"].to_numpy(), batch["v"].to_pylist()
            for dims in {len(v) for v in raw}:
                at = [i for i, v in enumerate(raw) if len(v) == dims]
                unit = _unit(np.array([raw[i] for i in at]))
                cells = _cells(unit, known[dims], margin) if dims in known else [np.zeros(1, np.int64)] * len(at)
                out["node"] += [int(nodes[i]) for i in at]
                out["rows"] += [int(weights[i]) for i in at]
                out["v"] += [u.tobytes() for u in unit]
                out["cells"] += [[dims * (MOST_PIVOTS + 1) + int(c) for c in cell] for cell in cells]
            yield pa.RecordBatch.from_pydict(out, pa.schema([("node", pa.int64()), ("rows", pa.int64()), ("v", pa.binary()), ("cells", pa.list_(pa.int64()))]))

    placed = staged(classes.select("node", "rows", "v").mapInArrow(place, "node long, rows long, v binary, cells array<long>"), "placed")
    sizes = placed.select(F.explode("cells").alias("cell")).groupBy("cell").agg(F.count("*").alias("n"))
    blocks = sizes.select("cell", F.ceil(F.col("n") / block_rows).alias("blocks"))
    dealt = (placed.select("node", "rows", "v", "cells", F.explode("cells").alias("cell")).join(blocks, "cell")
             .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
             .withColumn("other", F.explode(F.expr("sequence(0L, blocks - 1)")))
             .withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other")))

    def compare(key: tuple, group: pa.Table) -> pa.Table:
        _, low, high = (k.as_py() for k in key)
        return _compare(group, key[0].as_py(), low, high, similarity, projections, window, recall)

    found = staged(dealt.select("cell", "low", "high", "block", "node", "rows", "v", "cells").groupBy("cell", "low", "high")
                   .applyInArrow(compare, "node long, links long, hub long"), "found")
    return (found.groupBy("node").agg(F.sum("links").alias("links")),
            found.filter("hub <> node").select(F.col("node").alias("a"), F.col("hub").alias("b")))


def _unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _compare(group: pa.Table, cell: int, low: int, high: int, similarity: float, projections: int, window: float, recall: float) -> pa.Table:
    """What one pair of blocks of a cell adds: links of each class, and the smallest class it is connected to here."""
    block = group["block"].to_numpy()
    order = np.argsort(block != low, kind="stable")
    node, weight = group["node"].to_numpy()[order], group["rows"].to_numpy()[order]
    raw, cells = group["v"].to_pylist(), group["cells"].to_pylist()
    vectors = np.array([np.frombuffer(raw[i], np.float64) for i in order])
    mine = [cells[i] for i in order]
    queries = int((block == low).sum())
    if low != high and (queries == 0 or queries == len(node)):
        return _RESULT.empty_table()
    left, right = colliding_pairs(vectors, queries, similarity, projections, window, recall)
    if low != high:
        across = right >= queries
        left, right = left[across], right[across]
    if len(left):
        # A pair belongs to the first cell it shares.
        several = {i for i, c in enumerate(mine) if len(c) > 1}
        first = np.array([i not in several or j not in several or min(set(mine[i]) & set(mine[j])) == cell for i, j in zip(left.tolist(), right.tolist())])
        left, right = left[first], right[first]
    if not len(left):
        return _RESULT.empty_table()
    links = np.zeros(len(node), np.int64)
    np.add.at(links, left, weight[right])
    np.add.at(links, right, weight[left])
    # Smallest class reached inside this task.
    hub = node.copy()
    while True:
        least = np.minimum(hub[left], hub[right])
        before = hub.copy()
        np.minimum.at(hub, left, least)
        np.minimum.at(hub, right, least)
        if (hub == before).all():
            break
    some = links > 0
    return pa.table({"node": node[some], "links": links[some], "hub": hub[some]}, schema=_RESULT)


_RESULT = pa.schema([("node", pa.int64()), ("links", pa.int64()), ("hub", pa.int64())])
