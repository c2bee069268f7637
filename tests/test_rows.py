import random

import pytest
from pyspark.sql import functions as F

from wicklake.operators.checks import duplicate_keys, missing_references, not_null_counts, require_empty
from wicklake.operators.ids import assign_ids
from wicklake.operators.merge import absent_rows, merge_rows
from wicklake.operators.rows import dedup_latest, latest_by


def test_dedup_ignores_input_order(spark):
    rng = random.Random(1)
    rows = [(f"k{rng.randrange(20)}", rng.choice([None, 1, 2, 3]), rng.randrange(5), rng.random()) for _ in range(500)]
    results = []
    for parts in (1, 7):
        rng.shuffle(rows)
        df = spark.createDataFrame(rows, "k string, ingest_ts int, a int, b double").repartition(parts)
        results.append(sorted(map(tuple, dedup_latest(df, ["k"]).collect())))
    assert results[0] == results[1] and len(results[0]) == 20
    best = {}
    for k, ts, a, b in rows:
        rank = (-(ts if ts is not None else -1), a, b)
        best[k] = min(best.get(k, rank), rank)
    assert [(r[2], r[3]) for r in results[0]] == [best[k][1:] for k in sorted(best)]


def test_copies_are_dropped_before_the_shuffle(spark):
    df = spark.range(0, 100_000, 1, 8).select(F.lit("hot").alias("k"), F.col("id").alias("ingest_ts"))
    plan = dedup_latest(df.withColumn("k", F.when(F.col("ingest_ts") >= 0, F.col("k"))), ["k"])
    assert plan.collect()[0].ingest_ts == 99_999
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 1, Partial" in text


def test_latest_by_is_a_hash_aggregate(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), F.col("id").alias("t"), (F.col("id") * 2.0).alias("v"))
    out = latest_by(df, ["k"], "t")
    assert {r.k: (r.t, r.v) for r in out.collect()} == {k: (t, t * 2.0) for k in range(7) for t in [max(range(k, 1000, 7))]}
    text = out._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in text and "Sort [" not in text


def keyed(spark, rows):
    return spark.createDataFrame(rows, "k int, close int, trades int, is_final boolean")


def test_guarded_merge(spark):
    target = keyed(spark, [(1, 10, 7, True), (2, 20, 5, False)])
    hot = keyed(spark, [(1, 99, None, False), (2, 21, None, False), (3, 30, None, False)])
    after = merge_rows(target, hot, ["k"], update=["close"], keep_if="is_final")
    want = {(1, 10, 7, True), (2, 21, 5, False), (3, 30, None, False)}
    assert set(map(tuple, after.collect())) == want
    final = merge_rows(after, keyed(spark, [(2, 22, 9, True)]), ["k"])
    assert (2, 22, 9, True) in set(map(tuple, final.collect()))


def test_merge_twice_changes_nothing(spark):
    target = keyed(spark, [(i, i, i, False) for i in range(20)])
    source = keyed(spark, [(i, -i, None, True) for i in range(10, 30)])
    once = merge_rows(target, source, ["k"])
    assert set(map(tuple, merge_rows(once, source, ["k"]).collect())) == set(map(tuple, once.collect()))
    empty = keyed(spark, [])
    assert merge_rows(target, empty, ["k"]).count() == 20 and merge_rows(empty, source, ["k"]).count() == 20


def test_absent_rows(spark):
    schema = "s int, p int, t int, c double"
    target = spark.createDataFrame([(1, 1, 100, 5.0)], schema)
    source = spark.createDataFrame([(1, 1, 100, 5.0), (1, 1, 100, 5.5), (1, 1, 100, 5.5)], schema)
    assert list(map(tuple, absent_rows(source, target, ["s", "p", "t", "c"]).collect())) == [(1, 1, 100, 5.5)]


def test_ids_follow_the_order_and_continue(spark):
    rng = random.Random(2)
    rows = [(f"s{rng.randrange(4)}", rng.randrange(6), i) for i in range(300)]
    df = spark.createDataFrame(rows, "a string, b int, c int").repartition(5)
    out = assign_ids(df, "id", 100, ["a", "b"], ["c"]).collect()
    assert [r.id for r in sorted(out, key=lambda r: (r.a, r.b, r.c))] == list(range(101, 401))


def test_checks(spark):
    df = spark.createDataFrame([(1, None), (1, "x"), (2, "y"), (None, "z")], "k int, v string")
    assert {r.column_name: r.null_count for r in not_null_counts(df, ["k", "v"]).collect()} == {"k": 1, "v": 1}
    assert [tuple(r) for r in duplicate_keys(df, ["k"]).collect()] == [(1, 2)]
    dim = spark.createDataFrame([(2,)], "k int")
    assert [tuple(r) for r in missing_references(df, "k", dim).collect()] == [(1, 2)]
    with pytest.raises(ValueError, match="no good"):
        require_empty(df, "no good")
