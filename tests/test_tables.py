from datetime import date

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from wicklake.catalog import inputs, tables as scratch
from wicklake.schemas import BRONZE, DIM_DATA_SOURCE, GOLD, SILVER, Layout
from wicklake.session import fresh_dir, staged
from wicklake.sources import bronze, tables

A, B, C = date(2024, 1, 1), date(2024, 1, 2), date(2024, 1, 3)
SMALL = Layout(
    (("v", "int"), ("k", "int"), ("d", "date"), ("sym", "string")), partition_by=("d", "sym"),
    key=("d", "sym", "k"))


def rows(spark, *items):
    return spark.createDataFrame([(v, k, d, s) for d, s, k, v in items], SMALL.ddl)


def content(spark, table):
    return {(r.d, r.sym, r.k, r.v) for r in spark.table(table).collect()}


@pytest.fixture
def target(spark):
    return scratch.filled(spark, SMALL, rows(spark, (A, "A", 1, 10), (A, "A", 2, 20), (B, "B", 1, 5)), "small")


def test_upsert_rewrites_touched_partitions_only(spark, target):
    source = rows(spark, (A, "A", 2, 21), (A, "A", 3, 30), (C, "C", 1, 7))
    want = {(A, "A", 1, 10), (A, "A", 2, 21), (A, "A", 3, 30), (B, "B", 1, 5), (C, "C", 1, 7)}
    for _ in range(2):
        tables.upsert(source, SMALL, target)
        assert content(spark, target) == want


def test_upsert_rejects_repeated_keys(spark, target):
    with pytest.raises(ValueError, match="repeats keys"):
        tables.upsert(rows(spark, (A, "A", 2, 1), (A, "A", 2, 2)), SMALL, target)


def test_upsert_of_nothing(spark, target):
    before = content(spark, target)
    tables.upsert(rows(spark), SMALL, target)
    assert content(spark, target) == before


def test_replace_day(spark, target):
    tables.replace_day(rows(spark, (A, "Z", 1, 1)), SMALL, target, A)
    assert content(spark, target) == {(A, "Z", 1, 1), (B, "B", 1, 5)}
    tables.replace_day(rows(spark), SMALL, target, A)
    assert content(spark, target) == {(B, "B", 1, 5)}
    with pytest.raises(ValueError, match="rows outside"):
        tables.replace_day(rows(spark, (B, "Z", 1, 1)), SMALL, target, A)


def test_append_repeats(spark, target):
    tables.append(rows(spark, (A, "A", 1, 10)), SMALL, target)
    assert spark.table(target).count() == 4


def test_insert_absent(spark, target):
    tables.insert_absent(rows(spark, (A, "A", 1, 99), (C, "A", 1, 1), (C, "A", 1, 2)), SMALL, target)
    assert content(spark, target) == {(A, "A", 1, 10), (A, "A", 2, 20), (B, "B", 1, 5), (C, "A", 1, 1)}


def test_upsert_of_an_unpartitioned_table(spark):
    def dim(*items):
        return spark.createDataFrame(items, DIM_DATA_SOURCE.ddl)
    table = scratch.filled(spark, DIM_DATA_SOURCE, dim((1, "a", "x"), (2, "b", "y")), "dim")
    tables.upsert(dim((2, "b", "z"), (3, "c", "w")), DIM_DATA_SOURCE, table)
    assert set(map(tuple, spark.table(table).collect())) == {(1, "a", "x"), (2, "b", "z"), (3, "c", "w")}


def test_upsert_reads_only_the_touched_range(spark, target):
    pruned = tables.touched(spark.table(target), rows(spark, (A, "A", 9, 9)), SMALL.partition_by)
    assert {(r.d, r.sym) for r in pruned.collect()} == {(A, "A")}
    text = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(d" in text and "dynamicpruning" in text


def test_upsert_reads_its_staged_copy_by_column_and_writes_rebalanced(spark, target):
    copy = staged(rows(spark, (A, "A", 9, 9), (C, "Q", 1, 1)))
    scan = copy.select("d")._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet [d" in scan and "ExistingRDD" not in scan
    written = tables.gathered(copy, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert "RebalancePartitions" in written and "REPARTITION_BY_NUM" not in written


def test_swap_leaves_the_old_folder(spark):
    def dim(*items):
        return spark.createDataFrame(items, DIM_DATA_SOURCE.ddl)
    table = scratch.filled(spark, DIM_DATA_SOURCE, dim((1, "a", "x")), "dim")
    old = spark.table(table)
    for label in ("y", "z"):
        tables.swap(spark.table(table).withColumn("description", F.lit(label)), DIM_DATA_SOURCE, table)
        assert [tuple(r) for r in spark.table(table).collect()] == [(1, "a", label)]
    assert old.inputFiles() != spark.table(table).inputFiles()
    tables.append(dim((2, "b", "w")), DIM_DATA_SOURCE, table)
    assert spark.table(table).count() == 2


def test_ensure_is_repeatable(spark):
    gold = scratch.namespace(spark, "gold")
    tables.ensure_gold(spark, gold)
    tables.ensure_gold(spark, gold)
    for name, layout in GOLD.items():
        assert set(spark.table(f"{gold}.{name}").columns) == set(layout.names)
        assert spark.table(f"{gold}.{name}").count() == 0


def test_merge_into_needs_a_row_level_catalog(spark, target):
    with pytest.raises(PySparkException, match="MERGE"):
        tables.merge_into(rows(spark, (A, "A", 2, 21)), SMALL, target)


ODD = "a b=c/d%e'f\\"


def changes(spark):
    return rows(spark, (A, "A", 2, 21), (B, "B", 1, 6), (C, ODD, 1, 7), (C, None, 1, 8))


OLD = {(A, "A", 1, 10), (A, "A", 2, 20), (B, "B", 1, 5)}
NEW = {(A, "A", 1, 10), (A, "A", 2, 21), (B, "B", 1, 6), (C, ODD, 1, 7), (C, None, 1, 8)}


def broken(*_, **__):
    raise RuntimeError("interrupted")


@pytest.mark.parametrize("step", ["_write_text", "_laid_out"])
def test_a_break_before_the_note_leaves_the_table_as_it_was(spark, target, monkeypatch, step):
    with monkeypatch.context() as patch, pytest.raises(RuntimeError):
        patch.setattr(tables, step, broken)
        tables.upsert(changes(spark), SMALL, target)
    assert content(spark, target) == OLD
    tables.upsert(changes(spark), SMALL, target)
    assert content(spark, target) == NEW


def test_a_break_in_the_commit_is_finished_by_the_next_reader(spark, target, monkeypatch):
    real, said = spark.sql, []

    def sql(text, *a, **b):
        said.append(text)
        if len([t for t in said if "SET LOCATION" in t]) == 2:
            raise RuntimeError("interrupted")
        return real(text, *a, **b)

    with monkeypatch.context() as patch, pytest.raises(RuntimeError):
        patch.setattr(spark, "sql", sql)
        tables.upsert(changes(spark), SMALL, target)
    spark.catalog.refreshTable(target)
    # One partition is new and one is old, and none is missing.
    assert {(r.d, r.sym, r.k) for r in spark.table(target).collect()} == {(d, s, k) for d, s, k, _ in OLD}
    assert {(r.d, r.sym, r.k, r.v) for r in tables.read_table(spark, SMALL, target).collect()} == NEW
    tables.finish_moves(spark, target)
    assert content(spark, target) == NEW


def test_replaced_folders_stay_until_they_are_removed(spark, target):
    early = spark.table(target)
    held = early.inputFiles()
    for v in (1, 2, 3):
        tables.upsert(rows(spark, (A, "A", 2, v), (C, ODD, 1, v)), SMALL, target)
        assert set(map(tuple, spark.read.parquet(*held).select("v", "k").collect())) == {(10, 1), (20, 2), (5, 1)}
    want = {(A, "A", 1, 10), (A, "A", 2, 3), (B, "B", 1, 5), (C, ODD, 1, 3)}
    assert tables.remove_unused(spark, target) == 1 + 2 + 2
    assert content(spark, target) == want and tables.remove_unused(spark, target) == 0


def test_other_writes_after_a_move(spark, target):
    tables.upsert(changes(spark), SMALL, target)
    tables.append(rows(spark, (A, "A", 4, 4), (date(2024, 1, 9), "N", 1, 1)), SMALL, target)
    assert content(spark, target) == NEW | {(A, "A", 4, 4), (date(2024, 1, 9), "N", 1, 1)}
    tables.replace_day(rows(spark, (A, "Z", 1, 1)), SMALL, target, A)
    assert content(spark, target) == {r for r in NEW if r[0] != A} | {(A, "Z", 1, 1), (date(2024, 1, 9), "N", 1, 1)}
    tables.upsert(rows(spark, (A, "A", 1, 2)), SMALL, target)
    assert (A, "A", 1, 2) in content(spark, target) and (A, "A", 2, 21) not in content(spark, target)


# --- bronze --------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def candles(spark, small):
    return inputs.candles(spark, small)


def stored(spark, root):
    return bronze.read_bronze(spark, root, "1h", "2024-01-01", "2024-02-01")


def test_bronze_round_trip(spark, candles):
    root = fresh_dir(spark, "bronze")
    first = inputs.bronze(candles)
    bronze.write_bronze(first, root)
    back = stored(spark, root)
    assert back.columns == BRONZE.names
    assert back.exceptAll(first).isEmpty() and first.exceptAll(back).isEmpty()
    assert bronze.existing_partitions(spark, root).count() == 150
    assert bronze.existing_partitions(spark, root, "1h", "2024-01-10", "2024-01-12").count() == 10
    assert bronze.existing_partitions(spark, root, "5m", "2024-01-10", "2024-01-12").count() == 0


def test_bronze_skips_what_exists_unless_told(spark, candles):
    root = fresh_dir(spark, "bronze")
    rows_ = inputs.bronze(candles)
    early = rows_.where(F.col("open_time") < inputs.TARGET_END_MS)
    bronze.write_bronze(early, root)
    changed = rows_.withColumn("close_price", F.lit(-1.0))
    bronze.write_bronze(changed, root)
    assert stored(spark, root).where("close_price = -1").count() == rows_.count() - early.count()
    bronze.write_bronze(changed, root, overwrite=True)
    assert stored(spark, root).where("close_price <> -1").count() == 0
    assert stored(spark, root).count() == rows_.count()


def test_bronze_overwrite_leaves_other_partitions(spark, candles):
    root = fresh_dir(spark, "bronze")
    rows_ = inputs.bronze(candles)
    bronze.write_bronze(rows_, root)
    one = rows_.where("symbol = 'CLICKUSDT'").where(F.col("open_time") >= inputs.TARGET_END_MS)
    bronze.write_bronze(one.withColumn("close_price", F.lit(-1.0)), root, overwrite=True)
    assert stored(spark, root).where("close_price = -1").count() == one.count()
    assert stored(spark, root).count() == rows_.count()


def test_bronze_lists_only_the_day(spark, candles):
    root = fresh_dir(spark, "bronze")
    bronze.write_bronze(inputs.bronze(candles), root)
    day = bronze.read_bronze(spark, root, "1h", "2024-01-15")
    assert day.count() == 113
    assert len(day.inputFiles()) == 5
    assert bronze.read_bronze(spark, root, "1h", "2023-01-01").count() == 0
    assert bronze.read_bronze(spark, root, "5m", "2024-01-15").count() == 0
    assert bronze.read_bronze(spark, fresh_dir(spark, "none"), "1h", "2024-01-15").columns == BRONZE.names


def test_silver_layout_prunes(spark, candles):
    table = scratch.filled(spark, SILVER, candles, "kline")
    day = tables.read_table(spark, SILVER, table).where("trade_date = date'2024-01-15'").select("close_price")
    assert len(day.inputFiles()) == 5
    text = day._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<close_price:double>" in text
