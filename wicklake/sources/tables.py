"""Silver, gold and hot tables in the session catalog: creation and every kind of write.

A table without row-level commands (parquet) is changed by rewriting the partitions the source
touches. On a catalog that has them, `merge_into` runs one MERGE instead.
"""

from __future__ import annotations

import json
import re
import time
import uuid
from collections.abc import Sequence
from contextlib import contextmanager
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from wicklake.functions.time import parse_day
from wicklake.operators.checks import require_empty
from wicklake.operators.merge import absent_rows, merge_rows
from wicklake.schemas import GOLD, HOT, SILVER, Layout
from wicklake.session import runtime_conf, staged

BROADCAST_PARTITIONS = 100_000
# Providers whose tables take MERGE and are replaced in one step.
ROW_LEVEL = ("iceberg", "delta", "hudi")
SMALL_TASK = "1k"
# Rows of a page, the least that a reader skips, in tables that single values are looked up in.
PAGE_ROWS = 2_000
# Beside the folder of a table: new partitions, and notes of those that the catalog shall point to.
PARTS, MOVES, UNFINISHED = "-parts", "-moves", ".unfinished"
ADDED_AT_ONCE = 200
# What Spark escapes in a partition path, besides control characters.
_ESCAPED = set("\"#%'*/:=?\\{[]^")
_LEAST_TASK = "spark.sql.adaptive.coalescePartitions.minPartitionSize"
_MODE = "spark.sql.sources.partitionOverwriteMode"


def create_namespace(spark: SparkSession, name: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {name}{where}")


def file_options(layout: Layout, provider: str = "parquet") -> dict[str, str]:
    """How files are written so that readers of single values skip most of them."""
    if provider != "parquet" or not layout.find_by:
        return {}
    return {"parquet.page.row.count.limit": str(PAGE_ROWS), **{f"parquet.bloom.filter.enabled#{c}": "true" for c in layout.find_by}}


def create_table(spark: SparkSession, layout: Layout, table: str, provider: str = "parquet") -> None:
    parts = f" PARTITIONED BY ({', '.join(layout.partition_by)})" if layout.partition_by else ""
    options = ", ".join(f"'{k}' = '{v}'" for k, v in file_options(layout, provider).items())
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({layout.ddl}) USING {provider}" + (f" OPTIONS ({options})" if options else "") + parts)


def ensure_silver(spark: SparkSession, table: str, provider: str = "parquet") -> None:
    create_table(spark, SILVER, table, provider)


def ensure_gold(spark: SparkSession, namespace: str, provider: str = "parquet") -> None:
    for name, layout in GOLD.items():
        create_table(spark, layout, f"{namespace}.{name}", provider)


def ensure_hot(spark: SparkSession, namespace: str, provider: str = "parquet") -> None:
    for name, layout in HOT.items():
        create_table(spark, layout, f"{namespace}.{name}", provider)


def read_table(spark: SparkSession, layout: Layout, table: str) -> DataFrame:
    """The table as it is now: a stream writes from a session of its own, which this one cannot notice."""
    if layout.partition_by:
        finish_moves(spark, table)
    spark.catalog.refreshTable(table)
    return spark.table(table).select(*layout.names)


def gathered(df: DataFrame, layout: Layout) -> DataFrame:
    """Rows of one partition together, so that a partition gets few files.

    The rebalance hint lets adaptive execution split a partition too large for one task and join small ones.
    """
    return df.hint("rebalance", *[F.col(c) for c in layout.partition_by])


@contextmanager
def writer_tasks(spark: SparkSession, layout: Layout):
    """Where partitions are small a write is mostly opening files, so tasks are joined up to little data only."""
    if not layout.small_partitions:
        yield
        return
    with runtime_conf(spark, _LEAST_TASK, SMALL_TASK):
        yield


def _laid_out(df: DataFrame, layout: Layout) -> DataFrame:
    """Gathered rows, sorted so that readers can skip row groups."""
    if not layout.partition_by:
        return df
    sort = [F.col(c[1:]).desc() if c.startswith("-") else F.col(c) for c in layout.sort_by]
    return gathered(df, layout).sortWithinPartitions(*layout.partition_by, *sort)


def append(df: DataFrame, layout: Layout, table: str) -> None:
    spark = df.sparkSession
    if layout.partition_by:
        finish_moves(spark, table)
    columns = spark.table(table).columns
    with writer_tasks(spark, layout):
        _laid_out(df, layout).select(*columns).write.insertInto(table)
    spark.catalog.refreshTable(table)


def swap(df: DataFrame, layout: Layout, table: str) -> None:
    """Replace a whole table without partitions; `df` may read it.

    The rows go to a new folder and the table then points there, so it is whole at every moment. The old folder stays for
    those who still read it.
    """
    spark = df.sparkSession
    provider, location = place(spark, table)
    if provider in ROW_LEVEL:
        staged(df.select(*layout.names)).writeTo(table).overwrite(F.lit(True))
        return
    folder = f"{re.sub('-[0-9a-f]{32}$', '', location)}-{uuid.uuid4().hex}"
    df.select(*layout.names).write.format(provider).save(folder)
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{folder}'")
    spark.catalog.refreshTable(table)


def place(spark: SparkSession, table: str) -> tuple[str, str]:
    """Provider and folder of a table."""
    facts = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    return facts["Provider"].lower(), facts["Location"].rstrip("/")


def replace_partitions(df: DataFrame, layout: Layout, table: str, places: DataFrame | None = None) -> None:
    """Replace the partitions that occur in `df`; other partitions stay.

    The rows go to a new folder while the table stays as it is. A note then names the folder and its partitions, and the
    catalog is pointed to them one after the other, so each partition is old or new at every moment and never missing. If that
    breaks off, the next read or write of the table finishes it from the note: a change of several partitions is made whole or, if it
    broke off before its note, not at all. Old folders stay for those who still read them, until `remove_unused`. `places` holds the
    partitions if they are known.
    """
    spark = df.sparkSession
    provider, location = place(spark, table)
    parts = list(layout.partition_by)
    folder = f"{location}{PARTS}/{uuid.uuid4().hex}"
    with writer_tasks(spark, layout):
        _laid_out(df, layout).select(*layout.names).write.partitionBy(*parts).options(**file_options(layout, provider)).format(provider).save(folder)
    if places is None:
        places = spark.read.schema(layout.ddl).format(provider).load(folder)
    found = [r.asDict() for r in places.select(*[F.col(p).cast("string") for p in parts]).distinct().collect()]
    if found:
        _write_text(spark, f"{location}{MOVES}/{time.time_ns():020d}-{uuid.uuid4().hex}", json.dumps({"folder": folder, "parts": found}))
        finish_moves(spark, table)


def finish_moves(spark: SparkSession, table: str) -> None:
    """Point the catalog to the partitions that notes name, oldest note first. Doing so again changes nothing."""
    provider, location = place(spark, table)
    if provider in ROW_LEVEL:
        return
    for note in (n for n in _files(spark, f"{location}{MOVES}") if not n.endswith(UNFINISHED)):
        move = json.loads("\n".join(r[0] for r in spark.read.text(note).collect()))
        known = {r[0] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}
        new = []
        for part in move["parts"]:
            path = "/".join(f"{k}={_in_path(v)}" for k, v in part.items())
            spec = ", ".join(f"`{k}` = {_literal(v)}" for k, v in part.items())
            if path in known:
                spark.sql(f"ALTER TABLE {table} PARTITION ({spec}) SET LOCATION '{move['folder']}/{path}'")
            else:
                new.append(f"PARTITION ({spec}) LOCATION '{move['folder']}/{path}'")
        for first in range(0, len(new), ADDED_AT_ONCE):
            spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {' '.join(new[first:first + ADDED_AT_ONCE])}")
        _delete(spark, note)
    spark.catalog.refreshTable(table)


def remove_unused(spark: SparkSession, table: str) -> int:
    """Delete the folders of replaced partitions that the catalog points to no longer; gives how many. Not while somebody reads them."""
    finish_moves(spark, table)
    _, location = place(spark, table)
    live = set()
    for r in spark.sql(f"SHOW PARTITIONS {table}").collect():
        spec = ", ".join(f"`{k}` = {_literal(_from_path(v))}" for k, v in (x.split("=", 1) for x in r[0].split("/")))
        facts = spark.sql(f"DESCRIBE TABLE EXTENDED {table} PARTITION ({spec})").where("col_name = 'Location'").first()
        live.add(_plain(facts["data_type"]))
    depth = len(spark.sql(f"SHOW PARTITIONS {table}").first()[0].split("/")) if live else 0
    unused = [folder for root in (location, *_files(spark, f"{location}{PARTS}")) for folder in _below(spark, root, depth) if _plain(folder) not in live]
    for folder in unused:
        _delete(spark, folder)
    return len(unused)


def _plain(path: str) -> str:
    """A path without its scheme, whose form depends on who wrote it."""
    return re.sub("^[a-z0-9]+:/*", "/", path.rstrip("/"))


def _below(spark: SparkSession, folder: str, depth: int) -> list[str]:
    found = [folder]
    for _ in range(depth):
        found = [f for parent in found for f in _files(spark, parent) if "=" in f.rsplit("/", 1)[-1]]
    return found if depth else []


def _literal(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _in_path(value: str | None) -> str:
    """A partition value as Spark writes it in a path."""
    if value is None or value == "":
        return "__HIVE_DEFAULT_PARTITION__"
    return "".join(f"%{ord(c):02X}" if c in _ESCAPED or ord(c) < 32 or ord(c) == 127 else c for c in value)


def _from_path(value: str) -> str | None:
    return None if value == "__HIVE_DEFAULT_PARTITION__" else re.sub("%([0-9A-F]{2})", lambda m: chr(int(m[1], 16)), value)


def _hadoop(spark: SparkSession, path: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def _files(spark: SparkSession, folder: str) -> list[str]:
    fs, path = _hadoop(spark, folder)
    return sorted(str(f.getPath()) for f in fs.listStatus(path)) if fs.exists(path) else []


def _delete(spark: SparkSession, path: str) -> None:
    fs, path = _hadoop(spark, path)
    fs.delete(path, True)


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that is there whole or not at all."""
    fs, target = _hadoop(spark, path)
    hidden = target.suffix(UNFINISHED)
    out = fs.create(hidden, True)
    out.write(bytearray(text.encode()))
    out.close()
    fs.rename(hidden, target)


def replace_day(df: DataFrame, layout: Layout, table: str, day: date | str) -> None:
    """Replace every partition of one day in a single statement; an empty `df` empties the day.

    The statement clears the day before it writes, so the new rows are on reliable storage by then.
    """
    spark = df.sparkSession
    day = parse_day(day)
    first, *rest = layout.partition_by
    finish_moves(spark, table)
    df = checked(df, layout, table)
    require_empty(df.where(~F.col(first).eqNullSafe(F.lit(day))).select(first), f"rows outside {day}")
    columns = [c for c in spark.table(table).columns if c != first]
    spec = ", ".join([f"{first} = DATE '{day}'", *rest])
    with runtime_conf(spark, _MODE, "static"), writer_tasks(spark, layout):
        spark.sql(
            f"INSERT OVERWRITE TABLE {table} PARTITION ({spec}) SELECT {', '.join(columns)} FROM {{rows}}",
            rows=_laid_out(df, layout))
    spark.catalog.refreshTable(table)


def checked(df: DataFrame, layout: Layout, table: str) -> DataFrame:
    """`df` staged, unless a column that must not be NULL holds one: that stops the write before the table is changed.

    The counts are taken by the pass that stages, so the rule costs no second scan.
    """
    if not layout.not_null:
        return staged(df.select(*layout.names))
    watch = Observation()
    out = staged(df.select(*layout.names).observe(watch, *[F.count_if(F.col(c).isNull()).alias(c) for c in layout.not_null]))
    found = {column: n for column, n in watch.get.items() if n}
    if found:
        raise ValueError(f"NULL in the source of {table}: {found}")
    return out


def touched(target: DataFrame, source: DataFrame, parts: Sequence[str]) -> DataFrame:
    """Target rows in the partitions that `source` has rows for.

    The range of the leading partition column is a literal, so it prunes before anything is listed. The
    partitions themselves are counted and broadcast if they are few, which prunes the scan to them.
    """
    return _inside(target, staged(source.select(*parts).distinct()), parts)


def _inside(target: DataFrame, places: DataFrame, parts: Sequence[str]) -> DataFrame:
    lead = parts[0]
    count, low, high = places.agg(F.count(F.lit(1)), F.min(lead), F.max(lead)).first()
    if not count:
        return target.where(F.lit(False))
    inside = target.where(F.col(lead).between(F.lit(low), F.lit(high)))
    if count <= BROADCAST_PARTITIONS:
        places = F.broadcast(places)
    return inside.join(places, list(parts), "left_semi")


def upsert(
    source: DataFrame, layout: Layout, table: str,
    update: Sequence[str] | None = None, keep_if: str | None = None, unique: bool = False,
) -> None:
    """Upsert by key. Partition columns must follow from the key, so a key never changes partition.

    The source is staged once, which counts its NULLs where there must be none. One aggregate over its keys gives the partitions it
    touches and whether a key repeats; a caller that has made keys `unique` spares the count. Nothing is changed before. Tables with row-level commands get one MERGE.
    """
    spark = source.sparkSession
    source = checked(source, layout, table)
    target = read_table(spark, layout, table)
    parts = list(layout.partition_by)
    keys = source.select(*dict.fromkeys([*parts, *layout.key]))
    if not unique:
        keys = keys.groupBy(*layout.key).agg(
            F.count(F.lit(1)).alias("_n"), *[F.min(p).alias(p) for p in parts if p not in layout.key])
        worst = F.max("_n")
    else:
        worst = F.lit(1)
    places = staged(keys.groupBy(*parts).agg(worst.cast("bigint").alias("_n")))
    require_empty(places.where("_n > 1").select(*parts, "_n"), f"source of {table} repeats keys")
    if row_level(spark, table):
        merge_into(source, layout, table, update, keep_if)
    elif parts:
        merged = merge_rows(_inside(target, places, parts), source, layout.key, update, keep_if)
        replace_partitions(merged, layout, table, places)
    else:
        swap(merge_rows(target, source, layout.key, update, keep_if), layout, table)


def insert_absent(source: DataFrame, layout: Layout, table: str) -> None:
    """Append the rows whose key is new."""
    spark = source.sparkSession
    target = read_table(spark, layout, table)
    if layout.partition_by:
        source = staged(source)
        target = touched(target, source, layout.partition_by)
    append(checked(absent_rows(source.select(*layout.names), target, layout.key), layout, table), layout, table)


def row_level(spark: SparkSession, table: str) -> bool:
    return place(spark, table)[0] in ROW_LEVEL


def merge_into(
    source: DataFrame, layout: Layout, table: str, update: Sequence[str] | None = None, keep_if: str | None = None,
) -> None:
    """Upsert with one MERGE, for a table with row-level commands."""
    on = [F.col(f"{table}.{c}") == F.col(f"source.{c}") for c in layout.key]
    condition = on[0]
    for term in on[1:]:
        condition = condition & term
    changed = [c for c in layout.names if c not in layout.key and (update is None or c in update)]
    free = ~F.coalesce(F.col(f"{table}.{keep_if}"), F.lit(False)) if keep_if else None
    matched = source.select(*layout.names).alias("source").mergeInto(table, condition).whenMatched(free)
    matched.update({c: F.col(f"source.{c}") for c in changed}).whenNotMatched().insertAll().merge()
