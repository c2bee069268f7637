"""What several corpus operators share: staging, input columns, and byte buffers made of whole texts."""

from __future__ import annotations

import sys
import types
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wicklake.session import fresh_dir

# Words are runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
LAST_ID = 2**63 - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """`df` written once, as Parquet in the folder all executors share, and read back.

    Later passes read the columns they need from the copy; a lost executor takes nothing with it.
    """
    path = fresh_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_batches(spark: SparkSession, rows: int = 512) -> None:
    """Python workers get so many rows at a time, since a row may hold a very long text."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def worker_cache() -> dict:
    """A dictionary that lives as long as the Python worker and outlasts its tasks."""
    return sys.modules.setdefault("_corpus_worker_cache", types.ModuleType("_corpus_worker_cache")).__dict__


def held_out(doc_id: Column) -> Column:
    """True for the rows that no classifier may learn from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def whole_buffers(texts: list[bytes], most: int) -> Iterator[tuple[int, int, bytes, np.ndarray]]:
    """Concatenations of whole texts of about `most` bytes: first and last index, the bytes, and where each text starts.

    A text that is longer than `most` comes alone and whole.
    """
    first, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > most:
            yield first, i, b"".join(texts[first:i]), _starts(texts[first:i])
            first, size = i, 0
        size += len(text)
    if first < len(texts):
        yield first, len(texts), b"".join(texts[first:]), _starts(texts[first:])


def _starts(texts: list[bytes]) -> np.ndarray:
    return np.cumsum([0, *map(len, texts)], dtype=np.int64)


def words_at(buffer: bytes, width: int, dtype: str) -> np.ndarray:
    """The `width`-byte word that starts at each byte, as overlapping little-endian numbers."""
    return np.ndarray(shape=(max(0, len(buffer) - width + 1),), dtype=dtype, buffer=buffer, strides=(1,))
