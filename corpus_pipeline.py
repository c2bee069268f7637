"""The corpus pipeline: five stages over `documents`, each written as Parquet and read again by the next one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from wicklake.llm import decontaminate, language, mixing, simhash, tokens
from wicklake.llm.common import staged, table
from wicklake.llm.queries import tokenizer_path

# A text of which less than this share of n-grams belongs to the likeliest language is in none of the known ones.
LEAST_COVERAGE = 0.25


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the learned languages; texts without a letter and texts in no known language go.

    The judgement is made where the row is read and nothing is joined, so rows without an id and rows that share one are
    judged each. If no language could be learned, texts with a letter stay.
    """
    return language.known(docs, language.learn(docs), LEAST_COVERAGE)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies: three-word shingles, two bits."""
    return simhash.keep_one(docs)


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mix(docs)


def write_token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document in the token files, read back from them."""
    return tokens.encode_documents(docs, tokenizer_path()).select("doc_id", "start", "n_tokens", "ids_crc32")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language ID", keep_known_languages),
    ("SimHash near-dedup", keep_one_of_near_copies),
    ("benchmark decontamination", drop_benchmark_passages),
    ("mixing sources to target weights", mix_sources),
    ("token-ID / binary output", write_token_ids),
]

# Language ID, SimHash and the tokenizer are beyond SQL; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name.split()[0].lower())
    return docs
