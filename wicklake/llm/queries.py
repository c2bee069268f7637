"""One query per operator, over its whole table, with the parameters it would have in production."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wicklake.llm import decontaminate, html, language, maxent, mixing, runs, secrets, simhash, suffix, tokens, toxicity, variants, vectors
from wicklake.llm.common import table


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.groups(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


def op4_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(table(spark, sf_dir, "documents"))


def _joined(spans: str) -> Column:
    return F.array_join(F.transform(F.col(spans), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = secrets.scan(docs, secrets.learn(docs))
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [F.size(F.array_remove(kinds, kind)) for kind in secrets.KINDS]
    counts = [(F.size("base") - n).cast("long").alias(f"n_{kind}") for kind, n in zip(secrets.KINDS, counts)]
    return found.select("doc_id", *counts, F.sha2(_joined("base"), 256).alias("base_sha256"), _joined("spans").alias("spans"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.learn(docs, table(spark, sf_dir, "labels"))).select("doc_id", "held_out", "score", "predicted")


def op7_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.main_text(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op8_token_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (tokens.encode_documents(table(spark, sf_dir, "documents"), tokenizer_path())
            .select("doc_id", "start", "n_tokens", "ids_crc32"))


def op9_embedding_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.groups(table(spark, sf_dir, "embeddings"))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language.identify(docs, language.learn(docs)).select("doc_id", "held_out", "lang_pred", "score")


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.periodic_runs(runs.with_periodic_tails(table(spark, sf_dir, "documents")))
    longest = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("shorter"), r["start"], r["period"])))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = found.withColumns({"longest": longest, "listed": F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))})
    length = -F.col("longest.shorter")
    return listed.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("longest.start").alias("start"), length.alias("length"),
        F.col("longest.period").alias("period"), F.floor(1000 * length / F.col("longest.period")).alias("exponent_milli"),
        F.sha2(F.col("listed").cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.group_variants(table(spark, sf_dir, "documents"), slips=31)


def op13_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxent.score(table(spark, sf_dir, "documents"))


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_repeats": op1_suffix_repeats,
    "op2_decontaminate": op2_decontaminate,
    "op3_simhash": op3_simhash,
    "op4_mixture": op4_mixture,
    "op5_secrets": op5_secrets,
    "op6_toxicity": op6_toxicity,
    "op7_html": op7_html,
    "op8_token_planes": op8_token_planes,
    "op9_embedding_links": op9_embedding_links,
    "op10_language": op10_language,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_language_model": op13_language_model,
}
