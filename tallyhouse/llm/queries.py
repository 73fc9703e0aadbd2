"""One query per operator, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyhouse.llm import (
    byte_bpe, conversation_repair, damage, exact_dedup, language_model, license_scan, near_dedup, oracles, packing, periodic_runs,
    quality_classifier, quality_rules as rules, secret_scan, token_counts, toxicity,
)
from tallyhouse.llm.arrow import set_batch_rows
from tallyhouse.llm.labels import remainder
from tallyhouse.llm.license_texts import TEMPLATES

Query = Callable[[SparkSession, str], DataFrame]


def documents(spark: SparkSession, folder: str) -> DataFrame:
    set_batch_rows(spark)
    return spark.read.parquet(f"{folder}/documents.parquet")


def labels(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/labels.parquet")


def op1_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return byte_bpe.digests(documents(spark, folder), ranks, public_tokenizers.PATTERN)


def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", "text")
    held_out = remainder(F.col("doc_id"), 3) == 1
    model = toxicity.train(docs, labels(spark, folder), learn=~held_out)
    return toxicity.score(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"), "sentences",
    )


def op3_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", "text")
    base = ~rules.passes(rules.BASE)
    return rules.ledger(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base.alias("base_failed"), rules.passes(rules.STRICT).alias("kept"),
        "n_lines", "failed_rules",
    )


def op4_language_model(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", "text")
    held_out = remainder(F.col("doc_id"), 7) == 2
    model, counts = language_model.train(docs, learn=~held_out)
    return language_model.score(docs, model, counts).withColumn("held_out", held_out)


def op5_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", "text")
    held_out = remainder(F.col("doc_id"), 4) == 2
    model = quality_classifier.train(docs, labels(spark, folder), learn=~held_out)
    return quality_classifier.score(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score",
        (F.col("score") >= quality_classifier.THRESHOLD).cast("int").alias("predicted"),
    )


def op6_packing(spark: SparkSession, folder: str) -> DataFrame:
    tokenizer = Path(public_tokenizers.path("word_bpe_49k.json")).read_text()
    return packing.pack(documents(spark, folder), tokenizer)


def op7_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.scan(documents(spark, folder), TEMPLATES)


def op8_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.near_groups(documents(spark, folder), shingle_words=2, similarity=80)


def op9_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_groups(documents(spark, folder))


def op10_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    pieces = token_counts.Vocabulary.from_file(public_tokenizers.path("piece_bpe_32k.model"))
    return token_counts.token_counts(documents(spark, folder), pieces)


def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = periodic_runs.find_runs(damage.repeat_tails(documents(spark, folder)))
    longest = F.expr("array_min(transform(runs, r -> struct(-r.length AS less, r.start, r.period)))")
    listed = F.expr("array_join(transform(runs, r -> concat_ws(',', r.start, r.length, r.period) || '\n'), '')")
    return found.withColumns({"longest": longest, "listed": listed}).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"),
        "longest.start", (-F.col("longest.less")).alias("length"), "longest.period",
        F.expr("-1000 * longest.less div longest.period").alias("exponent_milli"),
        F.sha2("listed", 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    set_batch_rows(spark)
    conversations = spark.read.parquet(f"{folder}/conversations.parquet")
    found = conversation_repair.audits(conversation_repair.repair(damage.damage_turns(conversations)))
    ids = conversations.select(F.col("conv_id").alias("id")).distinct()
    every = ids.join(found, F.col("id").eqNullSafe(F.col("conv_id")), "left")
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return every.select(
        F.col("id").alias("conv_id"), *(F.coalesce(n, F.lit(0).cast("bigint")).alias(n) for n in counts),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def op13_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    def listed(spans) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    base = F.filter("spans", lambda s: s["kind"].isin(*secret_scan.PATTERN_KINDS))
    return secret_scan.scan(documents(spark, folder)).select(
        "doc_id", *map(count, secret_scan.PATTERN_KINDS), F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )


QUERIES: dict[str, Query] = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_toxicity": op2_toxicity,
    "op3_quality_rules": op3_quality_rules,
    "op4_language_model": op4_language_model,
    "op5_quality_classifier": op5_quality_classifier,
    "op6_packing": op6_packing,
    "op7_license_scan": op7_license_scan,
    "op8_near_dedup": op8_near_dedup,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_token_counts": op10_token_counts,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_secret_scan": op13_secret_scan,
}

ORACLES: dict[str, str] = {
    "op3_quality_rules": oracles.OP3,
    "op9_exact_dedup": oracles.OP9,
}
