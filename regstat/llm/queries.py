"""Registered queries: each applies one operator, with production
parameters, to its whole table and derives the contract's columns."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regstat.llm import (
    bpe,
    decontaminate,
    language,
    licenses,
    merkle,
    near_dups,
    paragraph_dups,
    periodic_runs,
    quality_model,
    quality_rules,
    secrets,
    substring_dups,
    token_blocks,
)
from regstat.llm.common import table

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
#: Documents scored below are rejected.
KEEP_SCORE = 0.3
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.tiktoken")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dups.deduplicated(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_bytes",
        F.expr("aggregate(spans, 0L, (n, s) -> n + s.end - s.start)").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dups.near_duplicates(table(spark, sf_dir, "documents"))
    return found.withColumn("kept", F.col("doc_id") == F.col("component_id"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents"), BYTE_BPE)
    base = F.expr("filter(spans, s -> s.kind != 'random')")
    joined = "array_join(transform({}, s -> concat_ws(':', s.kind, s.start, s.end)), ',')"
    count = lambda kind: F.expr(f"cast(size(filter(spans, s -> s.kind = '{kind}')) as long)").alias(f"n_{kind}")
    return (
        found.withColumn("base", base)
        .select(
            "doc_id",
            count("assign"),
            count("access"),
            count("hex"),
            F.sha2(F.expr(joined.format("base")), 256).alias("base_sha256"),
            F.expr(joined.format("spans")).alias("spans"),
        )
    )


def op4_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = quality_model.score(docs, quality_model.model(docs, table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id",
        (quality_model.fold("doc_id") == 0).alias("held_out"),
        "score",
        (F.col("score") >= KEEP_SCORE).cast("int").alias("predicted"),
    )


def op5_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks, freq = token_blocks.written_blocks(table(spark, sf_dir, "documents"), WORD_BPE)
    found = token_blocks.read_documents(blocks, freq)
    return found.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        F.size("found").cast("long").alias("n_paragraphs"),
        F.array_join(F.expr("array_sort(array_distinct(transform(found, x -> x.family)))"), ",").alias("families"),
        F.array_join(F.expr("transform(found, x -> cast(x.at as string))"), ",").alias("lines"),
    )


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    led = quality_rules.ledger(table(spark, sf_dir, "documents"))
    base = quality_rules.mask(quality_rules.BASE)
    base_failed = F.col("failed").bitwiseAND(F.lit(base)) != 0
    return led.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base_failed.alias("base_failed"),
        (~base_failed & quality_rules.passes()).alias("kept"),
        "failed",
    )


def op9_paragraph_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = paragraph_dups.removals(table(spark, sf_dir, "documents"))
    lines, runs = F.size("removed").cast("long"), F.size("passages").cast("long")
    return found.select(
        "doc_id",
        (lines + runs).alias("n_removed"),
        lines.alias("n_removed_lines"),
        F.expr("aggregate(removed, 0L, (s, r) -> s + r.n_words)").alias("n_removed_words"),
        F.array_join(F.expr("transform(removed, r -> cast(r.line as string))"), ",").alias("removed_lines"),
        F.array_join(F.expr("transform(passages, r -> concat(r.at, ':', r.at + r.n_words))"), ",").alias("passages"),
    )


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.encode_decode(table(spark, sf_dir, "documents"), WORD_BPE)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.periodic_runs(table(spark, sf_dir, "documents"), plant=True)
    top = F.get("runs", F.col("top").cast("int"))
    listed = F.expr("transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n'))")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        top["start"].alias("start"),
        top["length"].alias("length"),
        top["period"].alias("period"),
        F.expr("1000 * runs[top].length div runs[top].period").alias("exponent_milli"),
        F.sha2(F.array_join(listed, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    lowered = F.translate("text", merkle.UPPER, merkle.LOWER)
    found = merkle.manifest(table(spark, sf_dir, "documents"), tampered, text=lowered)
    siblings = F.expr("array_join(transform(path, s -> array_join(s.others, '')), '')")
    return found.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2(siblings, 256).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language.predict(docs, language.model(docs))
    return found.select("doc_id", (language.fold("doc_id") == 2).alias("held_out"), "lang_pred", "score")


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_suffix_dedup": op1_suffix_dedup,
        "op2_minhash_near_dedup": op2_minhash_near_dedup,
        "op3_secret_scan": op3_secret_scan,
        "op4_quality_model": op4_quality_model,
        "op5_token_blocks": op5_token_blocks,
        "op6_license_scan": op6_license_scan,
        "op7_decontamination": op7_decontamination,
        "op8_quality_rules": op8_quality_rules,
        "op9_paragraph_dups": op9_paragraph_dups,
        "op10_bpe": op10_bpe,
        "op11_periodic_runs": op11_periodic_runs,
        "op12_merkle_manifest": op12_merkle_manifest,
        "op13_language_id": op13_language_id,
    }
