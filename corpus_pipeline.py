"""A training corpus from ``documents``, in five stages.

1. ``quality``: documents that the quality classifier rejects go.
2. ``near_dedup``: one document of each group of near copies stays.
3. ``decontaminate``: documents with a benchmark passage go.
4. ``secrets``: secrets in the texts are replaced; every document stays.
5. ``tokens``: the texts are encoded, and decoded again as a check.

Each stage takes what the one before kept, written as Parquet and read again.
Rows that repeat an id stand or fall together; rows without an id each stand
on their own, as documents after all that have one. Null texts count as empty; an
empty table passes through as an empty table; extra columns are carried to
the last stage. No stage can be put in SQL as a whole, so ``ORACLE_SQL`` is
None; ``tests/llm`` holds the stages against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regstat.llm import bpe, decontaminate, near_dups, quality_model, secrets
from regstat.llm.common import table, written
from regstat.llm.queries import BYTE_BPE, KEEP_SCORE, WORD_BPE

ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    fitted = quality_model.model(docs, table(spark, sf_dir, "labels"))
    return quality_model.accepted(docs, fitted, KEEP_SCORE)


def with_row_ids(docs: DataFrame) -> DataFrame:
    """``docs`` with ``__row``: the id, and a number of its own, beyond all
    ids, for each row without one (then written, so that it stays the same)."""
    key = F.col("doc_id").cast("long")
    ids = docs.agg(F.max(key).alias("most"), F.count_if(key.isNull()).alias("missing")).first()
    if not ids["missing"]:
        return docs.withColumn("__row", key)
    after = F.lit(ids["most"] if ids["most"] is not None else -1).cast("decimal(38,0)")
    number = F.monotonically_increasing_id()
    # raises rather than meets an id, should the largest be near the end of the range
    return written(docs.withColumn("__row", F.coalesce(key, (after + 1 + number).cast("long"))), "rows")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = with_row_ids(docs)
    found = near_dups.near_duplicates(rows, id_col="__row")
    copies = found.where(F.col("doc_id") != F.col("component_id")).select(F.col("doc_id").alias("__row"))
    return rows.join(copies.distinct(), "__row", "left_anti").select(*docs.columns)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = with_row_ids(docs)
    found = decontaminate.contamination(rows, table(spark, sf_dir, "benchmark"), id_col="__row")
    hit = written(found.where("n_hit > 0").select(F.col("doc_id").alias("__row")), "contaminated")
    return rows.join(hit, "__row", "left_anti").select(*docs.columns)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = secrets.redacted(docs, BYTE_BPE)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    coded = bpe.encode_decode(docs, WORD_BPE)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        "ids",
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminated),
    ("secrets", without_secrets),
    ("tokens", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
