"""Registered queries of this subpackage, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smogline.llm import (
    alignment, bpe, decontaminate, exact_dedup, hard_negatives, langid, licenses, near_dedup, pii, quality,
    substring_dedup, token_counts, token_files,
)
from smogline.llm.workers import findable
from smogline.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    findable(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return out.select(
        F.col("id").alias("doc_id"), "n_words", "n_removed",
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def byte_bpe() -> str:
    """The vocabulary file that the queries use."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op2_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), byte_bpe()).withColumnRenamed("id", "doc_id")


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = exact_dedup.mark_copies(table(spark, sf_dir, "documents"))
    return out.select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept",
        F.lower(F.hex("key")).alias("text_sha256"),
    )


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit_on(docs, table(spark, sf_dir, "labels"))
    return quality.scored(docs, model).withColumnRenamed("id", "doc_id")


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )
    return out.select(
        F.col("id").alias("doc_id"), "n_words", "n_hit", "n_items",
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.predicted(docs, langid.fit_on(docs)).withColumnRenamed("id", "doc_id")


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_dedup.near_groups(table(spark, sf_dir, "documents"))
    return out.select(
        F.col("id").alias("doc_id"), "n_shingles", "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"),
    )


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pii.personal_data(table(spark, sf_dir, "documents"))
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [
        F.size(F.array_remove(F.transform(kinds, lambda k: k == F.lit(i)), False)).cast("long").alias(f"n_{kind}")
        for i, kind in enumerate(pii.KINDS)
    ]
    every = F.array_sort(F.concat("base", "added"))
    return out.select(
        F.col("id").alias("doc_id"), *counts,
        F.sha2(pii.listed(F.col("base")), 256).alias("base_sha256"), pii.listed(every).alias("spans"),
    )


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    token_files.write_token_files(table(spark, sf_dir, "documents"), path, byte_bpe())
    read = token_files.read_token_files(spark, path).select(
        "part", "number", "id", "at", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )
    return read.join(token_files.starts(spark, path), ["part", "number"]).select(
        F.col("id").alias("doc_id"), (F.col("before") + F.col("at")).alias("start"),
        "n_tokens", "ids_crc32",
    )


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = token_counts.token_counts(table(spark, sf_dir, "documents"), byte_bpe())
    return out.select(
        F.col("id").alias("doc_id"), "n_bytes", "n_tokens", (F.col("n_tokens") > 1024).alias("over_limit")
    )


def piece_bpe() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = alignment.aligned(table(spark, sf_dir, "documents"), byte_bpe(), piece_bpe())
    return out.select(
        F.col("id").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_shared"
    )


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose id is divisible by 7 get the next label; components become whole 256ths."""
    vectors = hard_negatives.prepared(
        table(spark, sf_dir, "embeddings"), "vec_id",
        F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")),
        F.transform("embedding", lambda x: F.floor(x.cast("double") * 256).cast("double")),
    )
    return hard_negatives.mined(vectors, F.col("id") % 50 == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_bpe_round_trip": op2_bpe_round_trip,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_quality": op4_quality,
    "op5_decontaminate": op5_decontaminate,
    "op6_language": op6_language,
    "op7_licenses": op7_licenses,
    "op8_near_dedup": op8_near_dedup,
    "op9_personal_data": op9_personal_data,
    "op10_token_files": op10_token_files,
    "op11_token_counts": op11_token_counts,
    "op12_alignment": op12_alignment,
    "op13_hard_negatives": op13_hard_negatives,
}
