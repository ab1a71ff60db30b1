"""A training corpus in five stages: from raw documents to token ids.

Each stage takes the documents that the one before kept, as a table, and its decisions take effect:
rejected documents, copies, near copies and documents with benchmark passages go. The last stage
returns the ids of what is left. All others return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from smogline.llm import bpe, decontaminate, exact_dedup, near_dedup, quality
from smogline.llm.catalog import byte_bpe, table
from smogline.llm.workers import findable
from smogline.session import stored


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line CRF scores 0.3 or more."""
    findable(spark)
    return quality.keep_good(docs, quality.fit_on(docs, table(spark, sf_dir, "labels")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the one with the largest id."""
    findable(spark)
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by a similarity of 0.75 or more, the one with the smallest id."""
    findable(spark)
    return near_dedup.drop_near(docs)


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of ten words of the benchmark."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, restored): the token ids of each text; they decode to it."""
    findable(spark)
    return bpe.encode_checked(docs, byte_bpe()).withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality", keep_good),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_benchmark_passages),
    ("bpe", encode),
]

#: Fitted models and tokenizers are not expressed in SQL; tests compare with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
