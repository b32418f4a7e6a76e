"""From raw documents to training shards: identify, deduplicate, decontaminate, mix, write.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the stage before it kept; its
result is written as Parquet and read again. All but the last return the columns of ``documents``,
those beyond the usual ones included, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.llm import decontaminate, language, mixing, ngram_join, tokens
from feedlake.llm.common import bucket_of, read_table
from feedlake.plans.shared import settle

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _all_columns(stage: Callable) -> Callable:
    """Keeps further columns of ``documents`` under names that no operator gives to a result."""

    @wraps(stage)
    def kept(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        further = {c: f"further_{k}" for k, c in enumerate(docs.columns) if c not in COLUMNS}
        out = stage(spark, docs.withColumnsRenamed(further), sf_dir)
        return out.select(*[F.col(further.get(c, c)).alias(c) for c in docs.columns])

    return kept


@_all_columns
def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that no language can be told of; fills in a missing language."""
    model = language.train(docs.where(bucket_of(F.col("doc_id"), 4) != 2))
    told = language.identify(docs, model).where(F.col("lang_pred") != language.UNKNOWN)
    return told.withColumn("lang", F.coalesce("lang", "lang_pred"))


@_all_columns
def join_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document, that of the smallest id, of each group linked by shared n-grams."""
    return ngram_join.keep_one(docs)


@_all_columns
def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops contaminated documents; the others stay as they are."""
    found = decontaminate.find_contamination(docs, read_table(spark, sf_dir, "benchmark"))
    return found.where(~F.col("contaminated"))


@_all_columns
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or leaves out documents so that sources meet their target weights."""
    return mixing.mix(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences in training order, one row per fixed-stride shard."""
    return tokens.write_order(docs)


STAGES = [
    ("language", identify_language),
    ("ngram_join", join_near_copies),
    ("decontaminate", remove_benchmark),
    ("mix", mix_sources),
    ("tokens", write_tokens),
]

# Trained models, sampling and tokenizers are beyond SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each settled in the shared folder before the next."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
