"""One query per operator over the supplied tables, and their SQL twins where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.llm import (
    bpe,
    centroids,
    covertree,
    decontaminate,
    gnat,
    html,
    language,
    lines,
    mixing,
    ngram_join,
    quality,
    secrets,
    tokens,
)
from feedlake.llm.common import bucket_of, read_table
from feedlake.llm.twins import TWINS


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document, by patterns and by the randomness battery."""
    found = secrets.find_secrets(read_table(spark, sf_dir, "documents"))

    def listed(spans) -> Column:
        names = F.array(*[F.lit(kind) for kind in secrets.KINDS])
        return F.array_join(
            F.transform(
                spans,
                lambda s: F.concat_ws(
                    ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"),
                    s["end"].cast("string"),
                ),
            ),
            ",",
        )

    def count(kind: str) -> Column:
        place = secrets.KINDS.index(kind)
        return F.size(F.filter("spans", lambda s: s["kind"] == place)).cast("bigint")

    base = F.filter("spans", lambda s: s["kind"] < 3)
    return found.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in secrets.KINDS],
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )


def op2_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as shards of token sequences in training order."""
    return tokens.write_order(read_table(spark, sf_dir, "documents"))


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes."""
    plan = mixing.plan_mix(read_table(spark, sf_dir, "documents"))
    return plan.select(
        "doc_id", "size", "source_size", "target",
        (F.col("copies") * F.col("size")).alias("taken"), "copies", "source",
    )


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size of every document's n-gram set and the group of linked documents it is in."""
    found = ngram_join.link(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "links")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learned outside the held-out fold."""
    docs = read_table(spark, sf_dir, "documents")
    model = quality.train(docs, read_table(spark, sf_dir, "labels"))
    held_out = F.coalesce(bucket_of(F.col("doc_id"), 3) == 1, F.lit(False)).alias("held_out")
    return quality.score(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out, "score", "predicted"
    )


def op6_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html.extract_text(pages).select("page_id", "url", "text", "n_chars")


def op7_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten highest inner products of every hundredth vector."""
    return covertree.top_k(read_table(spark, sf_dir, "embeddings"))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned outside the held-out fold."""
    docs = read_table(spark, sf_dir, "documents")
    model = language.train(docs.where(bucket_of(F.col("doc_id"), 4) != 2))
    held_out = F.coalesce(bucket_of(F.col("doc_id"), 4) == 2, F.lit(False)).alias("held_out")
    return language.identify(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out, "lang_pred", "score"
    )


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of every document and those that repeat an earlier one within an edit."""
    found = lines.find_repeats(read_table(spark, sf_dir, "documents"))
    dropped = F.size("dropped").cast("bigint")
    return found.select(
        "doc_id", "n_lines", dropped.alias("n_dropped"),
        F.array_join(F.transform("dropped", lambda k: k.cast("string")), ",").alias("dropped"),
    )


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark words and items found in every document."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_contamination(docs, read_table(spark, sf_dir, "benchmark"))
    return decontaminate.digest(found)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector, for each of its positives."""
    return gnat.mine(read_table(spark, sf_dir, "embeddings"))


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document, and the bytes they decode to, as digests."""
    docs = read_table(spark, sf_dir, "documents")
    codec = bpe.load(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return bpe.digest(bpe.encode(docs, codec, keep=["doc_id"], decoded=True))


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster of every vector with 64 components."""
    return centroids.cluster(read_table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_secrets": op1_secrets,
    "op2_training_order": op2_training_order,
    "op3_mix_sources": op3_mix_sources,
    "op4_ngram_join": op4_ngram_join,
    "op5_quality": op5_quality,
    "op6_main_text": op6_main_text,
    "op7_cover_tree": op7_cover_tree,
    "op8_language": op8_language,
    "op9_line_dedup": op9_line_dedup,
    "op10_decontaminate": op10_decontaminate,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_byte_bpe": op12_byte_bpe,
    "op13_centroids": op13_centroids,
}

__all__ = ["QUERIES", "TWINS"]
