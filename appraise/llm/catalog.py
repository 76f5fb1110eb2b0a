"""Registered queries of the training-data operators and, where SQL can express them, their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from appraise.llm import (
    decontaminate,
    filter_audit,
    jaccard,
    language_id,
    mixing,
    prefix_trie,
    quality_model,
    quality_rules,
    secrets,
    substrings,
    token_counts,
    token_files,
    toxicity,
)
from appraise.llm.common import documents, fold, table

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


@register("op1_language_id")
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; learned from the rows of the other four folds."""
    docs = documents(spark, sf_dir).withColumn("held_out", fold(F.col("doc_id"), 5) == 0)
    model = language_id.train(docs.where("not held_out"))
    return language_id.identify(docs.select("doc_id", "held_out", "text"), model).drop("text")


@register("op2_quality_rules", quality_rules.oracle())
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality verdict of every document by fences of its language and source."""
    return quality_rules.judge(documents(spark, sf_dir))


@register("op3_quality_classifier")
def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document; labels of the held-out fold are never read into the model."""
    docs = documents(spark, sf_dir)
    labels = table(spark, sf_dir, "labels").where(fold(F.col("doc_id"), 3) != 1)
    w = quality_model.train(docs, labels, "quality")
    rows = docs.select("doc_id", (fold(F.col("doc_id"), 3) == 1).alias("held_out"), "text")
    return quality_model.score(rows, w).drop("text")


@register("op4_secret_scan")
def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: base patterns, and spans whose structure was confirmed by decoding."""
    return secrets.scan_documents(documents(spark, sf_dir))


@register("op5_toxicity")
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document; labels of the held-out fold are never read into the model."""
    docs = documents(spark, sf_dir)
    labels = table(spark, sf_dir, "labels").where(fold(F.col("doc_id"), 5) != 0)
    model = toxicity.train(docs, labels, "toxic")
    rows = docs.select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "text")
    return toxicity.score(rows, model).drop("text")


@register("op6_substring_dedup")
def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that are left when repeated 20-word windows go."""
    return substrings.remove_repeats(documents(spark, sf_dir), with_text=False)


@register("op7_jaccard_join")
def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents linked by a Jaccard similarity of 0.75 of their five-word shingles."""
    return jaccard.jaccard_components(documents(spark, sf_dir))


@register("op8_source_mixing")
def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a mix of all sources by weight takes from every document."""
    return mixing.taken(mixing.mix(documents(spark, sf_dir)))


@register("op9_token_counts")
def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document before and after a cleaning pass that edits it."""
    return token_counts.recount(documents(spark, sf_dir), token_counts.cleaning_edits)


@register("op10_decontamination")
def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a test item of the benchmark, whole or edited, with the alignment's score."""
    return decontaminate.contaminated(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


@register("op11_filter_audit", filter_audit.oracle())
def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove per language, in every order and at every step."""
    return filter_audit.corpus_audit(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


@register("op12_token_files")
def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document, written to files of Huffman codes and read back."""
    import public_tokenizers

    return token_files.round_trip(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


@register("op13_prefix_trie")
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every shared beginning of the rebuilt conversations."""
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


def queries() -> dict[str, QueryFn]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
