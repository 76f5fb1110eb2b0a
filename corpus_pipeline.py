"""The training-data pipeline: five stages over ``documents``, each reading what the one before wrote.

1. ``language_id``: rows whose language can't be told go: no text, no letter, or a score below ``MIN_LANGUAGE_SCORE``.
2. ``near_duplicates``: of each component of the Jaccard join one document stays.
3. ``decontamination``: documents that hold a test item of ``benchmark``, whole or edited, go.
4. ``secrets``: secrets in the texts are masked (``n_chars`` follows); no document goes.
5. ``mixing``: what a mix of the sources by weight takes from every document that is left.

All stages but the last return the columns of ``documents``, whatever their names: verdicts are held in columns whose names
are free. A null or empty text has no language and goes in the first stage; very long texts are read whole; of repeated rows
and of ties (copies with the same key) the one with the least key and digest stays in the second; empty tables pass all stages as no rows. Rows go
to Python workers in batches of bounded bytes (``small_batches``). SQL can't express them (trained model, alignment,
pseudorandom draws), so there is no oracle; ``tests/llm/test_mixing_and_benchmark.py`` holds every stage against plain Python.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from appraise.llm import decontaminate, jaccard, language_id, mixing, secrets
from appraise.llm.common import documents, free_name, saved, small_batches, table

MIN_LANGUAGE_SCORE = 0.4


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows with a known language. Without any labelled row, all that have a letter stay."""
    small_batches(spark)
    model = language_id.train(docs)
    if not model.languages:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    pred, score = free_name(docs, "lang_pred"), free_name(docs, "score")
    found = language_id.identify(docs, model, pred, score)
    good = (F.col(pred) != language_id.UND) & (F.col(score) >= MIN_LANGUAGE_SCORE)
    return found.where(good).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return jaccard.representatives(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    into = free_name(docs, "matches")
    found = decontaminate.find(docs, table(spark, sf_dir, "benchmark"), into=into)
    return found.where(F.size(into) == 0).select(*docs.columns)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return secrets.mask_documents(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return mixing.taken(mixing.mix(docs))


STAGES = [
    ("language_id", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", mask_secrets),
    ("mixing", source_mixing),
]

ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage's result is written as Parquet and read again."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = saved(spark, stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
