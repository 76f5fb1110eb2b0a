"""Operator 1: language identification by word-first backoff.

Training counts words and padded character n-grams (orders 5 to 1) per language
on a bounded sample of distinct labelled texts. A known word scores with its
per-language log frequency. An unseen word falls back to the longest n-gram
order of which the model knows at least one n-gram, then to the next shorter one;
the mean log frequency of its known n-grams counts. A text's language is the
one with the largest sum over all its words, known or not. All words and n-grams of the sample are kept.

Defined results: a null text, an empty one and one without a letter give
``und`` with score 0. Ties go to the language that is first by code point. With
no labelled text at all every row is ``und``; an empty table gives no rows; very long texts are read whole. Repeated rows are scored one by
one; extra columns of the input are ignored (or kept, see ``identify``).
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from appraise.llm.common import below, map_batches

UND = "und"
TEXTS_AT_ONCE = 100
"""Texts of the sample whose words and n-grams a task counts before it passes the counts on."""
_LETTERS = re.compile(r"[^\W\d_]+").findall


@dataclass(frozen=True)
class Params:
    rows_per_language: int = 500
    """About so many distinct texts of each language are counted, once each (a hash of the text chooses them)."""
    words_per_language: int | None = None
    """Known words are the most frequent of each language; by default all that the sample holds."""
    orders: tuple[int, ...] = (5, 4, 3, 2, 1)
    smoothing: float = 0.5
    confidence_words: int = 8
    """The score is the posterior of a text of at most so many average words."""


@dataclass
class Model:
    """Per-language log frequencies of all that the sample holds; its size is bounded by the sample's."""

    languages: list[str]
    table: dict[int, tuple[list[str], np.ndarray]] = field(default_factory=dict)
    """By order (0: whole words), the tokens and a matrix with a row of log frequencies in each language for each."""
    params: Params = Params()


class Scorer:
    """Scores texts with a model; vectors of unseen words are worked out once a batch and kept (up to ``keep``)."""

    def __init__(self, model: Model, keep: int = 60_000):
        self.model, self.keep, rows = model, keep, []
        self.grams: dict[int, dict[str, int]] = {}
        if not model.languages:
            return
        width, upto = len(model.languages), 0
        for n in model.params.orders:
            own, matrix = model.table[n]
            self.grams[n] = dict(zip(own, range(upto, upto + len(own)), strict=True))
            rows.append(matrix.reshape(-1, width))
            upto += len(own)
        self.gram_rows = np.concatenate([*rows, np.zeros((1, width))])  # the last: nothing known
        known, matrix = model.table[0]
        self.known, self.known_rows = dict(zip(known, range(len(known)), strict=True)), matrix.reshape(-1, width)
        self.learned: dict[str, int] = {}
        self.rows = self.known_rows

    def backoff(self, word: str) -> list[int]:
        """Rows of the known n-grams of the longest order that has any."""
        padded = f"<{word}>"
        for n in self.model.params.orders:
            known = self.grams[n]
            hits = [known[g] for g in grams(padded, n) if g in known]
            if hits:
                return hits
        return [len(self.gram_rows) - 1]

    def learn(self, unseen: list[str]) -> None:
        hits = [self.backoff(w) for w in unseen]
        sizes = np.fromiter(map(len, hits), int, len(hits))
        flat = np.fromiter((h for own in hits for h in own), int, int(sizes.sum()))
        starts = np.cumsum(sizes) - sizes
        mean = np.add.reduceat(self.gram_rows[flat], starts, axis=0) / sizes[:, None]
        self.learned.update(zip(unseen, range(len(self.rows), len(self.rows) + len(unseen)), strict=True))
        self.rows = np.concatenate([self.rows, mean])

    def __call__(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        model, langs, scores = self.model, [UND] * len(texts), np.zeros(len(texts))
        if not model.languages:
            return langs, scores
        if len(self.learned) > self.keep:
            self.learned, self.rows = {}, self.known_rows
        counts = [Counter(letters(t)) for t in texts]
        known, learned = self.known, self.learned
        unseen = list(dict.fromkeys(w for of in counts for w in of if w not in known and w not in learned))
        if unseen:
            self.learn(unseen)
        for i, of in enumerate(counts):
            if not of:
                continue
            k = np.fromiter(of.values(), float, len(of))
            total = k @ self.rows[[known[w] if w in known else learned[w] for w in of]]
            best = int(np.argmax(total))
            n = k.sum()
            langs[i] = model.languages[best]
            scores[i] = 1.0 / np.exp((total - total[best]) * (min(n, model.params.confidence_words) / n)).sum()
        return langs, scores


def letters(text: str | None) -> list[str]:
    """Lower-cased runs of letters; empty if there is no letter."""
    if not text:
        return []
    got = _LETTERS(text.lower())
    return got if any(c.isalpha() for w in got for c in w) else []


def grams(padded: str, n: int) -> list[str]:
    return [padded[i : i + n] for i in range(len(padded) - n + 1)]


def train(labelled: DataFrame, params: Params = Params()) -> Model:
    """Fit on the columns ``text`` and ``lang`` of ``labelled`` (rows with a null in either are left out)."""
    rows = labelled.select("text", "lang").where("text is not null and lang is not null")
    # Copies of a text are chosen together, so distinct texts are what the rate counts; hashes of them are enough for that.
    distinct = rows.select("lang", F.xxhash64("text").alias("h")).distinct()
    n = {r["lang"]: r["n"] for r in distinct.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(n)
    if not languages:
        return Model([], {}, params)
    share = F.lit(0.0)
    for lang in languages:
        share = F.when(F.col("lang") == lang, params.rows_per_language / n[lang]).otherwise(share)
    sample = rows.where(below(F.col("text"), share)).distinct()
    orders = params.orders

    def count(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = (pdf.iloc[at : at + TEXTS_AT_ONCE] for pdf in it for at in range(0, len(pdf), TEXTS_AT_ONCE))
        for pdf in parts:  # their counts are added up below
            of: Counter = Counter()
            for lang, got in pdf.groupby("lang")["text"]:
                own: Counter = Counter()
                for text in got:
                    own.update(letters(text))
                for word, k in own.items():
                    of[lang, 0, word] += k
                    padded = f"<{word}>"
                    for o in orders:
                        for g in grams(padded, o):
                            of[lang, o, g] += k
            yield pd.DataFrame([(*k, v) for k, v in of.items()], columns=["lang", "ord", "token", "n"])

    counts = (
        sample.mapInPandas(count, "lang string, ord int, token string, n long")
        .groupBy("lang", "ord", "token")
        .agg(F.sum("n").alias("n"))
    )
    if params.words_per_language is not None:
        rank = F.row_number().over(W.partitionBy("lang", "ord").orderBy(F.desc("n"), "token"))
        counts = counts.withColumn("r", rank).where((F.col("ord") > 0) | (F.col("r") <= params.words_per_language))
    # One row per token, a column of counts for each language: the model of a bounded sample, so it may reach the driver whole.
    wide = counts.groupBy("ord", "token").agg(
        *[F.coalesce(F.sum(F.when(F.col("lang") == lang, F.col("n"))), F.lit(0)).alias(f"n{i}") for i, lang in enumerate(languages)]
    )
    got = wide.toArrow().sort_by([("ord", "ascending"), ("token", "ascending")])
    order = got["ord"].to_numpy()
    freq = np.stack([got[f"n{i}"].to_numpy() for i in range(len(languages))], axis=1).astype(float)
    table = {}
    for o in (0, *orders):
        own = slice(*np.searchsorted(order, [o, o + 1]))
        tokens = got["token"][own].to_pylist()
        low = np.log(freq[own].sum(axis=0) + params.smoothing * (len(tokens) + 1))
        table[o] = (tokens, np.log(freq[own] + params.smoothing) - low)
    return Model(languages, table, params)


def identify(docs: DataFrame, model: Model, pred: str = "lang_pred", score: str = "score") -> DataFrame:
    """Add the columns ``pred`` and ``score`` to the rows of ``docs``, judged by ``text`` alone.

    Other columns are kept as they are; columns of the two names are replaced.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)
    docs = docs.drop(pred, score)
    own: list[Scorer] = []

    def run(batch):
        if not own:
            own.append(Scorer(held.value))
        texts = batch.column("text").to_pylist()
        parts = [own[0](texts[i : i + 200]) for i in range(0, len(texts), 200)]
        return {pred: [x for p, _ in parts for x in p], score: [x for _, p in parts for x in p]}

    return map_batches(docs, run, T.StructType(list(docs.schema.fields)).add(pred, "string").add(score, "double"))
