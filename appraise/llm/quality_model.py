"""Operator 3: quality classifier, hashed word n-gram logistic regression trained with FTRL-proximal updates.

Tokens are runs of word characters or of symbols. Features are hashed unigrams
and bigrams of tokens, the same n-grams over token shapes (a word never seen
before still has one: case, digits or the symbol itself), and bigrams that mark a
token equal to the one before. A feature's value is ``log(1 + count)``; a text's
vector has length 1. Training runs the per-coordinate updates over shards of a
bounded, repeatable sample of labelled rows and averages the shards' states after
every round. Scoring is a sparse dot product and a logistic function.

Defined results: null and empty texts have no features and score with the
intercept; without any label every score is 0.5; a row's score depends on its
text alone; a document labelled more than once counts with its highest label.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from appraise.llm.common import below, map_batches, saved, train_in_rounds

_TOKENS = re.compile(r"\w+|[^\w\s]+").findall
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


@dataclass(frozen=True)
class Params:
    bits: int = 17
    """The weight vector has 2**bits entries, the last for the intercept."""
    train_rows: int = 6000
    """About so many labelled rows are learned from (a hash of the id chooses them)."""
    shard_rows: int = 1500
    rounds: int = 3
    epochs: int = 2
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.05


class Hasher:
    """Feature vectors of texts; token hashes are kept between texts (emptied when there are many)."""

    def __init__(self, bits: int):
        self.mask, self.kept = np.uint64((1 << bits) - 1), {}

    def __getstate__(self):
        return {"mask": self.mask, "kept": {}}

    def _pair(self, token: str) -> tuple[int, int]:
        got = self.kept.get(token)
        if got is None:
            if len(self.kept) > 300_000:
                self.kept.clear()
            got = self.kept[token] = (_hash64(token), _hash64(shape(token)))
        return got

    def __call__(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        tokens = _TOKENS(text) if text else []
        if not tokens:
            return np.zeros(0, np.int64), np.zeros(0)
        h = np.array([self._pair(t) for t in tokens], np.uint64)
        own, form = h[:, 0], h[:, 1]
        same = own[1:] == own[:-1]
        parts = [
            own,
            form + np.uint64(11),
            _mix(own[:-1] * _M1 + own[1:]),
            _mix(form[:-1] * _M1 + form[1:] + np.uint64(5)),
            _mix(np.where(same, form[1:] + np.uint64(77), np.uint64(3)))[same],
        ]
        at, n = np.unique((_mix(np.concatenate(parts)) & self.mask).astype(np.int64), return_counts=True)
        value = np.log1p(n)
        return at, value / np.sqrt(value @ value)


def _hash64(s: str) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(s)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _M2
    return x ^ (x >> np.uint64(29))


def shape(token: str) -> str:
    """Case and kind of a token; symbols stand for themselves (a run of one symbol for up to three)."""
    if token.isalpha():
        return "\x01x" if token.islower() else "\x01X" if len(token) > 1 and token.isupper() else "\x01Xx"
    if token.isdigit():
        return "\x019"
    if token[0].isalnum() or token[0] == "_":
        return "\x01x9"
    return "\x01" + (token[:1] * min(len(token), 3) if len(set(token)) == 1 else token[:3])


def weights(z: np.ndarray, n: np.ndarray, p: Params) -> np.ndarray:
    """Weights of a state: zero where |z| is within the L1 bound."""
    return np.where(np.abs(z) <= p.l1, 0.0, -(z - np.sign(z) * p.l1) / ((p.beta + np.sqrt(n)) / p.alpha + p.l2))


def ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], z: np.ndarray, n: np.ndarray, p: Params, weight: float) -> None:
    """One pass of updates, in place; rows of label 0 weigh ``weight``."""
    end = len(z) - 1
    for at, value, label in rows:
        at, value = np.append(at, end), np.append(value, 1.0)
        w = weights(z[at], n[at], p)
        g = (_sigmoid(w @ value) - label) * value * (1.0 if label else weight)
        s = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / p.alpha
        z[at] += g - s * w
        n[at] += g * g


def _sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))


def training_rows(docs: DataFrame, labels: DataFrame, label: str, rows: int, shard_rows: int) -> tuple[DataFrame, int, float]:
    """A bounded sample of labelled texts with a shard number, the number of shards and the share of label 1.

    Only the sampled ids (about ``rows``) are broadcast, so the texts aren't shuffled to find them.
    """
    one = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(label).alias("y"))
    stat = one.agg(F.count("*").alias("n"), F.avg((F.col("y") > 0).cast("double")).alias("share")).first()
    n = stat["n"]
    shards = max(1, min(n, rows) // shard_rows)
    picked = one.where(below(F.col("doc_id"), min(1.0, rows / max(1, n))))
    got = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")
    got = got.withColumn("shard", F.pmod(F.xxhash64("doc_id", F.lit(99)), F.lit(shards)).cast("int"))
    return got, shards, float(stat["share"] or 0.0)


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", params: Params = Params()) -> np.ndarray:
    """The weight vector (fixed size) learned from ``labels`` (doc_id, label) and the texts of ``docs``."""
    rows, shards, share = training_rows(docs, labels, label, params.train_rows, params.shard_rows)
    rows = saved(docs.sparkSession, rows, "quality-sample")
    size = (1 << params.bits) + 1
    balance = min(10.0, max(1.0, share / max(1e-9, 1 - share))) ** 0.5

    def step(pdf: pd.DataFrame, state: list[np.ndarray]) -> list[np.ndarray]:
        hasher = Hasher(params.bits)
        pdf = pdf.assign(k=[_hash64(str(d)) for d in pdf["doc_id"]]).sort_values(["k", "doc_id", "y"])
        seen = [(*hasher(t), int(y > 0)) for t, y in zip(pdf["text"], pdf["y"], strict=True)]
        for _ in range(params.epochs):
            ftrl(seen, *state, params, balance)
        return state

    z, n = train_in_rounds(rows, step, [np.zeros(size), np.zeros(size)], params.rounds, shards)
    return weights(z, n, params).astype(np.float32)


def score(docs: DataFrame, w: np.ndarray, params: Params = Params()) -> DataFrame:
    """Add ``score`` and ``predicted`` to the rows of ``docs``; other columns stay."""
    held = docs.sparkSession.sparkContext.broadcast(w)
    hasher = Hasher(params.bits)
    docs = docs.drop("score", "predicted")

    def run(batch):
        w = held.value
        raw = []
        for text in batch.column("text").to_pylist():
            at, value = hasher(text)
            raw.append(float(w[at] @ value) + float(w[-1]))
        p = _sigmoid(np.array(raw, float))
        return {"score": p, "predicted": (p >= 0.5).astype(np.int32)}

    return map_batches(docs, run, T.StructType(list(docs.schema.fields)).add("score", "double").add("predicted", "integer"))
