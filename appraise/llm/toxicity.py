"""Operator 5: toxicity classifier, subword-bag embeddings averaged into a linear softmax.

A word's vector is the mean of the embeddings of its hashed character n-grams
(3 to 5, with word ends) and of the word itself, so a misspelling that was never
seen shares most of its vector with the word it comes from. A window of
``window`` words is the mean of its word vectors; a linear softmax with two
classes reads it. Embeddings and softmax are trained jointly in numpy with
Adagrad. A text is as toxic as its most toxic window: a few words in a long text
are found and their number doesn't dilute. Accordingly the training looks, in each
epoch, at the windows that score highest in each text (in the first, at those
with words that texts of label 1 have and others lack), and leaves out texts of
label 1 whose windows look like the rest.

Training uses a bounded, repeatable sample of labelled rows, cut into shards whose
states are averaged each round. Because the softmax is linear in the mean, scoring
needs one number per word (its logit difference) and a moving mean.

Words are cut at ASCII blanks. One of more than ``LONG`` characters (a text in a script
without blanks, words joined by other signs) is cut into overlapping pieces that count
as a word each, so all of it is read and a few characters in it aren't diluted either.

Defined results: null and empty texts, and those without a word, score with the
intercept alone; without labels of both classes every score is 0; a row's
score depends on its text alone; a document labelled more than once counts with
its highest label.
"""

from __future__ import annotations

from array import array
from dataclasses import dataclass
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from appraise.llm.common import map_batches, saved, split_words, train_in_rounds
from appraise.llm.quality_model import _hash64, _sigmoid, training_rows

_EDGES = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())


LONG, PIECE, STEP = 64, 24, 12
"""Words of more than ``LONG`` characters are cut into pieces of ``PIECE``, one each ``STEP`` (any 12 characters are whole in one)."""


@dataclass(frozen=True)
class Params:
    bits: int = 17
    """The embedding table has 2**bits rows."""
    dim: int = 8
    grams: tuple[int, ...] = (3, 4, 5)
    window: int = 3
    positives: int = 1500
    negatives: int = 2500
    """About so many labelled rows of each class are learned from."""
    shard_rows: int = 1000
    rounds: int = 2
    epochs: int = 5
    steps: int = 4
    """On the windows of one epoch."""
    rate: float = 0.1
    decay: float = 0.01


def tokens(text: str | None) -> list[str]:
    """Lower-cased words without symbols at their ends, between marks for these; long ones in pieces."""
    if not text:
        return []
    return [t for w in (x.strip(_EDGES) for x in split_words(text.lower())) if w for t in pieces(w)]


def pieces(word: str) -> list[str]:
    padded = f"<{word}>"
    if len(word) <= LONG:
        return [padded]
    return [padded[i : i + PIECE] for i in range(0, len(padded) - PIECE + STEP, STEP)]


def rows_of(token: str, p: Params) -> list[int]:
    """Embedding rows of a token: itself and its character n-grams."""
    mask = (1 << p.bits) - 1
    out = [_hash64(token) & mask]
    for n in p.grams:
        out += [_hash64(token[i : i + n]) & mask for i in range(len(token) - n + 1)]
    return out


def word_matrix(words: list[str], p: Params) -> tuple[np.ndarray, np.ndarray]:
    """Flat embedding rows of all words and the start of each word's part."""
    flat, starts = array("q"), np.zeros(len(words), np.int64)
    for i, w in enumerate(words):
        starts[i] = len(flat)
        flat.extend(rows_of(w, p))
    return np.frombuffer(flat, np.int64), starts


def window_means(x: np.ndarray, size: int) -> np.ndarray:
    """Means of all runs of ``size`` consecutive values (of all values, if there are fewer)."""
    if len(x) <= size:
        return x.mean(axis=0, keepdims=True)
    c = np.concatenate([np.zeros((1, *x.shape[1:])), np.cumsum(x, axis=0)])
    return (c[size:] - c[:-size]) / size


def train_shard(texts: list[str | None], labels: list[int], state: list[np.ndarray], p: Params, warm: bool) -> list[np.ndarray]:
    """Joint Adagrad epochs on one shard; the state is (embeddings, softmax, intercepts and their squared gradients)."""
    emb, soft, bias, g_emb, g_soft, g_bias = state
    docs = [tokens(t) for t in texts]
    vocabulary = {w: i for i, w in enumerate(dict.fromkeys(w for d in docs for w in d))}
    if not vocabulary:
        return state
    flat, starts = word_matrix(list(vocabulary), p)
    sizes = np.diff(np.append(starts, len(flat)))
    of_word = np.repeat(np.arange(len(starts)), sizes)
    ids = [np.fromiter((vocabulary[w] for w in d), np.int64, len(d)) for d in docs]
    used = [(i, y) for i, y in zip(ids, labels, strict=True) if len(i)]
    rng = np.random.default_rng(7)
    w, floor, touched = p.window, 1e-6, np.unique(flat)
    for epoch in range(p.epochs):
        if warm and epoch == 0:  # nothing is known yet: look at words that texts of label 1 have and others lack
            margin = _contrast(used, len(starts))
        else:
            margin = _word_vectors(emb, flat, starts, sizes) @ (soft[:, 1] - soft[:, 0])
        tops = [_best(window_means(margin[own], w), w, 1 if y else 3) for own, y in used]
        peak = np.array([m[0] for _, m in tops])
        ys = np.array([y for _, y in used])
        # A text labelled 1 whose best window looks like those of label 0 teaches nothing: its label may be wrong.
        bar = np.quantile(peak[ys == 0], 0.95) if (ys == 0).any() else -np.inf
        if ((ys == 1) & (peak > bar)).sum() < 0.2 * (ys == 1).sum():
            bar = np.quantile(peak[ys == 1], 0.5)
        picked, want = [], []
        for (own, y), (top, m) in zip(used, tops, strict=True):
            n = max(1, len(own) - w + 1)
            if y and m[0] <= bar:
                continue
            if not y:
                top = [*top, *rng.choice(n, min(n, 8), replace=False)]
            picked += [own[c : c + w] for c in top]
            want += [y] * len(top)
        if not want:
            continue
        y = np.array(want)
        weight = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))
        width = np.fromiter(map(len, picked), np.int64, len(picked))
        which = np.concatenate(picked)
        at = np.repeat(np.arange(len(picked)), width)
        for _ in range(p.steps):
            vec = _word_vectors(emb, flat, starts, sizes)
            mean = np.add.reduceat(vec[which], np.cumsum(width) - width, axis=0) / width[:, None]
            logits = mean @ soft + bias
            err = np.exp(logits - logits.max(axis=1, keepdims=True))
            err /= err.sum(axis=1, keepdims=True)
            err[np.arange(len(y)), y] -= 1.0
            err *= weight[:, None]
            d_mean = err @ soft.T / width[:, None]
            d_emb = _sums(flat, (_sums(which, d_mean[at], len(starts)) / sizes[:, None])[of_word], len(emb))
            # Squares are summed over windows, so a row that few windows have moves little in one step.
            of_row = np.bincount(which, (d_mean**2).sum(axis=1)[at], len(starts)) / sizes**2
            g_emb += np.bincount(flat, of_row[of_word], len(emb))[:, None]
            d_soft, d_bias = mean.T @ err, err.sum(axis=0)
            g_soft += ((err**2).sum() * (mean**2).mean() + d_soft**2) * 0.5
            g_bias += (err**2).sum(axis=0) + d_bias**2
            emb -= p.rate * d_emb / (np.sqrt(g_emb) + floor)
            emb[touched] *= 1 - p.decay
            soft -= p.rate * d_soft / (np.sqrt(g_soft) + 1e-12)
            bias -= p.rate * d_bias / (np.sqrt(g_bias) + 1e-12)
    return [emb, soft, bias, g_emb, g_soft, g_bias]


def _word_vectors(emb: np.ndarray, flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    return np.add.reduceat(emb[flat], starts, axis=0) / sizes[:, None]


def _contrast(used: list[tuple[np.ndarray, int]], n: int) -> np.ndarray:
    """Per word: how far the share of texts of label 1 that have it exceeds that of label 0, in standard errors (0 below 2)."""
    has = np.zeros((2, n))
    of = np.zeros(2)
    for own, y in used:
        has[y, np.unique(own)] += 1
        of[y] += 1
    of = np.maximum(of, 1)
    z = (has[1] / of[1] - has[0] / of[0]) / np.sqrt((has[1] + 0.1) / of[1] ** 2 + (has[0] + 0.1) / of[0] ** 2)
    return np.where(z > 2, z, 0.0)


def _best(m: np.ndarray, w: int, k: int) -> tuple[list[int], list[float]]:
    """Starts and values of the ``k`` highest windows that don't overlap."""
    m, out, got = m.copy(), [], []
    while len(out) < k and np.isfinite(m).any():
        t = int(np.argmax(m))
        out.append(t)
        got.append(float(m[t]))
        m[max(0, t - w + 1) : t + w] = -np.inf
    return out, got


def _sums(at: np.ndarray, x: np.ndarray, n: int) -> np.ndarray:
    return np.stack([np.bincount(at, x[:, k], n) for k in range(x.shape[1])], axis=1)


def _step(pdf: pd.DataFrame, state: list[np.ndarray], p: Params, warm: bool) -> list[np.ndarray]:
    pdf = pdf.sort_values(["doc_id", "y"])
    out = train_shard(pdf["text"].tolist(), [int(y > 0) for y in pdf["y"]], [x.astype(float) for x in state], p, warm)
    return [x.astype(np.float32) for x in out]


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", params: Params = Params()) -> list[np.ndarray] | None:
    """Embeddings, softmax and intercepts (fixed size); None without labels of both classes."""
    p = params
    one = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(label).alias(label))
    hot, rest = one.where(F.col(label) > 0), one.where(F.col(label) <= 0)
    a, _, _ = training_rows(docs, hot, label, p.positives, p.positives)
    b, _, _ = training_rows(docs, rest, label, p.negatives, p.negatives)
    rows = saved(docs.sparkSession, a.unionByName(b), "toxicity-sample")
    n = rows.groupBy("y").count().collect()
    if len(n) < 2:
        return None
    shards = max(1, sum(r["count"] for r in n) // p.shard_rows)
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(shards)).cast("int"))
    rng = np.random.default_rng(1)
    size = 1 << p.bits
    state = [rng.normal(0, 0.1, (size, p.dim)), rng.normal(0, 0.1, (p.dim, 2)), np.zeros(2)]
    state += [np.zeros((size, 1)), np.zeros((p.dim, 2)), np.zeros(2)]
    state = [x.astype(np.float32) for x in state]
    for i in range(p.rounds):

        state = train_in_rounds(rows, partial(_step, p=p, warm=i == 0), state, 1, shards)
    return state[:3]


class Scorer:
    """Scores texts with a model; the logit of every word is worked out once (up to ``keep`` words)."""

    def __init__(self, model: list[np.ndarray], params: Params, keep: int = 400_000):
        emb, soft, bias = model
        side = (soft[:, 1] - soft[:, 0]).astype(float)
        self.row_logit = emb.astype(float) @ side
        self.bias, self.p, self.keep, self.of = float(bias[1] - bias[0]), params, keep, {}

    def __call__(self, texts: list[str | None]) -> np.ndarray:
        docs = [tokens(t) for t in texts]
        if len(self.of) > self.keep:
            self.of = {}
        unseen = list(dict.fromkeys(w for d in docs for w in d if w not in self.of))
        for k in range(0, len(unseen), 20_000):
            some = unseen[k : k + 20_000]
            flat, starts = word_matrix(some, self.p)
            sizes = np.diff(np.append(starts, len(flat)))
            self.of.update(zip(some, (np.add.reduceat(self.row_logit[flat], starts) / sizes).tolist(), strict=True))
        out = np.empty(len(docs))
        for i, d in enumerate(docs):
            x = np.fromiter(map(self.of.__getitem__, d), float, len(d))
            out[i] = self.bias + (window_means(x, self.p.window).max() if len(x) else 0.0)
        return _sigmoid(out)


def score(docs: DataFrame, model: list[np.ndarray] | None, params: Params = Params()) -> DataFrame:
    """Add ``score`` and ``predicted`` to the rows of ``docs``; other columns stay."""
    docs = docs.drop("score", "predicted")
    held = docs.sparkSession.sparkContext.broadcast(model)
    own: list[Scorer] = []

    def run(batch):
        texts = batch.column("text").to_pylist()
        if held.value is None:
            p = np.zeros(len(texts))
        else:
            if not own:
                own.append(Scorer(held.value, params))
            p = np.concatenate([np.zeros(0), *[own[0](texts[i : i + 1000]) for i in range(0, len(texts), 1000)]])
        return {"score": p, "predicted": (p >= 0.5).astype(np.int32)}

    return map_batches(docs, run, T.StructType(list(docs.schema.fields)).add("score", "double").add("predicted", "integer"))
