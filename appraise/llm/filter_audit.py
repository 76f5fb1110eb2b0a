"""Operator 11: how filters interact, for every order in which they can be applied.

A document has one bit per filter (1: it fails). Documents are counted per part and
combination of bits, so n filters make a contingency tensor of shape 2 x ... x 2 for
every part; what any order of filters removes at any step is a contraction of that
tensor with one vector per axis: ``PASS`` (1, 0) for the filters applied before, ``FAIL``
(0, 1) for the one of the step, ``ALL`` (1, 1) for the others. The corpus is read once;
only tensors (parts x 2**n cells) reach the contraction, which runs in tasks.

The five filters of ``corpus_filters``: A too few words, B too few distinct words, C too
many capitals, D a markup sign, E an exact copy of a document with a smaller key.

Copies: rows of equal text share the bits A to D, so what differs is only who
came first. Rows are counted per text, part and labels (added up on the map side, so a text
that a third of all rows share is a few rows) with the least key and the number of rows that
have it; one window over these counts gives each text's least key.

Defined results: a null text is empty (and fails A; 100 * 0 < 80 * 0 doesn't hold, so it passes B
and C); empty texts are copies of one another; very long texts are read whole; a null part is the
empty string; a row with a null key neither is nor makes a copy; rows with the same key and text aren't
copies of each other; repeated label rows count once (1 if any of them is); a null label is not 1; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from appraise.llm.common import words

PASS, FAIL, ALL = (1, 0), (0, 1), (1, 1)
FILTERS = "ABCDE"
MIN_WORDS, MIN_DISTINCT, MAX_CAPITALS = 100, 80, 10
AT_ONCE = 64
"""Parts whose tensors are contracted together."""


def text_bits(text: Column) -> tuple[Column, ...]:
    """The conditions A to D of a text that isn't null."""
    w = words(text)
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    return (
        F.size(w) < MIN_WORDS,
        100 * F.size(F.array_distinct(w)) < MIN_DISTINCT * F.size(w),
        100 * capitals > MAX_CAPITALS * F.length(text),
        text.rlike(r"[#$%&*|]"),
    )


def flags(labels: DataFrame, key: str) -> DataFrame:
    """One row per key: whether any of its labels says good, and whether any says toxic."""
    one = [F.max(F.coalesce(F.col(c) == 1, F.lit(False)).cast("int")).alias(f"_{c}") for c in ("quality", "toxic")]
    return labels.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(*one)


def cells(docs: DataFrame, labels: DataFrame, key: str = "doc_id", part: str = "lang") -> DataFrame:
    """Rows per part and combination of failed filters: ``part``, ``mask`` (bit i: filter i fails), ``n``, ``good``, ``toxic``."""
    text = F.coalesce("text", F.lit(""))
    read = docs.select(F.col(key).alias("_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), text.alias("_t"))
    mask = sum(
        (F.when(bit, F.lit(1 << i)).otherwise(F.lit(0)) for i, bit in enumerate(text_bits(F.col("_t")))), F.lit(0)
    )
    rows = read.select("_id", "part", mask.alias("_mask"), F.unhex(F.md5("_t")).alias("_text"))
    # Rows without a key match no label: they are spread by their text instead of meeting in one task.
    rows = rows.withColumn("_spread", F.when(F.col("_id").isNull(), F.xxhash64("_text")).otherwise(F.lit(0)))
    known = flags(labels, key).withColumn("_spread", F.lit(0).cast("long"))
    marked = rows.join(
        known.withColumnRenamed("_spread", "_s"), (F.col("_id") == F.col("_key")) & (F.col("_spread") == F.col("_s")), "left"
    ).select("_id", "_spread", "_text", "_mask", "part", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("_quality", "_toxic")])
    same = ("_text", "_mask", "part", "_quality", "_toxic")
    by_key = marked.groupBy("_id", "_spread", *same).agg(F.count("*").alias("c"))
    by_text = by_key.groupBy(*same).agg(
        F.sum("c").alias("n"),
        F.min("_id").alias("least"),
        F.min_by("c", "_id").alias("at_least"),
        F.sum(F.when(F.col("_id").isNull(), F.col("c")).otherwise(F.lit(0))).alias("no_key"),
    )
    first = F.min("least").over(W.partitionBy("_text"))
    firsts = F.col("no_key") + F.when(F.col("least") == first, F.col("at_least")).otherwise(F.lit(0))
    split = by_text.select("part", "_mask", "_quality", "_toxic", "n", firsts.alias("firsts"))
    both = F.explode(
        F.array(
            F.struct(F.col("_mask").alias("mask"), F.col("firsts").alias("n")),
            F.struct((F.col("_mask") + (1 << 4)).alias("mask"), (F.col("n") - F.col("firsts")).alias("n")),
        )
    )
    return (
        split.select("part", "_quality", "_toxic", both.alias("x"))
        .groupBy("part", "x.mask")
        .agg(
            F.sum("x.n").alias("n"),
            F.sum(F.col("x.n") * F.col("_quality")).alias("good"),
            F.sum(F.col("x.n") * F.col("_toxic")).alias("toxic"),
        )
    )


class Steps:
    """All steps of all orders of n filters, and for each step the vectors that select along every axis."""

    def __init__(self, names: str):
        n = len(names)
        self.names = names
        self.orders = list(permutations(range(n)))
        self.order = np.repeat(["".join(names[i] for i in o) for o in self.orders], n)
        self.step = np.tile(np.arange(1, n + 1), len(self.orders))
        self.filter = np.array(self.orders).ravel()
        self.kept, self.removed, self.failing = (np.ones((len(self.step), n, 2), np.int64) for _ in range(3))
        self.only = np.zeros((len(self.step), n, 2), np.int64) + PASS
        for s, (o, k) in enumerate((o, k) for o in self.orders for k in range(n)):
            self.kept[s, list(o[: k + 1])] = PASS
            self.removed[s, list(o[:k])] = PASS
            self.removed[s, o[k]] = self.failing[s, o[k]] = self.only[s, o[k]] = FAIL

    def contract(self, tensors: np.ndarray, select: np.ndarray) -> np.ndarray:
        """Parts x steps: each part's 2 x ... x 2 tensor, contracted with the step's vectors."""
        n = len(self.names)
        axes = "abcdefghijkl"[:n]
        return np.einsum(
            f"p{axes},{','.join(f's{a}' for a in axes)}->ps", tensors, *(select[:, i] for i in range(n)), optimize="greedy"
        )

    def rows(self, parts: list[str], tensors: np.ndarray) -> pd.DataFrame:
        """The audit of some parts; ``tensors``: parts x (all, good, toxic) x 2 x ... x 2, the first filter as first axis."""
        every, good, toxic = (tensors[:, i] for i in range(3))
        removed = self.contract(every, self.removed)
        shapley = np.zeros((len(parts), len(self.names)), np.int64)
        for i in range(len(self.names)):
            shapley[:, i] = removed[:, self.filter == i].sum(axis=1)
        columns = {
            "kept": self.contract(every, self.kept),
            "removed": removed,
            "redundant": self.contract(every, self.failing) - removed,
            "unique_fails": self.contract(every, self.only),
            "good_lost": self.contract(good, self.removed),
            "toxic_lost": self.contract(toxic, self.removed),
            "shapley": shapley[:, self.filter],
        }
        n = len(parts)
        out = {"part": np.repeat(parts, len(self.step)), "filter_order": np.tile(self.order, n), "step": np.tile(self.step, n)}
        return pd.DataFrame(out | {c: v.ravel() for c, v in columns.items()})


def audit(counts: DataFrame, names: str = FILTERS) -> DataFrame:
    """One row per part, order of the filters and step, from counts per part and combination of failed filters.

    ``counts`` has ``part``, ``mask`` (bit i: the i-th of ``names`` fails), ``n``, ``good``, ``toxic``. n filters have
    n! orders: meant for up to seven.
    """
    n = len(names)
    # 2**n entries a part at most.
    tensors = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        steps = Steps(names)
        for batch in batches:
            for at in range(0, len(batch), AT_ONCE):
                piece = batch.iloc[at : at + AT_ONCE]
                flat = np.zeros((len(piece), 3, 1 << n), np.int64)
                for i, got in enumerate(piece["cells"]):
                    for c in got:
                        flat[i, :, c["mask"]] += (c["n"], c["good"], c["toxic"])
                # The last axis of a reshaped array is bit 0: turn the axes round, so that axis i is filter i.
                shaped = flat.reshape(len(piece), 3, *[2] * n).transpose(0, 1, *range(n + 1, 1, -1))
                yield steps.rows(list(piece["part"]), shaped)

    longs = ", ".join(f"{c} long" for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"))
    return tensors.mapInPandas(run, f"part string, filter_order string, step int, {longs}")


def corpus_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of the five filters over whole texts, per language."""
    return audit(cells(docs, labels))


def oracle() -> str:
    """The same result in DuckDB's SQL over ``documents`` and ``labels``."""
    return r"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
      FROM labels GROUP BY doc_id),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws, min(doc_id) OVER (PARTITION BY t) AS first FROM d),
m AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
        CASE WHEN len(ws) < 100 THEN 1 ELSE 0 END
      + CASE WHEN 100 * len(list_distinct(ws)) < 80 * len(ws) THEN 2 ELSE 0 END
      + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > 10 * length(t) THEN 4 ELSE 0 END
      + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
      + CASE WHEN w.doc_id > first THEN 16 ELSE 0 END AS mask
      FROM w LEFT JOIN l ON l.doc_id = w.doc_id),
c AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY ALL),
f(name, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
o AS (SELECT a.name || b.name || c.name || d.name || e.name AS filter_order,
             [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
      FROM f a, f b, f c, f d, f e WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31
        AND len(list_distinct([a.bit, b.bit, c.bit, d.bit, e.bit])) = 5),
s AS (SELECT filter_order, step, bits[step] AS bit, CAST(coalesce(list_sum(bits[1:step - 1]), 0) AS INTEGER) AS before
      FROM o, (SELECT unnest(range(1, 6)) AS step)),
r AS (SELECT part, filter_order, step, bit,
        sum(CASE WHEN mask & (before | bit) = 0 THEN n ELSE 0 END) AS kept,
        sum(CASE WHEN mask & bit > 0 AND mask & before = 0 THEN n ELSE 0 END) AS removed,
        sum(CASE WHEN mask & bit > 0 AND mask & before > 0 THEN n ELSE 0 END) AS redundant,
        sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
        sum(CASE WHEN mask & bit > 0 AND mask & before = 0 THEN good ELSE 0 END) AS good_lost,
        sum(CASE WHEN mask & bit > 0 AND mask & before = 0 THEN toxic ELSE 0 END) AS toxic_lost
      FROM c, s GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM r"""
