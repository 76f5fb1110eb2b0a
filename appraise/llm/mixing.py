"""Operator 8: mixing sources to target weights.

Each source's documents form one stream of words, cut into blocks of ``block``
words. A shard of the output draws how many of its slots each source fills from a
multinomial; slots of a source are numbered across shards, and what the draws of
a source exceed or miss its quota by is handed to sources that miss some, so the
totals meet the targets whatever the draws. Slot k of a source goes through a
pseudorandom permutation of its block numbers (a Feistel network with cycle walking, keyed
by source and epoch), so all blocks are used equally often up to one, and
blocks are joined to slots by their number. The last slot of a source takes the first words of
its block only, as many as its target (rounded to a word) still lacks, so every source ends within half a word of it. Shards depend on nothing but their
number, so any of them can be made again alone and reruns agree.

Weights are 5, 2, 1, repeating over the sources by code point, null last. Targets
share all words by weight; what a source would get beyond ``most`` times its size is
shared by the others. Driver and tasks hold the list of sources (checked to be at most
``MAX_SOURCES``), never documents. Defined results: null and blank texts have
size 0 and are taken 0 times; an empty table gives an empty mix; repeated rows count each;
null ids are rows like others; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from appraise.llm.common import saved, words

SLOTS_AT_ONCE = 200_000
MAX_SOURCES = 100_000
WEIGHTS = (5.0, 2.0, 1.0)


@dataclass
class Sources:
    """Per source, in order: its name, words, blocks, target in words, quota in slots and the words of the last slot."""

    names: list[str | None]
    size: np.ndarray
    blocks: np.ndarray
    target: np.ndarray
    quota: np.ndarray
    last: np.ndarray
    rows: int


@dataclass
class Mix:
    """``rows`` (key, source, size, index of the source, place in its stream), ``fragments`` (source index, block,
    place, words, first word in the row) and ``slots`` (shard, slot, source index, block, words taken from the block's start)."""

    sources: Sources
    rows: DataFrame
    fragments: DataFrame
    slots: DataFrame
    block: int


def shares(size: np.ndarray, weights: np.ndarray, most: float) -> np.ndarray:
    """Targets that share all words by weight, none above ``most`` times its size."""
    size, total = np.asarray(size, float), float(np.sum(size))
    target, full = np.zeros(len(size)), size <= 0
    while not full.all():
        left = total - (most * size[full]).sum()
        target = np.where(full, most * size, left * weights / weights[~full].sum())
        over = ~full & (target > most * size)
        if not over.any():
            return target
        full |= over
    return np.where(full, most * size, target)


def quotas(size: np.ndarray, blocks: np.ndarray, target: np.ndarray, block: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Per source: the slots that reach its target, and the words that the last of them takes."""
    want = np.rint(target).astype(np.int64)
    quota, last = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
    for s in np.flatnonzero((size > 0) & (want > 0)):
        n, end = int(blocks[s]), int(size[s] - (blocks[s] - 1) * block)  # the stream's last block has ``end`` words
        epoch, left = divmod(int(want[s]) - 1, int(size[s]))
        left += 1  # words of the last epoch, 1 to size
        at = place_of(n - 1, n, key_of(seed, int(s), epoch))  # the last block's place in that epoch
        short = left > at * block  # the last epoch comes as far as the last block
        if short and left > at * block + end:
            left += block - end  # as if that block were whole
        k = -(-left // block)
        quota[s], last[s] = epoch * n + k, left - (k - 1) * block
    return quota, last


def measure(sized: DataFrame, block: int, most: float, seed: int) -> Sources:
    got = sized.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("n")).limit(MAX_SOURCES + 1).collect()
    if len(got) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    got.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
    size = np.array([r["size"] for r in got], np.int64)
    weights = np.array([WEIGHTS[i % len(WEIGHTS)] for i in range(len(got))])
    target, blocks = shares(size, weights, most), -(-size // block)
    quota, last = quotas(size, blocks, target, block, seed)
    return Sources([r["source"] for r in got], size, blocks, target, quota, last, sum(r["n"] for r in got))


def streams(sized: DataFrame, sources: Sources, per_bucket: int = 20_000) -> DataFrame:
    """Add each row's source index ``s`` and the place of its first word in its source's stream.

    Rows are dealt into buckets by hash, the totals of buckets are summed up over the buckets of a source, and
    places are counted inside a bucket, so no source is ordered in one task.
    """
    spark, buckets = sized.sparkSession, max(16, sources.rows // per_bucket)
    names = pa.table({"s": pa.array(range(len(sources.names)), pa.int32()), "name": pa.array(sources.names, pa.string())})
    index = F.broadcast(spark.createDataFrame(names, "s int, name string"))  # at most MAX_SOURCES rows
    rows = sized.join(index, sized["source"].eqNullSafe(index["name"])).drop("name")
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("key", "size"), F.lit(buckets)).cast("int"))
    totals = rows.groupBy("s", "bucket").agg(F.sum("size").alias("n"))
    before = F.sum("n").over(W.partitionBy("s").orderBy("bucket").rowsBetween(W.unboundedPreceding, 0)) - F.col("n")
    totals = totals.select("s", "bucket", before.alias("before"))
    own = W.partitionBy("s", "bucket").orderBy("key", "size").rowsBetween(W.unboundedPreceding, 0)
    rows = rows.withColumn("upto", F.sum("size").over(own)).join(totals, ["s", "bucket"])
    return rows.select("key", "source", "size", "s", (F.col("before") + F.col("upto") - F.col("size")).alias("place"))


def key_of(seed: int, s: int, epoch: int) -> int:
    return seed * 1_000_003 + s * 101 + epoch


def _network(n: int, key: int) -> tuple[int, list[np.uint64]]:
    """Bits of a half and the round keys."""
    half = max(1, (int(n - 1).bit_length() + 1) // 2)
    return half, [np.uint64((key * 0x9E3779B97F4A7C15 + r * 0xD1B54A32D192ED03 + 1) % (1 << 64)) for r in range(6)]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return ((x ^ (x >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)) >> np.uint64(33)


def permuted(k: np.ndarray, n: int, key: int) -> np.ndarray:
    """A pseudorandom permutation of range(n), applied to ``k``."""
    half, keys = _network(n, key)
    mask = np.uint64((1 << half) - 1)
    out, todo = k.astype(np.uint64), np.ones(len(k), bool)
    while todo.any():
        left, right = out[todo] >> np.uint64(half), out[todo] & mask
        for r in keys:
            left, right = right, left ^ (_mixed(right + r) & mask)
        out[todo] = left << np.uint64(half) | right
        todo = out >= np.uint64(n)
    return out.astype(np.int64)


def place_of(block: int, n: int, key: int) -> int:
    """The k that ``permuted`` maps to ``block``."""
    half, keys = _network(n, key)
    mask, out = np.uint64((1 << half) - 1), np.array([block], np.uint64)
    while True:
        left, right = out >> np.uint64(half), out & mask
        for r in reversed(keys):
            left, right = right ^ (_mixed(left + r) & mask), left
        out = left << np.uint64(half) | right
        if out[0] < n:
            return int(out[0])


def drawn_counts(spark, sources: Sources, shard_slots: int, seed: int) -> DataFrame:
    """shard, s and n: the multinomial draw of every shard."""
    total = int(sources.quota.sum())
    p, shards = sources.quota / max(1, total), -(-total // shard_slots)

    def draw(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            for shard in pdf["id"]:
                size = min(shard_slots, total - int(shard) * shard_slots)
                n = np.random.default_rng([seed, int(shard)]).multinomial(size, p)
                at = np.flatnonzero(n)
                yield pd.DataFrame({"shard": shard, "s": at.astype(np.int32), "n": n[at]})

    return spark.range(shards).mapInPandas(draw, "shard long, s int, n long")


def slot_table(spark, sources: Sources, block_words: int, shard_slots: int, seed: int) -> DataFrame:
    """shard, slot, s, block and words to take of every slot of the output."""
    counts = saved(spark, drawn_counts(spark, sources, shard_slots, seed), "draws")
    got = np.zeros(len(sources.names), np.int64)
    for r in counts.groupBy("s").agg(F.sum("n").alias("n")).collect():
        got[r["s"]] = r["n"]
    quota, blocks, last = sources.quota, sources.blocks, sources.last
    extra = np.maximum(got - quota, 0)
    lack = np.maximum(quota - got, 0)
    extra_from, lack_from = np.cumsum(extra) - extra, np.cumsum(lack) - lack
    first = F.sum("n").over(W.partitionBy("s").orderBy("shard").rowsBetween(W.unboundedPreceding, 0)) - F.col("n")
    in_shard = F.sum("n").over(W.partitionBy("shard").orderBy("s").rowsBetween(W.unboundedPreceding, 0)) - F.col("n")
    numbered = counts.withColumn("first", first).withColumn("slot", in_shard)

    def bounded(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows of about ``SLOTS_AT_ONCE`` slots; one row has at most ``shard_slots``."""
        for pdf in it:
            if len(pdf):
                part = np.cumsum(pdf["n"].to_numpy()) // SLOTS_AT_ONCE
                yield from (own for _, own in pdf.groupby(part))

    def fill(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in bounded(it):
            n = pdf["n"].to_numpy()
            run = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            s, k = np.repeat(pdf["s"].to_numpy(np.int64), n), np.repeat(pdf["first"].to_numpy(), n) + run
            over = np.flatnonzero(k >= quota[s])
            e = extra_from[s[over]] + k[over] - quota[s[over]]
            to = np.searchsorted(lack_from + lack, e, side="right")
            s[over], k[over] = to, got[to] + e - lack_from[to]
            block = np.zeros(len(s), np.int64)
            epoch = k // blocks[s]
            groups = s << 32 | epoch
            order = np.argsort(groups, kind="stable")
            for at in np.split(order, np.flatnonzero(np.diff(groups[order])) + 1):
                one = int(s[at[0]])
                block[at] = permuted(k[at] % blocks[one], int(blocks[one]), key_of(seed, one, int(epoch[at[0]])))
            shard, slot = np.repeat(pdf["shard"].to_numpy(), n), np.repeat(pdf["slot"].to_numpy(), n) + run
            take = np.where(k == quota[s] - 1, last[s], block_words)
            yield pd.DataFrame({"shard": shard, "slot": slot, "s": s.astype(np.int32), "block": block, "take": take})

    return numbered.mapInPandas(fill, "shard long, slot long, s int, block long, take long")


def mix(
    docs: DataFrame,
    key: str = "doc_id",
    source: str = "source",
    block: int = 128,
    most: float = 3.0,
    shard_slots: int = 4096,
    seed: int = 20,
) -> Mix:
    spark = docs.sparkSession
    sized = docs.select(
        F.col(key).alias("key"), F.col(source).cast("string").alias("source"), F.size(words(F.col("text"))).cast("long").alias("size")
    )
    sized = saved(spark, sized, "sizes")
    sources = measure(sized, block, most, seed)
    rows = saved(spark, streams(sized, sources), "streams")
    number = F.explode(F.sequence(F.floor(F.col("place") / block), F.floor((F.col("place") + F.col("size") - 1) / block)))
    end = F.least(F.col("place") + F.col("size"), (F.col("block") + 1) * block)
    fragments = (
        rows.where("size > 0")
        .select("key", "s", "place", "size", number.alias("block"))
        .withColumn("from", F.greatest(F.col("place"), F.col("block") * block))
        .select("key", "s", "block", "place", (F.col("from") - F.col("place")).alias("first"), (end - F.col("from")).alias("n"))
    )
    # Written out: its size then is known, so joins with it aren't planned as broadcasts of what is really large.
    slots = saved(spark, slot_table(spark, sources, block, shard_slots, seed), "slots")
    return Mix(sources, rows, fragments, slots, block)


def taken_of_piece(m: Mix, take: Column) -> Column:
    """How many words of a fragment lie among the first ``take`` of its block."""
    before = F.col("place") + F.col("first") - F.col("block") * m.block
    return F.greatest(F.least(F.col("n"), take - before), F.lit(0))


def assemble(m: Mix) -> DataFrame:
    """The mixed output: for each shard and slot the pieces of documents (key, first word, words) that fill it, in order of place.

    Pieces behind the words that the last slot of a source takes have 0 words.
    """
    pieces = m.slots.join(m.fragments, ["s", "block"])
    return pieces.select("shard", "slot", "s", "block", "place", "key", "first", taken_of_piece(m, F.col("take")).alias("n"))


def taken(m: Mix, key: str = "doc_id") -> DataFrame:
    """Per row: key, source, size, source_size, target and the words of it that the mix takes, repeats counted."""
    spark = m.rows.sparkSession
    part = F.col("take") < m.block  # at most one slot of a source
    uses = m.slots.groupBy("s", "block").agg(F.count(F.when(~part, 1)).alias("uses"), F.coalesce(F.max(F.when(part, F.col("take"))), F.lit(0)).alias("part"))
    of = F.col("n") * F.col("uses") + taken_of_piece(m, F.col("part"))
    words_taken = m.fragments.join(uses, ["s", "block"]).groupBy("s", "place").agg(F.sum(of).alias("taken"))
    n = len(m.sources.names)
    facts = pa.table({"s": pa.array(range(n), pa.int32()), "source_size": m.sources.size.astype(np.int64), "target": m.sources.target.astype(float)})
    facts = F.broadcast(spark.createDataFrame(facts, "s int, source_size long, target double"))  # at most MAX_SOURCES rows
    got = m.rows.withColumn("at", F.when(F.col("size") > 0, F.col("place")))
    words_taken = words_taken.withColumnRenamed("place", "at")
    return got.join(words_taken, ["s", "at"], "left").join(facts, "s").select(
        F.col("key").alias(key), "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")
    )
