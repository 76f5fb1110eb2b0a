"""Operator 10: benchmark decontamination, n-gram seeds and Smith-Waterman alignment.

Words are lower-cased runs of word characters. An item's seeds are the rarest of its word n-grams, and all that no other item
has. Rarity is counted over the items alone, so whether a document matches doesn't depend on what other documents hold. How many are
enough: a word replaced, left out or put in breaks at most ``n`` n-grams, so with ``n * k + 1`` of them a copy with up to ``k``
edits keeps a seed, whichever words were edited; ``k`` is a fifth of the item's words and at least four (``Params``). A copy with more
edits is found if one of its seeds is left.

Seeds are looked for in whole texts. The passage around each cluster of seeds of one item is
aligned with the item (local alignment of words: match 1, mismatch -0.5, gap
-0.5). Passages whose words can't reach the least score in any order are not aligned
(``at_most``, which never loses a match). The score is the alignment's value over the item's length, 1 for a whole copy;
``min_score`` and more is a match.

Test items are measured first. Up to ``block_chars`` characters of them are sent to all tasks, and documents aren't
shuffled. Beyond that seeds join documents by shuffle (``joined``): texts give the n-grams that a bitmap of fixed size lets
through, these meet the items' seeds by code and salt, and passages meet their items by number and salt. Both ways give the same matches.

Defined results: null and empty texts and items without
a word match nothing; very long texts are read whole; an item of fewer words than an n-gram is one seed as a whole;
repeated rows and items match one by one; of passages that tie the first counts; null ids are reported as null; empty
tables give no matches; other columns of the documents stay as they are, those of the items are ignored.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from appraise.llm.chunks import rolled
from appraise.llm.common import free_name, map_batches, saved

_WORDS = re.compile(r"\w+").findall
MATCH, MISMATCH, GAP = 1.0, -0.5, -0.5
MATCHES = T.ArrayType(
    T.StructType()
    .add("item_id", "long")
    .add("score", "double")
    .add("n_seeds", "integer")
    .add("first_word", "long")
    .add("last_word", "long")
)


@dataclass(frozen=True)
class Params:
    n: int = 3
    min_score: float = 0.5
    edits: float = 0.2
    """Copies with this share of an item's words edited, or ``least_edits``, keep a seed for certain."""
    least_edits: int = 4
    block_chars: int = 4_000_000
    """Characters of test items that are broadcast at most; more of them are joined by shuffle."""
    bitmap_bits: int = 1 << 26
    salts: int = 16

    def enough(self, words: int) -> int:
        """So many n-grams of an item are seeds at least."""
        return self.n * max(self.least_edits, -int(-words * self.edits // 1)) + 1


@dataclass
class Items:
    """Test items: word ids, and the codes of seeds with the items that have them."""

    ids: list[int | None]
    words: list[np.ndarray]
    vocabulary: dict[str, int]
    codes: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    owners: dict[int, list[int]] = field(default_factory=dict)


def tokens(text: str | None) -> list[str]:
    return _WORDS(text.lower()) if text else []


def coded(ids: np.ndarray, n: int, base: int) -> np.ndarray:
    """A code for the n words from each position on, -1 where one of them is unknown (id 0)."""
    size = len(ids) - n + 1
    if size <= 0:
        return np.zeros(0, np.int64)
    out, known = np.zeros(size, np.int64), np.ones(size, bool)
    for i in range(n):
        part = ids[i : i + size]
        out = (out * base + part) % ((1 << 61) - 1) if base < 1 << 30 else out * base + part
        known &= part > 0
    return np.where(known, out, -1)


def read_items(rows: list, p: Params) -> Items:
    vocabulary: dict[str, int] = {}
    words = [np.array([vocabulary.setdefault(w, len(vocabulary) + 1) for w in tokens(r["text"])], np.int64) for r in rows]
    items = Items([r["item_id"] for r in rows], words, vocabulary)
    grams = [coded(w, min(p.n, max(1, len(w))), len(vocabulary) + 1).tolist() for w in words]
    n_items = Counter((min(p.n, len(w)), c) for w, own in zip(words, grams, strict=True) for c in set(own))
    owners = defaultdict(set)
    for i, (w, own) in enumerate(zip(words, grams, strict=True)):
        keys = [(min(p.n, len(w)), c) for c in own]
        order = sorted(range(len(keys)), key=lambda at: (n_items[keys[at]], spread(at)))
        for rank, at in enumerate(order):
            if rank < p.enough(len(w)) or n_items[keys[at]] == 1:
                owners[keys[at]].add(i)
    items.owners = {k: sorted(v) for k, v in owners.items()}
    return items


def spread(at):
    """Orders positions of equal rarity so that those of any stretch of an item come early and late."""
    return at * 2654435761 % (1 << 32)


class Finder:
    """Seeds in texts. Codes of each n-gram length are looked up in a sorted array, beside which their items lie in a row."""

    def __init__(self, items: Items):
        self.items, self.base = items, len(items.vocabulary) + 1
        self.sizes = np.fromiter(map(len, items.words), np.int64, len(items.words))
        self.of = {}
        for n in sorted({n for n, _ in items.owners}):
            codes = sorted(c for m, c in items.owners if m == n)
            count = np.fromiter((len(items.owners[n, c]) for c in codes), np.int64, len(codes))
            flat = np.fromiter((i for c in codes for i in items.owners[n, c]), np.int64, int(count.sum()))
            self.of[n] = np.array(codes, np.int64), np.cumsum(count) - count, count, flat

    def encode(self, text: str | None) -> np.ndarray:
        got = tokens(text)
        look = self.items.vocabulary.get
        return np.fromiter((look(w, 0) for w in got), np.int64, len(got))

    def clusters(self, ids: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """Items and the positions of their seeds, cut where the next is more than the item's length away."""
        who, where = [], []
        for n, (codes, starts, count, flat) in self.of.items():
            c = coded(ids, n, self.base)
            at = np.searchsorted(codes, c)
            at[at == len(codes)] = 0
            found = np.flatnonzero(codes[at] == c)
            k = at[found]
            run = np.arange(int(count[k].sum())) - np.repeat(np.cumsum(count[k]) - count[k], count[k])
            who.append(flat[np.repeat(starts[k], count[k]) + run])
            where.append(np.repeat(found, count[k]))
        who, where = np.concatenate(who), np.concatenate(where)
        if not len(who):
            return
        order = np.lexsort((where, who))
        who, where = who[order], where[order]
        cuts = np.flatnonzero((np.diff(who) > 0) | (np.diff(where) > self.sizes[who[:-1]])) + 1
        for first, own in zip([0, *cuts.tolist()], np.split(where, cuts), strict=True):
            yield int(who[first]), own


def at_most(item: np.ndarray, passage: np.ndarray) -> float:
    """What no local alignment exceeds: a passage word adds 1 if the item has it, and else costs a mismatch or gap."""
    upto = np.concatenate([[0.0], np.cumsum(np.where(np.isin(passage, item), MATCH, max(MISMATCH, GAP)))])
    return float((upto - np.minimum.accumulate(upto)).max())


def local_alignment(item: np.ndarray, passage: np.ndarray) -> tuple[float, int, int]:
    """Value of the best local alignment of two word sequences, and where it ends and begins in the passage."""
    j = np.arange(len(passage) + 1)
    h, start = np.zeros(len(passage) + 1), j.copy()
    best = (0.0, 0, 0)
    for w in item:
        diagonal = h[:-1] + np.where(passage == w, MATCH, MISMATCH)
        up = h[1:] + GAP
        x = np.concatenate([[0.0], np.maximum(np.maximum(diagonal, up), 0.0)])
        s = np.concatenate([[0], np.where(diagonal >= up, start[:-1], start[1:])])
        s = np.where(x > 0, s, j)
        # A gap in the item: the best of all cells to the left, less a gap for each step.
        lifted = x - GAP * j
        top = np.maximum.accumulate(lifted)
        source = np.maximum.accumulate(np.where(lifted == top, j, 0))
        h = top + GAP * j
        start = np.where(h > x, s[source], s)
        h = np.maximum(h, x)
        k = int(np.argmax(h))
        if h[k] > best[0]:
            best = (float(h[k]), k, int(start[k]))
    return best


def matches(finder: Finder, text: str | None, p: Params) -> list[tuple]:
    """Items whose alignment with a passage of the text scores ``min_score`` or more, the best passage of each."""
    ids, items = finder.encode(text), finder.items
    best: dict[int, tuple] = {}
    for i, cluster in finder.clusters(ids):
        item = items.words[i]
        m = len(item)
        low, high = max(0, int(cluster[0]) - m), min(len(ids), int(cluster[-1]) + m + p.n)
        if at_most(item, ids[low:high]) / m < p.min_score:
            continue
        value, end, begin = local_alignment(item, ids[low:high])
        score = value / m
        if score >= p.min_score and (i not in best or score > best[i][1]):
            best[i] = (items.ids[i], score, len(cluster), low + begin, low + end - 1)
    return [best[i] for i in sorted(best)]


def find(docs: DataFrame, benchmark: DataFrame, params: Params = Params(), into: str = "matches") -> DataFrame:
    """Add the column ``into`` (item_id, score, n_seeds, first_word, last_word) to every row of ``docs``; other columns stay."""
    p = params
    items = benchmark.select("item_id", "text").where("text is not null")
    docs = docs.drop(into)
    total = items.agg(F.sum(F.length("text")).alias("n")).first()["n"] or 0
    if total > p.block_chars:
        return joined(docs, items, p, into)
    rows = sorted(items.collect(), key=lambda r: (r["item_id"] is None, r["item_id"] or 0, r["text"]))
    block = read_items(rows, p)
    if not block.owners:
        return docs.withColumn(into, F.array().cast(MATCHES))
    held = docs.sparkSession.sparkContext.broadcast(Finder(block))
    names = MATCHES.elementType.names

    def run(batch):
        got = [matches(held.value, t, p) for t in batch.column("text").to_pylist()]
        return {into: [[dict(zip(names, m, strict=True)) for m in g] for g in got]}

    return map_batches(docs, run, T.StructType(list(docs.schema.fields)).add(into, MATCHES))


def hashed(words: list[str], n: int) -> np.ndarray:
    """64-bit codes of the n words from each position on."""
    import xxhash

    digests = {w: xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass")) for w in set(words)}
    base = np.uint64(0x9E3779B97F4A7C15 + 2 * n)  # odd, another one for each length
    return rolled(np.fromiter(map(digests.__getitem__, words), np.uint64, len(words)), n, base).view(np.int64)


def rows_of(df: DataFrame, fn, schema: str) -> DataFrame:
    """``mapInArrow`` with a function from a record batch to columns of any number of rows."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for at in range(0, batch.num_rows, 100):
                yield from fn(batch.slice(at, 100))

    return df.mapInArrow(run, schema)


def columns_of(parts: list[tuple], types: dict) -> Iterator[pa.RecordBatch]:
    """One record batch of the parts' arrays, one under the other."""
    if parts:
        arrays = [pa.array(np.concatenate(of), t) for of, t in zip(zip(*parts, strict=True), types.values(), strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, list(types))


def rare_seeds(items: DataFrame, p: Params) -> DataFrame:
    """i, m (words of the item) and code of every seed of ``items`` (i, text)."""
    types = {"i": pa.int64(), "m": pa.int64(), "pos": pa.int64(), "code": pa.int64()}

    def grams(batch):
        parts = []
        for i, text in zip(batch.column("i").to_pylist(), batch.column("text").to_pylist(), strict=True):
            words = tokens(text)
            codes = hashed(words, min(p.n, len(words))) if words else np.zeros(0, np.int64)
            k = len(codes)
            parts.append((np.full(k, i), np.full(k, len(words)), np.arange(k), codes))
        return columns_of(parts, types)

    found = saved(items.sparkSession, rows_of(items, grams, "i long, m long, pos long, code long"), "grams")
    n_items = found.select("i", "code").distinct().groupBy("code").agg(F.count("*").alias("n"))
    enough = p.n * F.greatest(F.lit(p.least_edits), F.ceil(F.col("m") * p.edits)) + 1
    rank = F.row_number().over(W.partitionBy("i").orderBy("n", spread(F.col("pos"))))
    ranked = found.join(n_items, "code").withColumn("rank", rank)
    return ranked.where((F.col("rank") <= enough) | (F.col("n") == 1)).select("i", "m", "code").distinct()


def bitmap(seeds: DataFrame, bits: int) -> np.ndarray:
    """A bit for each code modulo ``bits``: a bounded picture of any number of seeds."""
    slot = F.pmod(F.col("code"), F.lit(bits))
    one = F.expr(f"shiftleft(1L, cast(pmod(code, {bits}L) % 64 as int))")
    got = seeds.select(F.floor(slot / 64).cast("long").alias("at"), one.alias("one")).groupBy("at").agg(F.bit_or("one").alias("all")).toArrow()
    out = np.zeros(-(-bits // 64), np.uint64)
    out[got["at"].to_numpy()] = got["all"].to_numpy().view(np.uint64)
    return out


def joined(docs: DataFrame, items: DataFrame, p: Params, into: str) -> DataFrame:
    """``find`` for any number of test items: seeds, passages and items meet by shuffle."""
    spark = docs.sparkSession
    row = free_name(docs, "row")
    docs = saved(spark, docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    texts = docs.select(F.col(row).alias("r"), "text").where("text is not null")
    items = saved(spark, items.withColumn("i", F.monotonically_increasing_id()), "items")
    seeds = saved(spark, rare_seeds(items.select("i", "text"), p), "seeds")
    held = spark.sparkContext.broadcast(bitmap(seeds, p.bitmap_bits))  # bitmap_bits / 8 bytes
    types = {"r": pa.int64(), "code": pa.int64(), "pos": pa.int64()}

    def seen(batch):
        parts = []
        for r, text in zip(batch.column("r").to_pylist(), batch.column("text").to_pylist(), strict=True):
            words = tokens(text)
            for n in range(1, min(p.n, len(words)) + 1):
                codes = hashed(words, n)
                slot = codes % p.bitmap_bits
                at = np.flatnonzero(held.value[slot >> 6] >> (slot & 63).astype(np.uint64) & np.uint64(1))
                parts.append((np.full(len(at), r), codes[at], at))
        return columns_of(parts, types)

    hits = rows_of(texts, seen, "r long, code long, pos long")
    salt, every = F.pmod(F.xxhash64("r"), F.lit(p.salts)), F.explode(F.expr(f"sequence(0L, {p.salts - 1}L)"))
    pairs = hits.withColumn("salt", salt).join(seeds.withColumn("salt", every), ["code", "salt"])
    # All that one document holds of one item, and then of all items: bounded by the document.
    found = pairs.groupBy("r", "i", "m").agg(F.sort_array(F.collect_set("pos")).alias("at"))
    found = found.groupBy("r").agg(F.collect_list(F.struct("i", "m", "at")).alias("found"))

    def passages(batch):
        out = []
        for r, text, own in zip(*[batch.column(c).to_pylist() for c in ("r", "text", "found")], strict=True):
            words = tokens(text)
            for x in own:
                m, at = x["m"], np.array(x["at"])
                for cluster in np.split(at, np.flatnonzero(np.diff(at) > m) + 1):
                    low, high = max(0, int(cluster[0]) - m), int(cluster[-1]) + m + p.n
                    out.append((r, x["i"], low, len(cluster), " ".join(words[low:high])))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], ["r", "i", "low", "n_seeds", "passage"])

    around = rows_of(texts.join(found, "r"), passages, "r long, i long, low long, n_seeds long, passage string")
    both = around.withColumn("salt", salt).join(items.withColumn("salt", every), ["i", "salt"])

    def aligned(batch):
        out = []
        names = ("r", "i", "item_id", "text", "low", "n_seeds", "passage")
        for r, i, item_id, text, low, n_seeds, passage in zip(*[batch.column(c).to_pylist() for c in names], strict=True):
            ids: dict[str, int] = {}
            a, b = (np.array([ids.setdefault(w, len(ids)) for w in x]) for x in (tokens(text), passage.split(" ")))
            if at_most(a, b) / len(a) >= p.min_score:
                value, end, begin = local_alignment(a, b)
                if value / len(a) >= p.min_score:
                    out.append((r, i, item_id, value / len(a), n_seeds, low + begin, low + end - 1))
        if out:
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.int32(), pa.int64(), pa.int64()]
            columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, ["r", "i", *MATCHES.elementType.names])

    scored = rows_of(both, aligned, "r long, i long, item_id long, score double, n_seeds int, first_word long, last_word long")
    match = F.struct(*MATCHES.elementType.names)
    best = scored.groupBy("r", "i").agg(F.max_by(match, F.struct("score", -F.col("first_word"))).alias("m"))
    lists = best.groupBy("r").agg(F.sort_array(F.collect_list("m")).cast(MATCHES).alias(into)).withColumnRenamed("r", row)
    out = docs.join(lists, row, "left")
    return out.select(*[c for c in docs.columns if c != row], F.coalesce(into, F.array().cast(MATCHES)).alias(into))


def contaminated(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", params: Params = Params()) -> DataFrame:
    """One row per document and test item that match."""
    found = find(docs.select(key, "text"), benchmark, params)
    return found.select(key, F.explode("matches").alias("m")).select(key, "m.*")
