"""Operator 7: exact n-gram Jaccard join by pivots, distance rings and triangle windows.

A document's set holds its distinct shingles of ``size`` lower-cased words. Two documents
link when their Jaccard similarity is at least ``percent`` / 100. Jaccard distance is a metric,
but two unrelated texts are at distance 1 of each other and of nearly every pivot, where
Voronoi cells of a few global pivots and windows of twice the radius would
send every document everywhere. So pivots are taken where documents are:

1. Chunks of documents exchange the document frequency of their shingles
   through buckets (see ``chunks``). In the order (frequency, hash) the first
   ``n - ceil(percent * n / 100) + 1`` shingles of linked sets must have one in common.
   Shingles of frequency 1 have no partner, so most documents end here.
2. Equal sets become one class. The pivot of a shingle is the least class that has it
   among its first; a class belongs to the region of each pivot of its first shingles, and its
   exact distance to them is worked out. Any two linked classes share a region.
   Classes within the radius of the pivot link to it.
3. A region whose classes are all connected by now is done. In the others, classes
   outside of the region's largest component are compared with all of the
   region that the triangle inequality allows: outsiders are cut into rings by
   distance from the pivot (and rings into parts), and each class is replicated to the
   rings within the radius of its own distance. Large regions are also cut into
   parts, so that every comparison has a bounded number of sets on either side.
   The comparison counts common shingles of all pairs of a part through an inverted index.
4. Connected components of all links (see ``components``).

Pairs of which both sides are known to be connected are never formed, so a
group of thousands of near copies costs a star and not all its pairs, and no link that
could join two components is left out. Defined results: null and blank texts have an empty set
and link with nothing; a text of fewer words than ``size`` has its whole sequence as one shingle;
repeated rows link with each other; null ids come last in the order of ids and give a null
component only among themselves; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from appraise.llm import chunks as C
from appraise.llm.common import free_name, map_batches, saved
from appraise.llm.components import components

RINGS = 32
"""Of width 1 / 32 between distance 0 and 1."""
BLOCK, PART = 256, 1024
"""Sets on the two sides of one comparison, about."""


def shingle_sets(texts: list[str | None], size: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text."""
    w = C.Words(texts, lower=True)
    h = w.windows(size)
    out = []
    for start, n in zip(w.start.tolist(), w.n.tolist(), strict=True):
        if n >= size:
            out.append(np.unique(h[start : start + n - size + 1]))
        elif n:
            out.append(C.rolled(w.a[start : start + n], n, np.uint64(0xA24BAED4963EE407 + 2 * n)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def fingerprint(s: np.ndarray) -> bytes | None:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None


def _distinct(pdf: pd.DataFrame, size: int) -> tuple[pd.DataFrame, list[np.ndarray], list[bytes | None], list[bool]]:
    """Rows in a fixed order, their sets and fingerprints, and which are the first of their fingerprint in the chunk."""
    pdf = pdf.assign(_t=pdf["text"].fillna("")).sort_values(["_k", "_t"], kind="stable")
    sets = shingle_sets(pdf["text"].tolist(), size)
    prints = [fingerprint(s) for s in sets]
    seen: set = {None}
    first = [not (p in seen or seen.add(p)) for p in prints]
    return pdf, sets, prints, first


def send_shingles(pdf: pd.DataFrame, buckets: int, size: int) -> pd.DataFrame:
    _, sets, _, first = _distinct(pdf, size)
    own = [np.zeros(0, np.uint64), *[s for s, f in zip(sets, first, strict=True) if f]]
    keys, n = np.unique(C.keyed(np.concatenate(own), buckets), return_counts=True)
    x, chunk = C.cut(keys, buckets), int(pdf["chunk"].iloc[0])
    n = np.minimum(n, 0xFFFF).astype("<u2")
    rows = [
        (k, chunk, j - i, C.packed(keys[i:j].astype(np.uint32)), zlib.compress(n[i:j].tobytes(), 1))
        for k, i, j in zip(range(buckets), x[:-1], x[1:], strict=True)
        if j > i
    ]
    return pd.DataFrame(rows, columns=["bucket", "chunk", "n", "hashes", "counts"])


def count_shingles(pdf: pd.DataFrame) -> pd.DataFrame:
    """For each chunk those of its values that two sets or more have, with their number."""
    pdf = pdf.sort_values("chunk")
    own = [C.unpacked(d, n) for d, n in zip(pdf["hashes"], pdf["n"], strict=True)]
    every = np.unique(np.concatenate(own))
    total = np.zeros(len(every), np.int64)
    for v, c in zip(own, pdf["counts"], strict=True):
        total[np.searchsorted(every, v)] += np.frombuffer(zlib.decompress(c), "<u2")
    rows, bucket = [], int(pdf["bucket"].iloc[0])
    for chunk, v in zip(pdf["chunk"], own, strict=True):
        n = total[np.searchsorted(every, v)]
        v, n = v[n >= 2], n[n >= 2]
        if len(v):
            rows.append((int(chunk), bucket, len(v), C.packed(v), zlib.compress(n.astype("<u4").tobytes(), 1)))
    return pd.DataFrame(rows, columns=["chunk", "bucket", "n", "hashes", "counts"])


def first_shingles(pdf: pd.DataFrame, said: pd.DataFrame, buckets: int, size: int, percent: int) -> pd.DataFrame:
    """Per row: key, set size and fingerprint; for sets that may have a partner also their first shared shingles
    and all hashes that another set has."""
    columns = ["_k", "digest", "n", "fp", "tokens", "shared"]
    if not len(pdf):
        return pd.DataFrame([], columns=columns)
    pdf, sets, prints, first = _distinct(pdf, size)
    parts = [
        (np.uint64(b) << np.uint64(32)) | C.unpacked(d, n)
        for b, d, n in zip(said["bucket"], said["hashes"], said["n"], strict=True)
    ]
    known = np.concatenate([np.zeros(0, np.uint64), *parts])
    count = np.concatenate([np.zeros(0, "<u4"), *[np.frombuffer(zlib.decompress(c), "<u4") for c in said["counts"]]])
    order = np.argsort(known)
    known, count = known[order], count[order]
    rows = []
    for k, text, s, p, f in zip(pdf["_k"], pdf["_t"], sets, prints, first, strict=True):
        digest = hashlib.md5(text.encode("utf-8", "surrogatepass")).hexdigest()
        tokens = shared = None
        if f and len(known):
            keys = C.keyed(s, buckets)
            at = np.searchsorted(known, keys)
            at[at == len(known)] = 0
            hit = known[at] == keys
            room = len(s) + (-percent * len(s) // 100) + 1 - int((~hit).sum())
            if room > 0:
                order = np.lexsort((s[hit], keys[hit], count[at[hit]]))[:room]
                tokens = np.unique(keys[hit][order]).view(np.int64).tolist()
                shared = s[hit].tobytes()
        rows.append((k, digest, len(s), p, tokens, shared))
    return pd.DataFrame(rows, columns=columns)


def common(a: bytes, b: bytes) -> int:
    """Number of values that two sorted packed arrays share."""
    return int(C.inside(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)).sum())


def measured(pairs: DataFrame, percent: int) -> DataFrame:
    """``distance`` and ``linked`` of pairs that carry n and shared hashes of both sides (na, sa, nb, sb)."""

    def run(batch):
        na, nb = batch.column("na").to_pylist(), batch.column("nb").to_pylist()
        both = [common(a, b) for a, b in zip(batch.column("sa").to_pylist(), batch.column("sb").to_pylist(), strict=True)]
        union = [x + y - i for x, y, i in zip(na, nb, both, strict=True)]
        return {
            "distance": [1 - i / u for i, u in zip(both, union, strict=True)],
            "linked": [100 * i >= percent * u for i, u in zip(both, union, strict=True)],
        }

    return map_batches(pairs, run, "a binary, b binary, distance double, linked boolean")


def compare(left: pd.DataFrame, right: pd.DataFrame, percent: int) -> pd.DataFrame:
    """Links between the outsiders ``left`` and the classes ``right`` of other components, one for each component."""
    out = []
    if len(left) and len(right):
        left, right = left.sort_values("fp"), right.sort_values("fp")
        sets = [np.frombuffer(s, np.uint64) for s in left["shared"]]
        sizes = left["n"].to_numpy(np.int64)
        flat = np.concatenate(sets)
        owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        order = np.argsort(flat, kind="stable")
        flat, owner = flat[order], owner[order]
        prints, roots = left["fp"].tolist(), left["root"].tolist()
        done: set = set()
        for fp, root, n, shared in zip(right["fp"], right["root"], right["n"], right["shared"], strict=True):
            x = np.frombuffer(shared, np.uint64)
            lo, hi = np.searchsorted(flat, x, "left"), np.searchsorted(flat, x, "right")
            width = hi - lo
            if not width.any():
                continue
            at = np.repeat(lo - (np.cumsum(width) - width), width) + np.arange(int(width.sum()))
            both = np.bincount(owner[at], minlength=len(sets))
            for i in np.flatnonzero(100 * both >= percent * (sizes + n - both)):
                if roots[i] != root and (i, root) not in done:
                    done.add((i, root))
                    out.append((prints[i], fp))
    return pd.DataFrame(out, columns=["a", "b"])


def _salt(column: str, n: Column) -> Column:
    return F.pmod(F.xxhash64(column), F.greatest(F.lit(1), n).cast("long")).cast("int")


def region_links(regions: DataFrame, classes: DataFrame, roots: DataFrame, percent: int) -> DataFrame:
    """Links between classes of a region that aren't connected yet. ``regions``: pivot, fp, distance."""
    radius = 1 - percent / 100 + 1e-9
    own = regions.join(roots.withColumnRenamed("node", "fp"), "fp")
    sizes = own.groupBy("pivot", "root").agg(F.count("*").alias("m"))
    main = sizes.groupBy("pivot").agg(
        F.sum("m").alias("all"), F.max(F.struct("m", "root")).alias("top"), F.count("*").alias("k")
    )
    main = main.where("k > 1").select("pivot", "all", F.col("top.root").alias("main"))
    own = own.join(main, "pivot").withColumn("ring", F.least(F.lit(RINGS - 1), F.floor(F.col("distance") * RINGS).cast("int")))
    own = saved(classes.sparkSession, own, "regions")
    outside = own.where("root != main")
    rings = outside.groupBy("pivot", "ring").agg(F.count("*").alias("m"))
    rings = rings.select("pivot", "ring", F.ceil(F.col("m") / BLOCK).cast("int").alias("blocks"))
    data = classes.select("fp", "n", "shared")
    left = (
        outside.join(rings, ["pivot", "ring"])
        .withColumn("block", _salt("fp", F.col("blocks")))
        .withColumn("part", F.explode(F.sequence(F.lit(0), F.ceil(F.col("all") / PART).cast("int") - 1)))
        .select("pivot", "ring", "block", "part", "fp", "root")
        .join(data, "fp")
    )
    near = rings.withColumnRenamed("ring", "to")
    right = (
        own.withColumn("part", _salt("fp", F.ceil(F.col("all") / PART)))
        .join(near, "pivot")
        .where((F.col("distance") >= F.col("to") / RINGS - radius) & (F.col("distance") <= (F.col("to") + 1) / RINGS + radius))
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("pivot", F.col("to").alias("ring"), "block", "part", "fp", "root")
        .join(data, "fp")
        .select(*left.columns)
    )
    key = ["pivot", "ring", "block", "part"]
    names = left.columns
    right = right.select(*[F.col(c).alias(f"r_{c}") for c in names])  # both sides stem from the same tables
    return left.groupBy(*key).cogroup(right.groupBy(*[f"r_{c}" for c in key])).applyInPandas(
        lambda x, y: compare(x, y.set_axis(names, axis=1), percent), "a binary, b binary"
    )


def grouped(docs: DataFrame, key: str, size: int, percent: int) -> DataFrame:
    """Per row: ``_k`` (the key, null last), digest of the text, set size ``n``, ``top`` (null for an empty set, else the
    same for all rows of a component) and ``component`` (its least ``_k``)."""
    spark = docs.sparkSession
    n, buckets = C.sizes(docs)
    dealt = C.chunked(docs, key, n)
    packed = "bucket int, chunk int, n int, hashes binary, counts binary"
    sent = dealt.groupBy("chunk").applyInPandas(lambda pdf: send_shingles(pdf, buckets, size), packed)
    said = sent.groupBy("bucket").applyInPandas(count_shingles, "chunk int, bucket int, n int, hashes binary, counts binary")
    rows = dealt.groupBy("chunk").cogroup(said.groupBy("chunk")).applyInPandas(
        lambda pdf, got: first_shingles(pdf, got, buckets, size, percent),
        "_k long, digest string, n long, fp binary, tokens array<long>, shared binary",
    )
    rows = saved(spark, rows, "shingle-sets")
    found = rows.where("tokens is not null")
    tokens = found.select("fp", F.explode("tokens").alias("token")).distinct()
    pivots = tokens.groupBy("token").agg(F.min("fp").alias("pivot"), F.count("*").alias("m")).where("m > 1")
    pairs = saved(spark, tokens.join(pivots, "token").where("fp != pivot").select("fp", "pivot").distinct(), "pairs")
    paired = pairs.select("fp").unionByName(pairs.select(F.col("pivot").alias("fp"))).distinct()
    classes = found.join(paired, "fp", "left_semi").groupBy("fp").agg(F.first("n").alias("n"), F.first("shared").alias("shared"))
    classes = saved(spark, classes, "classes")
    a = classes.select(F.col("fp").alias("a"), F.col("n").alias("na"), F.col("shared").alias("sa"))
    b = classes.select(F.col("fp").alias("b"), F.col("n").alias("nb"), F.col("shared").alias("sb"))
    pairs = pairs.select(F.col("fp").alias("a"), F.col("pivot").alias("b")).join(a, "a").join(b, "b")
    stars = saved(spark, measured(pairs, percent), "stars")
    links = stars.where("linked").select("a", "b")
    roots = components(links)
    regions = stars.select(F.col("b").alias("pivot"), F.col("a").alias("fp"), "distance").unionByName(
        stars.select(F.col("b").alias("pivot"), F.col("b").alias("fp"), F.lit(0.0).alias("distance")).distinct()
    )
    every = regions.select(F.col("fp").alias("node")).distinct().join(roots, "node", "left")
    every = saved(spark, every.select("node", F.coalesce("root", "node").alias("root")), "roots")
    more = region_links(regions, classes, every, percent)
    by_a, by_b = (every.select(F.col("node").alias(c), F.col("root").alias(f"r{c}")) for c in "ab")
    more = more.join(by_a, "a").join(by_b, "b").select(F.col("ra").alias("a"), F.col("rb").alias("b"))
    joined = components(more).select(F.col("node").alias("root"), F.col("root").alias("top"))
    top = every.join(joined, "root", "left").select(F.col("node").alias("fp"), F.coalesce("top", "root").alias("top"))
    least = rows.where("fp is not null").groupBy("fp").agg(F.min("_k").alias("least"))
    named = least.join(top, "fp", "left").select("fp", F.coalesce("top", "fp").alias("top"), "least")
    ids = named.groupBy("top").agg(F.min("least").alias("component"))
    named = named.join(ids, "top").select("fp", "top", "component")
    return rows.select("_k", "digest", "n", "fp").join(named, "fp", "left").drop("fp")


def jaccard_components(docs: DataFrame, key: str = "doc_id", size: int = 5, percent: int = 75) -> DataFrame:
    """Per row: the key, ``n_shingles`` and ``component_id`` (least key reachable by links, itself included)."""
    kind = docs.schema[key].dataType

    def back(c: Column) -> Column:
        return F.when(c != C.LAST, c).cast(kind)

    return grouped(docs, key, size, percent).select(
        back(F.col("_k")).alias(key),
        F.col("n").alias("n_shingles"),
        back(F.coalesce("component", "_k")).alias("component_id"),
    )


def representatives(docs: DataFrame, key: str = "doc_id", size: int = 5, percent: int = 75) -> DataFrame:
    """The rows of ``docs`` without near copies: of each component the one with the least key (then least digest of the
    text) stays. Rows without a word all stay."""
    spark, columns = docs.sparkSession, docs.columns
    k, digest = free_name(docs, "_k"), free_name(docs, "digest")
    groups = grouped(docs, key, size, percent).where("n > 0")
    chosen = groups.groupBy("top").agg(F.min(F.struct("_k", "digest")).alias("x"))
    chosen = saved(spark, chosen.select(F.col("x._k").alias(k), F.col("x.digest").alias(digest)).distinct(), "representatives")
    text = F.coalesce("text", F.lit(""))
    has_word = text.rlike(r"[^\x20\x09-\x0D]")
    rows = docs.where(has_word).withColumns({k: F.coalesce(F.col(key).cast("long"), F.lit(C.LAST)), digest: F.md5(text.cast("binary"))})
    rows = rows.join(chosen, [k, digest], "left_semi").dropDuplicates([k, digest])
    return rows.select(*columns).unionByName(docs.where(~has_word).select(*columns))
