"""Operator 6: removal of exact repeated substrings, found by fixed-block anchors.

Words are cut at ASCII blanks and kept as they are. A window is ``size``
consecutive words of a document. Every word goes that is covered by a window whose
word sequence starts earlier too (smaller id, or same document and earlier start).

1. Anchors. Each document is cut into non-overlapping reference blocks of
   ``size // 2`` words; any window holds at least one whole block. Block hashes and the
   hashes of every rolling window of that length go to buckets by hash, each chunk of
   documents sending a value once.
2. Hits. A bucket returns to each chunk the block values that occur twice or more
   anywhere; a value that no block has is dropped.
3. Extension. A chunk extends its hits to all windows that contain a hit block,
   and sends each distinct window (96 bits of hash) with its first place to a
   bucket, which finds the first place of all. Consecutive windows found this way are the
   maximal exact repeats; the words that they cover go.

Memory and messages are bounded by the chunk (documents / chunks) and not by the
number of copies. Defined results: null and blank texts have no words, nothing is removed and
``kept_sha256`` is that of the empty text; documents of fewer words than a
window are kept whole; rows with the same id count as one after another, in the
order of their texts; null ids come last; extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from appraise.llm import chunks as C
from appraise.llm.common import byte_words

_SENT = "bucket int, chunk int, n int, blocks binary, twice binary, m int, probes binary"
_PLACES = "bucket int, chunk int, a binary, b binary, doc binary, pos binary, more binary"


def _rows(pdf: pd.DataFrame) -> pd.DataFrame:
    return pdf.assign(_t=pdf["text"].fillna("")).sort_values(["_k", "_t"], kind="stable")


def _places(keys: np.ndarray, w: C.Words) -> np.ndarray:
    """Position of every word, going on through rows with the same key."""
    first = np.searchsorted(keys, keys, side="left")
    before = w.start - w.start[first]
    return w.offset() + np.repeat(before, w.n)


def send_windows(pdf: pd.DataFrame, buckets: int, block: int) -> pd.DataFrame:
    w = C.Words(_rows(pdf)["text"].tolist())
    ok = w.fits(block)
    keys = C.keyed(w.windows(block), buckets)
    aligned = ok & (w.offset() % block == 0)
    every = np.sort(keys[ok])
    first = np.ones(len(every), bool)
    first[1:] = every[1:] != every[:-1]
    again = np.unique(every[~first])
    every = every[first]
    own = np.unique(keys[aligned])
    is_block = C.inside(every, own)
    blocks, probes = every[is_block], every[~is_block]
    x, y = C.cut(blocks, buckets), C.cut(probes, buckets)
    twice = C.inside(blocks, again)
    chunk = int(pdf["chunk"].iloc[0])
    out = []
    for k in range(buckets):
        i, j, p, q = x[k], x[k + 1], y[k], y[k + 1]
        if j > i or q > p:
            a, b = blocks[i:j].astype(np.uint32), probes[p:q].astype(np.uint32)
            out.append((k, chunk, j - i, C.packed(a), np.packbits(twice[i:j]).tobytes(), q - p, C.packed(b)))
    return pd.DataFrame(out, columns=["bucket", "chunk", "n", "blocks", "twice", "m", "probes"])


def find_hits(pdf: pd.DataFrame) -> pd.DataFrame:
    """For each chunk the block values of its own that occur twice or more anywhere."""
    pdf = pdf.sort_values("chunk")
    blocks = [C.unpacked(d, n) for d, n in zip(pdf["blocks"], pdf["n"], strict=True)]
    all_blocks = np.unique(np.concatenate(blocks))
    seen = np.zeros(len(all_blocks), np.int32)
    had = []
    for own, bits, data, m in zip(blocks, pdf["twice"], pdf["probes"], pdf["m"], strict=True):
        np.add.at(seen, np.searchsorted(all_blocks, own), 1 + np.unpackbits(np.frombuffer(bits, np.uint8))[: len(own)])
        probes = C.unpacked(data, m)
        seen[np.searchsorted(all_blocks, probes[C.inside(probes, all_blocks)])] += 1
        had.append(own)
    hits = all_blocks[seen >= 2]
    got = [own[C.inside(own, hits)] for own in had]
    bucket = int(pdf["bucket"].iloc[0])
    rows = [(int(c), bucket, len(g), C.packed(g)) for c, g in zip(pdf["chunk"], got, strict=True) if len(g)]
    return pd.DataFrame(rows, columns=["chunk", "bucket", "n", "hits"])


def send_places(pdf: pd.DataFrame, hits: pd.DataFrame, buckets: int, size: int) -> pd.DataFrame:
    """Every distinct window that holds a hit block, with its first place in the chunk."""
    columns = ["bucket", "chunk", "a", "b", "doc", "pos", "more"]
    if not len(pdf) or not len(hits):
        return pd.DataFrame([], columns=columns)
    pdf, block = _rows(pdf), size // 2
    w = C.Words(pdf["text"].tolist())
    found = np.sort(
        np.concatenate(
            [(np.uint64(b) << np.uint64(32)) | C.unpacked(d, n) for b, d, n in zip(hits["bucket"], hits["hits"], hits["n"], strict=True)]
        )
    )
    at = np.flatnonzero(w.fits(block) & (w.offset() % block == 0))
    at = at[C.inside(C.keyed(w.windows(block)[at], buckets), found)]
    # A window starts up to size - block words before a block that it holds.
    near = np.zeros(len(w.a) + 1, np.int32)
    low = np.maximum(at - (size - block), np.repeat(w.start, w.n)[at])
    np.add.at(near, low, 1)
    np.add.at(near, at + 1, -1)
    at = np.flatnonzero((np.cumsum(near[:-1]) > 0) & w.fits(size))
    if not len(at):
        return pd.DataFrame([], columns=columns)
    keys = pdf["_k"].to_numpy(np.int64)
    doc, pos = np.repeat(keys, w.n)[at], _places(keys, w)[at].astype(np.int32)
    a, b = w.windows(size)[at], (w.windows(size, second=True)[at] >> np.uint64(32)).astype(np.uint32)
    key = C.keyed(a, buckets)
    order = np.lexsort((at, b, a, key >> np.uint64(32)))  # places rise with the position in the chunk
    key, a, b, doc, pos = key[order], a[order], b[order], doc[order], pos[order]
    first = np.ones(len(a), bool)
    first[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    more = np.diff(np.append(np.flatnonzero(first), len(a))) > 1
    key, a, b, doc, pos = key[first] >> np.uint64(32), a[first], b[first], doc[first], pos[first]
    x = np.searchsorted(key, np.arange(buckets + 1, dtype=np.uint64))
    chunk = int(pdf["chunk"].iloc[0])
    out = [
        (k, chunk, a[i:j].tobytes(), b[i:j].tobytes(), doc[i:j].tobytes(), pos[i:j].tobytes(), more[i:j].tobytes())
        for k, i, j in zip(range(buckets), x[:-1], x[1:], strict=True)
        if j > i
    ]
    return pd.DataFrame(out, columns=columns)


def find_first(pdf: pd.DataFrame) -> pd.DataFrame:
    """For each chunk: windows of which another chunk has an earlier place, and those of which it has the first of several."""

    def read(column: str, kind) -> np.ndarray:
        return np.frombuffer(b"".join(pdf[column]), kind)

    a, b, doc, pos = read("a", np.uint64), read("b", np.uint32), read("doc", np.int64), read("pos", np.int32)
    more = read("more", bool)
    chunk = np.repeat(pdf["chunk"].to_numpy(), [len(x) // 8 for x in pdf["a"]])
    order = np.lexsort((pos, doc, b, a))
    a, b, chunk, more = a[order], b[order], chunk[order], more[order]
    first = np.ones(len(a), bool)
    first[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    rows = []
    for c in np.unique(chunk):
        own = chunk == c
        rows.append((int(c), a[own & ~first].tobytes(), a[own & first & more].tobytes()))
    return pd.DataFrame(rows, columns=["chunk", "later", "local"])


def remove(pdf: pd.DataFrame, said: pd.DataFrame, size: int, with_text: bool) -> pd.DataFrame:
    pdf = _rows(pdf)
    w = C.Words(pdf["text"].tolist())
    gone = np.zeros(len(w.a), bool)
    if len(said):
        later = np.sort(np.frombuffer(b"".join(said["later"]), np.uint64))
        local = np.sort(np.frombuffer(b"".join(said["local"]), np.uint64))
        at = np.flatnonzero(w.fits(size))
        a = w.windows(size)[at]
        out = C.inside(a, later)
        several = np.flatnonzero(C.inside(a, local) & ~out)
        order = several[np.argsort(a[several], kind="stable")]
        out[order[1:][a[order][1:] == a[order][:-1]]] = True
        cover = np.zeros(len(w.a) + 1, np.int32)
        cover[at[out]] += 1
        np.add.at(cover, at[out] + size, -1)
        gone = np.cumsum(cover[:-1]) > 0
    rows = []
    for k, text, start, n in zip(pdf["_k"], pdf["text"], w.start, w.n, strict=True):
        out = gone[start : start + n]
        removed = int(out.sum())
        got = byte_words(text)
        kept = b" ".join(got if not removed else [x for x, g in zip(got, out.tolist(), strict=True) if not g])
        digest = hashlib.sha256(kept).hexdigest()
        rows.append((k, int(n), removed, digest, kept.decode("utf-8", "surrogatepass") if with_text else None))
    return pd.DataFrame(rows, columns=["_k", "n_words", "n_removed", "kept_sha256", "kept_text"])


def remove_repeats(docs: DataFrame, key: str = "doc_id", size: int = 20, with_text: bool = True) -> DataFrame:
    """Per row: the key, n_words, n_removed, kept_sha256 and (on request) the words that stay, joined by a blank."""
    n, buckets = C.sizes(docs)
    # One plan: the documents are dealt out by chunk once and that exchange is used three times.
    dealt = C.chunked(docs, key, n)
    sent = dealt.groupBy("chunk").applyInPandas(lambda pdf: send_windows(pdf, buckets, size // 2), _SENT)
    hits = sent.groupBy("bucket").applyInPandas(find_hits, "chunk int, bucket int, n int, hits binary")
    places = (
        dealt.groupBy("chunk")
        .cogroup(hits.groupBy("chunk"))
        .applyInPandas(lambda pdf, found: send_places(pdf, found, buckets, size), _PLACES)
    )
    said = places.groupBy("bucket").applyInPandas(find_first, "chunk int, later binary, local binary")
    schema = "_k long, n_words long, n_removed long, kept_sha256 string, kept_text string"
    out = dealt.groupBy("chunk").cogroup(said.groupBy("chunk")).applyInPandas(
        lambda pdf, got: remove(pdf, got, size, with_text), schema
    )
    back = F.when(F.col("_k") != C.LAST, F.col("_k")).cast(docs.schema[key].dataType).alias(key)
    return out.select(back, "n_words", "n_removed", "kept_sha256", *(["kept_text"] if with_text else []))
