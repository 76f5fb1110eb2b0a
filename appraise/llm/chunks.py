"""Word sequences of groups of documents as hash arrays, and compact hash exchange between groups.

A *chunk* is all documents whose key hashes to the same number; it is the unit
of work of one Python call. Chunks exchange window hashes through *buckets*: each
chunk sends a bucket its distinct hashes once, as one packed row, so a passage
that a third of all documents share costs one entry per chunk, and the rows and
bytes of every bucket are alike.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from itertools import count

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from appraise.llm.common import byte_words, partitions

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
LAST = (1 << 63) - 1
"""Stands for a null key: it comes after all others."""


def chunked(docs: DataFrame, key: str, n: int) -> DataFrame:
    """``_k`` (the key, null last), text and chunk number, dealt out by chunk."""
    return docs.select(
        F.coalesce(F.col(key).cast("long"), F.lit(LAST)).alias("_k"),
        "text",
        F.pmod(F.xxhash64(F.col(key).cast("long")), F.lit(n)).cast("int").alias("chunk"),
    ).repartition(n, "chunk")


def sizes(docs: DataFrame) -> tuple[int, int]:
    """Number of chunks and of buckets, in proportion to the session's shuffle partitions."""
    n = partitions(docs.sparkSession)
    return 3 * n, n


class Words:
    """The words of several texts, one after another, as two independent 64-bit hashes each."""

    def __init__(self, texts: list[str | None], lower: bool = False):
        import xxhash

        vocabulary: dict[bytes, int] = defaultdict(count().__next__)
        ids, ends = [], []
        for text in texts:
            got = byte_words(text, lower)
            ids.append(np.fromiter(map(vocabulary.__getitem__, got), np.int32, len(got)))
            ends.append(len(got))
        self.n = np.array(ends, np.int64)
        self.start = np.cumsum(self.n) - self.n
        at = np.concatenate([np.zeros(0, np.int32), *ids])
        digests = b"".join(map(xxhash.xxh3_128_digest, vocabulary))
        table = np.frombuffer(digests, np.uint64).reshape(-1, 2)
        self.a, self.b = (table[at, 0], table[at, 1]) if len(table) else (np.zeros(0, np.uint64),) * 2

    def windows(self, size: int, second: bool = False) -> np.ndarray:
        """Hash of the ``size`` words from each position on; positions too near the end of a text are meaningless."""
        out = rolled(self.b if second else self.a, size, _B if second else _A)
        return np.concatenate([out, np.zeros(len(self.a) - len(out), np.uint64)])

    def fits(self, size: int) -> np.ndarray:
        """Which positions start a whole window of their text."""
        left = np.repeat(self.start + self.n, self.n) - np.arange(len(self.a))
        return left >= size

    def offset(self) -> np.ndarray:
        """Position of each word in its own text."""
        return np.arange(len(self.a)) - np.repeat(self.start, self.n)


def rolled(h: np.ndarray, size: int, base: np.uint64) -> np.ndarray:
    """Polynomial hashes (modulo 2**64, then mixed) of all runs of ``size`` values."""
    n = len(h) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out, done, part, width, power = None, 0, h, 1, int(base)
    bits = size
    while bits:
        if bits & 1:
            piece = part[done : done + n]
            out = piece.copy() if out is None else out * np.uint64(power) + piece
            done += width
        bits >>= 1
        if bits:
            part = part[:-width] * np.uint64(power) + part[width:]
            power = power * power % (1 << 64)
            width *= 2
    out = (out ^ (out >> np.uint64(32))) * _B
    return out ^ (out >> np.uint64(29))


def packed(values: np.ndarray) -> bytes:
    """Sorted distinct uint32 values as differences; the two upper bytes are compressed."""
    d = np.diff(values, prepend=np.uint32(0)).astype("<u4")
    planes = d.view(np.uint8).reshape(-1, 4)
    return planes[:, :2].tobytes() + zlib.compress(planes[:, 2:].T.tobytes(), 1)


def unpacked(data: bytes, n: int) -> np.ndarray:
    planes = np.empty((n, 4), np.uint8)
    planes[:, :2] = np.frombuffer(data, np.uint8, 2 * n).reshape(n, 2)
    planes[:, 2:] = np.frombuffer(zlib.decompress(data[2 * n :]), np.uint8).reshape(2, n).T
    return np.cumsum(planes.view("<u4").ravel(), dtype=np.uint32)


def keyed(h: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket (upper half) and value in the bucket (lower half) of hashes."""
    return ((h & np.uint64(0xFFFFFFFF)) % np.uint64(buckets)) << np.uint64(32) | (h >> np.uint64(32))


def cut(sorted_keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket begins and ends in sorted keys."""
    return np.searchsorted(sorted_keys, np.arange(buckets + 1, dtype=np.uint64) << np.uint64(32))


def inside(x: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Which values of ``x`` are in the sorted array ``of``."""
    if not len(of):
        return np.zeros(len(x), bool)
    at = np.searchsorted(of, x)
    at[at == len(of)] = 0
    return of[at] == x
