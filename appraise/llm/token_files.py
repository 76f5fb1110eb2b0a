"""Operator 12: token ids of a corpus in files of canonical, length-limited Huffman codes.

Texts are encoded once (``encode``) and the ids of all documents counted. The code lengths, at most
``LIMIT`` bits, come from these counts by package-merge; codes are canonical, so lengths
alone rebuild them. ``HuffmanIds`` is a data source that writes and reads the files.

A folder holds ``codes`` (the lengths), one file per shard of the key range, and ``manifest``, written last,
that lists the shards in order: readers follow it, so files of lost or repeated tasks are never read. A shard is

    magic | bit stream | bit offset of every block | keys, null marks and id counts of its documents | sizes, magic

A block holds ``BLOCK`` ids and starts at its checkpoint (a bit offset), whatever lies before it; document
boundaries are in the index, not in the stream (an id that ends documents may occur in a text). The decoder looks up the
next ``LIMIT`` bits of many blocks at once in one table of ids and lengths, and steps through all of them together.

Size: the table of counts and codes is bounded by the vocabulary. Shards are ranges of the key, ties dealt on by content and
row, so a key that repeats is split too; a shard's stream is written and read in runs of ``RUN`` ids, what is held besides
is its index (8 bytes a block, 17 a document; at most about ``SHARD_DOCS`` documents).

Defined results: a null text is empty; an empty document has the end id alone; long texts are encoded
whole; repeated rows are written one by one; documents with the same key follow each other by their content's hash; null keys come
last; an empty table gives files without documents; other columns are ignored. Marks of special tokens in a text are
encoded as the tokenizers library does by default: as the special id.
"""

from __future__ import annotations

import io
import json
import re
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from appraise.llm.common import byte_words, partitions, saved
from appraise.session import scratch_path

END = 1
LIMIT = 20
BLOCK = 256
RUN = 1 << 20
SHARD_IDS, SHARD_DOCS, LEAST_IDS = 1 << 28, 1 << 22, 1 << 16
KNOWN = 350_000
MAGIC = b"idfile01"
_TAIL = struct.Struct("<QQQ8s")


# ---- texts to ids


# A tokenizer of this form takes lower-cased runs of letters as pieces and hands their bytes, as visible characters, to the merges.
LOWER = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

LETTERS = re.compile("([A-Za-zÀ-ÖØ-öø-\u012f\u0131-\u024f]+)([^\\w\\s'<>\x00-\x1f\x7f-\U0010ffff]*)")
"""Latin letters whose lower case stands alone, then signs that are one piece."""


class WordEncoder:
    """Ids of texts by a tokenizer whose pieces never reach over white space; ids of words met before are kept.

    True for tokenizers that drop white space and whose normalization works on single characters or
    combining sequences. A word alone gives the same ids as in any text, so words are encoded by the library one at a time. Where
    the tokenizer has the form above, Latin letters go straight to its merges, and the signs behind them apart.
    """

    def __init__(self, model: str, wide: bool):
        from tokenizers import Tokenizer

        self.tokenizer, self.type = Tokenizer.from_str(model), "I" if wide else "H"
        self.known, self.older = {}, {}  # words met since the last change of generations, and before
        form = json.loads(model)
        before, pieces = (form[k] or {} for k in ("normalizer", "pre_tokenizer"))
        first, *rest = pieces.get("pretokenizers") or [{}]
        self.plain = (
            before.get("normalizers") == LOWER
            and (first.get("pattern"), first.get("invert"), first.get("behavior")) == ({"Regex": SPLIT}, True, "Removed")
            and [(x["type"], x["add_prefix_space"], x["use_regex"]) for x in rest] == [("ByteLevel", False, False)]
        )
        seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
        self.visible = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in seen)}
        self.merge = self.tokenizer.model.tokenize

    def _piece(self, text: str, word: bytes) -> bytes:
        """Ids of one piece, given as text and as bytes."""
        out = self.known.get(word) or self.older.get(word)
        if out is None:
            shown = text if len(text) == len(word) else word.decode("latin-1").translate(self.visible)
            out = array(self.type, [t.id for t in self.merge(shown)]).tobytes()
        self.known[word] = out
        return out

    def _word(self, word: bytes) -> bytes:
        out = self.known.get(word) or self.older.get(word)
        if out is not None:
            self.known[word] = out
            return out
        text = word.decode()
        got = LETTERS.fullmatch(text) if self.plain else None
        if not got:
            out = array(self.type, self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        else:
            core, signs = got[1].lower(), got[2]
            out = self._piece(core, core.encode())
            if signs:
                out += self._piece(signs, signs.encode())
        self.known[word] = out
        return out

    def ids(self, text: str | None) -> bytes:
        found, known = byte_words(text), self.known
        if len(known) > KNOWN:
            self.older, self.known = known, {}
            known = self.known
        out = list(map(known.get, found))
        if None in out:
            for i in [i for i, x in enumerate(out) if x is None]:
                out[i] = self._word(found[i])
        return b"".join(out)


_ENCODERS: dict[str, WordEncoder] = {}


def word_encoder(model: str, wide: bool) -> WordEncoder:
    """The worker process's encoder, with what it has learned from earlier tasks."""
    if model not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[model] = WordEncoder(model, wide)
    return _ENCODERS[model]


def wide(tokenizer: str) -> bool:
    """Whether ids need more than two bytes."""
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer).get_vocab_size() > 1 << 16


def encode(docs: DataFrame, tokenizer: str, big: bool, key: str = "doc_id", end: int = END) -> DataFrame:
    """Per row: the key, ``ids`` (little-endian, two bytes each, four for vocabularies over 65 536; the end id last) and ``row``."""
    spark = docs.sparkSession
    held = spark.sparkContext.broadcast(Path(tokenizer).read_text(encoding="utf-8"))
    schema = pa.schema([("key", pa.int64()), ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = word_encoder(held.value, big)
        last = array(own.type, [end]).tobytes()
        for batch in batches:
            ids = [own.ids(t) + last for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(ids, pa.binary())], schema=schema)

    read = docs.select(F.col(key).cast("long").alias("key"), "text")
    return read.mapInArrow(run, "key long, ids binary").withColumn("row", F.monotonically_increasing_id())


def id_counts(encoded: DataFrame, big: bool) -> np.ndarray:
    """How often each id occurs: counted per task, added by id. As long as the vocabulary at most."""
    kind = np.dtype("<u4" if big else "<u2")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for ids in batch.column(0).to_pylist():
                got = np.bincount(np.frombuffer(ids, kind))
                if len(got) > len(total):
                    got, total = total, got
                total[: len(got)] += got
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names=["id", "n"])

    rows = encoded.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(max((r["id"] for r in rows), default=-1) + 1, np.int64)
    for r in rows:
        out[r["id"]] = r["n"]
    return out


# ---- codes


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Bits of every id's code (0: the id doesn't occur), optimal among codes of at most ``limit`` bits (package-merge)."""
    lengths = np.zeros(len(counts), np.uint8)
    used = np.flatnonzero(counts)
    if len(used) > 1 << limit:
        raise ValueError(f"{len(used)} ids don't fit codes of {limit} bits")
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    order = used[np.argsort(counts[used], kind="stable")]
    weights = counts[order].astype(np.int64)
    level, leaves = weights, [np.ones(len(order), bool)]
    for _ in range(limit - 1):
        pairs = level[: len(level) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([weights, pairs])
        sort = np.argsort(both, kind="stable")
        level = both[sort]
        leaves.append(sort < len(weights))
    take = 2 * len(order) - 2
    for is_leaf in reversed(leaves):
        own = int(is_leaf[:take].sum())
        lengths[order[:own]] += 1
        take = 2 * (take - own)
    return lengths


class Codes:
    """Canonical codes of given lengths: shorter codes first, ids ascending within a length."""

    def __init__(self, lengths: np.ndarray):
        self.lengths = lengths
        used = np.flatnonzero(lengths)
        self.order = used[np.argsort(lengths[used], kind="stable")]
        self.bits = int(lengths.max(initial=1))
        spans = np.left_shift(1, self.bits - lengths[self.order].astype(np.int64))
        starts = np.cumsum(spans) - spans
        self.code = np.zeros(len(lengths), np.uint64)
        self.code[self.order] = starts >> (self.bits - lengths[self.order].astype(np.int64))
        self._spans = spans

    def encode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The bit stream (whole bytes, the first bit on top) and the bit offset of every block."""
        if not len(ids):
            return b"", np.zeros(0, np.int64)
        n = self.lengths[ids].astype(np.int64)
        ends = np.cumsum(n)
        at = ends - n
        out = np.zeros(int(ends[-1]) // 64 + 2, np.uint64)
        word, shift = at >> 6, 64 - (at & 63) - n
        code = self.code[ids]
        over = shift < 0  # the code's end falls into the next word
        left = np.where(over, code >> np.abs(np.minimum(shift, 0)).astype(np.uint64), code << np.maximum(shift, 0).astype(np.uint64))
        first = np.flatnonzero(np.diff(word, prepend=-1))
        out[word[first]] = np.bitwise_or.reduceat(left, first)
        out[word[over] + 1] |= code[over] << (64 + shift[over]).astype(np.uint64)
        return out.astype(">u8").tobytes()[: (int(ends[-1]) + 7) // 8], at[::BLOCK]

    def table(self) -> tuple[np.ndarray, np.ndarray]:
        """For every value of the next ``bits`` bits: the id that they start with, and its length."""
        ids = np.zeros(1 << self.bits, np.uint32)
        size = np.ones(1 << self.bits, np.uint8)
        total = int(self._spans.sum())
        ids[:total] = np.repeat(self.order, self._spans)
        size[:total] = np.repeat(self.lengths[self.order], self._spans)
        return ids, size


def decode(data: bytes, offsets: np.ndarray, n: int, table: tuple[np.ndarray, np.ndarray], bits: int) -> np.ndarray:
    """The ``n`` ids of consecutive blocks; ``offsets``: the bit in ``data`` at which each of them starts."""
    ids, size = table
    raw = np.frombuffer(data + b"\0\0\0\0", np.uint8).astype(np.uint32)
    window = raw[:-3] << 24 | raw[1:-2] << 16 | raw[2:-1] << 8 | raw[3:]  # 32 bits from each byte on
    out = np.zeros((len(offsets), BLOCK), np.uint32)
    pos = offsets.astype(np.int64)
    tail = n - (len(offsets) - 1) * BLOCK  # ids of the last block
    for step in range(min(BLOCK, n)):
        if step == tail:
            pos = pos[:-1]
        live = len(pos)
        if not live:
            break
        next_bits = window[pos >> 3] >> (32 - bits - (pos & 7)).astype(np.uint32) & np.uint32((1 << bits) - 1)
        out[:live, step] = ids[next_bits]
        pos = pos + size[next_bits]
    return out.ravel()[:n]


# ---- files


def _fs(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def _put(path: str, name: str, data: bytes) -> None:
    files, base = _fs(path)
    files.create_dir(base, recursive=True)
    with files.open_output_stream(f"{base}/{name}") as f:
        f.write(data)


def _get(path: str, name: str) -> bytes:
    files, base = _fs(path)
    with files.open_input_stream(f"{base}/{name}") as f:
        return f.read()


def put_codes(path: str, lengths: np.ndarray) -> None:
    _put(path, "codes", zlib.compress(lengths.tobytes()))


def get_codes(path: str) -> Codes:
    return Codes(np.frombuffer(zlib.decompress(_get(path, "codes")), np.uint8))


class ShardWriter:
    """Writes one shard as ids arrive; a run is coded as soon as it is full."""

    def __init__(self, out: io.RawIOBase, codes: Codes):
        self.out, self.codes = out, codes
        self.bytes, self.blocks, self.parts, self.held = len(MAGIC), [], [], 0
        self.keys, self.nulls, self.sizes = [], [], []
        out.write(MAGIC)

    def add(self, keys: np.ndarray, nulls: np.ndarray, ids: list[np.ndarray]) -> None:
        self.keys.append(keys)
        self.nulls.append(nulls)
        self.sizes.append(np.array([len(x) for x in ids], np.int64))
        self.parts += ids
        self.held += int(self.sizes[-1].sum())
        if self.held >= RUN:
            self._flush(self.held // RUN * RUN)

    def _flush(self, n: int) -> None:
        every = np.concatenate(self.parts) if self.parts else np.zeros(0, np.uint16)
        for at in range(0, n, RUN):
            stream, blocks = self.codes.encode(every[at : min(n, at + RUN)])
            self.blocks.append(blocks + 8 * self.bytes)
            self.out.write(stream)
            self.bytes += len(stream)
        self.parts, self.held = [every[n:].copy()], len(every) - n

    def close(self) -> tuple[int, int]:
        self._flush(self.held)
        blocks = np.concatenate([np.zeros(0, np.int64), *self.blocks]).astype("<u8")
        keys = np.concatenate([np.zeros(0, np.int64), *self.keys]).astype("<i8")
        nulls = np.concatenate([np.zeros(0, np.uint8), *self.nulls]).astype("u1")
        sizes = np.concatenate([np.zeros(0, np.int64), *self.sizes]).astype("<i8")
        for a in (blocks, keys, nulls, sizes):
            self.out.write(a.tobytes())
        self.out.write(_TAIL.pack(len(blocks), len(keys), self.bytes, MAGIC))
        return len(keys), int(sizes.sum())


class Shard:
    """Reads one shard."""

    def __init__(self, f, codes: Codes):
        self.f, self.codes, self.table = f, codes, codes.table()
        size = f.size()
        n_blocks, n_docs, self.end, magic = _TAIL.unpack(f.read_at(_TAIL.size, size - _TAIL.size))
        if magic != MAGIC:
            raise ValueError("not a file of ids")
        index = f.read_at(size - _TAIL.size - self.end, self.end)
        at = np.cumsum([0, 8 * n_blocks, 8 * n_docs, n_docs, 8 * n_docs])
        kinds = ("<u8", "<i8", "u1", "<i8")
        self.blocks, self.keys, self.nulls, self.sizes = (
            np.frombuffer(index[a:b], k) for a, b, k in zip(at, at[1:], kinds, strict=False)
        )
        self.ends = np.cumsum(self.sizes)

    def ids(self, start: int, stop: int) -> np.ndarray:
        """The ids from position ``start`` to ``stop``: only the blocks that hold them are read."""
        if stop <= start:
            return np.zeros(0, np.uint32)
        total = int(self.ends[-1])
        out = []
        for b in range(start // BLOCK, (stop - 1) // BLOCK + 1, RUN // BLOCK):
            e = min(b + RUN // BLOCK, (stop - 1) // BLOCK + 1)
            first = int(self.blocks[b]) // 8
            last = self.end if e == len(self.blocks) else int(self.blocks[e]) // 8 + 1
            data = self.f.read_at(last - first, first)
            n = min(e * BLOCK, total) - b * BLOCK
            got = decode(data, self.blocks[b:e].astype(np.int64) - 8 * first, n, self.table, self.codes.bits)
            out.append(got[max(0, start - b * BLOCK) : stop - b * BLOCK])
        return np.concatenate(out)

    def documents(self) -> Iterator[tuple[int, int, np.ndarray]]:
        """First and one past the last document, and their ids, for groups of about ``RUN`` ids (one document at least)."""
        at = 0
        while at < len(self.sizes):
            base = int(self.ends[at] - self.sizes[at])
            to = max(at + 1, int(np.searchsorted(self.ends, base + RUN, "right")))
            yield at, to, self.ids(base, int(self.ends[to - 1]))
            at = to


@dataclass
class Written(WriterCommitMessage):
    shard: int
    file: str
    documents: int
    ids: int


class Writer(DataSourceArrowWriter):
    """Writes every partition as one shard; the commit writes the manifest."""

    def __init__(self, path: str, width: int):
        self.path, self.kind = path, np.dtype(f"<u{width}")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId()
        name = f"shard-{shard:06d}-{uuid.uuid4().hex}"
        files, base = _fs(self.path)
        with files.open_output_stream(f"{base}/{name}") as f:
            out = ShardWriter(f, get_codes(self.path))
            for batch in iterator:
                keys = batch.column("key")
                ids = [np.frombuffer(x, self.kind) for x in batch.column("ids").to_pylist()]
                nulls = keys.is_null().to_numpy(zero_copy_only=False).astype(np.uint8)
                out.add(keys.fill_null(0).to_numpy(zero_copy_only=False), nulls, ids)
            documents, n = out.close()
        return Written(shard, name, documents, n)

    def commit(self, messages: list[Written | None]) -> None:
        done = sorted((m for m in messages if m), key=lambda m: m.shard)
        rows = [{"file": m.file, "documents": m.documents, "ids": m.ids} for m in done]
        _put(self.path, "manifest", json.dumps(rows).encode())


@dataclass
class ShardRange(InputPartition):
    file: str
    start: int
    """Ids in the shards before it."""


class Reader(DataSourceReader):
    """Reads the shards of the manifest, one partition each: key, position of the first id, ids as 32-bit little-endian."""

    def __init__(self, path: str):
        self.path = path

    def partitions(self) -> list[ShardRange]:
        out, at = [], 0
        for row in json.loads(_get(self.path, "manifest")):
            if row["documents"]:
                out.append(ShardRange(row["file"], at))
            at += row["ids"]
        return out or [ShardRange("", 0)]

    def read(self, partition: ShardRange) -> Iterator[pa.RecordBatch]:
        if not partition.file:
            return
        files, base = _fs(self.path)
        schema = pa.schema([("key", pa.int64()), ("start", pa.int64()), ("ids", pa.binary())])
        with files.open_input_file(f"{base}/{partition.file}") as f:
            shard = Shard(f, get_codes(self.path))
            for a, b, ids in shard.documents():
                ends = shard.ends[a:b]
                starts = ends - shard.sizes[a:b]
                data, zero = ids.astype("<u4").tobytes(), int(starts[0])
                cut = [data[4 * (s - zero) : 4 * (e - zero)] for s, e in zip(starts.tolist(), ends.tolist(), strict=True)]
                keys = pa.array(shard.keys[a:b], pa.int64(), mask=shard.nulls[a:b].astype(bool))
                yield pa.RecordBatch.from_arrays([keys, pa.array(starts + partition.start, pa.int64()), pa.array(cut, pa.binary())], schema=schema)


class HuffmanIds(DataSource):
    """``spark.read.format("huffman_ids").load(path)``: ``key``, ``start``, ``ids``. Written by ``write``."""

    @classmethod
    def name(cls) -> str:
        return "huffman_ids"

    def schema(self) -> str:
        return "key long, start long, ids binary"

    def reader(self, schema) -> Reader:
        return Reader(self.options["path"])

    def writer(self, schema, overwrite: bool) -> Writer:
        return Writer(self.options["path"], int(self.options.get("width", "2")))


def write(docs: DataFrame, path: str, tokenizer: str, key: str = "doc_id", end: int = END, limit: int = LIMIT) -> None:
    """Encode every text and write the ids of all documents, ascending by key, as files below ``path``."""
    spark = docs.sparkSession
    spark.dataSource.register(HuffmanIds)
    big = wide(tokenizer)
    encoded = saved(spark, encode(docs, tokenizer, big, key, end), "ids")
    counts = id_counts(encoded, big)
    put_codes(path, code_lengths(counts, limit))
    n, rows = int(counts.sum()), encoded.count()
    shards = max(1, n // SHARD_IDS, rows // SHARD_DOCS, min(partitions(spark), n // LEAST_IDS))
    order = (F.col("key").asc_nulls_last(), F.xxhash64("ids"), F.col("row"))
    dealt = encoded.repartitionByRange(shards, *order).sortWithinPartitions(*order).select("key", "ids")
    dealt.write.format("huffman_ids").option("width", 4 if big else 2).mode("append").save(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """Documents of the files: ``key``, ``start`` (ids of all documents before it), ``ids`` (32-bit little-endian)."""
    spark.dataSource.register(HuffmanIds)
    return spark.read.format("huffman_ids").load(path)


def round_trip(docs: DataFrame, tokenizer: str, key: str = "doc_id") -> DataFrame:
    """Write the corpus, read the files back and sum up each document's ids."""
    spark = docs.sparkSession
    path = scratch_path(spark, f"id-files-{uuid.uuid4().hex}")
    write(docs, path, tokenizer, key)
    return read(spark, path).select(
        F.col("key").alias(key),
        "start",
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )
