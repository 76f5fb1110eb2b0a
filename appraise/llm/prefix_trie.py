"""Operator 13: the trie of shared beginnings of conversations.

Every conversation is a path of turns; each distinct beginning is a node. A path's key is the chain of its
prefixes' digests (16 bytes a turn), so equal beginnings have equal first bytes and the order of
the keys is a depth-first walk of the trie.

Splitter skeleton: conversations are range-partitioned and sorted by (key, conversation). A node lies in more than one
shard only if it is a common beginning of the last path of one shard and the first path of a later one; these paths at the splitters
form a small trie, the *skeleton* (at most shards x depth nodes), which is broadcast. Each shard walks its sorted paths
once, finishes all nodes outside the skeleton, and gives partial aggregates of those inside; a reduction by node adds them up,
and the skeleton's own sums over subtrees are added from its leaves up. Copies of one conversation are dealt on over
shards by their number, so a group of any size is split.

The digest of conversations that end at a node is of one long text. Inside a shard it is fed as the
walk goes; for skeleton nodes every shard gives runs of ids (``RUN`` each), which one streaming pass
per node reads in order: it holds one run at a time. (SHA-256 can't be computed in parts, so this is the least that one task has to do.)

Defined results: turns come by turn number (null first), then by role, then by digest; a null role or text is empty; rows without
``conv_id`` belong to no conversation and are left out; repeated rows are repeated turns; a conversation that
gets no turns ends at the root; an empty table has no root: no rows; very long texts count whole (they enter
paths as digest and length); a conversation is held as 24 bytes a turn; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from appraise.llm.common import partitions, saved
from appraise.session import materialize

WIDTH = 16
"""Bytes of a digest."""
FAMILY, HEADS = 100, 6
SHARD_TURNS, LEAST_TURNS = 2_000_000, 20_000
RUN = 50_000
NODE = "kind string, node binary, depth int, parent binary, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, chars long, ends binary"
SKELETON = "node binary, conv_id long, depth int, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


# ---- paths


def turns(conversations: DataFrame) -> DataFrame:
    """Per conversation its turns in order, each as digest and length; texts don't travel."""
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    digest = F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)))
    one = F.struct(F.col("turn"), role.alias("role"), digest.alias("digest"), F.length(text).cast("long").alias("chars"))
    ordered = F.sort_array(F.collect_list("one"))
    return (
        conversations.where("conv_id is not null")
        .select(F.col("conv_id").cast("long").alias("conv_id"), one.alias("one"))
        .groupBy("conv_id")
        .agg(F.transform(ordered, lambda t: F.struct(t["digest"].alias("digest"), t["chars"].alias("chars"))).alias("turns"))
    )


def rebuilt(conversations: DataFrame) -> DataFrame:
    """Every conversation with its first turns taken from the head of its family."""
    own = turns(conversations)
    head = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).cast("int")
    first = own.where(F.col("conv_id") % FAMILY == 0).select(
        F.col("conv_id").alias("family"), F.slice("turns", 1, HEADS - 1).alias("lead")
    )
    joined = own.withColumn("family", F.col("conv_id") - F.col("conv_id") % FAMILY).join(first, "family", "left")
    lead = F.coalesce(F.slice("lead", F.lit(1), head), F.slice("turns", 1, 0))
    rest = F.slice("turns", head + 1, F.greatest(F.size("turns"), F.lit(1)))
    return joined.select("conv_id", F.concat(lead, rest).alias("turns"))


def paths(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``key`` (digest of every beginning, one after another) and ``chars`` (length of every turn, 64 bits each)."""
    schema = pa.schema([("conv_id", pa.int64()), ("key", pa.binary()), ("chars", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = []
            for digests in batch.column("digests").to_pylist():
                at, key = b"", []
                for d in digests:
                    at = hashlib.blake2b(at + d, digest_size=WIDTH).digest()
                    key.append(at)
                keys.append(b"".join(key))
            chars = [np.array(x, "<i8").tobytes() for x in batch.column("chars").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), pa.array(keys, pa.binary()), pa.array(chars, pa.binary())], schema=schema)

    flat = rebuilt(conversations).select("conv_id", F.col("turns.digest").alias("digests"), F.col("turns.chars").alias("chars"))
    return flat.mapInArrow(run, "conv_id long, key binary, chars binary")


def common(a: bytes, b: bytes) -> int:
    """How many first turns two keys share. Digests are chained: equal at one depth means equal above it."""
    low, high = 0, min(len(a), len(b)) // WIDTH
    while low < high:
        mid = (low + high + 1) // 2
        if a[(mid - 1) * WIDTH : mid * WIDTH] == b[(mid - 1) * WIDTH : mid * WIDTH]:
            low = mid
        else:
            high = mid - 1
    return low


# ---- one shard


class Node:
    __slots__ = ("id", "least", "n", "children", "leaves", "below", "chars", "ends", "run", "ended", "kids", "open")

    def __init__(self, node: bytes, chars: int, in_skeleton: bool):
        self.id, self.chars, self.open = node, chars, in_skeleton
        self.least, self.n, self.children, self.leaves, self.below = None, 0, 0, 0, 0
        self.ends = None if in_skeleton else hashlib.sha256()
        self.run, self.ended, self.kids = [], False, []


class Walk:
    """Walks sorted paths depth first, keeping the open nodes of the current path only (and, until a node's smallest
    member is known, the finished rows of its children)."""

    def __init__(self, skeleton: frozenset[bytes]):
        self.skeleton, self.out = skeleton, []
        self.stack = [Node(b"", 0, b"" in skeleton)]
        self.last = b""

    def row(self, kind: str, x: Node, depth: int, parent: bytes | None, above: int | None, ends: bytes | None) -> tuple:
        return (kind, x.id, depth, parent, x.least, above, x.n, x.children, x.leaves, x.below, x.chars, ends)

    def add(self, conv: int, key: bytes, chars: np.ndarray) -> None:
        shared = common(self.last, key)
        while len(self.stack) > shared + 1:
            self.close()
        for depth in range(shared + 1, len(key) // WIDTH + 1):
            at = key[(depth - 1) * WIDTH : depth * WIDTH]
            self.stack.append(Node(at, int(chars[depth - 1]), self.stack[-1].open and at in self.skeleton))
        top = self.stack[-1]
        if top.open:
            top.run.append(conv)
            if len(top.run) >= RUN:
                self.give_run(top)
        else:
            top.ends.update(b",%d" % conv if top.ended else b"%d" % conv)
            top.ended = True
        top.n += 1
        top.least = conv if top.least is None else min(conv, top.least)
        self.last = key

    def give_run(self, x: Node) -> None:
        if x.run:
            text = ",".join(map(str, x.run)).encode()
            self.out.append(("run", x.id, 0, None, x.run[0], None, len(x.run), 0, 0, 0, 0, text))
            x.run = []

    def close(self) -> None:
        """The deepest open node is done: its sums go to its parent, its row waits there."""
        x, depth = self.stack.pop(), len(self.stack)
        above = self.stack[-1] if depth else None
        for kid in x.kids:  # rows of children, which lack the smallest member of this node
            self.out.append((*kid[:5], None if x.open else x.least, *kid[6:]))
        if x.open:
            self.give_run(x)
            self.out.append(self.row("part", x, depth, above.id if above else None, None, None))
        else:
            if not x.children:
                x.leaves = 1
            x.below += (x.n - 1) * x.chars
            done = self.row("node", x, depth, above.id if above and above.open else None, None, x.ends.hexdigest().encode())
            if above:
                above.kids.append(done)
                above.children += 1
            else:
                self.out.append(done)
        if above:
            above.n += x.n
            above.leaves += x.leaves
            above.below += x.below
            above.least = x.least if above.least is None else min(x.least, above.least)

    def finish(self) -> None:
        while self.stack:
            self.close()


def table(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def shard_rows(sorted_paths: DataFrame, skeleton: set[bytes]) -> DataFrame:
    """Finished nodes (``kind`` node), partial aggregates (part) and runs of ids (run) of every shard."""
    kinds = {"string": pa.string(), "binary": pa.binary(), "int": pa.int32(), "long": pa.int64()}
    schema = pa.schema([(n, kinds[t]) for n, t in (c.split() for c in NODE.split(", "))])
    held = sorted_paths.sparkSession.sparkContext.broadcast(frozenset(skeleton))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walk, seen = Walk(held.value), False
        for batch in batches:
            for conv, key, chars in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "key", "chars")), strict=True):
                walk.add(conv, key, np.frombuffer(chars, "<i8"))
                seen = True
            while len(walk.out) >= 4096:
                yield table(walk.out[:4096], schema)
                del walk.out[:4096]
        if seen:
            walk.finish()
            for at in range(0, len(walk.out), 4096):
                yield table(walk.out[at : at + 4096], schema)

    return sorted_paths.mapInArrow(run, NODE)


# ---- the skeleton


def splitters(sorted_paths: DataFrame) -> list[tuple[bytes, bytes]]:
    """First and last key of every shard that has rows, in order: two keys a shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        first = last = None
        for batch in batches:
            if batch.num_rows:
                first = batch.column("key")[0].as_py() if first is None else first
                last = batch.column("key")[batch.num_rows - 1].as_py()
        if first is not None:
            rows = [(TaskContext.get().partitionId(), first, last)]
            yield table(rows, pa.schema([("shard", pa.int32()), ("first", pa.binary()), ("last", pa.binary())]))

    rows = sorted_paths.select("key").mapInArrow(run, "shard int, first binary, last binary").collect()
    return [(bytes(r["first"]), bytes(r["last"])) for r in sorted(rows, key=lambda r: r["shard"])]


def skeleton_of(edges: list[tuple[bytes, bytes]]) -> set[bytes]:
    """The nodes that reach over a splitter: common beginnings of the paths on its two sides."""
    out: set[bytes] = set()
    for (_, last), (first, _) in zip(edges, edges[1:], strict=False):
        out.add(b"")
        out.update(first[i * WIDTH : (i + 1) * WIDTH] for i in range(common(last, first)))
    return out


def run_digests(rows: DataFrame, n: int) -> DataFrame:
    """SHA-256 of the ids that end at each skeleton node: its runs in order, one at a time."""
    schema = pa.schema([("node", pa.binary()), ("ends_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            for at, text in zip(batch.column("node").to_pylist(), batch.column("ends").to_pylist(), strict=True):
                if state is not None and at == node:
                    state.update(b",")
                else:
                    if state is not None:
                        yield table([(node, state.hexdigest())], schema)
                    node, state = at, hashlib.sha256()
                state.update(text)
        if state is not None:
            yield table([(node, state.hexdigest())], schema)

    dealt = rows.select("node", "conv_id", "ends").repartition(n, "node").sortWithinPartitions("node", "conv_id")
    return dealt.select("node", "ends").mapInArrow(run, "node binary, ends_sha256 string")


def finished(parts: list) -> list[tuple]:
    """The skeleton's nodes from their reduced partial aggregates: sums over subtrees, from the leaves up."""
    by_id = {bytes(r["node"]): r for r in sorted(parts, key=lambda r: r["depth"])}
    extra = {k: [0, 0, 0] for k in by_id}  # skeleton children; leaves and saved characters of skeleton nodes below
    rows = []
    for node in reversed(by_id):
        r, (children, leaves, below) = by_id[node], extra[node]
        children += r["n_children"]
        leaves += r["n_leaves"] if children else 1
        below += r["saved_tokens"] + (r["n_convs"] - 1) * r["chars"]
        above = None
        if r["depth"]:
            above = bytes(r["parent"])
            up = extra[above]
            up[0] += 1
            # What lies below in finished nodes is in the parent's own sums already.
            up[1] += leaves - r["n_leaves"]
            up[2] += below - r["saved_tokens"]
            above = by_id[above]["conv_id"]
        rows.append((node, r["conv_id"], r["depth"], above, r["n_convs"], children, leaves, below, r["ends_sha256"]))
    return rows


# ---- the operator


def trie(conversations: DataFrame, shard_turns: int = SHARD_TURNS, least_turns: int = LEAST_TURNS) -> DataFrame:
    """One row per node: smallest member, depth, the parent's smallest member, members, children, leaves, saved characters, digest of ends."""
    spark = conversations.sparkSession
    made = saved(spark, paths(conversations), "trie-paths")
    total = made.agg(F.sum(F.length("key") / WIDTH + 1).cast("long").alias("n")).first()["n"] or 0
    n = max(1, total // shard_turns, min(partitions(spark), total // least_turns))
    shards = materialize(made.repartitionByRange(n, "key", "conv_id").sortWithinPartitions("key", "conv_id"))
    skeleton = skeleton_of(splitters(shards))
    rows = saved(spark, shard_rows(shards, skeleton), "trie-rows")
    empty = hashlib.sha256().hexdigest()
    reduced = (
        rows.where("kind = 'part'")
        .groupBy("node")
        .agg(
            F.min("depth").alias("depth"),
            F.min("parent").alias("parent"),
            F.min("conv_id").alias("conv_id"),
            *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
            F.max("chars").alias("chars"),
        )
    )
    digests = run_digests(rows.where("kind = 'run'"), partitions(spark))
    parts = reduced.join(digests, "node", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(empty)))
    # As many rows as the skeleton has nodes: shards x depth at most.
    top = spark.createDataFrame(finished(parts.collect()), SKELETON)
    own = rows.where("kind = 'node'").withColumn("ends_sha256", F.col("ends").cast("string"))
    above = top.select(F.col("node").alias("parent"), F.col("conv_id").alias("_above"))
    own = own.join(F.broadcast(above), "parent", "left").withColumn("parent_conv_id", F.coalesce("_above", "parent_conv_id"))
    both = own.select(*COLUMNS).unionByName(top.select(*COLUMNS))
    return both.withColumn("depth", F.col("depth").cast("long"))
