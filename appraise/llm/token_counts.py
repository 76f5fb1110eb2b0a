"""Operator 9: edit-aware token counts.

A document's state is its text and a tree over its pre-tokens: leaves are runs of
pre-tokens with their lengths in characters and tokens, inner nodes hold sums. An
edit (start, stop, replacement; code points) descends the tree to the first
pre-token that it can change, splits the text anew from there until a boundary
falls on an old one beyond the edit, encodes only those pre-tokens, puts them into the
leaf and updates the sums on the paths to the root.

How much context is enough: a pre-token depends on the text from its start to
one character beyond the character after it (a look-ahead after white space, a
contraction cut short), so all pre-tokens that end two or more characters before the
edit stay, and what follows a common boundary is split as before.

Defined results: a null text counts as empty (0 tokens, null stays null); edits beyond the
end of a text are clipped to it; edits of a document apply one after another, each to
the outcome of the one before; documents without edits keep their counts; repeated rows are
counted one by one; other columns of the input are ignored or kept, as said below.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from appraise.llm.common import map_batches

# Fixed value: the published split pattern of the byte-level vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
LEAF = 64

Edit = tuple[int, int, str]


class Encoder:
    """Splits texts into pre-tokens and counts the tokens of each; counts are kept (up to ``keep`` pre-tokens)."""

    def __init__(self, ranks_file: bytes, pattern: str = PATTERN, keep: int = 500_000):
        import regex
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks_file.splitlines())}
        self.bpe = tiktoken.Encoding("vocabulary", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.split, self.keep, self.known = regex.compile(pattern), keep, {}

    def counts(self, pieces: list[str]) -> list[int]:
        known = self.known
        if len(known) > self.keep:
            known.clear()
        for piece in set(pieces).difference(known):
            known[piece] = len(self.bpe.encode_ordinary(piece))
        return list(map(known.__getitem__, pieces))


def encoder(held, own: list[Encoder]) -> Encoder:
    """The worker's encoder, made once from the broadcast vocabulary file."""
    if not own:
        own.append(Encoder(held.value))
    return own[0]


class Tree:
    """Text, pre-tokens and the tree of sums of one document."""

    def __init__(self, text: str, enc: Encoder, chars: np.ndarray | None = None, tokens: np.ndarray | None = None):
        self.text, self.enc, self.reencoded = text, enc, 0
        if chars is None:
            pieces = enc.split.findall(text)
            chars, tokens = np.array([len(x) for x in pieces], np.int64), np.array(enc.counts(pieces), np.int64)
        self._build(chars, tokens)

    def _build(self, chars: np.ndarray, tokens: np.ndarray) -> None:
        at = range(0, max(1, len(chars)), LEAF)
        self.leaves = [(chars[i : i + LEAF], tokens[i : i + LEAF]) for i in at]
        level = np.array([(c.sum(), t.sum()) for c, t in self.leaves], np.int64)
        self.levels = [level]  # from the leaves to the root: characters and tokens
        while len(level) > 1:
            level = np.add.reduceat(level, np.arange(0, len(level), 2), axis=0)
            self.levels.append(level)

    @property
    def tokens(self) -> int:
        return int(self.levels[-1][0, 1])

    @property
    def pretokens(self) -> int:
        return sum(len(c) for c, _ in self.leaves)

    def arrays(self) -> tuple[np.ndarray, np.ndarray]:
        return np.concatenate([c for c, _ in self.leaves]), np.concatenate([t for _, t in self.leaves])

    def _leaf_at(self, pos: int) -> tuple[int, int]:
        """The leaf that holds the character (the last one for the end of the text), and where it starts."""
        node, start = 0, 0
        for level in reversed(self.levels[:-1]):
            node *= 2
            if node + 1 < len(level) and pos >= start + level[node, 0]:
                start += int(level[node, 0])
                node += 1
        return node, start

    def _set(self, leaf: int, chars: np.ndarray, tokens: np.ndarray) -> None:
        self.leaves[leaf] = (chars, tokens)
        change = np.array([chars.sum(), tokens.sum()]) - self.levels[0][leaf]
        for level in self.levels:
            level[leaf] += change
            leaf //= 2

    def edit(self, start: int, stop: int, new: str) -> None:
        size = len(self.text)
        start = min(max(0, start), size)
        stop = min(max(start, stop), size)
        text = self.text[:start] + new + self.text[stop:]
        shift, edge = len(new) - (stop - start), start + len(new)
        # The first pre-token that ends less than two characters before the edit.
        first, before = self._leaf_at(max(0, start - 2))
        ends = before + np.cumsum(self.leaves[first][0])
        i = int(np.searchsorted(ends, start - 1, side="left"))
        restart = before if i == 0 else int(ends[i - 1])
        # New pre-tokens up to the first boundary beyond the edit that the old text has too.
        pieces, pos, last, base = [], restart, first, before
        while True:
            if pos >= edge:
                old = pos - shift
                while last + 1 < len(self.leaves) and old > base + self.levels[0][last, 0]:
                    base += int(self.levels[0][last, 0])
                    last += 1
                ends = base + np.cumsum(self.leaves[last][0])
                k = int(np.searchsorted(ends, old, side="right"))
                if old == (ends[k - 1] if k else base):
                    break
            found = self.enc.split.match(text, pos)
            pieces.append(found[0])
            pos = found.end()
        self.text = text
        self.reencoded += len(pieces)
        chars = np.array([len(x) for x in pieces], np.int64)
        tokens = np.array(self.enc.counts(pieces), np.int64)
        head, tail = self.leaves[first], self.leaves[last]
        merged = [np.concatenate([h[:i], x, t[k:]]) for h, x, t in zip(head, (chars, tokens), tail, strict=True)]
        none = np.zeros(0, np.int64)
        for leaf in range(first + 1, last + 1):
            self._set(leaf, none, none)
        self._set(first, *merged)
        if len(merged[0]) > 8 * LEAF:
            self._build(*self.arrays())


def vocabulary(spark: SparkSession, path: str):
    """The vocabulary file, read on the driver and sent to the tasks."""
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def build(docs: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """Add the state of a tree (``chars``, ``tokens``: packed per pre-token) and ``n_tokens``; other columns stay."""
    held, own = vocabulary(docs.sparkSession, path), []

    def run(batch):
        trees = [Tree(t or "", encoder(held, own)) for t in batch.column("text").to_pylist()]
        packed = [[a.astype("<i4").tobytes() for a in t.arrays()] for t in trees]
        return {"chars": [c for c, _ in packed], "tokens": [t for _, t in packed], "n_tokens": [t.tokens for t in trees]}

    docs = docs.drop("chars", "tokens", "n_tokens")
    schema = T.StructType(list(docs.schema.fields)).add("chars", "binary").add("tokens", "binary").add("n_tokens", "long")
    return map_batches(docs, run, schema)


def update(states: DataFrame, edits: DataFrame, key: str = "doc_id", path: str = VOCABULARY) -> DataFrame:
    """States after ``edits`` (key, seq, start, stop, replacement), in the order of seq; untouched states stay as they are."""
    held, own = vocabulary(states.sparkSession, path), []
    lists = edits.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("seq", "start", "stop", "replacement"))).alias("_edits"))
    columns = states.columns

    def run(batch):
        out: dict[str, list] = {"text": [], "chars": [], "tokens": [], "n_tokens": []}
        names = ("text", "chars", "tokens", "n_tokens", "_edits")
        for text, c, t, n, todo in zip(*[batch.column(x).to_pylist() for x in names], strict=True):
            if todo:
                state = [np.frombuffer(x, "<i4").astype(np.int64) for x in (c, t)]
                tree = Tree(text or "", encoder(held, own), *state)
                for e in todo:
                    tree.edit(e["start"], e["stop"], e["replacement"] or "")
                c, t = (a.astype("<i4").tobytes() for a in tree.arrays())
                text, n = tree.text, tree.tokens
            for name, x in zip(out, (text, c, t, n), strict=True):
                out[name].append(x)
        return out

    joined = states.join(lists, key, "left").select(*columns, "_edits")
    return map_batches(joined, run, joined.schema).select(*columns)


_DIGITS = re.compile(r"[0-9]{4,}")


def cleaning_edits(text: str) -> list[Edit]:
    """The edits of a cleaning pass, last first (so offsets hold): lines that repeat an earlier one go, digit runs of
    four or more become ``0``."""
    out: list[Edit] = []
    seen, at = set(), 0
    for line in text.split("\n"):
        end = at + len(line)
        if line.strip() and line in seen:
            out.append((max(0, at - 1), end, ""))
        else:
            seen.add(line)
            out += [(at + m.start(), at + m.end(), "0") for m in _DIGITS.finditer(line)]
        at = end + 1
    return out[::-1]


def recount(docs: DataFrame, edits_of: Callable[[str], list[Edit]], key: str = "doc_id", path: str = VOCABULARY) -> DataFrame:
    """Per row: tokens and pre-tokens of the text, and after its edits the tokens and the pre-tokens that were encoded again."""
    held, own = vocabulary(docs.sparkSession, path), []

    def run(batch):
        out: dict[str, list] = {c: [] for c in ("n_tokens", "n_pretokens", "n_edits", "n_reencoded", "n_tokens_after")}
        for text in batch.column("text").to_pylist():
            tree = Tree(text or "", encoder(held, own))
            todo = edits_of(tree.text)
            before = (tree.tokens, tree.pretokens, len(todo))
            for e in todo:
                tree.edit(*e)
            for name, x in zip(out, (*before, tree.reencoded, tree.tokens), strict=True):
                out[name].append(x)
        return out

    schema = T.StructType([docs.schema[key]])
    for name in ("n_tokens", "n_pretokens", "n_edits", "n_reencoded", "n_tokens_after"):
        schema = schema.add(name, "long")
    return map_batches(docs.select(key, "text"), run, schema)
