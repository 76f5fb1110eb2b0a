"""Substring removal and the Jaccard join against brute force; components against union-find."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from appraise.llm import chunks, jaccard, substrings
from appraise.llm.common import byte_words, split_words
from appraise.llm.components import components

from .samples import sample_docs


def cut_by_hand(docs, size):
    """For each row in order (key, text): words, removed words and digest."""
    docs = sorted(docs, key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
    first: dict = {}
    for d, (_, t) in enumerate(docs):
        w = split_words(t)
        for i in range(len(w) - size + 1):
            first.setdefault(tuple(w[i : i + size]), (d, i))
    out = []
    for d, (k, t) in enumerate(docs):
        w = split_words(t)
        gone = [False] * len(w)
        for i in range(len(w) - size + 1):
            if first[tuple(w[i : i + size])] != (d, i):
                gone[i : i + size] = [True] * size
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((k, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def near_copies(seed=1, n=150):
    """Texts with passages shared by many, exact and near copies, and repeats inside a text."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    shared = [" ".join(rng.choices(words, k=rng.choice([19, 20, 21, 35, 60]))) for _ in range(6)]
    base = [" ".join(rng.choices(words, k=rng.randint(30, 90))) for _ in range(8)]
    rows = []
    for i in range(n):
        kind = rng.random()
        if kind < 0.5:
            w = rng.choice(base).split()
            for _ in range(rng.choice([0, 0, 1, 2, 3, 6])):
                w[rng.randrange(len(w))] = rng.choice(words)
            t = " ".join(w)
        else:
            parts = [" ".join(rng.choices(words, k=rng.randint(0, 40))), rng.choice(shared), "", rng.choice(shared)]
            rng.shuffle(parts)
            t = "\n".join(parts)
        rows.append((i, t.upper() if rng.random() < 0.1 else t))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_substrings_by_brute_force(spark, seed):
    rows = [*near_copies(seed), (7, "again " * 50), (7, "again " * 50), (None, "again " * 25), (500, None), (501, ""), (502, "  \n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumnRenamed("doc_id", "key").withColumn("n_words", substrings.F.lit("x"))
    got = substrings.remove_repeats(docs, "key").collect()
    assert sorted([(r.key, r.n_words, r.n_removed, r.kept_sha256) for r in got], key=str) == cut_by_hand(rows, 20)
    assert all(hashlib.sha256(r.kept_text.encode()).hexdigest() == r.kept_sha256 for r in got)


def test_substrings_of_a_sample(spark):
    docs = sample_docs(spark)
    got = substrings.remove_repeats(docs).collect()
    want = cut_by_hand([(r.doc_id, r.text) for r in docs.collect()], 20)
    assert sorted([(r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got], key=str) == want
    assert substrings.remove_repeats(docs.where("false")).count() == 0


def joined_by_hand(docs, percent=75):
    sets = []
    for _, t in docs:
        w = [x.decode() for x in byte_words(t, lower=True)]
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()})
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    inverted = defaultdict(list)
    for i, s in enumerate(sets):
        for j, n in Counter(j for x in s for j in inverted[x]).items():
            if 100 * n >= percent * len(s | sets[j]):
                root[find(i)] = find(j)
        for x in s:
            inverted[x].append(i)
    least: dict = {}
    for i, (k, _) in enumerate(docs):
        a = float("inf") if k is None else k
        least[find(i)] = min(least.get(find(i), a), a)
    return sorted(
        [(k, len(s), None if (m := least[find(i)]) == float("inf") else m) for i, ((k, _), s) in enumerate(zip(docs, sets, strict=True))], key=str
    )


@pytest.mark.parametrize("seed", [3, 4])
def test_jaccard_by_brute_force(spark, monkeypatch, seed):
    monkeypatch.setattr(jaccard, "BLOCK", 4)  # many blocks and parts
    monkeypatch.setattr(jaccard, "PART", 5)
    rows = [*near_copies(seed, 220), (7, "again " * 50), (7, "one two"), (9, "ONE two"), (None, "one  two"), (500, None), (501, ""), (None, " ")]
    docs = spark.createDataFrame(rows, "key long, text string")
    got = jaccard.jaccard_components(docs, "key").collect()
    assert sorted([(r.key, r.n_shingles, r.component_id) for r in got], key=str) == joined_by_hand(rows)


def test_chain_of_near_copies(spark):
    """Neighbours link, ends don't: one component by links that no single pivot sees."""
    words = [f"v{i}" for i in range(300)]
    rows = [(i, " ".join(words[i * 3 : i * 3 + 60])) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = jaccard.jaccard_components(docs).collect()
    assert sorted([(r.doc_id, r.n_shingles, r.component_id) for r in got], key=str) == joined_by_hand(rows)
    assert {r.component_id for r in got} == {0}


def test_jaccard_of_a_sample(spark):
    docs = sample_docs(spark)
    got = jaccard.jaccard_components(docs.withColumnRenamed("n_chars", "n_shingles")).collect()
    assert sorted([(r.doc_id, r.n_shingles, r.component_id) for r in got], key=str) == joined_by_hand([(r.doc_id, r.text) for r in docs.collect()])
    assert jaccard.jaccard_components(docs.where("false")).count() == 0


def test_components(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(1000 + i, 1001 + i) for i in range(40)] + [(5, 5)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    group = {x: {x} for e in edges for x in e}
    for a, b in edges:
        if group[a] is not group[b]:
            group[a] |= group[b]
            for x in group[b]:
                group[x] = group[a]
    nodes = {x for a, b in edges if a != b for x in (a, b)}
    assert set(got) == nodes
    assert {frozenset(x for x in got if got[x] == r) for r in set(got.values())} == {frozenset(group[x]) for x in nodes}


def test_packed_hashes():
    rng = np.random.default_rng(1)
    for n in (0, 1, 5, 4000):
        v = np.unique(rng.integers(0, 1 << 32, n, dtype=np.uint64)).astype(np.uint32)
        assert (chunks.unpacked(chunks.packed(v), len(v)) == v).all()


def test_rolled_hashes_are_those_of_the_window():
    h = np.random.default_rng(2).integers(0, 1 << 63, 64, dtype=np.uint64)
    for size in (1, 2, 5, 10, 20, 64):
        got = chunks.rolled(h, size, np.uint64(0x9E3779B97F4A7C15))
        assert len(got) == 64 - size + 1
        assert all(got[i] == chunks.rolled(h[i : i + size], size, np.uint64(0x9E3779B97F4A7C15))[0] for i in range(len(got)))
