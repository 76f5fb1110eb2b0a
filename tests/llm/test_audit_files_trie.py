"""Filter audit, token files and prefix trie against plain Python and DuckDB."""

from __future__ import annotations

import hashlib
import heapq
import itertools
import json
import math
import uuid
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from appraise.llm import filter_audit, prefix_trie, token_files
from appraise.session import scratch_path
from tests.conftest import SF_SMALL

from .samples import sample_docs

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def rows_of(df, columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


# ---- filter audit

AUDIT = ("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def plain_audit(docs, labels):
    """Applies the filters one after another, document by document."""
    import re

    good = {k for k, q, _ in labels if q == 1 and k is not None}
    toxic = {k for k, _, t in labels if t == 1 and k is not None}
    least = {}
    for k, t, _ in docs:
        if k is not None:
            least[t or ""] = min(k, least.get(t or "", k))
    parts = defaultdict(list)
    for k, t, lang in docs:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {
            "A": len(w) < 100,
            "B": 100 * len(set(w)) < 80 * len(w),
            "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
            "D": bool(re.search(r"[#$%&*|]", t)),
            "E": k is not None and k > least[t],
        }
        parts[lang or ""].append((k, {f for f, bad in fails.items() if bad}))
    out, removed_by = [], Counter()
    for part, members in parts.items():
        for order in itertools.permutations("ABCDE"):
            left = members
            for step, f in enumerate(order, 1):
                gone = [(k, b) for k, b in left if f in b]
                left = [(k, b) for k, b in left if f not in b]
                failing = sum(f in b for _, b in members)
                removed_by[part, f] += len(gone)
                out.append([part, "".join(order), step, len(left), len(gone), failing - len(gone), sum(b == {f} for _, b in members),
                            sum(k in good for k, _ in gone), sum(k in toxic for k, _ in gone), f])
    return sorted((tuple(r[:9]) + (removed_by[r[0], r[9]],) for r in out), key=str)


def odd_audit(spark):
    copies = "THE SAME #text " * 60
    docs = [(i, copies, "en") for i in range(30)] + [(None, copies, "en"), (None, "x", None), (3, copies, "en"), (3, copies, "de")]
    docs += [(50, None, None), (51, "", ""), (52, " ".join(f"w{i}" for i in range(200)), "fr"), (53, "A b " * 99, "fr"), (54, "a%b", "de")]
    docs += [(55, " ".join(f"w{i}" for i in range(200)) + "\n", "fr")]
    labels = [(3, 1, 0), (3, 0, 1), (4, 1, 1), (50, 1, None), (52, None, 1), (None, 1, 1), (99, 1, 1)]
    return docs, labels


def test_audit_of_odd_rows(spark):
    docs, labels = odd_audit(spark)
    # Columns that clash with the operator's own names.
    frame = spark.createDataFrame([(*d, "mine", 7) for d in docs], "doc_id long, text string, lang string, part string, _mask int")
    marks = spark.createDataFrame([(*x, 9) for x in labels], "doc_id long, quality int, toxic int, n int")
    assert rows_of(filter_audit.corpus_audit(frame, marks), AUDIT) == plain_audit(docs, labels)
    none = filter_audit.corpus_audit(frame.limit(0), marks.limit(0))
    assert none.collect() == [] and none.columns == list(AUDIT)


def test_audit_agrees_with_plain_python_and_sql(spark):
    docs = sample_docs(spark).where("doc_id is not null")
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    got = rows_of(filter_audit.corpus_audit(docs, labels), AUDIT)
    assert got == plain_audit([tuple(r) for r in docs.select("doc_id", "text", "lang").collect()], [tuple(r) for r in labels.collect()])
    con = duckdb.connect()
    con.register("documents", docs.toPandas())
    con.register("labels", labels.toPandas())
    want = con.execute(filter_audit.oracle()).df()[list(AUDIT)]
    assert got == sorted((tuple(r) for r in want.astype(object).itertuples(index=False)), key=str)


def test_audit_of_two_filters(spark):
    """The contraction is general: two filters, counts by hand."""
    cells = spark.createDataFrame([("p", 0, 5, 1, 0), ("p", 1, 3, 0, 2), ("p", 2, 4, 4, 0), ("p", 3, 2, 1, 1)], "part string, mask int, n long, good long, toxic long")
    got = {(r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in filter_audit.audit(cells, "XY").collect()}
    assert got == {
        ("XY", 1): (9, 5, 0, 3, 1, 3, 8),
        ("XY", 2): (5, 4, 2, 4, 4, 0, 10),
        ("YX", 1): (8, 6, 0, 4, 5, 1, 10),
        ("YX", 2): (5, 3, 2, 3, 0, 2, 8),
    }


# ---- token files


def huffman_cost(counts):
    heap = [(int(c), 0) for c in counts if c]
    heapq.heapify(heap)
    cost = 0
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        cost += a[0] + b[0]
        heapq.heappush(heap, (a[0] + b[0], 0))
    return cost


def limited_cost(counts, limit):
    """Least cost of codes of at most ``limit`` bits, by trying all length multisets (few symbols)."""
    w = sorted((int(c) for c in counts if c), reverse=True)
    best = None
    for lengths in itertools.combinations_with_replacement(range(1, limit + 1), len(w)):
        if sum(2.0**-n for n in lengths) <= 1:
            cost = sum(a * b for a, b in zip(w, lengths, strict=True))
            best = cost if best is None else min(best, cost)
    return best


def test_code_lengths():
    rng = np.random.default_rng(3)
    for n in (2, 3, 10, 500):
        counts = (rng.pareto(1.0, n) * 5).astype(np.int64)
        lengths = token_files.code_lengths(counts, 40).astype(int)
        assert (lengths[counts == 0] == 0).all()
        if (counts > 0).sum() > 1:
            assert (counts * lengths).sum() == huffman_cost(counts)
            assert sum(2.0 ** -lengths[counts > 0]) == 1
    fibonacci = np.array([1, 1, 2, 3, 5, 8, 13])
    for limit in (3, 4, 5):
        lengths = token_files.code_lengths(fibonacci, limit).astype(int)
        assert lengths.max() <= limit and (fibonacci * lengths).sum() == limited_cost(fibonacci, limit)
    assert list(token_files.code_lengths(np.array([0, 7]))) == [0, 1]
    assert len(token_files.code_lengths(np.zeros(0, np.int64))) == 0
    with pytest.raises(ValueError):
        token_files.code_lengths(np.ones(9, np.int64), 3)


def test_codes_are_canonical_and_blocks_stand_alone():
    rng = np.random.default_rng(5)
    ids = np.minimum(rng.zipf(1.2, 50_001), 3000).astype(np.uint32)
    codes = token_files.Codes(token_files.code_lengths(np.bincount(ids), 14))
    text = {int(i): format(int(codes.code[i]), f"0{codes.lengths[i]}b") for i in np.unique(ids)}
    by_code = sorted(text, key=lambda i: (len(text[i]), i))
    assert sorted(text.values()) == [text[i] for i in by_code]  # longer codes and larger ids come later
    assert not any(b.startswith(a) for a, b in itertools.pairwise(sorted(text.values())))
    stream, offsets = codes.encode(ids)
    bits = "".join(format(b, "08b") for b in stream)
    assert bits.rstrip("0") == "".join(text[int(i)] for i in ids).rstrip("0")
    table = codes.table()
    assert (token_files.decode(stream, offsets, len(ids), table, codes.bits) == ids).all()
    a, b = 7, 9  # from a checkpoint on, without what lies before
    first = int(offsets[a]) // 8
    got = token_files.decode(stream[first : int(offsets[b]) // 8 + 1], offsets[a:b] - 8 * first, (b - a) * 256, table, codes.bits)
    assert (got == ids[a * 256 : b * 256]).all()


ODD_TEXTS = [
    "Hello, WORLD. don't DON'T we'll it's o'clock's x.y.z a., .5 3.14, 1,000. '' 's 'S.",
    "<|endoftext|> mid<|endoftext|>dle <|ENDOFTEXT|> <|startoftext|>. <|endoftext|>,",
    "é café. İstanbul ΣΑΣ.  nbsp em\u0085next ẛ̣ 가가 ̈́",
    "tab\tline\nfeed\x0bv\x0cf\rr \x1c\x1d\x00 zero​width   sep",
    '" "" "quote" said "a".',
    "\U0001f600\U0001f469‍\U0001f4bb emoji! 中文字. क्ष, กำ",
]


def test_words_give_the_ids_of_whole_texts():
    model = Tokenizer.from_file(WORD_BPE)
    own = token_files.WordEncoder(open(WORD_BPE, encoding="utf-8").read(), False)
    rng = np.random.default_rng(1)
    chars = "aZ.,'s\" \n\t<|>éİΣé中 5!-"
    texts = ODD_TEXTS + ["".join(rng.choice(list(chars), 60)) for _ in range(500)]
    for t in [*texts, "", None]:
        want = model.encode(t or "", add_special_tokens=False).ids
        assert np.frombuffer(own.ids(t), "<u2").tolist() == want, t


def test_files_hold_every_id(spark):
    docs = sample_docs(spark)
    odd = [(2_000_000 + i, t, "en", "src9", len(t)) for i, t in enumerate(ODD_TEXTS)]
    docs = docs.unionByName(spark.createDataFrame(odd, docs.schema)).selectExpr("*", "'mine' as ids", "1 as start", "2 as key", "3 as row")
    got = token_files.round_trip(docs, WORD_BPE).collect()
    model, want = Tokenizer.from_file(WORD_BPE), []
    for r in docs.collect():
        ids = [*model.encode(r.text or "", add_special_tokens=False).ids, 1]
        want.append((r.doc_id, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    order = sorted(got, key=lambda r: r.start)
    last = float("inf")
    assert [r.start for r in order] == list(np.cumsum([0] + [r.n_tokens for r in order[:-1]]))
    keys = [last if r.doc_id is None else r.doc_id for r in order]
    assert keys == sorted(keys)
    assert sorted(((r.doc_id, r.n_tokens, r.ids_crc32) for r in got), key=str) == sorted(want, key=str)
    assert token_files.round_trip(docs.limit(0), WORD_BPE).collect() == []
    again = token_files.round_trip(docs.repartition(3, "text"), WORD_BPE).collect()
    assert sorted(map(tuple, again), key=str) == sorted(map(tuple, got), key=str)


def test_readers_follow_the_manifest(spark):
    """Files that a lost or repeated task left are not read; a shard whose tail is broken is an error."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    path = scratch_path(spark, f"ids-test-{uuid.uuid4().hex}")
    token_files.write(docs, path, WORD_BPE)
    shards = json.loads(token_files._get(path, "manifest"))
    assert sum(s["documents"] for s in shards) == docs.count() and len(shards) > 1
    token_files._put(path, "shard-000000-left-over", token_files._get(path, shards[0]["file"]))
    assert token_files.read(spark, path).count() == docs.count()
    text = sum(len(r.text or "") for r in docs.collect())
    stored = sum(len(token_files._get(path, s["file"])) for s in shards)
    assert stored < 0.6 * text
    token_files._put(path, shards[0]["file"], b"broken" * 20)
    with pytest.raises(Exception, match="not a file of ids"):
        token_files.read(spark, path).collect()


# ---- prefix trie


def plain_trie(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    made = {}
    for c, got in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = sorted(own.get(c - int(math.fmod(c, 100)), []))
        made[c] = tuple((r, t) for *_, r, t in base[:h] + sorted(got)[h:])
    members, ends = defaultdict(list), defaultdict(list)
    for c, path in made.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
        ends[path].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        kids = children[node]
        leaves[node] = sum(leaves[k] for k in kids) if kids else 1
        saved[node] = sum(saved[k] for k in kids) + (len(members[node]) - 1) * (len(node[-1][1]) if node else 0)
    return sorted(
        (
            (min(m), len(node), min(members[node[:-1]]) if node else None, len(m), len(children[node]), leaves[node], saved[node],
             hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest())
            for node, m in members.items()
        ),
        key=str,
    )


def random_conversations(n, seed):
    rng = np.random.default_rng(seed)
    rows = []
    for c in range(n):
        if rng.random() < 0.35:  # a third of all conversations is one conversation
            rows += [(c, t, "user", f"same {t}") for t in range(6)]
            continue
        for t in range(int(rng.integers(1, 9))):
            rows.append((c, t, str(rng.choice(["user", "assistant"])), f"é{rng.integers(0, 3)}"))
    return rows


@pytest.mark.parametrize("least,turns", [(1, 120), (40, 10**9), (10**9, 10**9)])
def test_trie_equals_plain_python(spark, least, turns):
    rows = random_conversations(900, least % 7)
    odd = [(5000, None, "user", "x"), (5000, 0, None, None), (5001, 0, "user", ""), (5002, 0, "", None), (None, 0, "user", "lost")]
    odd += [(5103, 3, "user", "b"), (5103, 1, "user", "a"), (5103, 1, "user", "a"), (5104, 0, "user", "LONG" * 100_000)]
    odd += [(5200, t, "user", f"deep {t}") for t in range(300)] + [(5299, t, "user", f"deep {t}") for t in range(300)]
    odd += [(10**15 + 3, 0, "user", "x"), (-5, 0, "user", "x"), (-100, 0, "user", "y"), (-205, 1, "user", "z")]
    df = spark.createDataFrame([(*r, b"mine", "k") for r in rows + odd], "conv_id long, turn long, role string, text string, node binary, kind string")
    got = rows_of(prefix_trie.trie(df, turns, least), prefix_trie.COLUMNS)  # some 40 shards, four, one
    assert got == plain_trie(rows + odd)


def test_trie_of_the_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    want = plain_trie([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])
    for least in (50, 10**9):
        assert rows_of(prefix_trie.trie(df, least_turns=least), prefix_trie.COLUMNS) == want
    none = prefix_trie.trie(df.limit(0))
    assert none.collect() == [] and tuple(none.columns) == prefix_trie.COLUMNS


def test_skeleton_is_what_reaches_over_a_splitter():
    a, b, c, d = (bytes([x]) * 16 for x in (1, 2, 3, 4))
    edges = [(a, a + b), (a + b + c, a + b + c), (a + b + c + d, b), (c, d)]
    assert prefix_trie.skeleton_of(edges) == {b"", a, b, c}
    assert prefix_trie.skeleton_of(edges[:1]) == set()
    assert prefix_trie.common(a + b + c, a + b + d) == 2
    assert prefix_trie.common(b"", a) == 0
