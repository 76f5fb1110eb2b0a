from __future__ import annotations

import random

import pytest

from appraise.llm import token_counts as X


@pytest.fixture(scope="module")
def enc():
    with open(X.VOCABULARY, "rb") as f:
        return X.Encoder(f.read())


def whole(enc, text):
    return len(enc.bpe.encode_ordinary(text))


def test_random_edits_agree_with_a_full_count(enc):
    rng = random.Random(3)
    bits = ["the ", "don't", "'", "'r", "e", "  ", "\n", "\n\n", "12", "3", "é", "ßen", "!!", " ", "\t ", "we've ", "x", "日本"]
    for _ in range(300):
        text = "".join(rng.choices(bits, k=rng.choice([0, 1, 5, 40, 900])))
        tree = X.Tree(text, enc)
        assert tree.tokens == whole(enc, text)
        for _ in range(6):
            a = rng.randint(0, len(text) + 2)
            b = a + rng.choice([0, 0, 1, 2, 9, 300])
            new = "".join(rng.choices(bits, k=rng.choice([0, 1, 2, 200 if rng.random() < 0.1 else 3])))
            size = len(text)
            a0 = min(a, size)
            text = text[:a0] + new + text[min(max(b, a0), size) :]
            tree.edit(a, b, new)
            assert tree.text == text
            assert tree.tokens == whole(enc, text)
            chars, tokens = tree.arrays()
            pieces = enc.split.findall(text)
            assert chars.tolist() == [len(p) for p in pieces]
            assert tokens.tolist() == enc.counts(pieces)
            assert tree.pretokens == len(pieces)


def test_an_edit_encodes_only_its_surroundings(enc):
    tree = X.Tree("word and more " * 5000, enc)
    tree.edit(30_000, 30_004, "other")
    assert tree.reencoded < 10


def test_states_survive_tables(spark, enc):
    docs = spark.createDataFrame(
        [(1, "a b\na b\n12345 x", "q"), (2, None, "q"), (3, "", None), (3, "", None), (None, "tail", "q")],
        "doc_id long, text string, n_tokens string",
    )
    states = X.build(docs)
    edits = spark.createDataFrame(
        [(1, 0, 0, 1, "the"), (1, 1, 3, 99, ""), (2, 0, 0, 0, "new text")], "doc_id long, seq int, start int, stop int, replacement string"
    )
    got = {(r.doc_id, r.text): r.n_tokens for r in X.update(states, edits).collect()}
    assert got == {(k, t): whole(enc, t or "") for k, t in [(1, "the"), (2, "new text"), (3, ""), (None, "tail")]}


def test_recount_of_documents(spark, enc):
    from .samples import sample_docs

    rows = sample_docs(spark)
    got = X.recount(rows, X.cleaning_edits).collect()
    texts = [r.text for r in rows.collect()]
    want = []
    for t in texts:
        new = t or ""
        for a, b, x in X.cleaning_edits(new):
            new = new[:a] + x + new[b:]
        want.append((whole(enc, t or ""), whole(enc, new)))
    assert sorted((r.n_tokens, r.n_tokens_after) for r in got) == sorted(want)
    assert sum(r.n_edits for r in got) > 0
