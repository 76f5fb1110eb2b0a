"""Language identification, quality and toxicity classifiers: held-out accuracy and odd rows."""

from __future__ import annotations

import zlib

import numpy as np
import pytest

from appraise.llm import language_id, quality_model, toxicity
from appraise.llm.catalog import QUERIES
from tests.conftest import SF_MID, SF_SMALL

from .samples import odd_docs, sample_docs


def rank_share(y: np.ndarray, p: np.ndarray) -> float:
    """Share of pairs (label 1, label 0) that the score orders rightly."""
    a, b = p[y == 1], p[y == 0]
    return float(np.mean((a[:, None] > b[None, :]) + 0.5 * (a[:, None] == b[None, :])))


def test_languages_of_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "lang")
    got = QUERIES["op1_language_id"](spark, SF_MID).join(docs, "doc_id").toPandas()
    assert len(got) == docs.count()
    assert (got.held_out == got.doc_id.map(lambda d: zlib.crc32(str(d).encode()) % 5 == 0)).all()
    held = got[got.held_out]
    assert (held.lang == held.lang_pred).mean() > 0.99
    assert got.score.between(0, 1).all()


def test_backoff_uses_the_longest_known_order():
    p = language_id.Params(orders=(3, 1))
    table = {0: (["the"], np.array([[-1.0, -5.0]])), 3: (["sch"], np.array([[-6.0, -2.0]])), 1: (["x"], np.array([[-1.0, -9.0]]))}
    s = language_id.Scorer(language_id.Model(["en", "de"], table, p))
    assert s(["the", "schx", "x", "qq", "123", None])[0] == ["en", "de", "en", "en", "und", "und"]


def test_language_of_odd_rows(spark):
    rows = odd_docs(spark).withColumnRenamed("n_chars", "score")
    model = language_id.train(sample_docs(spark))
    got = {r.doc_id: r for r in language_id.identify(rows, model).collect()}
    assert {got[k].lang_pred for k in (900_001, 900_002, 900_003, 900_006)} == {"und"}
    assert got[900_001].score == 0.0
    assert got[900_004].lang_pred in model.languages
    empty = language_id.train(rows.where("false"))
    assert {r.lang_pred for r in language_id.identify(rows, empty).collect()} == {"und"}
    assert language_id.identify(rows.where("false"), model).count() == 0


def test_languages_of_many_copies(spark):
    """A language whose rows are mostly copies is read in full, each text once."""
    few = [(f"zwei{'abcdefgh'[i % 8]} drei{'klmnopqr'[i // 8]}", "de") for i in range(40)]
    many = [(" ".join(f"w{'abcdefghij'[int(d)]}" for d in str(i)), "en") for i in range(2000)]
    rows = spark.createDataFrame(few, "text string, lang string").crossJoin(spark.range(500)).drop("id")
    rows = rows.unionByName(spark.createDataFrame(many, "text string, lang string"))
    p = language_id.Params(smoothing=1.0, rows_per_language=500)
    model = language_id.train(rows, p)
    words, matrix = model.table[0]
    de = model.languages.index("de")
    assert {w for t, _ in few for w in t.split()} <= set(words)
    # 80 words in all: zwei.. 5 times each, drei.. 8 times.
    total = np.exp(matrix[:, de]) * (80 + len(words) + 1) - 1
    assert round(total[words.index("zweia")]) == 5 and round(total[words.index("dreik")]) == 8


@pytest.mark.parametrize(("name", "label", "least"), [("op3_quality_classifier", "quality", 0.95), ("op5_toxicity", "toxic", 0.6)])
def test_held_out_labels(spark, name, label, least):
    labels = spark.read.parquet(f"{SF_MID}/labels.parquet")
    got = QUERIES[name](spark, SF_MID)
    assert got.count() == spark.read.parquet(f"{SF_MID}/documents.parquet").count()
    held = got.join(labels, "doc_id").where("held_out").toPandas()
    assert rank_share(held[label].to_numpy(), held.score.to_numpy()) > least
    assert (held.predicted == (held.score >= 0.5)).all()


def toxic_rows(spark, n=120):
    rng = np.random.default_rng(4)
    plain = ["river", "table", "window", "garden", "paper", "cloud", "bridge", "letter", "music", "winter"]
    rows = []
    for i in range(n):
        words = rng.choice(plain, 60).tolist()
        if i % 3 == 0:
            for w in rng.choice(["blockhead", "numbskull", "scoundrel"], 4):
                words[rng.integers(0, 60)] = str(w)
        rows.append((i, " ".join(words), int(i % 3 == 0)))
    return spark.createDataFrame(rows, "doc_id long, text string, toxic int")


def test_toxic_words_and_misspellings(spark):
    rows = toxic_rows(spark)
    p = toxicity.Params(bits=12, rounds=2)
    model = toxicity.train(rows.select("doc_id", "text"), rows.select("doc_id", "toxic"), params=p)
    asked = spark.createDataFrame(
        [(0, "river table garden " * 30), (1, "cloud bridge numbskulls music " + "paper " * 50), (2, "a scoundrell by the river"), (3, None), (4, "")],
        "doc_id long, text string",
    )
    got = {r.doc_id: r.predicted for r in toxicity.score(asked, model, p).collect()}
    assert got == {0: 0, 1: 1, 2: 1, 3: got[3], 4: got[3]}



def test_toxic_words_in_texts_without_blanks(spark):
    """All of a long word is read: insults far behind its 64th character raise the score, whatever joins the words."""
    rows = toxic_rows(spark)
    p = toxicity.Params(bits=12, rounds=2)
    model = toxicity.train(rows.select("doc_id", "text"), rows.select("doc_id", "toxic"), params=p)
    plain, insults = ["river", "table", "garden", "cloud"] * 10, ["blockhead", "numbskull", "scoundrel"]
    texts = [j.join(w) for j in (",", "\u3000", "\u00a0", "_", "") for w in (plain, plain + insults + plain)]
    asked = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in toxicity.score(asked, model, p).collect()}
    assert [got[i].predicted for i in range(len(texts))] == [0, 1] * 5
    for n in (64, 65, 66, 76, 77, 200):
        word = "".join(chr(0x4E00 + i) for i in range(n))
        grams = {t[i : i + 5] for t in toxicity.tokens(word) for i in range(len(t) - 4)}
        assert grams == {f"<{word}>"[i : i + 5] for i in range(n - 2)}


def test_models_without_labels(spark):
    docs, none = odd_docs(spark), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    w = quality_model.train(docs, none)
    got = quality_model.score(docs.withColumnRenamed("n_chars", "score"), w).collect()
    assert {r.score for r in got} == {0.5}
    assert toxicity.train(docs, none) is None
    assert {r.score for r in toxicity.score(docs, None).collect()} == {0.0}


def test_scores_depend_on_the_text_alone(spark):
    docs = sample_docs(spark)
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    w = quality_model.train(docs, labels)
    got = quality_model.score(docs, w).toPandas()
    assert len(got) == docs.count()
    assert got.groupby(got.text.fillna("")).score.nunique().max() == 1


def test_languages_equal_a_plain_backoff(spark):
    """Every document of the smallest table and the odd rows, word by word from dictionaries."""
    docs = sample_docs(spark)
    model = language_id.train(docs, language_id.Params(words_per_language=60))  # few known words, so that many back off
    lookup = {o: dict(zip(tokens, matrix.reshape(-1, len(model.languages)), strict=True)) for o, (tokens, matrix) in model.table.items()}

    def word_scores(word):
        if word in lookup[0]:
            return lookup[0][word]
        padded = f"<{word}>"
        for n in model.params.orders:
            hits = [lookup[n][padded[i : i + n]] for i in range(len(padded) - n + 1) if padded[i : i + n] in lookup[n]]
            if hits:
                return sum(hits) / len(hits)
        return np.zeros(len(model.languages))

    unseen = 0
    for r in language_id.identify(docs, model).collect():
        words = language_id.letters(r.text)
        if not words:
            assert (r.lang_pred, r.score) == (language_id.UND, 0.0)
            continue
        unseen += sum(w not in lookup[0] for w in set(words))
        total = sum(word_scores(w) for w in words)
        best = int(np.argmax(total))
        scale = min(len(words), model.params.confidence_words) / len(words)
        assert r.lang_pred == model.languages[best]
        assert r.score == pytest.approx(1 / sum(np.exp((t - total[best]) * scale) for t in total))
    assert unseen > 100


def test_ties_of_languages_go_to_the_first_name():
    table = {0: (["w"], np.array([[-2.0, -2.0]]))}
    s = language_id.Scorer(language_id.Model(["de", "en"], table, language_id.Params(orders=())))
    langs, scores = s(["w w", "w"])
    assert langs == ["de", "de"] and scores.tolist() == [0.5, 0.5]


def test_quality_updates_equal_a_dense_ftrl():
    """The published per-coordinate updates over whole dense vectors, and scores as dense products."""
    p = quality_model.Params(bits=8)
    hasher, rng = quality_model.Hasher(p.bits), np.random.default_rng(0)
    texts = [" ".join(rng.choice(["good", "fine", "spam", "BUY", "!!!", "$$$", "12"], 12)) for _ in range(60)] + ["", None]
    labels = [int("spam" not in (t or "")) for t in texts]
    size = (1 << p.bits) + 1
    z, n = np.zeros(size), np.zeros(size)
    quality_model.ftrl([(*hasher(t), y) for t, y in zip(texts, labels, strict=True)], z, n, p, 1.5)
    zs, ns = [0.0] * size, [0.0] * size

    def weight(i):
        if abs(zs[i]) <= p.l1:
            return 0.0
        return -(zs[i] - np.sign(zs[i]) * p.l1) / ((p.beta + ns[i] ** 0.5) / p.alpha + p.l2)

    def dense(text):
        x = [0.0] * size
        for at, value in zip(*hasher(text), strict=True):
            x[at] = value
        x[-1] = 1.0
        return x

    for t, y in zip(texts, labels, strict=True):
        x, w = dense(t), [weight(i) for i in range(size)]
        prob = 1 / (1 + np.exp(-sum(a * b for a, b in zip(w, x, strict=True))))
        for i in range(size):
            g = (prob - y) * x[i] * (1.0 if y else 1.5)
            s = ((ns[i] + g * g) ** 0.5 - ns[i] ** 0.5) / p.alpha
            zs[i] += g - s * w[i]
            ns[i] += g * g
    assert z == pytest.approx(zs) and n == pytest.approx(ns)
    w = quality_model.weights(z, n, p)
    assert w == pytest.approx([weight(i) for i in range(size)]) and np.count_nonzero(w) > 10


def test_quality_scores_equal_dense_products(spark):
    p = quality_model.Params(bits=10)
    w = np.random.default_rng(1).normal(size=(1 << p.bits) + 1)
    hasher = quality_model.Hasher(p.bits)
    got = quality_model.score(sample_docs(spark), w, p).collect()
    for r in got:
        x = np.zeros(len(w))
        at, value = hasher(r.text)
        x[at], x[-1] = value, 1.0
        assert r["score"] == pytest.approx(1 / (1 + np.exp(-(x * w).sum())))
        assert r.predicted == int(r["score"] >= 0.5)
    assert quality_model.score(sample_docs(spark).where("false"), w, p).count() == 0


def test_toxicity_scores_equal_a_plain_forward_pass(spark):
    """Mean of subword rows a word, mean of every window, softmax over the two classes, the best window of a text."""
    p = toxicity.Params(bits=10, dim=4)
    rng = np.random.default_rng(2)
    emb, soft, bias = rng.normal(size=(1 << p.bits, p.dim)), rng.normal(size=(p.dim, 2)), rng.normal(size=2)
    docs = sample_docs(spark).where("doc_id IS NULL OR doc_id < 120 OR doc_id > 900000")
    for r in toxicity.score(docs, [emb, soft, bias], p).collect():
        words = toxicity.tokens(r.text)
        vectors = [np.mean([emb[i] for i in toxicity.rows_of(w, p)], axis=0) for w in words]
        runs = [vectors[i : i + p.window] for i in range(max(1, len(vectors) - p.window + 1))] if vectors else []
        best = 1 / (1 + np.exp(bias[0] - bias[1])) if not runs else 0.0
        for run in runs:
            logits = np.mean(run, axis=0) @ soft + bias
            best = max(best, np.exp(logits[1]) / np.exp(logits).sum())
        assert r["score"] == pytest.approx(best)
        assert r.predicted == int(r["score"] >= 0.5)
    assert toxicity.score(docs.where("false"), [emb, soft, bias], p).count() == 0
