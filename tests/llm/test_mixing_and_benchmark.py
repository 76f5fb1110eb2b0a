"""Source mixing, benchmark decontamination and the pipeline."""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from appraise.llm import decontaminate, mixing, secrets
from appraise.llm.common import split_words
from tests.conftest import SF_SMALL

from .samples import LONG, odd_docs, sample_docs
from .test_dedup import joined_by_hand


def shares_by_hand(sizes, most=3.0):
    weights = [(5.0, 2.0, 1.0)[i % 3] for i in range(len(sizes))]
    full: set = {i for i, s in enumerate(sizes) if s == 0}
    while True:
        left = sum(sizes) - sum(most * sizes[i] for i in full)
        free = sum(w for i, w in enumerate(weights) if i not in full)
        target = [most * s if i in full else left * weights[i] / free for i, s in enumerate(sizes)]
        over = {i for i in range(len(sizes)) if target[i] > most * sizes[i] + 1e-9}
        if not over - full:
            return target
        full |= over


@pytest.mark.parametrize("sizes", [[10, 10, 10], [1, 1000, 5, 0, 70], [0], [3, 3, 3, 1000, 2, 9999], [7]])
def test_shares(sizes):
    w = np.array([(5.0, 2.0, 1.0)[i % 3] for i in range(len(sizes))])
    assert np.allclose(mixing.shares(np.array(sizes), w, 3.0), shares_by_hand(sizes))


def test_permutations():
    for n in (1, 2, 3, 7, 64, 1000):
        got = [mixing.permuted(np.arange(n), n, key) for key in (1, 2)]
        assert all(sorted(g.tolist()) == list(range(n)) for g in got)
    assert (got[0] != got[1]).any()


def test_mix_of_a_sample(spark):
    docs = sample_docs(spark).withColumnRenamed("n_chars", "size")
    m = mixing.mix(docs, block=32, shard_slots=64)
    got = mixing.taken(m).toPandas()
    assert len(got) == docs.count()
    assert (got.taken <= 3 * got["size"]).all()
    want = {}
    for r in docs.collect():
        want[r.source] = want.get(r.source, 0) + len(split_words(r.text))
    names = sorted((n for n in want if n is not None)) + [None]
    target = dict(zip(names, shares_by_hand([want[n] for n in names]), strict=True))
    for name, part in got.groupby(got.source.fillna("-")):
        name = None if name == "-" else name
        assert (part.source_size == want[name]).all() and np.allclose(part.target, target[name])
        assert abs(part.taken.sum() - target[name]) <= 3 * 32 + 0.02 * target[name]
    again = mixing.taken(mixing.mix(docs.repartition(7), block=32, shard_slots=64)).toPandas()
    key = ["doc_id", "source", "size", "taken"]
    assert sorted(map(str, again[key].to_numpy().tolist())) == sorted(map(str, got[key].to_numpy().tolist()))


def test_blocks_and_slots(spark):
    m = mixing.mix(sample_docs(spark), block=32, shard_slots=64)
    slots, pieces = m.slots.toPandas(), m.fragments.toPandas()
    assert len(slots) == m.sources.quota.sum()
    assert not slots.duplicated(["shard", "slot"]).any()
    for s, part in slots.groupby("s"):
        assert len(part) == m.sources.quota[s]
        uses = part.groupby("block").size().reindex(range(int(m.sources.blocks[s])), fill_value=0)
        assert uses.max() - uses.min() <= 1
    full = pieces.groupby(["s", "block"]).n.sum()
    assert (full <= 32).all() and full.sum() == m.sources.size.sum()
    assert mixing.assemble(m).count() == len(slots.merge(pieces, on=["s", "block"]))



def test_small_sources_meet_their_targets(spark):
    """Every source ends within a word of its target, also a long tail of sources of less than a block."""
    rows = [(i, f"s{i:03d}", " ".join(["w"] * 50)) for i in range(90)] + [(100 + i, "z", " ".join(["w"] * (i * 7))) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    for block in (128, 32):
        m = mixing.mix(docs, block=block)
        got = mixing.taken(m).toPandas()
        own = got.groupby("source").agg({"taken": "sum", "target": "first"})
        assert (abs(own.taken - own.target) <= 0.5).all() and len(own) == 91
        assert mixing.assemble(m).groupBy().sum("n").first()[0] == own.taken.sum()


def test_places_in_permutations():
    for n in (1, 2, 3, 7, 64, 1000):
        assert [mixing.place_of(int(b), n, 5) for b in mixing.permuted(np.arange(n), n, 5)] == list(range(n))


def test_quotas_by_hand():
    rng = np.random.default_rng(3)
    for _ in range(500):
        block = int(rng.integers(1, 9))
        size = np.array([int(rng.integers(1, 60))])
        target = rng.uniform(0, 3 * size)
        blocks = -(-size // block)
        quota, last = mixing.quotas(size, blocks, target, block, 20)
        n, words = int(blocks[0]), 0
        for k in range(int(quota[0])):
            b = int(mixing.permuted(np.array([k % n]), n, mixing.key_of(20, 0, k // n))[0])
            own = min(block, int(size[0]) - b * block)
            words += min(own, int(last[0])) if k == quota[0] - 1 else own
        assert words == round(float(target[0]))


def test_taken_words_slot_by_slot(spark, monkeypatch):
    """Every slot is replayed in plain Python over the words of its source; large and small steps of slots give the same."""
    docs = sample_docs(spark).repartition(3)
    m = mixing.mix(docs, block=16, shard_slots=64)
    order = {}
    for r in m.rows.where("size > 0").collect():
        order.setdefault(r.s, {}).update({r.place + k: (r.key, r.place) for k in range(r["size"])})
    want, slots, asked = {}, m.slots.collect(), {}
    for x in slots:
        own = order[x.s]
        at = [p for p in range(x.block * m.block, (x.block + 1) * m.block) if p in own][: x["take"]]
        asked[x.s] = asked.get(x.s, 0) + len(at)
        for p in at:
            want[x.s, own[p][1]] = want.get((x.s, own[p][1]), 0) + 1
    assert len({(x.shard, x.slot) for x in slots}) == len(slots)
    sources = {r.s: r.source for r in m.rows.collect()}
    target = {r.source: r.target for r in mixing.taken(m).collect()}
    assert all(abs(n - target[sources[s]]) <= 1 for s, n in asked.items())
    got = mixing.taken(m)
    by_row = {(r.s, r.place): r.key for r in m.rows.where("size > 0").collect()}
    plain = sorted((str(by_row[k]), n) for k, n in want.items())
    assert sorted((str(r.doc_id), r.taken) for r in got.where("taken > 0").collect()) == plain
    monkeypatch.setattr(mixing, "SLOTS_AT_ONCE", 100)
    again = mixing.slot_table(spark, m.sources, 16, 64, 20).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, slots))


def test_mix_of_nothing(spark):
    assert mixing.taken(mixing.mix(odd_docs(spark).where("false"))).count() == 0
    blank = mixing.taken(mixing.mix(odd_docs(spark).where("doc_id in (900001, 900002)"))).collect()
    assert [r.taken for r in blank] == [0, 0]


def edited(rng, words, share):
    out = []
    for w in words:
        x = rng.random()
        if x < share:
            out += rng.choice([[], [f"new{rng.randrange(999)}"], [w, "also"]])
        else:
            out.append(w)
    return " ".join(out)


def test_whole_and_edited_items(spark):
    rng = random.Random(8)
    words = [f"term{i}" for i in range(3000)] + ["the", "of", "and"] * 500
    items = [(i, " ".join(rng.choices(words, k=40))) for i in range(30)] + [(30, None), (31, ""), (32, "two words"), (0, "Repeated id, other text here")]
    rows, want = [], set()
    for i in range(120):
        text = rng.choices(words, k=rng.choice([0, 30, 300]))
        if i % 4 == 0:
            item = rng.randrange(30)
            want.add((i, item))
            text[rng.randint(0, len(text)) : 0] = edited(rng, items[item][1].upper().split(), [0, 0.1, 0.2][i % 3]).split()
        rows.append((i, " ".join(text)))
    rows += [(500, None), (501, ""), (502, LONG), (None, "x two words, y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("matches", decontaminate.F.lit(1))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, bench).collect()}
    assert got == want | {(None, 32)}
    small = decontaminate.Params(block_chars=1000)
    assert {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, bench, params=small).collect()} == got
    assert decontaminate.contaminated(docs.where("false"), bench).count() == 0
    assert decontaminate.contaminated(docs, bench.where("false")).count() == 0


def test_items_copied_into_many_documents(spark):
    """Seeds are rare for their item, so an item that is in most documents is still found."""
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
    docs = spark.createDataFrame([(i, f"before {item} after {i}") for i in range(50)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert decontaminate.contaminated(docs, bench).count() == 50


def replaced(words, at):
    return " ".join(f"changed{i}" if i in at else w for i, w in enumerate(words))


def test_edited_passage_in_any_number_of_documents(spark):
    """Copies with one word in five replaced are found whether 3, 4 or 1000 documents hold them."""
    item = [f"word{i}" for i in range(40)]
    passage = replaced(item, range(3, 40, 5))
    bench = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    for n in (3, 4, 1000):
        docs = spark.createDataFrame([(i, f"before it {passage} after {i}") for i in range(n)], "doc_id long, text string")
        got = decontaminate.contaminated(docs, bench).collect()
        assert {r.doc_id for r in got} == set(range(n)) and {r.score for r in got} == {0.7}


def test_short_items_with_one_seed_left(spark):
    """15 words of which runs of 3, 2, 2, 2 and 2 stay: one 3-gram is left and the score is (11 - 2) / 15."""
    item = [f"word{i}" for i in range(15)]
    docs = spark.createDataFrame([(1, f"before {replaced(item, (3, 6, 9, 12))} after"), (2, "only word0 word1 word2 here")], "doc_id long, text string")
    got = decontaminate.contaminated(docs, spark.createDataFrame([(7, " ".join(item))], "item_id long, text string")).collect()
    assert [(r.doc_id, r.item_id, r.score, r.n_seeds) for r in got] == [(1, 7, 0.6, 1)]


def alignment_by_hand(a, b):
    h, best = np.zeros((len(a) + 1, len(b) + 1)), 0.0
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            h[i, j] = max(0, h[i - 1, j - 1] + (1 if x == y else -0.5), h[i - 1, j] - 0.5, h[i, j - 1] - 0.5)
            best = max(best, h[i, j])
    return best


def test_local_alignment():
    rng = np.random.default_rng(6)
    for _ in range(200):
        a, b = rng.integers(0, 5, rng.integers(1, 12)), rng.integers(0, 5, rng.integers(1, 15))
        value, end, begin = decontaminate.local_alignment(a, b)
        assert value == pytest.approx(alignment_by_hand(a, b))
        if value:
            assert alignment_by_hand(a, b[begin:end]) == pytest.approx(value)


def test_matches_equal_an_alignment_of_all_pairs(spark):
    """Both ways of the join against every pair of a whole text and an item that share three words in a row; hot, short, common and repeated items."""
    rng = random.Random(5)
    common, rare = ["the", "of", "and", "in", "to"], [f"t{i}" for i in range(2000)]
    draw = lambda k: [rng.choice(common if rng.random() < 0.4 else rare) for _ in range(k)]
    items = [(i, " ".join(draw(rng.choice([6, 15, 40, 80])))) for i in range(60)]
    items += [items[3], (77, items[4][1]), (78, "lone"), (79, None), (80, "..."), (None, "no id but nine words of text in this")]
    rows = []
    for i in range(150):
        item = items[3 if i % 3 == 0 else rng.randrange(60)][1].split()
        rows.append((i, " ".join(draw(20) + edited(rng, item, rng.choice([0, 0.1, 0.15])).split() + draw(20)) if i % 4 else " ".join(draw(90))))
    rows += [rows[1], (None, "x no id but nine words of text in this y"), (900, ""), (901, None), (902, "a lone word")]
    docs, bench = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    want = []
    for d, text in rows:
        for i, item in items:
            a, b = (decontaminate.tokens(x) for x in (item, text))
            ids = {w: k for k, w in enumerate(dict.fromkeys(a + b))}
            a, b = (np.array([ids[w] for w in x], int) for x in (a, b))
            n = min(3, len(a))
            runs = lambda x: {tuple(x[k : k + n]) for k in range(len(x) - n + 1)}  # noqa: B023, E731
            if n and len(b) and decontaminate.local_alignment(a, b)[0] >= 0.5 * len(a) and runs(a) & runs(b):
                want.append((str(d), str(i)))
    for p in (decontaminate.Params(), decontaminate.Params(block_chars=0, salts=3, bitmap_bits=1 << 12)):
        got = decontaminate.contaminated(docs, bench, params=p).collect()
        assert sorted((str(r.doc_id), str(r.item_id)) for r in got) == sorted(want)
        rows_ = sorted(map(str, got))
        assert p.block_chars or rows_ == before
        before = rows_


def test_shuffled_join_of_odd_tables(spark):
    """Items without a word, no documents, and columns with the names that the join uses inside."""
    p = decontaminate.Params(block_chars=0)
    docs = spark.createDataFrame([(1, "alpha beta gamma delta", "mine", 5)], "doc_id long, text string, row string, i int")
    bench = spark.createDataFrame([(1, "alpha beta gamma delta"), (2, "...")], "item_id long, text string")
    got = decontaminate.find(docs, bench, p)
    assert got.columns == ["doc_id", "text", "row", "i", "matches"]
    assert [(r.row, r.i, [m.item_id for m in r.matches]) for r in got.collect()] == [("mine", 5, [1])]
    assert [r.matches for r in decontaminate.find(docs, bench.where("item_id = 2"), p).collect()] == [[]]
    assert decontaminate.find(docs.where("false"), bench, p).count() == 0


def test_copies_with_few_edits_keep_a_seed():
    """``enough`` seeds: whichever words are edited, up to a fifth of them or four."""
    p, rng = decontaminate.Params(), random.Random(9)
    words = [f"c{i}" for i in range(9)]
    items = [{"item_id": i, "text": " ".join(rng.choices(words, k=rng.choice([12, 30, 61])))} for i in range(400)]
    block = decontaminate.read_items(items, p)
    own = [set() for _ in items]
    for key, of in block.owners.items():
        for i in of:
            own[i].add(key)
    dropped = 0
    for i, w in enumerate(block.words):
        base = len(block.vocabulary) + 1
        at = [k for k, c in enumerate(decontaminate.coded(w, 3, base).tolist()) if (3, c) in own[i]]
        dropped += len(w) - 2 - len(at)
        edits = max(4, -(-len(w) // 5))
        # The edits that break most seeds, one after another.
        left = set(at)
        for _ in range(edits if len(w) >= 3 * edits + 3 else 0):
            worst = max(range(len(w)), key=lambda x: len(left & {x - 2, x - 1, x}))
            left -= {worst - 2, worst - 1, worst}
            assert left
    assert dropped > 0


def test_stages(spark, tmp_path):
    docs = sample_docs(spark)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language_id", "near_duplicates", "decontamination", "secrets", "mixing"]
    sf, columns = str(tmp_path), ["doc_id", "text", "lang", "source", "n_chars"]
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = corpus_pipeline.saved(spark, stage(spark, docs, sf), name)
        seen[name] = (before.collect(), docs.collect())
        if name != "mixing":
            assert docs.columns == columns

    rows, kept = seen["language_id"]
    letters = [r for r in rows if r.text and re.search(r"[^\W\d_]", r.text)]
    assert {r.doc_id for r in kept} <= {r.doc_id for r in letters}
    assert len(kept) >= 0.99 * len(letters)

    rows, kept = seen["near_duplicates"]
    groups = joined_by_hand([(r.doc_id, r.text) for r in rows])
    assert sorted((r.doc_id for r in kept), key=str) == sorted({c for k, n, c in groups}, key=str)

    rows, kept = seen["decontamination"]
    plain = lambda t: " ".join(re.findall(r"\w+", t.lower()))
    items = [plain(r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    leaks = {r.doc_id for r in rows if any(i in plain(r.text) for i in items)}
    assert leaks and {r.doc_id for r in rows} - leaks == {r.doc_id for r in kept}

    rows, kept = seen["secrets"]
    assert {r.doc_id: secrets.redact(r.text, secrets.scan(r.text)) for r in rows} == {r.doc_id: r.text for r in kept}
    assert all(r.n_chars == len(r.text) for r in kept if "[SECRET]" in r.text)

    rows, kept = seen["mixing"]
    assert sorted((r.doc_id, len(split_words(r.text))) for r in rows if r.doc_id) == sorted((r.doc_id, r["size"]) for r in kept if r.doc_id)


def test_run(spark):
    assert corpus_pipeline.run(spark, SF_SMALL).count() > 100


def test_stages_leave_columns_of_the_caller(spark):
    """Columns with the names that the operators use inside keep their values and types."""
    import corpus_pipeline as P

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    mine = {"score": "'mine'", "lang_pred": "7L", "_k": "array('k')", "digest": "1.5D", "matches": "'none'", "n": "doc_id * 2", "size": "'big'", "LANG_PRED_": "3"}
    rows = docs.selectExpr("*", *[f"{v} AS {c}" for c, v in mine.items()])
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, rows, SF_SMALL)
        assert out.columns == rows.columns and out.schema.simpleString() == rows.schema.simpleString(), name
        got = out.selectExpr(*mine, "doc_id").collect()
        assert got and all((r.score, r.lang_pred, r["_k"], r.digest, r.matches, r.n, r["size"]) == ("mine", 7, ["k"], 1.5, "none", 2 * r.doc_id, "big") for r in got), name
    for name, stage in P.STAGES:
        assert stage(spark, docs.limit(0), SF_SMALL).collect() == [], name


def test_batches_are_small(spark):
    """Stages hand Python workers batches of bounded bytes and rows, whatever the session's default."""
    from pyspark.sql import functions as F

    from appraise.llm.common import BATCH_BYTES, ROWS_AT_ONCE, map_batches

    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    docs = spark.range(0, 3500, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("word "), 800).alias("text"))
    docs = docs.withColumns({"lang": F.lit("en"), "source": F.lit("a")})
    try:
        spark.conf.unset(key)
        corpus_pipeline.mask_secrets(spark, docs, "")
        got = docs.mapInArrow(lambda it: (pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["size"]) for b in it), "size long").collect()
        assert len(got) > 3 and max(r["size"] for r in got) <= 1.5 * BATCH_BYTES
        spark.conf.unset(key)
        rows = map_batches(docs.select("doc_id"), lambda b: {"n": [b.num_rows] * b.num_rows}, "doc_id long, n long").collect()
        assert [r.doc_id for r in rows] == list(range(3500)) and max(r.n for r in rows) <= ROWS_AT_ONCE
        spark.conf.set(key, "1m")
        corpus_pipeline.mask_secrets(spark, docs, "")
        assert spark.conf.get(key) == "1m"
    finally:
        spark.conf.unset(key)


def test_sources_need_no_python_tasks(spark, monkeypatch):
    """The list of sources becomes a table without a task in a second set of Python workers."""
    from pyspark import RDD

    docs = odd_docs(spark)
    n = docs.count()
    monkeypatch.setattr(RDD, "_to_java_object_rdd", lambda self: pytest.fail("rows went through Python workers"))
    assert mixing.taken(mixing.mix(docs)).count() == n
