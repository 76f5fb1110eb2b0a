"""Tiled cross products, sweeps, penalised grids and linear walk-forward against plain numpy."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from appraise.ml import linear as L
from appraise.operators import collinearity as CL
from appraise.operators import folds as FO
from appraise.operators.gramian import Sweep, tiled_gramian


@pytest.mark.parametrize("width,rows,tile", [(200, 500, 64), (2000, 40, 512), (5, 1, 256)])
def test_tiled_gramian_equals_numpy(spark, width, rows, tile):
    x = np.random.default_rng(width).normal(0, 1, (rows, width))
    df = spark.createDataFrame(pd.DataFrame({"x": list(x), "k": np.arange(rows) % 3})).repartition(3)
    got = tiled_gramian(df, F.col("x"), width, F.col("k"), tile)
    assert set(got) == set(range(min(3, rows)))
    for k, m in got.items():
        assert np.allclose(m, x[np.arange(rows) % 3 == k].T @ x[np.arange(rows) % 3 == k])
    assert tiled_gramian(df.limit(0), F.col("x"), width) == {}


def test_wide_gramian_and_narrow_agree(spark):
    x = np.random.default_rng(1).normal(1, 2, (300, 60))
    pdf = pd.DataFrame(x, columns=[f"c{i}" for i in range(60)])
    wide = CL.gramian(spark.createDataFrame(pdf), list(pdf.columns))
    assert np.allclose(wide.g, x.T @ x) and np.allclose(wide.sums, x.sum(axis=0)) and wide.n == 300


def test_sweep_is_the_inverse_and_dropping_is_a_refit():
    rng = np.random.default_rng(7)
    x = rng.normal(0, 1, (200, 12)) * rng.uniform(0.01, 100, 12)
    g = x.T @ x
    s = Sweep(g)
    left = list(range(12))
    for k in (3, 11, 0, 5):
        s.drop(k)
        left.remove(k)
        inverse = np.linalg.inv(g[np.ix_(left, left)])
        assert s.residuals()[left] * s.norm[left] ** 2 == pytest.approx(1 / np.diag(inverse), rel=1e-8)
        assert np.isnan(s.residuals()[k])


def prune_by_refits(gm, threshold):
    """Drops one column at a time, solving every regression anew."""
    left, dropped = list(gm.columns), []
    while len(left) >= 2:
        v = {k: x for k, x in CL.vif_from_gramian(gm.sub(left)).items() if not np.isnan(x)}
        if not v or max(v.values()) < threshold:
            break
        worst = next(c for c in left if v.get(c) == max(v.values()))
        left.remove(worst)
        dropped.append(worst)
    return dropped


def test_pruning_by_sweeps_equals_refits():
    rng = np.random.default_rng(3)
    x = rng.normal(0, 1, (400, 8))
    mixed = np.column_stack([x, x[:, 0] + 0.1 * x[:, 1], x[:, 2] - x[:, 3] + 0.05 * rng.normal(0, 1, 400), 5 + 0.3 * x[:, 4]])
    for data in (mixed, np.column_stack([mixed, np.ones(400)]), x):
        names = [f"c{i}" for i in range(data.shape[1])]
        gm = CL.Gramian(names, data.T @ data, data.sum(axis=0), len(data))
        kept, dropped, history = CL.prune_by_vif(gm, 10.0)
        assert dropped == prune_by_refits(gm, 10.0) and kept == [c for c in names if c not in dropped]
        assert history[0] == pytest.approx(CL.vif_from_gramian(gm), rel=1e-6)
    # Exact dependencies: a column that repeats another, and one that is a sum, go; the rest is independent.
    exact = np.column_stack([x, x[:, 0], x[:, 1] + x[:, 2], np.zeros(400)])
    names = [f"c{i}" for i in range(exact.shape[1])]
    gm = CL.Gramian(names, exact.T @ exact, exact.sum(axis=0), 400)
    kept, dropped, history = CL.prune_by_vif(gm, 10.0, ["c5"])
    assert len(dropped) == 2 and np.linalg.matrix_rank(exact[:, [names.index(c) for c in kept]]) == 8
    assert {k for k, v in history[0].items() if np.isinf(v)} == {"c0", "c1", "c2", "c8", "c9"} and np.isnan(history[0]["c10"])


@pytest.fixture(scope="module")
def encoded(spark):
    rng = np.random.default_rng(12)
    n = 300
    x = np.column_stack([rng.normal(0, 1, (n, 4)), rng.integers(0, 2, (n, 3)), np.ones(n)])
    y = 50 + x @ np.array([3.0, 0, -2, 0.1, 5, 0, 0.2, 0]) + rng.normal(0, 1, n)
    df = spark.createDataFrame([(Vectors.dense(a), float(b)) for a, b in zip(x, y, strict=True)], ["features", "y"])
    return df.repartition(3).persist(), x, y


def proximal(x, y, alpha, l1, steps=20_000):
    """Elastic net by proximal gradient steps over the rows."""
    xc, yc, n = x - x.mean(axis=0), y - y.mean(), len(y)
    b, rate = np.zeros(x.shape[1]), 1 / (np.linalg.eigvalsh(xc.T @ xc / n)[-1] + alpha)
    for _ in range(steps):
        z = b - rate * (xc.T @ (xc @ b - yc) / n + alpha * (1 - l1) * b)
        b = np.sign(z) * np.maximum(np.abs(z) - rate * alpha * l1, 0)
    return b


def test_coefficients_equal_a_plain_solver(encoded):
    df, x, y = encoded
    sums = L.fold_sums(df, "y", 3)
    total = sum(sums.values())
    assert np.allclose(total, np.column_stack([x, y, np.ones(len(y))]).T @ np.column_stack([x, y, np.ones(len(y))]))
    c = L.centred(total)
    for alpha, l1 in [(0.01, 1.0), (0.1, 1.0), (0.5, 0.5), (1.0, 0.9), (10.0, 0.97)]:
        assert L.descend(c, alpha, l1) == pytest.approx(proximal(x, y, alpha, l1), abs=1e-6)
    xc = x - x.mean(axis=0)
    assert L.ridge(c, 2.0) == pytest.approx(np.linalg.solve(xc.T @ xc + 2.0 * np.eye(8), xc.T @ (y - y.mean())), abs=1e-8)


def test_grid_equals_a_fit_per_fold(spark, encoded):
    df, x, y = encoded
    folds = 3
    own = df.select("features", "y", F.pmod(F.xxhash64(L.vector_to_array("features"), "y"), F.lit(folds)).alias("k")).collect()
    xs, ys, k = np.array([r.features.toArray() for r in own]), np.array([r.y for r in own]), np.array([r.k for r in own])
    found = L.grid_search(L.fold_sums(df, "y", folds), [0.01, 0.5], [0.5, 1.0])
    for alpha, l1, e in found.grid:
        want = 0.0
        for f in range(folds):
            b = proximal(xs[k != f], ys[k != f], alpha, l1)
            a = ys[k != f].mean() - xs[k != f].mean(axis=0) @ b
            want += ((ys[k == f] - a - xs[k == f] @ b) ** 2).sum() / len(ys)
        assert e == pytest.approx(want, rel=1e-6)
    assert (found.alpha, found.l1) == min(((e, a, r) for a, r, e in found.grid))[1:]
    p = df.select(found.predict(F.col("features")).alias("p"), "features").first()
    assert p.p == pytest.approx(found.intercept + p.features.toArray() @ found.coefficients)
    rows = L.grid_table(spark, {"ElasticNet": found}).collect()
    assert len(rows) == 4 and [r.chosen for r in rows].count(True) == 1


def test_walk_forward_with_two_features(spark):
    rng = np.random.default_rng(9)
    n = 2400
    month = pd.to_datetime("2015-01-01") + pd.to_timedelta(rng.integers(0, 30, n) * 30.44, unit="D")
    pdf = pd.DataFrame({"month": month.to_period("M").to_timestamp(), "a": rng.normal(90, 20, n), "b": rng.normal(5, 1, n), "same": 1.0})
    pdf["resale_price"] = 1000 + 30 * pdf.a - 200 * pdf.b + rng.normal(0, 10, n)
    df = spark.createDataFrame(pdf).withColumn("month", F.to_date("month"))
    got = {r.fold: r for r in FO.walk_forward_linear(df, ["a", "b", "same"]).collect()}
    months = sorted(pdf.month.unique())
    assert len(got) == len(range(18, len(months) - 5, 6)) >= 1
    for k, r in got.items():
        cut = 18 + (k - 1) * 6
        train, test = pdf[pdf.month.isin(months[:cut])], pdf[pdf.month.isin(months[cut : cut + 6])]
        w = np.linalg.lstsq(np.column_stack([train.a, train.b, np.ones(len(train))]), train.resale_price, rcond=None)[0]
        error = np.column_stack([test.a, test.b, np.ones(len(test))]) @ w - test.resale_price
        assert (r.n_train, r.n_test) == (len(train), len(test))
        assert r.MAE == pytest.approx(np.abs(error).mean(), abs=0.006) and r.RMSE == pytest.approx(np.sqrt((error**2).mean()), abs=0.006)


def test_vector_gramian_equals_numpy_and_moves_no_zero_tiles(spark):
    """Sparse and dense vectors, one-hot blocks of rare values and a few common columns."""
    from appraise.operators import gramian as GR

    rng = np.random.default_rng(15)
    n, a, b = 400, 300, 250
    x = np.zeros((n, 3 + a + b + 1))
    x[:, :3] = rng.normal(0, 1, (n, 3))
    x[np.arange(n), 3 + rng.integers(0, a, n)] = 1
    x[np.arange(n), 3 + a + rng.integers(0, b, n)] = rng.choice([1.0, -2.0], n)
    y, k = rng.normal(5, 1, n), np.arange(n) % 3
    vectors = [Vectors.dense(r) if i % 7 == 0 else Vectors.sparse(len(r), np.flatnonzero(r), r[r != 0]) for i, r in enumerate(x)]
    df = spark.createDataFrame([(v, float(t), int(g)) for v, t, g in zip(vectors, y, k, strict=True)], ["features", "y", "k"]).repartition(3)
    got = GR.vector_gramian(df, "features", F.col("y"), x.shape[1], F.col("k"), tile=64)
    whole = np.column_stack([x, y, np.ones(n)])
    assert set(got) == {0, 1, 2}
    for g, m in got.items():
        assert np.allclose(m, whole[k == g].T @ whole[k == g])
    few = np.column_stack([x[:, 0], x[:, 1], x[:, 2]])
    df = spark.createDataFrame([(Vectors.dense(r), float(t), 0) for r, t in zip(few, y, strict=True)], ["features", "y", "k"])
    whole = np.column_stack([few, y, np.ones(n)])
    assert np.allclose(GR.vector_gramian(df, "features", F.col("y"), 3, F.col("k"))[0], whole.T @ whole)


def test_least_squares_equals_numpy_however_wide_a_category_is(spark, monkeypatch):
    """Predictions of an exact solver, with and without rows of no level; tasks that hold fewer levels than there are pass them on."""
    rng = np.random.default_rng(21)
    n, k, m = 3000, 700, 6
    level, kind = rng.integers(-1, k, n), rng.integers(0, m, n)
    x = np.zeros((n, 3 + m + k))
    x[:, :2] = rng.normal(0, 1, (n, 2))
    x[:, 2] = (level % 5 == 0) & (kind > 2)
    x[np.arange(n), 3 + kind] = 1
    x[level >= 0, 3 + m + level[level >= 0]] = 1
    y = 40 + x @ rng.normal(0, 3, x.shape[1]) + rng.normal(0, 1, n)
    blocks = [(3, 3 + m), (3 + m, 3 + m + k)]
    vectors = [Vectors.dense(r) if i % 9 == 0 else Vectors.sparse(len(r), np.flatnonzero(r), r[r != 0]) for i, r in enumerate(x)]
    df = spark.createDataFrame([(v, float(t), int(g)) for v, t, g in zip(vectors, y, level, strict=True)], ["features", "y", "g"]).repartition(5)
    for held, least in ((L.HELD, -1), (64, -1), (300, 0)):
        monkeypatch.setattr(L, "HELD", held)
        rows = df.where(F.col("g") >= least)
        mine = level >= least
        found = L.least_squares(rows, "y", x.shape[1], blocks)
        whole = np.column_stack([x[mine], np.ones(mine.sum())])
        want = whole @ np.linalg.lstsq(whole, y[mine], rcond=None)[0]
        assert x[mine] @ found.coefficients + found.intercept == pytest.approx(want, abs=1e-7)
        got = sorted(tuple(r) for r in found.transform(rows, "y").collect())
        assert np.allclose(got, sorted(zip(y[mine], want, strict=True)))
        # A row without a level where each training row has one: effects are about a mean of 0.
        for i, j in blocks[: 1 if least < 0 else 2]:
            p = x[mine, i:j].mean(axis=0)
            assert np.average(found.coefficients[i:j], weights=p * (1 - p)) == pytest.approx(0, abs=1e-7)


def test_least_squares_without_categories_and_with_unknown_targets(spark):
    rows = [(Vectors.dense([float(i), 1.0]), 3.0 * i + 2) for i in range(20)]
    df = spark.createDataFrame(rows, ["features", "y"])
    got = L.least_squares(df, "y", 2, []).transform(df, "y").collect()
    assert [r.prediction for r in got] == pytest.approx([r.y for r in got])
    with pytest.raises(ValueError):
        L.least_squares(spark.createDataFrame([*rows, (rows[0][0], None)], ["features", "y"]), "y", 2, [])


def test_wide_linear_member_equals_the_normal_equations(spark):
    """Encoded rows with an unseen and a null category: both solvers predict alike."""
    from appraise.ml import models as M

    rng = np.random.default_rng(5)
    rows = [(f"s{i % 40}", None if i % 11 == 0 else "ab"[i % 2], float(rng.normal()), float(rng.normal(50, 9))) for i in range(800)]
    train = spark.createDataFrame(rows, "s string, t string, x double, y double")
    test = spark.createDataFrame([*rows[:50], ("new", "a", 0.5, 1.0)], train.schema)
    enc = M.encoder_pipeline(["s", "t"], ["x"]).fit(train)
    assert enc.transform(train).first().features.size == M.category_blocks(enc, ["s", "t"], ["x"])[-1][1]
    plain, wide = (M.linear_predictions(enc, enc.transform(train), enc.transform(test), "y", ["s", "t"], ["x"], normal).collect()
                   for normal in (4096, 0))
    assert [r.prediction for r in wide] == pytest.approx([r.prediction for r in plain], rel=1e-3)


def test_a_wide_category_is_kept_apart_in_grids(spark, monkeypatch):
    """The same errors, choices and coefficients as from all cross products, without a matrix of all columns on the driver."""
    rng = np.random.default_rng(33)
    n, k, m = 4000, 400, 4
    level, kind = rng.integers(-1, k - 20, n), rng.integers(0, m, n)
    x = np.zeros((n, 2 + k + m))
    x[:, :2] = rng.normal(0, 1, (n, 2))
    x[level >= 0, 2 + level[level >= 0]] = 1
    x[np.arange(n), 2 + k + kind] = 1
    y = 40 + x @ rng.normal(0, 3, x.shape[1]) + rng.normal(0, 1, n)
    rows = [(Vectors.sparse(len(r), np.flatnonzero(r), r[r != 0]), float(t)) for r, t in zip(x, y, strict=True)]
    df = spark.createDataFrame(rows, ["features", "y"]).repartition(3).persist()
    blocks = [(2, 2 + k), (2 + k, 2 + k + m)]
    plain = L.fold_sums(df, "y", 3)
    for held in (L.HELD, 150):
        monkeypatch.setattr(L, "HELD", held)
        apart = L.fold_sums(df, "y", 3, blocks=blocks)
        assert set(apart) == set(plain)
        for g, s in apart.items():
            assert max(s.total.size, s.levels.size) < x.shape[1] ** 2 / 20
            other = np.r_[0:2, 2 + k : 2 + k + m + 2]
            assert np.allclose(s.total, plain[g][np.ix_(other, other)]) and np.allclose(s.levels, plain[g][2 : 2 + k][:, other])
        for alphas, ratios in (([0.1, 1.0, 10.0], None), ([0.001, 0.01, 0.1], [1.0]), ([0.002, 0.05], [0.5, 0.95])):
            want, got = L.grid_search(plain, alphas, ratios), L.grid_search(apart, alphas, ratios)
            assert (got.alpha, got.l1) == (want.alpha, want.l1)
            assert [e for *_, e in got.grid] == pytest.approx([e for *_, e in want.grid], rel=1e-8)
            assert got.coefficients == pytest.approx(want.coefficients, abs=1e-6) and got.intercept == pytest.approx(want.intercept, abs=1e-6)
