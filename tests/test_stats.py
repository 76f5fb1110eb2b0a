"""Error breakdowns, quantiles, drift, collinearity (D1-D10, D13-D18), checked against numpy/pandas."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from appraise.operators import collinearity as CL
from appraise.operators import drift as D
from appraise.operators import eda as X
from appraise.operators import errors as E
from appraise.operators.ranking import exact_quantiles, in_ranges, running_totals


def _frame(spark, pdf):
    return spark.createDataFrame(pdf)


def test_error_by_segment_matches_pandas(spark):
    rng = np.random.default_rng(0)
    pdf = pd.DataFrame({"town": rng.choice(["A", "B", "C", None], 300), "flat_type": rng.choice(["3", "4"], 300),
                        "resale_price": rng.uniform(1e5, 5e5, 300)})
    pdf["prediction"] = pdf.resale_price * rng.uniform(0.8, 1.2, 300)
    got = E.error_by_segment(_frame(spark, pdf), segment_cols=["town", "flat_type", "absent"]).toPandas()
    res = pdf.prediction - pdf.resale_price
    for seg_col in ["town", "flat_type"]:
        g = pdf.assign(res=res, ae=res.abs(), ape=res.abs() / pdf.resale_price).groupby(seg_col)
        exp = g.agg(n=("res", "count"), mse=("res", "mean"), mae=("ae", "mean"), mape=("ape", "mean"))
        sub = got[got.segment_col == seg_col].set_index("segment")
        assert set(sub.index) == set(exp.index)
        for k, row in exp.iterrows():
            assert sub.loc[k, "n"] == row.n
            assert sub.loc[k, "mean_signed_error"] == pytest.approx(row.mse)
            assert sub.loc[k, "mae"] == pytest.approx(row.mae)
            assert sub.loc[k, "mape_pct"] == pytest.approx(row.mape * 100)
    assert list(got.mean_signed_error) == sorted(got.mean_signed_error, reverse=True)


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(1)
    vals = np.concatenate([rng.integers(0, 50, 500).astype(float), rng.normal(0, 10, 700)])
    df = spark.createDataFrame(pd.DataFrame({"v": vals}))
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    got = exact_quantiles(df, "v", probs, parts=8)
    assert got == pytest.approx(list(np.quantile(vals, probs)), rel=1e-12, abs=1e-12)


def test_running_totals_of_a_hot_group_over_many_ranges(spark):
    """One group with most of the values: totals as in pandas, and its values lie in many ranges."""
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"g": ["hot"] * 600 + list("abc") * 40, "v": rng.permutation(720).astype(float),
                        "n": rng.integers(1, 9, 720)})
    df = spark.createDataFrame(pdf)
    got = running_totals(df, ["g"], "v", ["n"], parts=9).toPandas().sort_values(["g", "v"]).reset_index(drop=True)
    exp = pdf.sort_values(["g", "v"]).reset_index(drop=True)
    assert got.cum_n.tolist() == exp.groupby("g").n.cumsum().tolist()
    rows = in_ranges(df, ["g"], "v", parts=9).groupBy("g", "_part").count().toPandas()
    hot = rows[rows.g == "hot"]
    assert len(hot) >= 6 and hot["count"].max() <= 240


def test_quantiles_without_rows(spark):
    assert exact_quantiles(spark.createDataFrame([], "v double"), "v", [0.5]) == [None]
    assert X.box_stats(spark.createDataFrame([], "g string, v double"), "g", "v").count() == 0


def test_describe_all_matches_pandas(spark):
    rng = np.random.default_rng(4)
    pdf = pd.DataFrame({"a": rng.normal(5, 2, 501), "b": rng.integers(0, 4, 501), "t": "x"})
    pdf.loc[::7, "a"] = np.nan
    df = spark.createDataFrame(pdf).withColumn("empty", F.lit(None).cast("double"))
    got = X.describe_all(df).toPandas().set_index("column")
    exp = pdf[["a", "b"]].describe()
    assert set(got.index) == {"a", "b", "empty"}
    for c in ("a", "b"):
        have = got.loc[c, ["count", "mean", "std", "min", "q25", "q50", "q75", "max"]].astype(float)
        assert have.tolist() == pytest.approx(exp[c].tolist())
    assert got.loc["empty", "count"] == 0 and np.isnan(got.loc["empty", "q50"])


def test_price_bands_match_qcut(spark):
    rng = np.random.default_rng(2)
    y = np.round(rng.lognormal(12, 0.4, 1000), -2)  # ties on purpose
    pdf = pd.DataFrame({"resale_price": y, "prediction": y * 1.05})
    got = E.error_by_price_band(spark.createDataFrame(pdf), n_bands=5).toPandas().set_index("price_band")
    band = pd.qcut(pdf.resale_price, q=5, labels=False)
    exp = pdf.assign(band=band).groupby("band").agg(n=("resale_price", "count"), mn=("resale_price", "min"),
                                                     mx=("resale_price", "max"))
    for b, row in exp.iterrows():
        assert got.loc[b, "n"] == row.n
        assert got.loc[b, "price_min"] == row.mn and got.loc[b, "price_max"] == row.mx


def test_error_report_equals_the_single_breakdowns(spark):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"town": rng.choice(["A", "B", None], 400), "flat_type": rng.choice(["3", "4"], 400),
                        "resale_price": rng.uniform(1e5, 5e5, 400)})
    pdf["one"], pdf["two"] = pdf.resale_price * rng.uniform(0.8, 1.2, 400), 3e5
    df = spark.createDataFrame(pdf)
    report = E.error_report(df, {"m1": "one", "m2": "two"})
    for model, col in (("m1", "one"), ("m2", "two")):
        metrics, seg, bands = E.report_sections(report, model)
        exp = E.error_by_segment(df, col).toPandas().sort_values(["segment_col", "segment"])
        got = seg.toPandas().sort_values(["segment_col", "segment"])
        assert got[["segment_col", "segment", "n"]].values.tolist() == exp[["segment_col", "segment", "n"]].values.tolist()
        for c in ("mean_signed_error", "mae", "mape_pct"):
            assert got[c].tolist() == pytest.approx(exp[c].tolist())
        b = bands.toPandas().sort_values("price_band").reset_index(drop=True)
        pd.testing.assert_frame_equal(b, E.error_by_price_band(df, col).toPandas(), check_dtype=False)
        row = metrics.filter(F.col("model") == model).first()
        one = E.evaluate(df, col).first()
        assert [row[c] for c in ("MAE", "RMSE", "R2", "MAPE_pct")] == [one[c] for c in ("MAE", "RMSE", "R2", "MAPE_pct")]


def test_duplicate_band_edges_raise(spark):
    df = spark.createDataFrame(pd.DataFrame({"resale_price": [1.0] * 50 + [2.0], "prediction": [1.0] * 51}))
    with pytest.raises(ValueError):
        E.error_by_price_band(df, n_bands=5)


def test_metrics(spark):
    y = np.array([100.0, 200.0, 300.0, 400.0])
    p = np.array([110.0, 190.0, 330.0, 380.0])
    df = spark.createDataFrame(pd.DataFrame({"resale_price": y, "prediction": p}))
    r = E.evaluate(df).first()
    assert r.MAE == round(np.mean(np.abs(p - y)), 2)
    assert r.RMSE == round(float(np.sqrt(np.mean((p - y) ** 2))), 2)
    r2 = 1 - np.sum((y - p) ** 2) / np.sum((y - y.mean()) ** 2)
    assert r.R2 == round(r2, 4)
    assert r.MAPE_pct == round(float(np.mean(np.abs(p - y) / y) * 100), 2)
    assert r.signed_error == round(float(np.mean(p - y)), 2)


def _ks_numpy(a, b):
    a, b = np.sort(a), np.sort(b)
    allv = np.concatenate([a, b])
    return np.max(np.abs(np.searchsorted(a, allv, "right") / len(a) - np.searchsorted(b, allv, "right") / len(b)))


def _psi_numpy(exp, act):
    bins = np.linspace(min(exp.min(), act.min()), max(exp.max(), act.max()), 11)
    e, _ = np.histogram(exp, bins)
    a, _ = np.histogram(act, bins)
    ep = np.where(e == 0, 1e-4, e / e.sum())
    ap = np.where(a == 0, 1e-4, a / a.sum())
    return float(np.sum((ap - ep) * np.log(ap / ep)))


def test_drift_matches_numpy_and_flags_shift(spark):
    rng = np.random.default_rng(3)
    tr = pd.DataFrame({"price": rng.normal(400_000, 50_000, 2000), "area": rng.integers(40, 120, 2000).astype(float)})
    te = pd.DataFrame({"price": rng.normal(800_000, 50_000, 800), "area": rng.integers(40, 120, 800).astype(float)})
    rep = D.drift_report(spark.createDataFrame(tr), spark.createDataFrame(te), ["price", "area"], 0.1).toPandas()
    rep = rep.set_index("feature")
    for c in ["price", "area"]:
        assert rep.loc[c, "ks_stat"] == pytest.approx(round(_ks_numpy(tr[c].values, te[c].values), 4), abs=1e-4)
        assert rep.loc[c, "psi"] == pytest.approx(round(_psi_numpy(tr[c].values, te[c].values), 4), abs=1e-4)
    assert bool(rep.loc["price", "flagged"]) and rep.loc["price", "ks_p"] < 0.01
    assert rep.loc["area", "ks_p"] > 0.01


def test_drift_of_one_flagged_frame(spark):
    """The parts of one frame give what two frames give; PSI of the raw rows equals PSI of the counts of values."""
    rng = np.random.default_rng(13)
    rows = pd.DataFrame({"a": rng.normal(0, 1, 900), "b": rng.integers(0, 9, 900).astype(float), "split": rng.choice(["train", "test", "other"], 900)})
    rows.loc[::50, "a"] = np.nan
    df = spark.createDataFrame(rows)
    flag = F.when(F.col("split") != "other", F.col("split") == "test")
    long = D.unpivot_split(df, flag, ["a", "b"])
    got = {r.feature: r for r in D.drift_of_long(long).collect()}
    want = {r.feature: r for r in D.drift_report(df.filter("split = 'train'"), df.filter("split = 'test'"), ["a", "b"]).collect()}
    assert got == want and set(got) == {"a", "b"}
    assert {r.feature: r.psi for r in D.psi_by_feature(long).collect()} == {k: r.psi for k, r in want.items()}


def test_constant_column_psi_zero(spark):
    tr = spark.createDataFrame(pd.DataFrame({"c": [5.0] * 10}))
    te = spark.createDataFrame(pd.DataFrame({"c": [5.0] * 4}))
    rep = D.drift_report(tr, te, ["c"]).first()
    assert rep.psi == 0.0 and rep.ks_stat == 0.0


def _vif_numpy(x):
    out = []
    for i in range(x.shape[1]):
        y, o = x[:, i], np.delete(x, i, axis=1)
        beta, *_ = np.linalg.lstsq(o, y, rcond=None)
        ssr = np.sum((y - o @ beta) ** 2)
        out.append(1.0 / (ssr / np.sum(y ** 2)))
    return out


def test_vif_independent_low_and_near_copy_high(spark):
    rng = np.random.default_rng(4)
    x1, x2, x3 = rng.normal(size=500), rng.normal(size=500), rng.normal(size=500)
    pdf = pd.DataFrame({"x1": x1, "x2": x2, "x3": x3})
    gm = CL.gramian(spark.createDataFrame(pdf), ["x1", "x2", "x3"])
    v = CL.vif_from_gramian(gm)
    assert all(val < 5 for val in v.values())
    assert [v[c] for c in ["x1", "x2", "x3"]] == pytest.approx(_vif_numpy(pdf.values), rel=1e-9)
    pdf2 = pd.DataFrame({"x1": x1, "x2": 0.99 * x1 + rng.normal(0, 0.01, 500), "x3": x3})
    v2 = CL.vif_from_gramian(CL.gramian(spark.createDataFrame(pdf2), ["x1", "x2", "x3"]))
    assert max(v2.values()) > 10


def test_prune_by_vif(spark):
    rng = np.random.default_rng(5)
    x1 = rng.normal(size=400)
    pdf = pd.DataFrame({"x1": x1, "x2": 0.99 * x1 + rng.normal(0, 0.01, 400), "x3": rng.normal(size=400),
                        "target": x1 * 3})
    gm = CL.gramian(spark.createDataFrame(pdf), list(pdf.columns))
    kept, dropped, hist = CL.prune_by_vif(gm, 10.0, ["target"])
    assert len(dropped) >= 1 and "target" not in dropped
    rest = [c for c in kept if c != "target"]
    assert all(val < 10 for val in CL.vif_from_gramian(gm.sub(rest)).values())
    kept2, dropped2, _ = CL.prune_by_vif(CL.gramian(spark.createDataFrame(pdf[["x1", "x3"]]), ["x1", "x3"]))
    assert dropped2 == []


def test_exact_collinearity_gives_infinite_vif(spark):
    x1 = np.arange(50, dtype=float)
    pdf = pd.DataFrame({"a": x1, "b": 2 * x1, "c": np.sin(x1)})
    v = CL.vif_from_gramian(CL.gramian(spark.createDataFrame(pdf), ["a", "b", "c"]))
    assert math.isinf(v["a"]) and math.isinf(v["b"])


def test_correlation_screen(spark):
    rng = np.random.default_rng(6)
    x1 = rng.normal(size=300)
    pdf = pd.DataFrame({"x1": x1, "x2": 0.99 * x1 + rng.normal(0, 0.05, 300), "x3": rng.normal(size=300)})
    pdf.loc[5, "x3"] = np.nan
    got = CL.correlation_screen(spark.createDataFrame(pdf), ["x1", "x2", "x3"], 0.85).collect()
    assert [(r.feature_a, r.feature_b) for r in got] == [("x1", "x2")]
    assert got[0].pearson_r == pytest.approx(round(abs(pdf.corr().loc["x1", "x2"]), 4))
    pairs = {(a, b): r for a, b, r in CL.pearson_pairs(spark.createDataFrame(pdf), ["x1", "x2", "x3"])}
    assert pairs[("x1", "x3")] == pytest.approx(pdf.corr().loc["x1", "x3"], rel=1e-9)
    none = CL.correlation_screen(spark.createDataFrame(pdf[["x1", "x3"]]), ["x1", "x3"], 0.85)
    assert none.count() == 0


def test_describe_and_box(spark):
    rng = np.random.default_rng(7)
    pdf = pd.DataFrame({"g": rng.choice(["a", "b"], 400), "v": rng.normal(0, 1, 400)})
    pdf.loc[0, "v"] = 50.0
    df = spark.createDataFrame(pdf)
    d = {r.stat: r.value for r in X.describe(df, "v").collect()}
    ref = pdf.v.describe()
    for k in ["count", "mean", "std", "min", "25%", "50%", "75%", "max"]:
        assert d[k] == pytest.approx(ref[k], rel=1e-9)
    box = {r.g: r for r in X.box_stats(df, "g", "v").collect()}
    for g, sub in pdf.groupby("g"):
        q1, q3 = np.quantile(sub.v, [0.25, 0.75])
        assert box[g].q1 == pytest.approx(q1) and box[g].q3 == pytest.approx(q3)
        inside = sub.v[(sub.v >= q1 - 1.5 * (q3 - q1)) & (sub.v <= q3 + 1.5 * (q3 - q1))]
        assert box[g].whisker_hi == pytest.approx(inside.max())
        assert box[g].n_outliers == len(sub) - len(inside)


def test_histogram_and_counts(spark):
    pdf = pd.DataFrame({"v": [0.0, 1.0, 2.0, 3.0, 4.0, 10.0], "k": ["a", "a", "b", None, "b", "b"]})
    df = spark.createDataFrame(pdf)
    h = X.histogram(df, "v", 5).orderBy("bin").collect()
    assert [r.n for r in h] == list(np.histogram(pdf.v, bins=5)[0])
    f = X.frequency_table(df, "k").collect()
    assert [(r.k, r.n) for r in f] == [("b", 3), ("a", 2)]
    dc = {r.column: r.n_distinct for r in X.distinct_counts(df, ["k", "v"]).collect()}
    assert dc == {"k": 2, "v": 6}


def test_trend_and_freshness(spark):
    m = spark.createDataFrame([("m", "2024-01-01", 10.0), ("m", "2024-01-02", 12.0)], "model string, date string, MAE double")
    t = X.metric_trend(m).orderBy("date").collect()
    assert t[0].previous is None and t[1].change == 2.0
    f = X.freshness(m, "date", "2024-01-03 13:00:00").first()
    assert f.age_hours == 37.0 and f.stale


def test_group_mean_model(spark):
    train = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 10.0)], "town string, resale_price double")
    test = spark.createDataFrame([("a", 0.0), ("c", 0.0)], "town string, resale_price double")
    got = {r.town: r.prediction for r in E.group_mean_model(train, test).collect()}
    assert got == {"a": 2.0, "c": pytest.approx(14.0 / 3)}


def test_top_segments(spark):
    seg = spark.createDataFrame([(str(i), i, float(i % 3)) for i in range(30)],
                                "segment string, n int, mean_signed_error double")
    top = E.top_segments(seg, 5).collect()
    assert sorted(r.n for r in top) == [25, 26, 27, 28, 29]
    assert [r.mean_signed_error for r in top] == sorted([r.mean_signed_error for r in top], reverse=True)
    assert F is not None


def test_collinearity_reads_its_input_once(spark):
    rng = np.random.default_rng(6)
    pdf = pd.DataFrame(rng.normal(0, 1, (200, 3)), columns=["a", "b", "c"])
    pdf["d"], pdf["y"] = pdf.a + 0.01 * pdf.b, 2 * pdf.c
    read = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            read.add(len(batch))
            yield batch

    df = spark.createDataFrame(pdf)
    t = CL.collinearity_tables(spark, df.mapInPandas(count, df.schema), list(pdf.columns), "y")
    assert t["dropped_list"] in (["a"], ["d"]) and t["vif"].count() == 4 and t["corr_pairs"].count() == 1
    assert read.value == 200
