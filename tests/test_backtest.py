"""Folds and walk-forward (E3, E4, C13), contracts."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from appraise.operators import errors as E
from appraise.operators import folds as FO
from appraise.operators import quality as Q
from appraise.sources import tables as T

from .conftest import SF_SMALL


@pytest.mark.parametrize("n,expected", [(87, 11), (80, 10), (114, 16), (20, 0)])
def test_fold_counts(n, expected):
    assert len(FO.fold_specs(n, 6, 18)) == expected


def test_too_few_months_raise():
    with pytest.raises(ValueError):
        FO.fold_specs(18, 6, 18)


def test_fold_bounds():
    f = FO.fold_specs(30, 6, 18)
    assert [(s.train_end_idx, s.test_start_idx, s.test_end_idx) for s in f] == [(17, 18, 23), (23, 24, 29)]


def _months(spark, n):
    rows = []
    for i in range(n):
        m = dt.date(2017 + i // 12, i % 12 + 1, 1)
        for k in range(3):
            rows.append((m, "A" if k else "B", float(100 + i + k)))
    return spark.createDataFrame(rows, "month date, town string, resale_price double")


def test_walk_forward_group_mean_equals_generic(spark):
    df = _months(spark, 30)
    fast = FO.walk_forward_group_mean(df, "town", "resale_price", "month", 6, 18).orderBy("fold").collect()
    slow, errors = FO.walk_forward_cv(df, lambda tr, te: E.group_mean_model(tr, te, "town"), "month",
                                      "resale_price", 6, 18)
    slow = slow.collect()
    assert errors.count() == 0 and len(fast) == len(slow) == 2
    for a, b in zip(fast, slow):
        assert a.asDict() == b.asDict()
    assert fast[0].n_train == 18 * 3 and fast[0].n_test == 6 * 3
    assert (fast[0].train_end, fast[0].test_start, fast[0].test_end) == ("2018-06", "2018-07", "2018-12")


def test_failing_fold_keeps_number(spark):
    df = _months(spark, 30)
    calls = []

    def model_fn(tr, te):
        calls.append(1)
        if len(calls) == 1:
            raise RuntimeError("boom")
        return E.group_mean_model(tr, te, "town")

    res, errors = FO.walk_forward_cv(df, model_fn, "month", "resale_price", 6, 18, parallelism=1)
    assert [r.fold for r in res.collect()] == [2]
    assert [r.fold for r in errors.collect()] == [1]


def test_fold_membership(spark):
    df = _months(spark, 30)
    folds, months = FO.fold_table(df, "month", 6, 18)
    got = {(r.fold, r.role): r.n for r in FO.fold_membership_counts(df, folds, months).collect()}
    assert got == {(1, "train"): 54, (1, "test"): 18, (2, "train"): 72, (2, "test"): 18}


def _tx(spark, price=500000.0, area=93.0):
    return spark.createDataFrame(
        [("k1", dt.date(2020, 1, 1), "ANG MO KIO", "4 ROOM", "123", "AMK AVE 1", "07 TO 09", area, "Model A", 1998,
          "73 years 05 months", price)],
        "tx_id string, month date, town string, flat_type string, block string, street_name string, "
        "storey_range string, floor_area_sqm double, flat_model string, lease_commence_date int, "
        "remaining_lease string, resale_price double")


def test_contract_pass_and_fail(spark):
    ok, fails = Q.validate(_tx(spark), Q.transaction_contract(), "tx_id")
    assert ok and fails.count() == 0
    ok, fails = Q.validate(_tx(spark, price=10.0), Q.transaction_contract(), "tx_id")
    assert not ok and [(r.column, r.failure_case) for r in fails.collect()] == [("resale_price", "10.0")]
    ok, fails = Q.validate(_tx(spark, area=5.0), Q.transaction_contract(), "tx_id")
    assert not ok and fails.first().column == "floor_area_sqm"


def test_missing_column_and_coercion(spark):
    df = _tx(spark).drop("town").withColumn("floor_area_sqm", F.lit("abc"))
    fails = {(r.column, r.check) for r in Q.failure_cases(df, Q.transaction_contract(), "tx_id").collect()}
    assert ("town", "column_in_dataframe") in fails
    assert ("floor_area_sqm", "coerce_dtype('double')") in fails


def test_request_bounds_exclusive(spark):
    df = spark.createDataFrame([("r1", 30.0), ("r2", 31.0), ("r3", -10.0)], "request_id string, floor_area_sqm double")
    specs = [s for s in Q.request_contract() if s.name == "floor_area_sqm"]
    bad = {r.row_key for r in Q.failure_cases(df, specs, "request_id").collect()}
    assert bad == {"r1", "r3"}


def test_series_contract_on_driver_series(spark):
    s = T.monthly_series(spark, SF_SMALL)
    summary = Q.rule_summary(s, Q.series_contract())
    assert summary.count() == 23


def test_coverage_and_nulls(spark):
    df = spark.createDataFrame([(1.0,), (None,), (2.0,), (3.0,)], "latitude double")
    c = Q.coverage(df, "latitude", 0.99).first()
    assert c.coverage == 0.75 and not c.passed
    n = {r.column: r.n_null for r in Q.null_counts(df).collect()}
    assert n == {"latitude": 1}
