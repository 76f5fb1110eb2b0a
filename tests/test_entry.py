"""Driver contract: entry, registered queries and oracles line up; a sample of queries runs at sf0.001."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as E
from appraise.sources.tables import DRIVER_TABLES

from .conftest import SF_SMALL


def test_entry_runs(spark):
    df = E.entry(spark)
    assert set(df.columns) == {"segment_col", "segment", "n", "mean_signed_error", "mae", "mape_pct"}
    assert df.count() > 0


def test_oracle_keys_are_queries():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def _rows(pdf):
    cols = sorted(pdf.columns)
    norm = lambda v: None if v is None or (isinstance(v, float) and v != v) else (round(v, 6) if isinstance(v, float) else v)
    out = [tuple(norm(getattr(v, "item", lambda: v)()) for v in (r[c] for c in cols)) for r in pdf.to_dict("records")]
    return cols, sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.mark.parametrize("name", ["walk_forward_naive", "drift_report", "nearest_by_category", "contract_summary",
                                  "error_by_band", "box_stats", "lagged_series_join", "gazetteer_lookup"])
def test_query_matches_oracle_small(spark, duck, name):
    got = _rows(E.queries()[name](spark, SF_SMALL).toPandas())
    exp = _rows(duck.execute(E.oracle_sql()[name]).df())
    assert got == exp


def test_analytics_document_sections(spark):
    rows = E.queries()["analytics_document"](spark, SF_SMALL).collect()
    sections = {r.section for r in rows}
    assert sections == {"backtest_folds", "bias_by_town", "bias_by_flat_type", "bias_by_price_band", "metrics",
                        "summary"}
    summary = {r.metric: r.value for r in rows if r.section == "summary"}
    from appraise.sources.tables import transactions

    assert summary["n_train"] + summary["n_test"] == transactions(spark, SF_SMALL).count()
    assert summary["n_train"] > 0 and summary["n_test"] > 0
    assert len({r.item for r in rows if r.section == "bias_by_price_band"}) == 5
