"""End-to-end job on the smallest tables (all stages, tiny models)."""

from __future__ import annotations

import json
import os
from dataclasses import replace

from appraise.ml import models as M
from appraise.plans.job import JobConfig, run_job

from .conftest import SF_SMALL


def test_job_all_stages(spark, scratch):
    out = os.path.join(scratch, "out")
    cfg = JobConfig(sf_dir=SF_SMALL, out_dir=out, run_date="2001-09-01",
                    models={"lgbm": replace(M.MODEL_A, trees=3, leaves=8), "xgboost": replace(M.MODEL_B, trees=3, depth=2)},
                    backtest_model="group_mean")
    run_job(spark, cfg)
    doc = json.loads(spark.read.text(os.path.join(out, "reports", "date=2001-09-01", "analytics_json")).first()[0])
    processed = spark.read.parquet(os.path.join(out, "processed"))
    assert doc["run_date"] == "2001-09-01" and doc["n_train"] == processed.filter("split = 'train'").count()
    assert len(doc["feature_importance_top20"]) == 20
    assert set(doc["metrics"]) == {"lgbm", "xgboost", "ensemble"}
    assert len(doc["backtest_folds"]) == 10 and len(doc["bias_by_price_band"]) == 5
    checks = {r.name: r for r in spark.read.parquet(os.path.join(out, "reports", "validation_checks")).collect()}
    assert not checks["series_completeness"].passed and checks["series_completeness"].detail == "1995-01"
    ptr = json.loads(spark.read.text(os.path.join(out, "models", "latest")).first()[0])
    assert ptr["run_date"] == "2001-09-01" and os.path.isdir(ptr["model_prefix"])
    # a later stage alone reads the saved output of the earlier ones
    run_job(spark, cfg, ("collinearity",))
    again = run_job(spark, cfg, ("analytics",))["document"].first()
    assert [r.fold for r in again.backtest_folds] == [r["fold"] for r in doc["backtest_folds"]] and again.n_train == doc["n_train"]
    assert "document" not in run_job(spark, replace(cfg, run_date="2001-10-01"), ("analytics",))  # no reports of that date
    assert spark.read.parquet(os.path.join(out, "reports", "collinearity_vif")).count() > 0
    tx = spark.read.parquet(os.path.join(out, "interim", "tx"))
    assert {"is_elite_closest_primary", "is_elite_closest_secondary", "is_elite_closest_mixed"} <= set(tx.columns)
    assert set(tx.columns) & set(spark.read.parquet(os.path.join(out, "processed")).columns) >= {"is_elite_closest_primary"}
