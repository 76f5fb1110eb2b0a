"""The batch job: ingest -> validate -> features -> collinearity -> train -> backtest -> analytics.

Each stage reads the saved output of the previous stage when that stage is
not part of the run, writes its own tables, and never stops the job on a
data-quality failure (unless ``fail_fast``). Intermediates are parquet
tables under ``out_dir`` (shared storage), which also cuts lineage between
stages. The model pointer is the last write of the train stage.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from appraise.ml import models as M
from appraise.operators import collinearity as CL
from appraise.operators import drift as D
from appraise.operators import errors as E
from appraise.operators import folds as FO
from appraise.operators import joins as J
from appraise.operators import quality as Q
from appraise.plans import report as R
from appraise.plans.features import FeatureConfig, enriched_sales, model_columns, processed_frame
from appraise.sources import tables as T
from appraise.streaming.scoring import write_pointer

log = logging.getLogger(__name__)

ALL_STAGES = ("ingest", "validate", "features", "collinearity", "train", "backtest", "analytics")


@dataclass
class JobConfig:
    sf_dir: str
    out_dir: str
    run_date: str
    features: FeatureConfig = field(default_factory=FeatureConfig)
    tx_bounds: dict = field(default_factory=lambda: dict(area=(5.0, 45.0), lease_year=(1960, 2024),
                                                         price=(1000.0, 100000.0)))
    vif_threshold: float = 10.0
    corr_threshold: float = 0.85
    psi_threshold: float = 0.2
    step_months: int = 6
    min_train_months: int = 18
    models: dict = field(default_factory=lambda: {"lgbm": M.MODEL_A, "xgboost": M.MODEL_B})
    weights: dict = field(default_factory=lambda: {"lgbm": 0.5, "xgboost": 0.5})
    backtest_model: str = "ensemble"  # or "group_mean"
    parallelism: int = 2
    fail_fast: bool = False

    @property
    def target(self) -> str:
        return self.features.target

    def path(self, *parts: str) -> str:
        return "/".join([self.out_dir.rstrip("/"), *parts])


class Job:
    def __init__(self, spark: SparkSession, cfg: JobConfig):
        self.spark, self.cfg = spark, cfg
        self.state: dict = {}

    # ------------------------------------------------------------ helpers
    def _read(self, *parts: str) -> DataFrame:
        return self.spark.read.parquet(self.cfg.path(*parts))

    def _report(self, df: DataFrame, name: str) -> None:
        R.write_report(df, self.cfg.path("reports"), name, self.cfg.run_date)

    def _saved_report(self, name: str) -> DataFrame | None:
        """A report of this run date, or None if no run has written it. Any other failure is an error."""
        try:
            rows = self._read("reports", name)
        except AnalysisException as exc:
            if exc.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            return None
        rows = rows.filter(F.col("date") == F.lit(self.cfg.run_date).cast(rows.schema["date"].dataType)).drop("date")
        return None if rows.isEmpty() else rows

    # ------------------------------------------------------------ stages
    def ingest(self) -> None:
        s, c = self.spark, self.cfg
        R.write_table(enriched_sales(s, c.sf_dir, c.features), c.path("interim", "tx"))

    def validate(self) -> None:
        s, c = self.spark, self.cfg
        tx = self._read("interim", "tx")
        series = T.monthly_series(s, c.sf_dir)
        fails = Q.failure_cases(tx, Q.transaction_contract(**c.tx_bounds), "tx_id").cache()
        sfails = Q.failure_cases(series, Q.series_contract(), "month").cache()
        n_tx, n_series = fails.count(), sfails.count()
        lagged = J.lag_series(series, c.features.lag_months)
        missing = [r["month"].isoformat()[:7] for r in J.missing_months(tx, lagged).orderBy("month").collect()]
        cov = Q.coverage(tx.select("block", "street_name", "latitude").distinct(), "latitude").first() if "latitude" in tx.columns else None
        split = J.split_by_cutoff(tx, c.features.cutoff + "-01")
        nums = D.numeric_columns(tx, ["resale_price"]) + ["resale_price"]
        drift = D.drift_of_long(D.unpivot_split(split, F.col("split") == "test", nums), c.psi_threshold).cache()
        flagged = [r["feature"] for r in drift.filter("flagged").collect()]
        entries = [
            ("schema", "transaction_contract", n_tx == 0, n_tx, f"{n_tx} failure rows"),
            ("macro", "series_contract", n_series == 0, n_series, f"{n_series} failure rows"),
            ("macro", "series_completeness", not missing, len(missing), ",".join(missing)),
            ("drift", "psi_flagged", not flagged, len(flagged), ",".join(flagged)),
        ]
        if cov is not None:
            entries.append(("geo", "coverage", bool(cov["passed"]), 0, f"{cov['coverage']:.4f}"))
        self._report(Q.check_table(s, entries), "validation_checks")
        self._report(fails.unionByName(sfails), "contract_failures")
        self._report(drift, "drift")
        fails.unpersist()
        sfails.unpersist()
        drift.unpersist()
        if c.fail_fast and (n_tx or n_series):
            raise RuntimeError("validation failed")

    def features(self) -> None:
        s, c = self.spark, self.cfg
        df = processed_frame(s, c.sf_dir, c.features, self._read("interim", "tx"))
        df.write.mode("overwrite").partitionBy("split").parquet(c.path("processed"))

    def collinearity(self) -> None:
        s, c = self.spark, self.cfg
        train = self._read("processed").filter("split = 'train'")
        nums = [n for n in D.numeric_columns(train) if n != c.target]
        t = CL.collinearity_tables(s, train, nums + [c.target], c.target, c.vif_threshold, c.corr_threshold)
        self._report(t["vif"], "collinearity_vif")
        self._report(t["dropped"], "collinearity_dropped")
        self._report(t["corr_pairs"], "collinearity_corr_pairs")
        self.state["dropped"] = t["dropped_list"]

    def _dropped(self) -> list[str]:
        if "dropped" not in self.state:
            rows = self._saved_report("collinearity_dropped")  # none: collinearity not run, nothing dropped
            self.state["dropped"] = [] if rows is None else [r["dropped_feature"] for r in rows.orderBy("step").collect()]
        return self.state["dropped"]

    def train(self) -> None:
        s, c = self.spark, self.cfg
        proc = self._read("processed")
        train, test = proc.filter("split = 'train'"), proc.filter("split = 'test'")
        cats, nums = model_columns(proc, c.target, self._dropped())
        ens, metrics = M.train_ensemble(train, test, c.target, cats, nums, c.models, c.weights)
        metrics = metrics.cache()
        self._report(metrics, "model_metrics")
        imp = M.summarise_importance(s, ens, 20)
        self._report(imp, "feature_importance")
        latest = J.latest_row(T.monthly_series(s, c.sf_dir)).first()
        latest_d = {k: (v.isoformat() if hasattr(v, "isoformat") else v) for k, v in latest.asDict().items()} if latest else {}
        ens_m = metrics.filter("model = 'ensemble'").first()
        ens_metrics = {k: ens_m[k] for k in ("MAE", "RMSE", "R2", "MAPE_pct")} if ens_m else {}
        model_prefix = c.path("models", c.run_date)
        M.save_bundle(s, ens, model_prefix, {"run_date": c.run_date, "metrics": ens_metrics, "latest_series": latest_d,
                                             "collinearity_dropped": self._dropped()})
        write_pointer(s, c.path("models", "latest"), model_prefix, c.path("reports"), c.run_date, ens_metrics)
        self.state["ensemble"] = ens

    def _model_fn(self, cats: list[str], nums: list[str]):
        c = self.cfg
        if c.backtest_model == "group_mean":
            return lambda tr, te: E.group_mean_model(tr, te, "town", c.target)

        def fit_predict(tr: DataFrame, te: DataFrame) -> DataFrame:
            ens, _ = M.train_ensemble(tr, te.limit(0), c.target, cats, nums, c.models, c.weights)
            return ens.predict(te)

        return fit_predict

    def backtest(self) -> None:
        s, c = self.spark, self.cfg
        proc = self._read("processed")
        if "transaction_month" not in proc.columns:
            raise ValueError("the processed table has no transaction_month column; folds need it")
        cats, nums = model_columns(proc, c.target, self._dropped())
        folds, errors = FO.walk_forward_cv(proc, self._model_fn(cats, nums), "transaction_month", c.target,
                                           c.step_months, c.min_train_months, c.parallelism)
        folds = folds.cache()
        self._report(folds, "backtest_folds")
        self._report(errors, "backtest_fold_errors")
        test = proc.filter("split = 'test'")
        ens = self.state.get("ensemble")
        if ens is None:
            ens, _ = M.train_ensemble(proc.filter("split = 'train'"), test.limit(0), c.target, cats, nums, c.models,
                                      c.weights)
        report = E.error_report(ens.predict(test), {"ensemble": "prediction"}, c.target)
        _, seg, bands = E.report_sections(report, "ensemble")
        self._report(seg, "backtest_segments")
        self._report(bands, "backtest_price_bands")

    def analytics(self) -> None:
        s, c = self.spark, self.cfg
        names = ("model_metrics", "backtest_folds", "backtest_segments", "backtest_price_bands", "feature_importance")
        saved = [self._saved_report(n) for n in names]
        absent = [n for n, t in zip(names, saved) if t is None]
        if absent:
            log.warning("analytics needs the reports %s; skipped", ", ".join(absent))
            return
        proc = self._read("processed")
        n = {r["split"]: r["n"] for r in proc.groupBy("split").agg(F.count(F.lit(1)).alias("n")).collect()}  # two rows
        doc = R.analytics_document(s, c.run_date, n.get("train", 0), n.get("test", 0), *saved)
        R.write_document(doc, c.path("reports", f"date={c.run_date}", "analytics_json"))
        self.state["document"] = doc

    def run(self, stages: tuple[str, ...] = ALL_STAGES) -> dict:
        for name in ALL_STAGES:
            if name in stages:
                log.info("stage %s", name)
                getattr(self, name)()
        return self.state


def run_job(spark: SparkSession, cfg: JobConfig, stages: tuple[str, ...] = ALL_STAGES) -> dict:
    return Job(spark, cfg).run(stages)
