"""Walk-forward (expanding window) backtesting.

Folds are defined on the months *present* in the data: months are ranked
0..n-1; fold k (1-based) trains on ranks < min_train + (k-1)*step and tests
on the next ``step`` ranks; a trailing partial window is dropped. The month
list is bounded by the calendar, so the fold table (tens of rows) is built
on the driver and broadcast; facts reach their test fold through an
equi-join on the month rank (test windows never overlap).
"""

from __future__ import annotations

import logging
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from appraise.operators.errors import metric_columns
from appraise.operators.joins import join_measured
from appraise.operators.sets import union_by_name
from appraise.session import materialize

log = logging.getLogger(__name__)

FOLD_SCHEMA = "fold int, train_end date, test_start date, test_end date, train_end_idx int, test_start_idx int, test_end_idx int"


@dataclass(frozen=True)
class FoldSpec:
    fold: int
    train_end_idx: int
    test_start_idx: int
    test_end_idx: int


def ranked_months(df: DataFrame, month_col: str = "month") -> DataFrame:
    """Distinct months (truncated) with their 0-based rank: (month, idx)."""
    m = df.select(F.trunc(F.col(month_col), "month").alias("month")).distinct()
    # one row per calendar month: the window over it is small by construction
    return m.withColumn("idx", (F.row_number().over(Window.orderBy("month")) - 1).cast("int"))


def fold_specs(n_months: int, step: int = 6, min_train: int = 18) -> list[FoldSpec]:
    """Fold index ranges; error when there are not more than ``min_train`` months."""
    if min_train >= n_months:
        raise ValueError(f"{n_months} months leave no test month after {min_train} training months")
    out = []
    for k, i in enumerate(range(min_train, n_months - step + 1, step), start=1):
        out.append(FoldSpec(k, i - 1, i, min(i + step - 1, n_months - 1)))
    return out


def fold_table(df: DataFrame, month_col: str = "month", step: int = 6, min_train: int = 18
               ) -> tuple[DataFrame, DataFrame]:
    """(folds, ranked months). folds: fold, train_end, test_start, test_end (+ rank bounds)."""
    spark: SparkSession = df.sparkSession
    months = ranked_months(df, month_col)
    month_rows = months.orderBy("idx").collect()  # bounded by the calendar (one row per month)
    by_idx = {r["idx"]: r["month"] for r in month_rows}
    specs = fold_specs(len(month_rows), step, min_train)
    rows = [(s.fold, by_idx[s.train_end_idx], by_idx[s.test_start_idx], by_idx[s.test_end_idx],
             s.train_end_idx, s.test_start_idx, s.test_end_idx) for s in specs]
    folds = spark.createDataFrame(rows, FOLD_SCHEMA)
    return folds, spark.createDataFrame([(r["month"], r["idx"]) for r in month_rows], "month date, idx int")


def attach_test_fold(df: DataFrame, months: DataFrame, n_folds: int, step: int, min_train: int,
                     month_col: str = "month") -> DataFrame:
    """C13 (test side): each row gets the one fold whose test window holds its month."""
    d = df.withColumn("_m", F.trunc(F.col(month_col), "month"))
    d = d.join(F.broadcast(months.withColumnRenamed("month", "_m")), "_m").drop("_m")
    fold = (F.floor((F.col("idx") - min_train) / step) + 1).cast("int")
    last_idx = min_train + n_folds * step - 1
    return d.filter((F.col("idx") >= min_train) & (F.col("idx") <= last_idx)).withColumn("fold", fold)


def fold_membership_counts(df: DataFrame, folds: DataFrame, months: DataFrame, month_col: str = "month") -> DataFrame:
    """Rows per fold and role, from monthly counts (never multiplies fact rows)."""
    mc = df.groupBy(F.trunc(F.col(month_col), "month").alias("month")).agg(F.count(F.lit(1)).alias("c"))
    mc = mc.join(F.broadcast(months), "month")
    f = F.broadcast(folds.select("fold", "train_end_idx", "test_start_idx", "test_end_idx"))
    train = mc.join(f, mc.idx <= f.train_end_idx).groupBy("fold").agg(F.sum("c").alias("n")).withColumn("role", F.lit("train"))
    test = mc.join(f, (mc.idx >= f.test_start_idx) & (mc.idx <= f.test_end_idx)).groupBy("fold").agg(
        F.sum("c").alias("n")).withColumn("role", F.lit("test"))
    return train.unionByName(test)


def walk_forward_group_mean(df: DataFrame, key: str = "town", target_col: str = "resale_price",
                            month_col: str = "month", step: int = 6, min_train: int = 18) -> DataFrame:
    """E4 with the group-mean model, fully distributed.

    Train means per (fold, key) come from (month, key) pre-aggregates joined
    to the folds, so the fold fan-out touches months x keys rows, not facts.
    """
    folds, months = fold_table(df, month_col, step, min_train)
    n_folds = folds.count()
    d = df.select(F.trunc(F.col(month_col), "month").alias("_m"), key, target_col)
    d = d.join(F.broadcast(months.withColumnRenamed("month", "_m")), "_m")
    mk = d.groupBy("idx", key).agg(F.sum(target_col).alias("s"), F.count(target_col).alias("c"))
    fb = F.broadcast(folds.select("fold", "train_end_idx"))
    tr = mk.join(fb, mk.idx <= fb.train_end_idx)
    key_means = tr.groupBy("fold", key).agg((F.sum("s") / F.sum("c")).alias("_km"))
    fold_means = tr.groupBy("fold").agg((F.sum("s") / F.sum("c")).alias("_fm"),
                                        F.sum("c").alias("n_train"))
    test = attach_test_fold(d.withColumnRenamed("_m", "month").drop("idx"), months, n_folds, step, min_train)
    pred = (
        join_measured(test, key_means, ["fold", key]).join(F.broadcast(fold_means), "fold")
        .withColumn("prediction", F.coalesce("_km", "_fm"))
    )
    metrics = pred.groupBy("fold").agg(
        *metric_columns("prediction", target_col),
        F.round(F.avg(F.col("prediction") - F.col(target_col)), 2).alias("signed_error"),
        F.count(F.lit(1)).alias("n_test"),
        F.first("n_train").alias("n_train"),
    )
    return folds.join(metrics, "fold").select(
        "fold", F.date_format("train_end", "yyyy-MM").alias("train_end"),
        F.date_format("test_start", "yyyy-MM").alias("test_start"),
        F.date_format("test_end", "yyyy-MM").alias("test_end"),
        "n_train", "n_test", "MAE", "RMSE", "R2", "MAPE_pct", "signed_error",
    )


def fold_summary(folds: DataFrame) -> DataFrame:
    """How many folds there are and the mean of their MAPE (null without folds), one row."""
    return folds.agg(F.count(F.lit(1)).alias("n_folds"), F.avg("MAPE_pct").alias("mean_MAPE_pct"))


def monthly_sums(df: DataFrame, months: DataFrame, columns: list[str], month_col: str = "month") -> DataFrame:
    """Per month rank the cross products of ``columns`` (rows with a null in one of them are left out): sums that add up."""
    d = df.select(F.trunc(F.col(month_col), "month").alias("_m"), *[F.col(c).cast("double").alias(c) for c in columns]).dropna()
    d = d.join(F.broadcast(months.withColumnRenamed("month", "_m")), "_m")
    pairs = [(i, j) for i in range(len(columns)) for j in range(i, len(columns))]
    return d.groupBy("idx").agg(
        *[F.sum(F.col(columns[i]) * F.col(columns[j])).alias(f"s{i}_{j}") for i, j in pairs],
        *[F.sum(c).alias(f"t{i}") for i, c in enumerate(columns)], F.count(F.lit(1)).alias("n"),
    )


def fold_regressions(sums: DataFrame, specs: list[FoldSpec], features: list[str]) -> dict[int, tuple[np.ndarray, float, int]]:
    """Least squares of every fold's training months, from prefix sums over the months: coefficients, intercept, rows.

    One row per month reaches the driver. Columns that don't vary in a fold get the coefficient 0.
    """
    p = len(features) + 1  # the target is the last one
    rows = {r["idx"]: r for r in sums.collect()}
    total, out, at = np.zeros((p + 1, p + 1)), {}, 0
    for s in specs:
        while at <= s.train_end_idx:
            r = rows.get(at)
            if r:
                m = np.zeros((p + 1, p + 1))
                for i in range(p):
                    m[i, i:p] = [r[f"s{i}_{j}"] for j in range(i, p)]
                    m[i, p] = r[f"t{i}"]
                m[p, p] = r["n"]
                total += np.triu(m) + np.triu(m, 1).T
            at += 1
        n = total[p, p]
        if not n:
            continue
        mean = total[:p, p] / n
        c = total[:p, :p] - n * np.outer(mean, mean)
        scale = np.sqrt(np.maximum(np.diag(c)[:-1], 0))
        ok = scale > 1e-9 * np.sqrt(np.maximum(np.diag(total)[: p - 1], 1e-300))
        beta = np.zeros(p - 1)
        if ok.any():
            q = c[:-1, :-1][np.ix_(ok, ok)] / np.outer(scale[ok], scale[ok])
            beta[ok] = np.linalg.lstsq(q, c[:-1, -1][ok] / scale[ok], rcond=1e-10)[0] / scale[ok]
        out[s.fold] = (beta, float(mean[-1] - beta @ mean[:-1]), int(n))
    return out


def walk_forward_linear(df: DataFrame, features: list[str], target_col: str = "resale_price", month_col: str = "month",
                        step: int = 6, min_train: int = 18) -> DataFrame:
    """E4 with a linear model: the facts are read once for the sums of all folds and once for their predictions.

    A test row with a null feature has no prediction and counts in ``n_test`` alone.
    """
    spark = df.sparkSession
    folds, months = fold_table(df, month_col, step, min_train)
    specs = [FoldSpec(r["fold"], r["train_end_idx"], r["test_start_idx"], r["test_end_idx"]) for r in folds.collect()]  # tens of rows
    fits = fold_regressions(monthly_sums(df, months, [*features, target_col], month_col), specs, features)
    table = spark.createDataFrame(
        [(k, n, float(a), *map(float, b)) for k, (b, a, n) in fits.items()],
        "fold int, n_train long, _a double" + "".join(f", _b{i} double" for i in range(len(features))),
    )
    test = attach_test_fold(df.select(month_col, target_col, *features), months, len(specs), step, min_train, month_col)
    test = test.join(F.broadcast(table), "fold")  # a row per fold
    prediction = F.col("_a")
    for i, c in enumerate(features):
        prediction = prediction + F.col(f"_b{i}") * F.col(c)
    metrics = test.withColumn("prediction", prediction).groupBy("fold").agg(
        *metric_columns("prediction", target_col),
        F.round(F.avg(F.col("prediction") - F.col(target_col)), 2).alias("signed_error"),
        F.count(F.lit(1)).alias("n_test"),
        F.first("n_train").alias("n_train"),
    )
    return folds.join(metrics, "fold").select(
        "fold", F.date_format("train_end", "yyyy-MM").alias("train_end"),
        F.date_format("test_start", "yyyy-MM").alias("test_start"),
        F.date_format("test_end", "yyyy-MM").alias("test_end"),
        "n_train", "n_test", "MAE", "RMSE", "R2", "MAPE_pct", "signed_error",
    )


ModelFn = Callable[[DataFrame, DataFrame], DataFrame]


def walk_forward_cv(df: DataFrame, model_fn: ModelFn, month_col: str = "month", target_col: str = "resale_price",
                    step: int = 6, min_train: int = 18, parallelism: int = 2
                    ) -> tuple[DataFrame, DataFrame]:
    """E4 with any model: ``model_fn(train, test) -> test + prediction``.

    Folds are fitted from a small driver thread pool (each fit is itself a
    distributed job); predictions of all folds are unioned and measured in a
    single grouped aggregate. A failing fold keeps its number and is reported
    in the second frame (fold, error) instead of stopping the run.
    """
    spark = df.sparkSession
    folds, months = fold_table(df, month_col, step, min_train)
    specs = folds.collect()  # tens of rows
    base = df.withColumn("_m", F.trunc(F.col(month_col), "month")).join(
        F.broadcast(months.withColumnRenamed("month", "_m")), "_m").drop("_m")

    def run(row):
        train = base.filter(F.col("idx") <= row["train_end_idx"]).drop("idx")
        test = base.filter((F.col("idx") >= row["test_start_idx"]) & (F.col("idx") <= row["test_end_idx"])).drop("idx")
        try:
            out = model_fn(train, test).select(F.lit(row["fold"]).alias("fold"), "prediction", target_col)
            out = materialize(out)  # materialise the fold's predictions once
            return row["fold"], out, train.count(), None
        except Exception as exc:  # noqa: BLE001 - a failing fold is reported, not fatal
            log.error("fold %s failed: %s", row["fold"], exc)
            return row["fold"], None, None, str(exc)

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        results = list(pool.map(run, specs))
    ok = [r for r in results if r[1] is not None]
    errors = spark.createDataFrame([(r[0], r[3]) for r in results if r[3] is not None], "fold int, error string")
    if not ok:
        empty = spark.createDataFrame([], "fold int, train_end string, test_start string, test_end string, "
                                          "n_train bigint, n_test bigint, MAE double, RMSE double, R2 double, "
                                          "MAPE_pct double, signed_error double")
        return empty, errors
    preds = union_by_name([r[1] for r in ok])
    n_train = spark.createDataFrame([(r[0], r[2]) for r in ok], "fold int, n_train bigint")
    metrics = preds.groupBy("fold").agg(
        *metric_columns("prediction", target_col),
        F.round(F.avg(F.col("prediction") - F.col(target_col)), 2).alias("signed_error"),
        F.count(F.lit(1)).alias("n_test"),
    )
    res = folds.join(metrics, "fold").join(n_train, "fold").select(
        "fold", F.date_format("train_end", "yyyy-MM").alias("train_end"),
        F.date_format("test_start", "yyyy-MM").alias("test_start"),
        F.date_format("test_end", "yyyy-MM").alias("test_end"),
        "n_train", "n_test", "MAE", "RMSE", "R2", "MAPE_pct", "signed_error",
    ).orderBy("fold")
    return res, errors
