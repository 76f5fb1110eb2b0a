"""Error breakdowns and regression metrics.

Predictions are a column of the frame (never aligned by position). Residual
= prediction - actual, so a positive mean signed error is over-estimation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from appraise.operators.joins import join_measured
from appraise.operators.ranking import exact_quantiles
from appraise.session import materialize

EPS = 2.220446049250313e-16  # float64 machine epsilon (guards the MAPE divisor)


def with_residuals(df: DataFrame, pred_col: str = "prediction", target_col: str = "resale_price") -> DataFrame:
    """Residual, absolute error and absolute percentage error columns."""
    res = F.col(pred_col) - F.col(target_col)
    return df.withColumns(
        {
            "_residual": res,
            "_abs_error": F.abs(res),
            "_ape": F.abs(res) / F.col(target_col),
        }
    )


def signed_error(df: DataFrame, pred_col: str = "prediction", target_col: str = "resale_price") -> Column:
    """Mean signed error as an aggregate expression."""
    return F.avg(F.col(pred_col) - F.col(target_col))


def error_by_segment(
    df: DataFrame,
    pred_col: str = "prediction",
    target_col: str = "resale_price",
    segment_cols: list[str] | None = None,
) -> DataFrame:
    """Per segment value n, mean signed error, MAE and MAPE %.

    All segment columns are handled in one scan: each row is expanded into
    (segment_col, segment) pairs before a single partial+final aggregate, so
    the shuffle carries only one partial row per segment value per task.
    Null segment values are dropped; absent segment columns are skipped.
    Result: long table sorted by mean signed error, descending.
    """
    segs = [c for c in (segment_cols or ["town", "flat_type"]) if c in df.columns]
    if not segs:
        raise ValueError("none of the segment columns is present")
    d = with_residuals(df, pred_col, target_col)
    pairs = F.explode(
        F.array(*[F.struct(F.lit(c).alias("segment_col"), F.col(c).cast("string").alias("segment")) for c in segs])
    )
    long = d.select(pairs.alias("_p"), "_residual", "_abs_error", "_ape").select("_p.*", "_residual", "_abs_error", "_ape")
    return (
        long.filter(F.col("segment").isNotNull())
        .groupBy("segment_col", "segment")
        .agg(
            F.count("_residual").alias("n"),
            F.avg("_residual").alias("mean_signed_error"),
            F.avg("_abs_error").alias("mae"),
            (F.avg("_ape") * 100).alias("mape_pct"),
        )
        .orderBy(F.col("mean_signed_error").desc(), "segment_col", "segment")
    )


def quantile_edges(df: DataFrame, col: str, n_bands: int) -> list[float]:
    """Inner and outer edges of ``n_bands`` equal-frequency bands (exact, linear)."""
    probs = [i / n_bands for i in range(n_bands + 1)]
    edges = exact_quantiles(df, col, probs)
    if any(e is None for e in edges):
        raise ValueError(f"no values in {col}")
    if len(set(edges)) != len(edges):
        raise ValueError(f"band edges are not unique: {edges}")
    return edges


def band_of(col: str | Column, inner_edges: list[float]) -> Column:
    """Band index = number of inner edges strictly below the value (right-closed bands)."""
    c = F.col(col) if isinstance(col, str) else col
    terms = [F.when(c > F.lit(e), F.lit(1)).otherwise(F.lit(0)) for e in inner_edges]
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    return total.cast("int") if terms else F.lit(0)


def error_by_price_band(
    df: DataFrame, pred_col: str = "prediction", target_col: str = "resale_price", n_bands: int = 5
) -> DataFrame:
    """Equal-frequency bands of the target; per band min, max, n, mean signed error, MAE.

    The two needed columns are materialised once: the exact edges take three
    passes and the band aggregate a fourth, none of which should recompute
    the (possibly expensive) prediction plan.
    """
    base = materialize(df.select(target_col, pred_col).filter(F.col(target_col).isNotNull()))
    edges = quantile_edges(base, target_col, n_bands)
    d = with_residuals(base, pred_col, target_col)
    return (
        d.withColumn("price_band", band_of(target_col, edges[1:-1]))
        .groupBy("price_band")
        .agg(
            F.min(target_col).alias("price_min"),
            F.max(target_col).alias("price_max"),
            F.count("_residual").alias("n"),
            F.avg("_residual").alias("mean_signed_error"),
            F.avg("_abs_error").alias("mae"),
        )
        .orderBy("price_band")
    )


def metric_columns(pred_col: str = "prediction", target_col: str = "resale_price") -> list[Column]:
    """D3 as aggregate expressions: MAE, RMSE (2 dp), R2 (4 dp), MAPE % (2 dp)."""
    y, p = F.col(target_col), F.col(pred_col)
    err = p - y
    ss_res = F.sum(err * err)
    ss_tot = F.var_pop(y) * F.count(y)
    r2 = (
        F.when(ss_tot == 0, F.when(ss_res == 0, F.lit(1.0)).otherwise(F.lit(0.0)))
        .otherwise(F.lit(1.0) - ss_res / ss_tot)
    )
    return [
        F.round(F.avg(F.abs(err)), 2).alias("MAE"),
        F.round(F.sqrt(F.avg(err * err)), 2).alias("RMSE"),
        F.round(r2, 4).alias("R2"),
        F.round(F.avg(F.abs(err) / F.greatest(F.abs(y), F.lit(EPS))) * 100, 2).alias("MAPE_pct"),
    ]


def evaluate(df: DataFrame, pred_col: str = "prediction", target_col: str = "resale_price",
             group_cols: list[str] | None = None) -> DataFrame:
    """D3 (+D4 as signed_error, 2 dp) in one aggregate, optionally per group (model, fold)."""
    aggs = metric_columns(pred_col, target_col) + [
        F.round(signed_error(df, pred_col, target_col), 2).alias("signed_error"),
        F.count(F.col(target_col)).alias("n"),
    ]
    return df.groupBy(*(group_cols or [])).agg(*aggs)


def error_report(scored: DataFrame, predictions: dict[str, str], target_col: str = "resale_price",
                 segment_cols: list[str] | None = None, n_bands: int = 5) -> DataFrame:
    """D1-D4 of several models at once: (section, model, item, n, price_min, price_max, metrics ...), written down.

    ``predictions`` maps model names to columns of ``scored``. The columns needed are written once; the band edges are exact
    quantiles of that table and one aggregate over grouping sets gives the section ``all`` (item null), one section per segment
    column and ``price_band``. Rows without a target and null segments are left out.
    """
    segs = [c for c in (segment_cols or ["town", "flat_type"]) if c in scored.columns]
    cols = list(dict.fromkeys([target_col, *segs, *predictions.values()]))
    base = materialize(scored.select(*cols).filter(F.col(target_col).isNotNull()))
    edges = quantile_edges(base, target_col, n_bands)
    models = F.explode(F.array(*[F.struct(F.lit(m).alias("model"), F.col(c).cast("double").alias("_p"))
                                 for m, c in predictions.items()]))
    long = base.select(
        models.alias("_m"), F.col(target_col).alias("_y"), band_of(target_col, edges[1:-1]).alias("price_band"),
        *[F.col(c).cast("string").alias(c) for c in segs])
    long = long.select("_m.*", "_y", "price_band", *segs)
    dims = [*segs, "price_band"]
    residual = F.col("_p") - F.col("_y")
    section = F.lit("all")
    for d in dims:
        section = F.when(F.grouping(d) == 0, F.lit(d)).otherwise(section)
    out = long.groupingSets([["model"], *[["model", d] for d in dims]], "model", *dims).agg(
        section.alias("section"),
        F.count("_p").alias("n"), F.min("_y").alias("price_min"), F.max("_y").alias("price_max"),
        F.avg(residual).alias("mean_signed_error"), F.avg(F.abs(residual)).alias("mean_abs_error"),  # names are compared without case: MAE and MAPE_pct are the rounded ones
        (F.avg(F.abs(residual) / F.col("_y")) * 100).alias("mean_ape_pct"), *metric_columns("_p", "_y"))
    item = F.coalesce(*[F.col(d).cast("string") for d in dims])
    out = out.withColumn("item", item).filter((F.col("section") == "all") | F.col("item").isNotNull())
    return materialize(out.drop(*dims))


def report_sections(report: DataFrame, model: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Metrics of all models, and segments and price bands of ``model``, as the analytics document takes them."""
    own = report.filter(F.col("model") == model)
    metrics = report.filter("section = 'all'").select("model", "MAE", "RMSE", "R2", "MAPE_pct")
    seg = own.filter("section NOT IN ('all', 'price_band')").select(
        F.col("section").alias("segment_col"), F.col("item").alias("segment"), "n", "mean_signed_error",
        F.col("mean_abs_error").alias("mae"), F.col("mean_ape_pct").alias("mape_pct"))
    bands = own.filter("section = 'price_band'").select(
        F.col("item").cast("int").alias("price_band"), "price_min", "price_max", "n", "mean_signed_error",
        F.col("mean_abs_error").alias("mae"))
    return metrics, seg, bands


def top_segments(seg: DataFrame, k: int = 20) -> DataFrame:
    """the k segments with most rows, then re-sorted by mean signed error."""
    return seg.orderBy(F.col("n").desc(), "segment").limit(k).orderBy(F.col("mean_signed_error").desc())


def group_mean_model(train: DataFrame, test: DataFrame, key: str = "town", target_col: str = "resale_price",
                     out: str = "prediction") -> DataFrame:
    """The naive model: train mean of the target per key, else the overall train mean."""
    sums = materialize(train.groupBy(key).agg(F.sum(target_col).alias("_s"), F.count(target_col).alias("_c")))
    overall = sums.agg(F.try_divide(F.sum("_s"), F.sum("_c")).alias("m")).first()
    fallback = float(overall["m"]) if overall and overall["m"] is not None else None
    means = sums.select(key, F.try_divide(F.col("_s"), F.col("_c")).alias("_key_mean"))
    return join_measured(test, means, [key]).withColumn(
        out, F.coalesce(F.col("_key_mean"), F.lit(fallback).cast("double"))
    ).drop("_key_mean")
