"""Collinearity screening.

* ``correlation_screen``: |Pearson r| of every numeric pair in one aggregate
  (pairwise-complete rows), kept when >= threshold; a report, drops nothing.
* ``gramian``: G = X'X (plus column sums and the row count) in one
  distributed aggregate; only the p x p result reaches the driver.
* ``vif_from_gramian`` / ``prune_by_vif``: VIF_i = G_ii * (G^-1)_ii for the
  regression of column i on the others without intercept (uncentred R^2);
  iterative pruning deletes rows/columns of G, so the data is read once.
"""

from __future__ import annotations

import math
import uuid
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from appraise.operators.drift import numeric_columns
from appraise.operators.gramian import Sweep, tiled_gramian
from appraise.session import scratch_path


def null_free_columns(df: DataFrame, cols: list[str]) -> list[str]:
    """The columns of ``cols`` that hold no null (one aggregate)."""
    row = df.agg(*[F.count_if(F.col(c).isNull() | F.isnan(F.col(c).cast("double"))).alias(f"_n{i}")
                   for i, c in enumerate(cols)]).first()
    return [c for i, c in enumerate(cols) if row[f"_n{i}"] == 0]


def pearson_pairs(df: DataFrame, cols: list[str]) -> list[tuple[str, str, float | None]]:
    """Pearson r of every column pair, pairwise-complete (NaN counts as missing).

    Two aggregate passes of plain sums (codegen-friendly; ``corr`` with
    dozens of pairs in one aggregate is several times slower): means and
    null counts, then centred cross sums. Pairs of null-free columns share
    the per-column sums; pairs touching a column with nulls get masked sums.
    """
    x = df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(f"_x{i}")
                    for i, c in enumerate(cols)])
    r1 = x.agg(*[F.avg(f"_x{i}").alias(f"_m{i}") for i in range(len(cols))],
               *[F.count_if(F.col(f"_x{i}").isNull()).alias(f"_z{i}") for i in range(len(cols))],
               F.count(F.lit(1)).alias("_n")).first()
    means = [r1[f"_m{i}"] if r1[f"_m{i}"] is not None else 0.0 for i in range(len(cols))]
    nullable = {i for i in range(len(cols)) if r1[f"_z{i}"]}
    cx = [F.col(f"_x{i}") - F.lit(float(means[i])) for i in range(len(cols))]
    pairs = [(i, j) for i in range(len(cols)) for j in range(i + 1, len(cols))]
    aggs = []
    for i in range(len(cols)):
        aggs += [F.sum(cx[i]).alias(f"_s{i}"), F.sum(cx[i] * cx[i]).alias(f"_q{i}")]
    for i, j in pairs:
        if i in nullable or j in nullable:
            both = cx[i].isNotNull() & cx[j].isNotNull()
            aggs += [F.count_if(both).alias(f"_n{i}_{j}"),
                     F.sum(F.when(both, cx[i])).alias(f"_si{i}_{j}"), F.sum(F.when(both, cx[j])).alias(f"_sj{i}_{j}"),
                     F.sum(F.when(both, cx[i] * cx[i])).alias(f"_qi{i}_{j}"),
                     F.sum(F.when(both, cx[j] * cx[j])).alias(f"_qj{i}_{j}")]
        aggs.append(F.sum(cx[i] * cx[j]).alias(f"_c{i}_{j}"))
    r2 = x.agg(*aggs).first() if aggs else None
    out = []
    n_all = r1["_n"]
    for i, j in pairs:
        if i in nullable or j in nullable:
            n, si, sj = r2[f"_n{i}_{j}"], r2[f"_si{i}_{j}"] or 0.0, r2[f"_sj{i}_{j}"] or 0.0
            qi, qj = r2[f"_qi{i}_{j}"] or 0.0, r2[f"_qj{i}_{j}"] or 0.0
        else:
            n, si, sj, qi, qj = n_all, r2[f"_s{i}"] or 0.0, r2[f"_s{j}"] or 0.0, r2[f"_q{i}"] or 0.0, r2[f"_q{j}"] or 0.0
        cij = r2[f"_c{i}_{j}"] or 0.0
        if not n or n < 2:
            out.append((cols[i], cols[j], None))
            continue
        cov = cij - si * sj / n
        vi, vj = qi - si * si / n, qj - sj * sj / n
        r = cov / math.sqrt(vi * vj) if vi > 0 and vj > 0 else None
        out.append((cols[i], cols[j], r))
    return out


def correlation_screen(df: DataFrame, cols: list[str] | None = None, threshold: float = 0.85,
                       protected: list[str] | None = None) -> DataFrame:
    """(feature_a, feature_b, pearson_r, both_unprotected), |r| >= threshold, sorted desc.

    A report only: nothing is dropped. The p(p-1)/2 pair results are tiny.
    """
    cols = cols or numeric_columns(df)
    prot = set(protected or [])
    rows = [(a, b, round(abs(r), 4), a not in prot and b not in prot)
            for a, b, r in pearson_pairs(df, cols) if r is not None and abs(r) >= threshold]
    return df.sparkSession.createDataFrame(
        rows, "feature_a string, feature_b string, pearson_r double, both_unprotected boolean"
    ).orderBy(F.col("pearson_r").desc(), "feature_a", "feature_b")


@dataclass
class Gramian:
    columns: list[str]
    g: np.ndarray  # X'X
    sums: np.ndarray  # column sums
    n: int

    def sub(self, cols: list[str]) -> "Gramian":
        idx = [self.columns.index(c) for c in cols]
        return Gramian(cols, self.g[np.ix_(idx, idx)], self.sums[idx], self.n)


def gramian_frame(df: DataFrame, cols: list[str]) -> DataFrame:
    """The upper triangle of X'X as rows (feature_a, feature_b, g), one aggregate."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    x = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
    row = x.agg(*[F.sum(F.col(a) * F.col(b)).alias(f"_g{i}") for i, (a, b) in enumerate(pairs)])
    return row.select(F.explode(F.array(*[
        F.struct(F.lit(a).alias("feature_a"), F.lit(b).alias("feature_b"), F.col(f"_g{i}").alias("g"))
        for i, (a, b) in enumerate(pairs)
    ])).alias("_p")).select("_p.*")


NARROW = 40
"""Columns up to which cross products are plain aggregates; beyond it they are tiles."""


def gramian(df: DataFrame, cols: list[str]) -> Gramian:
    """X'X, column sums and n in one distributed pass; p(p+1)/2 sums reach the driver."""
    if len(cols) > NARROW:
        x = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in cols], F.lit(1.0))
        g = tiled_gramian(df, x, len(cols) + 1).get(0, np.zeros((len(cols) + 1,) * 2))
        return Gramian(list(cols), g[:-1, :-1], g[:-1, -1], int(round(g[-1, -1])))
    pairs = [(i, j) for i in range(len(cols)) for j in range(i, len(cols))]
    x = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
    aggs = [F.sum(F.col(cols[i]) * F.col(cols[j])).alias(f"_g{k}") for k, (i, j) in enumerate(pairs)]
    aggs += [F.sum(F.col(c)).alias(f"_s{i}") for i, c in enumerate(cols)]
    aggs.append(F.count(F.lit(1)).alias("_n"))
    row = x.agg(*aggs).first()
    p = len(cols)
    g = np.zeros((p, p))
    for k, (i, j) in enumerate(pairs):
        v = row[f"_g{k}"] or 0.0
        g[i, j] = g[j, i] = v
    sums = np.array([row[f"_s{i}"] or 0.0 for i in range(p)])
    return Gramian(list(cols), g, sums, int(row["_n"]))


def vif_from_gramian(gm: Gramian, rel_tol: float = 1e-12) -> dict[str, float]:
    """VIF per column from X'X (uncentred R^2, no intercept).

    Columns are scaled to unit norm before inverting (VIF is scale-free).
    When the others contain a constant column the centred R^2 is used, as
    the regression then has an implicit intercept. Columns in the null
    space of a singular G get +inf; fewer than two columns give NaN.
    """
    p = len(gm.columns)
    if p < 2:
        return {c: float("nan") for c in gm.columns}
    out: dict[str, float] = {}
    diag = np.sqrt(np.clip(np.diag(gm.g), 0, None))
    for i, c in enumerate(gm.columns):
        if diag[i] == 0:
            out[c] = float("nan")
            continue
        others = [j for j in range(p) if j != i and diag[j] > 0]
        if not others:
            out[c] = float("nan")
            continue
        # an "other" column is constant when its centred sum of squares is ~0
        const = any(
            abs(gm.g[j, j] - gm.sums[j] ** 2 / gm.n) <= 1e-12 * max(gm.g[j, j], 1.0) for j in others
        ) if gm.n else False
        idx = [i] + others
        s = np.diag(1.0 / diag[idx])
        gs = s @ gm.g[np.ix_(idx, idx)] @ s  # unit-norm columns
        a = gs[1:, 1:]
        b = gs[1:, 0]
        w, v = np.linalg.eigh(a)
        keep = w > rel_tol * max(w.max(), 1e-300)
        coef = v[:, keep] @ ((v[:, keep].T @ b) / w[keep])
        ssr = gs[0, 0] - b @ coef  # residual sum of squares (unit-norm target)
        if const:
            mean_i = gm.sums[i] / gm.n / diag[i]
            tss = gs[0, 0] - gm.n * mean_i ** 2
        else:
            tss = gs[0, 0]
        if ssr <= rel_tol * tss:
            out[c] = float("inf")
        else:
            r2 = 1.0 - ssr / tss
            out[c] = float("inf") if r2 >= 1.0 else 1.0 / (1.0 - r2)
    return out


def vif_frame(spark: SparkSession, vifs: dict[str, float], name: str = "VIF") -> DataFrame:
    rows = [(k, None if (v is None or math.isnan(float(v))) else round(float(v), 4)) for k, v in vifs.items()]
    return spark.createDataFrame(rows, f"Feature string, {name} double").orderBy(F.col(name).desc_nulls_last(), "Feature")


def prune_by_vif(gm: Gramian, threshold: float = 10.0, protected: list[str] | None = None
                 ) -> tuple[list[str], list[str], list[dict[str, float]]]:
    """Drop the highest-VIF unprotected column until every VIF < threshold.

    Works on the Gramian only (no data pass per step): columns are swept out one by one, p² work a drop.
    Ties go to the first column in column order. Returns (kept, dropped in order, VIF per step).
    """
    prot = set(protected or [])
    cols = [c for c in gm.columns if c not in prot]
    sub = gm.sub(cols)
    sweep = Sweep(sub.g)
    left, dropped, history = np.ones(len(cols), bool), [], []
    while left.sum() >= 2:
        v = _swept_vif(sub, sweep, left)
        history.append({c: float(x) for c, x, ok in zip(cols, v, left) if ok})
        worst = np.where(left & ~np.isnan(v), v, -np.inf)
        i = int(np.argmax(worst))
        if worst[i] < threshold:
            break
        sweep.drop(i)
        left[i] = False
        dropped.append(cols[i])
    kept = [c for c in gm.columns if c not in dropped]
    return kept, dropped, history


def _swept_vif(gm: Gramian, sweep: Sweep, left: np.ndarray) -> np.ndarray:
    """VIF of the columns that are left: total over residual sum of squares, about the mean where another column is constant."""
    diag = np.diag(gm.g)
    centred = diag - gm.sums ** 2 / gm.n if gm.n else diag
    constant = left & (diag > 0) & (np.abs(centred) <= 1e-12 * np.maximum(diag, 1.0))
    others = constant.sum() - constant > 0
    total = np.where(others, centred, diag) / sweep.norm ** 2
    rest = sweep.residuals()
    with np.errstate(divide="ignore", invalid="ignore"):
        v = np.where(rest <= 1e-12 * total, np.inf, np.maximum(total / rest, 1.0 if not others.any() else 0.0))
    v[~left | (diag <= 0)] = np.nan
    return v


def collinearity_tables(spark: SparkSession, df: DataFrame, cols: list[str], target: str | None = None,
                        vif_threshold: float = 10.0, corr_threshold: float = 0.85
                        ) -> dict[str, DataFrame | list[str]]:
    """Stage 4 (A13): corr pairs, VIF before/after (full outer join, C10), dropped list.

    The columns are written once: the passes over them don't repeat the joins behind ``df``.
    """
    protected = [target] if target else []
    cols = [c for c in cols if c != target]
    if cols:
        path = scratch_path(spark, f"collinearity-{uuid.uuid4().hex}")
        df.select(*cols).write.parquet(path)
        df = spark.read.schema(df.select(*cols).schema).parquet(path)
    pairs = correlation_screen(df, cols, corr_threshold, protected)
    clean = null_free_columns(df, cols)
    gm = gramian(df, clean)
    kept, dropped, _ = prune_by_vif(gm, vif_threshold, protected)
    before = vif_frame(spark, vif_from_gramian(gm), "VIF_before")
    after = vif_frame(spark, vif_from_gramian(gm.sub(kept)), "VIF_after")
    vif = before.join(after, "Feature", "full").orderBy(F.col("VIF_before").desc_nulls_last(), "Feature")
    dropped_df = spark.createDataFrame([(i + 1, c) for i, c in enumerate(dropped)], "step int, dropped_feature string")
    return {"vif": vif, "dropped": dropped_df, "corr_pairs": pairs, "dropped_list": dropped, "kept": kept}
