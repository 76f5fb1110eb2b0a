"""Distribution drift between a reference sample and a new sample.

Both samples are unpivoted once into (feature, value, is_test) rows, so any
number of numeric columns is handled by the same two aggregates. Samples that are parts of
one frame are told apart by a flag (``unpivot_split``), so the frame is computed once:

* KS: counts per distinct (feature, value), exact running sums by
  ``running_totals`` (no single-partition window), statistic = max gap of
  the two empirical CDFs.
* PSI: combined min/max per feature, ten equal-width bins (last bin closed),
  zero-count bins get 1e-4, PSI = sum((a - e) * ln(a / e)).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from appraise.operators.ranking import count_le, running_totals
from appraise.session import materialize

PSI_EPS = 1e-4


def numeric_columns(df: DataFrame, exclude: list[str] | None = None) -> list[str]:
    """Numeric columns (booleans excluded) minus ``exclude``."""
    ex = set(exclude or [])
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in ex]


def _long(df: DataFrame, cols: list[str], is_test: Column) -> DataFrame:
    pairs = [F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in cols]
    rows = df.select(is_test.alias("is_test"), F.explode(F.array(*pairs)).alias("_kv")).select("_kv.*", "is_test")
    return rows.filter(F.col("value").isNotNull() & ~F.isnan("value"))


def unpivot_split(df: DataFrame, is_test: Column, cols: list[str]) -> DataFrame:
    """(feature, value, is_test) from one frame; nulls dropped, and rows whose flag is null."""
    return _long(df.filter(is_test.isNotNull()), cols, is_test)


def unpivot_samples(train: DataFrame, test: DataFrame, cols: list[str]) -> DataFrame:
    """(feature, value, is_test) for the columns present in both samples; nulls dropped."""
    cols = [c for c in cols if c in train.columns and c in test.columns]
    if not cols:
        raise ValueError("no common columns to compare")

    return _long(train, cols, F.lit(False)).unionByName(_long(test, cols, F.lit(True)))


def kolmogorov_sf(lam: Column) -> Column:
    """Asymptotic survival function of the Kolmogorov distribution, Q(lambda).

    Two series, each converging quickly in its own range: for lambda >= 1.18
    Q = 2 sum (-1)^(k-1) exp(-2 k^2 lambda^2); below it the Jacobi form
    Q = 1 - sqrt(2 pi)/lambda * sum exp(-(2k-1)^2 pi^2 / (8 lambda^2)).
    """
    big = sum((F.lit(2.0 * (-1) ** (k - 1)) * F.exp(F.lit(-2.0 * k * k) * lam * lam) for k in range(1, 11)),
              F.lit(0.0))
    small_terms = sum((F.exp(F.lit(-((2 * k - 1) ** 2) * math.pi ** 2 / 8.0) / (lam * lam)) for k in range(1, 11)),
                      F.lit(0.0))
    small = F.lit(1.0) - F.lit(math.sqrt(2 * math.pi)) / lam * small_terms
    q = F.when(lam <= 0, F.lit(1.0)).when(lam < 1.18, small).otherwise(big)
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), q))


def value_counts(long: DataFrame) -> DataFrame:
    """(feature, value, n_train, n_test): the only pass over the unpivoted rows.

    Both KS and PSI are computed from this table, which is checkpointed to the
    shared folder: it is read several times (edges, offsets, bins) and is at
    most as large as the input, usually far smaller (distinct values only).
    """
    vc = long.groupBy("feature", "value").agg(
        F.count_if(~F.col("is_test")).alias("n_train"),
        F.count_if(F.col("is_test")).alias("n_test"),
    )
    return materialize(vc)


def ks_from_counts(vc: DataFrame) -> DataFrame:
    """(feature, ks_stat, ks_p, n_train, n_test) from per-value counts.

    p-value: asymptotic with the Stephens correction
    lambda = (sqrt(en) + 0.12 + 0.11 / sqrt(en)) * D, en = n1 n2 / (n1 + n2).
    """
    totals = vc.groupBy("feature").agg(F.sum("n_train").alias("N1"), F.sum("n_test").alias("N2"))
    cum = running_totals(vc, ["feature"], "value", ["n_train", "n_test"])
    # one row per feature: bounded by the number of columns
    gaps = cum.join(F.broadcast(totals), "feature").select(
        "feature", "N1", "N2",
        F.abs(F.try_divide(F.col("cum_n_train"), F.col("N1")) - F.try_divide(F.col("cum_n_test"), F.col("N2"))).alias("gap"),
    )
    d = gaps.groupBy("feature").agg(F.max("gap").alias("D"), F.first("N1").alias("n_train"),
                                   F.first("N2").alias("n_test"))
    en = F.col("n_train") * F.col("n_test") / (F.col("n_train") + F.col("n_test"))
    lam = (F.sqrt(en) + F.lit(0.12) + F.lit(0.11) / F.sqrt(en)) * F.col("D")
    return d.select(
        "feature",
        F.round("D", 4).alias("ks_stat"),
        F.when((F.col("n_train") > 0) & (F.col("n_test") > 0), F.round(kolmogorov_sf(lam), 4)).alias("ks_p"),
        "n_train", "n_test",
    )


def psi_from_counts(vc: DataFrame, bins: int = 10, eps: float = PSI_EPS) -> DataFrame:
    """Population stability index per feature (test vs train) from counts of values, each once or in several rows."""
    stats = vc.groupBy("feature").agg(
        F.min("value").alias("mn"), F.max("value").alias("mx"),
        F.sum("n_train").alias("N1"), F.sum("n_test").alias("N2"),
    )
    step = (F.col("mx") - F.col("mn")) / F.lit(float(bins))
    inner = F.array(*[F.lit(float(i)) * step + F.col("mn") for i in range(1, bins)])
    edges = stats.select("feature", inner.alias("_edges"), "N1", "N2")
    # one row per feature: bounded by the number of columns
    binned = vc.join(F.broadcast(edges), "feature").withColumn("bin", count_le("_edges", "value", bins - 1))
    counts = binned.groupBy("feature", "bin").agg(F.sum("n_train").alias("c_train"), F.sum("n_test").alias("c_test"))
    grid = edges.select("feature", "N1", "N2", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    full = grid.join(counts, ["feature", "bin"], "left").fillna(0, ["c_train", "c_test"])
    e = F.when(F.col("c_train") == 0, F.lit(eps)).otherwise(F.col("c_train") / F.col("N1"))
    a = F.when(F.col("c_test") == 0, F.lit(eps)).otherwise(F.col("c_test") / F.col("N2"))
    return full.withColumn("_e", e).withColumn("_a", a).groupBy("feature").agg(
        F.round(F.sum((F.col("_a") - F.col("_e")) * F.log(F.col("_a") / F.col("_e"))), 4).alias("psi")
    )


def ks_by_feature(long: DataFrame) -> DataFrame:
    """D8 from the unpivoted samples."""
    return ks_from_counts(value_counts(long))


def psi_by_feature(long: DataFrame, bins: int = 10, eps: float = PSI_EPS) -> DataFrame:
    """D9 from the unpivoted samples: written once, then read for the bounds and for the bins; values aren't shuffled."""
    test = F.col("is_test").cast("long")
    rows = materialize(long).select("feature", "value", (1 - test).alias("n_train"), test.alias("n_test"))
    return psi_from_counts(rows, bins, eps)


def drift_report(train: DataFrame, test: DataFrame, cols: list[str] | None = None,
                 psi_threshold: float = 0.2) -> DataFrame:
    """(feature, ks_stat, ks_p, psi, flagged); flagged when psi > threshold (strict)."""
    return drift_of_long(unpivot_samples(train, test, cols or numeric_columns(train)), psi_threshold)


def drift_of_long(long: DataFrame, psi_threshold: float = 0.2) -> DataFrame:
    """D10 from the unpivoted samples."""
    vc = value_counts(long)
    ks = ks_from_counts(vc)
    psi = psi_from_counts(vc)
    return ks.join(psi, "feature").select(
        "feature", "ks_stat", "ks_p", "psi", (F.col("psi") > F.lit(psi_threshold)).alias("flagged")
    )
