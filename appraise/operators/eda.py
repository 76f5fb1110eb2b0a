"""Exploratory statistics (D13-D18) and run-over-run views.

Quantiles here are exact (linear interpolation, as ``describe`` and box
plots use) and computed by exact ranks over ranges of values, per group
when grouped, so a group holding a third of the rows is still split
across tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from appraise.operators.joins import join_measured
from appraise.operators.ranking import count_le, exact_quantiles, running_totals
from appraise.session import materialize


def counted_values(df: DataFrame, group_col: str, value_col: str) -> DataFrame:
    """Rows of each (group, value) as ``_c``, written once; null values are left out."""
    return materialize(df.filter(F.col(value_col).isNotNull()).groupBy(group_col, value_col).agg(
        F.count(F.lit(1)).alias("_c")))


def grouped_exact_quantiles(df: DataFrame, group_col: str, value_col: str, probs: list[float],
                            names: list[str] | None = None) -> DataFrame:
    """Exact per-group quantiles: (group_col, n, q...) with linear interpolation."""
    return quantiles_of_counts(counted_values(df, group_col, value_col), group_col, value_col, probs, names)


def quantiles_of_counts(vc: DataFrame, group_col: str, value_col: str, probs: list[float],
                        names: list[str] | None = None) -> DataFrame:
    """The same from ``counted_values``."""
    names = names or [f"q{int(p * 100)}" for p in probs]
    cum = running_totals(vc, [group_col], value_col, ["_c"])
    n = vc.groupBy(group_col).agg(F.sum("_c").alias("_n"))
    j = cum.join(n, group_col).withColumn("_start", F.col("cum__c") - F.col("_c"))
    aggs = [F.first("_n").alias("n")]
    for p, name in zip(probs, names):
        h = (F.col("_n") - 1) * F.lit(p)
        lo, hi = F.floor(h), F.ceil(h)
        aggs.append(F.max(F.when((F.col("_start") <= lo) & (lo < F.col("cum__c")), F.col(value_col))).alias(f"_lo_{name}"))
        aggs.append(F.max(F.when((F.col("_start") <= hi) & (hi < F.col("cum__c")), F.col(value_col))).alias(f"_hi_{name}"))
        aggs.append(F.first(h - lo).alias(f"_d_{name}"))
    out = j.groupBy(group_col).agg(*aggs)
    return out.select(group_col, "n", *[
        (F.col(f"_lo_{nm}") + (F.col(f"_hi_{nm}") - F.col(f"_lo_{nm}")) * F.col(f"_d_{nm}")).alias(nm) for nm in names
    ])


def describe(df: DataFrame, col: str) -> DataFrame:
    """Count, mean, std (sample), min, 25%, 50%, 75%, max as (stat, value)."""
    row = df.agg(F.count(col).alias("count"), F.avg(col).alias("mean"), F.stddev_samp(col).alias("std"),
                 F.min(col).alias("min"), F.max(col).alias("max")).first()
    q = exact_quantiles(df, col, [0.25, 0.5, 0.75])
    stats = [("count", float(row["count"])), ("mean", row["mean"]), ("std", row["std"]), ("min", row["min"]),
             ("25%", q[0]), ("50%", q[1]), ("75%", q[2]), ("max", row["max"])]
    return df.sparkSession.createDataFrame(stats, "stat string, value double")


def describe_all(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """D13 for all numeric columns (or ``cols``): one row per column with count, mean, std, min, q25, q50, q75, max.

    The columns are counted in long form in one pass over the table; quantiles and moments come from those counts, ranked together.
    Nulls and NaN are left out; a column without a value has count 0 and nulls.
    """
    cols = cols or [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("_v")) for c in cols]))
    long = df.select(pairs.alias("_p")).select("_p.column", F.nanvl("_p._v", F.lit(None).cast("double")).alias("_v"))
    vc = counted_values(long, "column", "_v")
    q = quantiles_of_counts(vc, "column", "_v", [0.25, 0.5, 0.75], ["q25", "q50", "q75"])
    v, c = F.col("_v"), F.col("_c")
    means = vc.groupBy("column").agg(
        F.sum(c).alias("count"), (F.sum(v * c) / F.sum(c)).alias("mean"), F.min(v).alias("min"), F.max(v).alias("max"))
    # one row per column of the table
    spread = vc.join(F.broadcast(means), "column").groupBy("column").agg(
        F.sqrt(F.try_divide(F.sum(c * (v - F.col("mean")) * (v - F.col("mean"))), F.sum(c) - 1)).alias("std"))
    names = df.sparkSession.createDataFrame([(c,) for c in cols], "column string")
    out = names.join(F.broadcast(means), "column", "left").join(F.broadcast(spread), "column", "left").join(
        F.broadcast(q.drop("n")), "column", "left")
    return out.select("column", F.coalesce("count", F.lit(0)).alias("count"), "mean", "std", "min", "q25", "q50", "q75", "max")


def frequency_table(df: DataFrame, col: str) -> DataFrame:
    """Value counts, descending; nulls dropped."""
    return df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n")).orderBy(
        F.col("n").desc(), col)


def histogram(df: DataFrame, col: str, bins: int = 20) -> DataFrame:
    """Equal-width bins over min..max (last bin closed): (bin, bin_lo, bin_hi, n)."""
    st = df.agg(F.min(col).alias("mn"), F.max(col).alias("mx"))
    step = (F.col("mx") - F.col("mn")) / F.lit(float(bins))
    inner = F.array(*[F.lit(float(i)) * step + F.col("mn") for i in range(1, bins)])
    edges = st.select("mn", "mx", inner.alias("_edges"), step.alias("_step"))
    # a one-row frame of edges, joined on a constant key (no cross product)
    d = df.filter(F.col(col).isNotNull()).select(F.col(col).cast("double").alias("_v"), F.lit(1).alias("_k"))
    b = d.join(F.broadcast(edges.withColumn("_k", F.lit(1))), "_k").withColumn("bin", count_le("_edges", "_v", bins - 1))
    counts = b.groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
    grid = edges.select("mn", "_step", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return grid.join(counts, "bin", "left").select(
        "bin", (F.col("bin") * F.col("_step") + F.col("mn")).alias("bin_lo"),
        ((F.col("bin") + 1) * F.col("_step") + F.col("mn")).alias("bin_hi"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def box_stats(df: DataFrame, group_col: str, value_col: str) -> DataFrame:
    """Per group quartiles, whiskers (extreme values within 1.5 IQR) and outlier count."""
    vc = counted_values(df, group_col, value_col)
    q = quantiles_of_counts(vc, group_col, value_col, [0.25, 0.5, 0.75], ["q1", "median", "q3"])
    j = join_measured(vc, q, [group_col], "inner")
    iqr = F.col("q3") - F.col("q1")
    inside = F.col(value_col).between(F.col("q1") - 1.5 * iqr, F.col("q3") + 1.5 * iqr)
    return j.groupBy(group_col).agg(
        F.first("n").alias("n"), F.first("q1").alias("q1"), F.first("median").alias("median"),
        F.first("q3").alias("q3"),
        F.min(F.when(inside, F.col(value_col))).alias("whisker_lo"),
        F.max(F.when(inside, F.col(value_col))).alias("whisker_hi"),
        F.sum(F.when(inside, F.lit(0)).otherwise(F.col("_c"))).alias("n_outliers"),
    )


def mean_by(df: DataFrame, key: str, value_col: str) -> DataFrame:
    """Mean of the value per key."""
    return df.groupBy(key).agg(F.avg(value_col).alias("mean_value"), F.count(value_col).alias("n"))


def distinct_counts(df: DataFrame, cols: list[str], approx: bool = False) -> DataFrame:
    """Distinct count per column as (column, n_distinct)."""
    fn = F.approx_count_distinct if approx else F.count_distinct
    row = df.agg(*[fn(F.col(c)).alias(f"_d{i}") for i, c in enumerate(cols)])
    return row.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"_d{i}").cast("long").alias("n_distinct")) for i, c in enumerate(cols)
    ])).alias("_s")).select("_s.*")


def metric_trend(metrics: DataFrame, key: str = "model", date_col: str = "date", value_col: str = "MAE") -> DataFrame:
    """E5: previous value and change per key over run dates."""
    w = Window.partitionBy(key).orderBy(date_col)
    prev = F.lag(value_col).over(w)
    return metrics.select(key, date_col, value_col, prev.alias("previous"), (F.col(value_col) - prev).alias("change"))


def freshness(df: DataFrame, date_col: str, as_of: str, max_age_hours: float = 36.0) -> DataFrame:
    """Newest date, its age in hours at ``as_of`` and whether it is stale."""
    newest = F.max(F.col(date_col).cast("timestamp"))
    age = (F.unix_timestamp(F.to_timestamp(F.lit(as_of))) - F.unix_timestamp(newest)) / 3600.0
    return df.agg(newest.alias("newest"), age.alias("age_hours")).withColumn(
        "stale", F.col("age_hours") > F.lit(max_age_hours))
