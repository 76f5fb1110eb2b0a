"""Report tables, the nested analytics document and run history.

Reports are parquet tables with one folder ``date=<run_date>`` per run, each
overwritten as a whole, so re-running a date replaces that date (also by nothing)
and no other. Reading the table base path yields every run with a ``date`` column
(partition discovery), which is what the trend and freshness views use.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """A5: overwrite a table."""
    df.write.mode("overwrite").format(fmt).save(path)


def write_report(df: DataFrame, base: str, name: str, run_date: str) -> str:
    """Write a report under ``base/name/date=<run_date>`` (only that date is replaced)."""
    path = f"{base.rstrip('/')}/{name}"
    df.write.mode("overwrite").parquet(f"{path}/date={run_date}")
    return path


def write_report_dates(df: DataFrame, base: str, name: str, date_col: str = "date") -> str:
    """A6 for many run dates at once: each date of ``date_col`` (``yyyy-MM-dd`` text) in ``df`` is replaced, no other."""
    path = f"{base.rstrip('/')}/{name}"
    out = df.withColumnRenamed(date_col, "date").repartition("date")  # one file a date
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date").parquet(path)
    return path


def read_report_history(spark: SparkSession, base: str, name: str) -> DataFrame:
    """All run dates of a report as one table with a ``date`` column."""
    path = f"{base.rstrip('/')}/{name}"
    return spark.read.option("basePath", path).parquet(path).withColumn("date", F.col("date").cast("string"))


def _one_row_join(frames: list[DataFrame]) -> DataFrame:
    """Combine one-row frames side by side with an equi-join on a constant key."""
    keyed = [f.withColumn("_k", F.lit(1)) for f in frames]
    return reduce(lambda a, b: a.join(b, "_k"), keyed).drop("_k")


def _section(df: DataFrame | None, name: str, order_col: str | None, fields: list[str] | None = None) -> DataFrame:
    """One section of the document: an array of structs ordered by ``order_col``."""
    cols = fields or (df.columns if df is not None else [])
    st = F.struct(*[F.col(c) for c in cols])
    if order_col:
        arr = F.transform(F.array_sort(F.collect_list(F.struct(F.col(order_col).alias("_o"), st.alias("_v")))),
                          lambda x: x["_v"])
    else:
        arr = F.collect_list(st)
    return df.agg(arr.alias(name))


def analytics_document(spark: SparkSession, run_date: str, n_train: int, n_test: int, metrics: DataFrame,
                       folds: DataFrame, seg: DataFrame, bands: DataFrame, importance: DataFrame) -> DataFrame:
    """One nested document; floats rounded (4 dp; fold MAE/RMSE/signed error 2 dp).

    ``metrics`` is (model, MAE, RMSE, R2, MAPE_pct, ...) and becomes a map of maps;
    empty sections are empty arrays, never null.
    """
    r4 = lambda c: F.round(F.col(c), 4).alias(c)
    metric_cols = [c for c in ("MAE", "RMSE", "R2", "MAPE_pct") if c in metrics.columns]
    m = metrics.select("model", F.create_map(*sum([[F.lit(c), F.round(F.col(c).cast("double"), 4)] for c in metric_cols], []))
                       .alias("m")).agg(F.map_from_entries(F.collect_list(F.struct("model", "m"))).alias("metrics"))
    f = folds.select(
        "fold", "test_start", "test_end", "n_train", "n_test",
        F.round(F.coalesce(F.col("MAPE_pct"), F.lit(0.0)), 4).alias("MAPE_pct"),
        F.round(F.coalesce(F.col("MAE"), F.lit(0.0)), 2).alias("MAE"),
        F.round(F.coalesce(F.col("RMSE"), F.lit(0.0)), 2).alias("RMSE"),
        F.round(F.coalesce(F.col("signed_error"), F.lit(0.0)), 2).alias("signed_error"),
    )
    seg_cols = ["segment", "n", "mean_signed_error", "mae", "mape_pct"]

    def seg_of(col: str) -> DataFrame:
        s = seg.filter(F.col("segment_col") == col).select(
            F.col("segment").alias(col), "n", r4("mean_signed_error"), r4("mae"), r4("mape_pct"),
            (-F.col("mean_signed_error")).alias("_rank"))
        return s

    ft, tw = seg_of("flat_type"), seg_of("town")
    b = bands.select("price_band", r4("price_min"), r4("price_max"), "n", r4("mean_signed_error"), r4("mae"))
    imp = importance.select(
        "Feature", *[r4(c) for c in importance.columns if c != "Feature"],
        (-F.col("mean_importance")).alias("_rank") if "mean_importance" in importance.columns else F.lit(0).alias("_rank"))
    head = spark.range(1).select(F.lit(run_date).alias("run_date"), F.lit(n_train).cast("long").alias("n_train"),
                                 F.lit(n_test).cast("long").alias("n_test"))
    doc = _one_row_join([
        head, m,
        _section(f, "backtest_folds", "fold", f.columns),
        _section(ft, "bias_by_flat_type", "_rank", ["flat_type"] + seg_cols[1:]),
        _section(tw, "bias_by_town", "_rank", ["town"] + seg_cols[1:]),
        _section(b, "bias_by_price_band", "price_band", b.columns),
        _section(imp.orderBy("_rank").limit(20), "feature_importance_top20", "_rank",
                 [c for c in imp.columns if c != "_rank"]),
    ])
    return doc


# Sections of the document: the column that names an item, and the numbers of an item.
SECTIONS = {
    "backtest_folds": ("fold", ["n_train", "n_test", "MAPE_pct", "MAE", "RMSE", "signed_error"]),
    "bias_by_town": ("town", ["n", "mean_signed_error", "mae", "mape_pct"]),
    "bias_by_flat_type": ("flat_type", ["n", "mean_signed_error", "mae", "mape_pct"]),
    "bias_by_price_band": ("price_band", ["price_min", "price_max", "n", "mean_signed_error", "mae"]),
    "feature_importance_top20": ("Feature", ["mean_importance"]),
}


def document_rows(doc: DataFrame) -> DataFrame:
    """The nested document in long form: (section, item, metric, value)."""
    def numbers(of: str, names: list[str]):
        return F.explode(F.create_map(*sum([[F.lit(n), F.col(f"{of}{n}").cast("double")] for n in names], [])))

    parts = [doc.select(F.explode(name).alias("r")).select(
        F.lit(name).alias("section"), F.col(f"r.{key}").cast("string").alias("item"),
        numbers("r.", names).alias("metric", "value")) for name, (key, names) in SECTIONS.items()]
    parts.append(doc.select(F.explode("metrics").alias("model", "m")).select(
        F.lit("metrics").alias("section"), F.col("model").alias("item"), F.explode("m").alias("metric", "value")))
    parts.append(doc.select(F.lit("summary").alias("section"), F.lit("run").alias("item"),
                            numbers("", ["n_train", "n_test"]).alias("metric", "value")))
    return reduce(DataFrame.unionByName, parts)


def write_document(doc: DataFrame, path: str) -> None:
    """The document as JSON text (one line)."""
    doc.select(F.to_json(F.struct(*doc.columns)).alias("value")).coalesce(1).write.mode("overwrite").text(path)


def metrics_rows(spark: SparkSession, all_metrics: dict[str, dict[str, float]]) -> DataFrame:
    """(model, metric, value) from the per-model metric dictionaries."""
    rows = [(model, k, float(v)) for model, d in all_metrics.items() for k, v in d.items()]
    return spark.createDataFrame(rows, "model string, metric string, value double")
