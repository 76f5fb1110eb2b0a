"""Registered queries: folds, walk-forward, series windows, run trend and EDA."""

from __future__ import annotations

from pyspark.sql import functions as F

from appraise.functions import parse as P
from appraise.operators import eda as X
from appraise.operators import errors as E
from appraise.operators import folds as FO
from appraise.operators import joins as J
from appraise.plans import report as R
from appraise.plans.catalog import naive_predictions, r4, register
from appraise.plans.oracle_views import CUTOFF, with_views
from appraise.session import materialize
from appraise.sources import tables as T

STEP, MIN_TRAIN = 6, 18

_FOLDS_SQL = f"""
m AS (SELECT month, CAST(row_number() OVER (ORDER BY month) - 1 AS INTEGER) AS idx FROM (SELECT DISTINCT month FROM tx)),
nm AS (SELECT count(*) AS n FROM m),
f AS (SELECT CAST(r.k + 1 AS INTEGER) AS fold, {MIN_TRAIN} + r.k * {STEP} - 1 AS te, {MIN_TRAIN} + r.k * {STEP} AS ts,
             least({MIN_TRAIN} + r.k * {STEP} + {STEP - 1}, nm.n - 1) AS tend
      FROM nm, range(0, 100000) r(k) WHERE {MIN_TRAIN} + r.k * {STEP} <= nm.n - {STEP}),
fd AS (SELECT f.fold, f.te, f.ts, f.tend, strftime(a.month, '%Y-%m') AS train_end, strftime(b.month, '%Y-%m') AS test_start,
              strftime(c.month, '%Y-%m') AS test_end
       FROM f JOIN m a ON a.idx = f.te JOIN m b ON b.idx = f.ts JOIN m c ON c.idx = f.tend)"""


@register("fold_table", with_views(f"WITH {_FOLDS_SQL.strip()}\nSELECT fold, train_end, test_start, test_end FROM fd", "tx"))
def q_fold_table(spark, sf):
    folds, _ = FO.fold_table(T.transactions(spark, sf), "month", STEP, MIN_TRAIN)
    return folds.select("fold", *[F.date_format(c, "yyyy-MM").alias(c) for c in ("train_end", "test_start", "test_end")])


@register("fold_membership_counts", with_views(f"""
WITH {_FOLDS_SQL.strip()},
d AS (SELECT m.idx FROM tx JOIN m USING (month))
SELECT f.fold, 'train' AS role, count(*) AS n FROM d JOIN f ON d.idx <= f.te GROUP BY f.fold
UNION ALL
SELECT f.fold, 'test', count(*) FROM d JOIN f ON d.idx BETWEEN f.ts AND f.tend GROUP BY f.fold""", "tx"))
def q_fold_membership_counts(spark, sf):
    tx = T.transactions(spark, sf)
    folds, months = FO.fold_table(tx, "month", STEP, MIN_TRAIN)
    return FO.fold_membership_counts(tx, folds, months).select("fold", "role", "n")


_METRICS_SQL = """round(avg(abs(p - y)), 2) AS MAE, round(sqrt(avg((p - y) * (p - y))), 2) AS RMSE,
              round(1 - sum((p - y) * (p - y)) / (var_pop(y) * count(y)), 4) AS R2,
              round(avg(abs(p - y) / greatest(abs(y), 2.220446049250313e-16)) * 100, 2) AS MAPE_pct,
              round(avg(p - y), 2) AS signed_error, count(*) AS n_test"""


@register("walk_forward_linear", with_views(f"""
WITH {_FOLDS_SQL.strip()},
d AS (SELECT m.idx, tx.floor_area_sqm AS x, tx.resale_price AS y FROM tx JOIN m USING (month)),
co AS (SELECT f.fold, regr_slope(y, x) AS b, regr_intercept(y, x) AS a, count(*) AS n_train FROM d JOIN f ON d.idx <= f.te GROUP BY f.fold),
pr AS (SELECT f.fold, d.y, co.a + co.b * d.x AS p, co.n_train FROM d JOIN f ON d.idx BETWEEN f.ts AND f.tend JOIN co ON co.fold = f.fold),
mt AS (SELECT fold, {_METRICS_SQL}, max(n_train) AS n_train FROM pr GROUP BY fold)
SELECT fd.fold, fd.train_end, fd.test_start, fd.test_end, mt.n_train, mt.n_test, mt.MAE, mt.RMSE, mt.R2, mt.MAPE_pct,
       mt.signed_error
FROM fd JOIN mt USING (fold)""", "tx"))
def q_walk_forward_linear(spark, sf):
    """E4 with a linear model of the floor area: all folds from one scan of monthly sums."""
    return FO.walk_forward_linear(T.transactions(spark, sf), ["floor_area_sqm"], "resale_price", "month", STEP, MIN_TRAIN)


_NAIVE_FOLDS_SQL = f"""
WITH {_FOLDS_SQL.strip()},
d AS (SELECT m.idx, tx.town, tx.resale_price FROM tx JOIN m USING (month)),
mk AS (SELECT idx, town, sum(resale_price) AS s, count(resale_price) AS c FROM d GROUP BY idx, town),
km AS (SELECT f.fold, mk.town, sum(s) / sum(c) AS km FROM mk JOIN f ON mk.idx <= f.te GROUP BY f.fold, mk.town),
fm AS (SELECT f.fold, sum(s) / sum(c) AS fm, sum(c) AS n_train FROM mk JOIN f ON mk.idx <= f.te GROUP BY f.fold),
te AS (SELECT f.fold, d.town, d.resale_price FROM d JOIN f ON d.idx BETWEEN f.ts AND f.tend),
pr AS (SELECT te.fold, te.resale_price AS y, coalesce(km.km, fm.fm) AS p, fm.n_train
       FROM te LEFT JOIN km ON te.fold = km.fold AND te.town = km.town JOIN fm ON te.fold = fm.fold),
mt AS (SELECT fold, round(avg(abs(p - y)), 2) AS MAE, round(sqrt(avg((p - y) * (p - y))), 2) AS RMSE,
              round(1 - sum((p - y) * (p - y)) / (var_pop(y) * count(y)), 4) AS R2,
              round(avg(abs(p - y) / greatest(abs(y), 2.220446049250313e-16)) * 100, 2) AS MAPE_pct,
              round(avg(p - y), 2) AS signed_error, count(*) AS n_test, max(n_train) AS n_train
       FROM pr GROUP BY fold)
SELECT fd.fold, fd.train_end, fd.test_start, fd.test_end, mt.n_train, mt.n_test, mt.MAE, mt.RMSE, mt.R2, mt.MAPE_pct,
       mt.signed_error
FROM fd JOIN mt USING (fold)"""


@register("walk_forward_naive", with_views(_NAIVE_FOLDS_SQL, "tx"))
def q_walk_forward_naive(spark, sf):
    return FO.walk_forward_group_mean(T.transactions(spark, sf), "town", "resale_price", "month", STEP, MIN_TRAIN)


@register("fold_mape", with_views(f"""
WITH per_fold AS ({_NAIVE_FOLDS_SQL})
SELECT count(*) AS n_folds, round(avg(MAPE_pct), 4) AS mean_MAPE_pct FROM per_fold""", "tx"))
def q_fold_mape(spark, sf):
    """Mean MAPE of the walk-forward folds."""
    f = FO.fold_summary(FO.walk_forward_group_mean(T.transactions(spark, sf), "town", "resale_price", "month", STEP, MIN_TRAIN))
    return f.select("n_folds", r4("mean_MAPE_pct").alias("mean_MAPE_pct"))


# ---------------------------------------------------------------- E: windows over series and records


@register("latest_series_row", with_views("""
SELECT strftime(month, '%Y-%m') AS month, sora_3m, cpi_all_items, cpi_housing, hdb_rpi, gdp_growth_qoq,
       unemployment_rate, cooling_measure
FROM series ORDER BY month DESC LIMIT 1""", "series"))
def q_latest_series_row(spark, sf):
    row = J.latest_row(T.monthly_series(spark, sf), "month")
    return row.select(P.month_key("month").alias("month"), *T.SERIES_MEASURES)


@register("first_per_key", with_views("""
SELECT block, tx_id, strftime(month, '%Y-%m') AS month FROM (
  SELECT *, row_number() OVER (PARTITION BY block ORDER BY month, tx_id) AS rn FROM tx) WHERE rn = 1""", "tx"))
def q_first_per_key(spark, sf):
    first = J.first_per_key(T.transactions(spark, sf), ["block"], ["month", "tx_id"])
    return first.select("block", "tx_id", P.month_key("month").alias("month"))


@register("attach_latest", with_views("""
WITH l AS (SELECT * FROM series ORDER BY month DESC LIMIT 1)
SELECT t.tx_id, l.sora_3m, l.cpi_all_items, l.cooling_measure FROM split_tx t, l WHERE t.split = 'test'""", "split", "series"))
def q_attach_latest(spark, sf):
    from appraise.plans.catalog import split_tx

    t = split_tx(spark, sf).filter("split = 'test'").select("tx_id")
    return J.attach_latest(t, T.monthly_series(spark, sf), ["sora_3m", "cpi_all_items", "cooling_measure"])


@register("metric_trend", with_views("""
WITH mm AS (SELECT 'town_mean' AS model, strftime(month, '%Y-%m') AS date,
                   avg(abs(prediction - resale_price)) AS mae FROM naive GROUP BY month)
SELECT model, date, round(mae, 4) AS MAE, round(lag(mae) OVER (PARTITION BY model ORDER BY date), 4) AS previous,
       round(mae - lag(mae) OVER (PARTITION BY model ORDER BY date), 4) AS change FROM mm""", "naive"))
def q_metric_trend(spark, sf):
    per_month = naive_predictions(spark, sf).groupBy(P.month_key("month").alias("date")).agg(
        F.avg(F.abs(F.col("prediction") - F.col("resale_price"))).alias("MAE")).withColumn("model", F.lit("town_mean"))
    t = X.metric_trend(per_month, "model", "date", "MAE")
    return t.select("model", "date", r4("MAE").alias("MAE"), r4("previous").alias("previous"),
                    r4("change").alias("change"))


AS_OF = "2001-08-02 12:00:00"


@register("freshness", with_views(f"""
SELECT strftime(max(month), '%Y-%m-%d') AS newest,
       round(epoch(TIMESTAMP '{AS_OF}') / 3600.0 - epoch(CAST(max(month) AS TIMESTAMP)) / 3600.0, 4) AS age_hours,
       (epoch(TIMESTAMP '{AS_OF}') - epoch(CAST(max(month) AS TIMESTAMP))) / 3600.0 > 36.0 AS stale FROM tx""", "tx"))
def q_freshness(spark, sf):
    f = X.freshness(T.transactions(spark, sf), "month", AS_OF, 36.0)
    return f.select(F.date_format("newest", "yyyy-MM-dd").alias("newest"), r4("age_hours").alias("age_hours"), "stale")


# ---------------------------------------------------------------- D13-D18: exploration


@register("describe_price", with_views("""
SELECT stat, round(value, 4) AS value FROM (
  SELECT 'count' AS stat, CAST(count(resale_price) AS DOUBLE) AS value FROM tx
  UNION ALL SELECT 'mean', avg(resale_price) FROM tx
  UNION ALL SELECT 'std', stddev_samp(resale_price) FROM tx
  UNION ALL SELECT 'min', min(resale_price) FROM tx
  UNION ALL SELECT '25%', quantile_cont(resale_price, 0.25) FROM tx
  UNION ALL SELECT '50%', quantile_cont(resale_price, 0.5) FROM tx
  UNION ALL SELECT '75%', quantile_cont(resale_price, 0.75) FROM tx
  UNION ALL SELECT 'max', max(resale_price) FROM tx)""", "tx"))
def q_describe_price(spark, sf):
    return X.describe(T.transactions(spark, sf), "resale_price").select("stat", r4("value").alias("value"))


DESCRIBED = ["floor_area_sqm", "lease_commence_date", "resale_price"]


@register("describe_all", with_views("\nUNION ALL ".join(
    f"""SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std,
       round(CAST(min({c}) AS DOUBLE), 4) AS min, round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 4) AS q25,
       round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 4) AS q50, round(quantile_cont(CAST({c} AS DOUBLE), 0.75), 4) AS q75,
       round(CAST(max({c}) AS DOUBLE), 4) AS max FROM tx""" for c in DESCRIBED), "tx"))
def q_describe_all(spark, sf):
    """D13 for every numeric column of the sales."""
    d = X.describe_all(T.transactions(spark, sf))
    return d.select("column", "count", *[r4(c).alias(c) for c in ("mean", "std", "min", "q25", "q50", "q75", "max")])


@register("freq_table", with_views("SELECT town, count(*) AS n FROM tx WHERE town IS NOT NULL GROUP BY town", "tx"))
def q_freq_table(spark, sf):
    return X.frequency_table(T.transactions(spark, sf), "town")


HIST_BINS = 20


@register("hist_price", with_views(f"""
WITH st AS (SELECT min(resale_price) AS mn, max(resale_price) AS mx FROM tx),
ed AS (SELECT r.i, CAST(r.i AS DOUBLE) * ((mx - mn) / {float(HIST_BINS)}) + mn AS e FROM st, range(1, {HIST_BINS}) r(i)),
b AS (SELECT (SELECT count(*) FROM ed WHERE ed.e <= CAST(t.resale_price AS DOUBLE)) AS bin FROM tx t
      WHERE resale_price IS NOT NULL),
c AS (SELECT bin, count(*) AS n FROM b GROUP BY bin)
SELECT g.bin, round(g.bin * ((mx - mn) / {float(HIST_BINS)}) + mn, 4) AS bin_lo,
       round((g.bin + 1) * ((mx - mn) / {float(HIST_BINS)}) + mn, 4) AS bin_hi, coalesce(c.n, 0) AS n
FROM (SELECT CAST(r.i AS INTEGER) AS bin FROM range(0, {HIST_BINS}) r(i)) g CROSS JOIN st LEFT JOIN c USING (bin)""", "tx"))
def q_hist_price(spark, sf):
    h = X.histogram(T.transactions(spark, sf), "resale_price", HIST_BINS)
    return h.select("bin", r4("bin_lo").alias("bin_lo"), r4("bin_hi").alias("bin_hi"), "n")


@register("box_stats", with_views("""
WITH q AS (SELECT flat_type, count(resale_price) AS n, quantile_cont(resale_price, 0.25) AS q1,
                  quantile_cont(resale_price, 0.5) AS median, quantile_cont(resale_price, 0.75) AS q3
           FROM tx WHERE resale_price IS NOT NULL GROUP BY flat_type),
j AS (SELECT t.flat_type, t.resale_price AS v, q.*,
             t.resale_price >= q.q1 - 1.5 * (q.q3 - q.q1) AND t.resale_price <= q.q3 + 1.5 * (q.q3 - q.q1) AS inside
      FROM tx t JOIN q ON t.flat_type = q.flat_type WHERE t.resale_price IS NOT NULL)
SELECT flat_type, max(n) AS n, round(max(q1), 4) AS q1, round(max(median), 4) AS median, round(max(q3), 4) AS q3,
       round(min(CASE WHEN inside THEN v END), 4) AS whisker_lo, round(max(CASE WHEN inside THEN v END), 4) AS whisker_hi,
       count(*) FILTER (WHERE NOT inside) AS n_outliers
FROM j GROUP BY flat_type""", "tx"))
def q_box_stats(spark, sf):
    b = X.box_stats(T.transactions(spark, sf), "flat_type", "resale_price")
    return b.select("flat_type", "n", *[r4(c).alias(c) for c in ("q1", "median", "q3", "whisker_lo", "whisker_hi")],
                    "n_outliers")


@register("mean_by_year", with_views("""
SELECT CAST(year(month) AS INTEGER) AS year, round(avg(resale_price), 4) AS mean_value, count(resale_price) AS n
FROM tx GROUP BY 1""", "tx"))
def q_mean_by_year(spark, sf):
    d = P.expand_transaction_date(T.transactions(spark, sf))
    m = X.mean_by(d, "year", "resale_price")
    return m.select("year", r4("mean_value").alias("mean_value"), "n")


DISTINCT_COLS = ["town", "flat_type", "flat_model", "block", "street_name"]


@register("distinct_counts", with_views("\nUNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS n_distinct FROM tx" for c in DISTINCT_COLS), "tx"))
def q_distinct_counts(spark, sf):
    return X.distinct_counts(T.transactions(spark, sf), DISTINCT_COLS)


@register("signed_error_by_split_month", with_views("""
SELECT strftime(month, '%Y-%m') AS month, round(avg(prediction - resale_price), 4) AS signed_error, count(*) AS n
FROM naive GROUP BY month""", "naive"))
def q_signed_error_by_month(spark, sf):
    """D4 per month of the held-out period."""
    n = naive_predictions(spark, sf)
    return n.groupBy(P.month_key("month").alias("month")).agg(
        r4(E.signed_error(n)).alias("signed_error"), F.count(F.lit(1)).alias("n"))


def _rows_sql(section: str, item: str, names: list[str], source: str) -> str:
    values = ", ".join(f"CAST({n} AS DOUBLE)" for n in names)
    labels = ", ".join(f"'{n}'" for n in names)
    return (f"SELECT '{section}' AS section, CAST({item} AS VARCHAR) AS item, unnest([{labels}]) AS metric, "
            f"unnest([{values}]) AS value FROM {source}")


_SEGMENT_SQL = """count(prediction) AS n, round(avg(prediction - resale_price), 4) AS mean_signed_error,
  round(avg(abs(prediction - resale_price)), 4) AS mae, round(avg(abs(prediction - resale_price) / resale_price) * 100, 4) AS mape_pct"""

_DOCUMENT_SQL = f"""
WITH folds AS ({_NAIVE_FOLDS_SQL}),
ftm AS (SELECT flat_type, avg(resale_price) AS m FROM split_tx WHERE split = 'train' GROUP BY flat_type),
g AS (SELECT avg(resale_price) AS m FROM split_tx WHERE split = 'train'),
three AS (SELECT n.town, n.flat_type, n.resale_price, n.prediction, coalesce(ftm.m, g.m) AS p_flat
          FROM naive n LEFT JOIN ftm ON n.flat_type = ftm.flat_type, g),
e AS (SELECT quantile_cont(resale_price, [0.2, 0.4, 0.6, 0.8]) AS q FROM three),
b AS (SELECT three.*, CAST((resale_price > e.q[1])::INT + (resale_price > e.q[2])::INT
                           + (resale_price > e.q[3])::INT + (resale_price > e.q[4])::INT AS INTEGER) AS price_band
      FROM three, e),
lm AS (SELECT 'town_mean' AS model, prediction AS p, resale_price AS y FROM three
       UNION ALL SELECT 'flat_type_mean', p_flat, resale_price FROM three
       UNION ALL SELECT 'blend', 0.5 * prediction + 0.5 * p_flat, resale_price FROM three),
mt AS (SELECT model, {_METRICS_SQL} FROM lm GROUP BY model),
towns AS (SELECT town, {_SEGMENT_SQL} FROM three WHERE town IS NOT NULL GROUP BY town),
types AS (SELECT flat_type, {_SEGMENT_SQL} FROM three WHERE flat_type IS NOT NULL GROUP BY flat_type),
bands AS (SELECT price_band, round(min(resale_price), 4) AS price_min, round(max(resale_price), 4) AS price_max, {_SEGMENT_SQL}
          FROM b GROUP BY price_band),
sizes AS (SELECT count(*) FILTER (WHERE split = 'train') AS n_train, count(*) FILTER (WHERE split = 'test') AS n_test FROM split_tx),
long_form AS (
  {_rows_sql("backtest_folds", "fold", R.SECTIONS["backtest_folds"][1], "folds")}
  UNION ALL {_rows_sql("bias_by_town", "town", R.SECTIONS["bias_by_town"][1], "towns")}
  UNION ALL {_rows_sql("bias_by_flat_type", "flat_type", R.SECTIONS["bias_by_flat_type"][1], "types")}
  UNION ALL {_rows_sql("bias_by_price_band", "price_band", R.SECTIONS["bias_by_price_band"][1], "bands")}
  UNION ALL {_rows_sql("metrics", "model", ["MAE", "RMSE", "R2", "MAPE_pct"], "mt")}
  UNION ALL {_rows_sql("summary", "'run'", ["n_train", "n_test"], "sizes")})
SELECT section, item, metric, CAST(round(CAST(value AS DECIMAL(28, 4)), 3) AS DOUBLE) AS value FROM long_form"""


@register("analytics_document", with_views(_DOCUMENT_SQL, "naive"))
def q_analytics_document(spark, sf):
    """A7 with the group-mean models (importances: ``model_document``): the nested document, read back in long form.

    The sales are read once, into a narrow table; folds, predictions and the error report read that one. Values have three decimals.
    """
    sales = materialize(T.transactions(spark, sf).select("month", "town", "flat_type", "resale_price"))
    sides = J.split_by_cutoff(sales, CUTOFF + "-01")
    train, test = sides.filter("split = 'train'"), sides.filter("split = 'test'")
    scored = E.group_mean_model(train, E.group_mean_model(train, test, "town", out="p_town"), "flat_type", out="p_flat")
    scored = scored.withColumn("p_blend", P.blend("p_town", "p_flat"))
    report = E.error_report(scored, {"town_mean": "p_town", "flat_type_mean": "p_flat", "blend": "p_blend"})
    metrics, seg, bands = E.report_sections(report, "town_mean")
    folds = FO.walk_forward_group_mean(sales, "town", "resale_price", "month", STEP, MIN_TRAIN)
    n = {r["split"]: r["n"] for r in sides.groupBy("split").agg(F.count(F.lit(1)).alias("n")).collect()}  # two rows
    none = spark.createDataFrame([], "Feature string, mean_importance double")
    doc = R.analytics_document(spark, "2001-09-01", n.get("train", 0), n.get("test", 0), metrics, folds, seg, bands, none)
    return R.document_rows(materialize(doc)).withColumn("value", F.round("value", 3))
