"""

Every query reads the driver's tables (through the derived views) and returns
a DataFrame; the oracle is DuckDB SQL over the same parquet tables. Doubles
are rounded to 4 decimals in both, months are ``yyyy-MM`` text, counts are
BIGINT, and every computed column carries the same alias on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from appraise.functions import parse as P
from appraise.operators import errors as E
from appraise.operators import joins as J
from appraise.plans.oracle_views import CUTOFF, with_views
from appraise.sources import tables as T

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def r4(c: str | Column) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 4)


def split_tx(spark: SparkSession, sf: str) -> DataFrame:
    return J.split_by_cutoff(T.transactions(spark, sf), CUTOFF + "-01")


def train_test(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """The two sides of the month split, each filtered at the orders scan (pushed down)."""
    cut = CUTOFF + "-01"
    train = T.transactions(spark, sf, until=cut).withColumn("split", F.lit("train"))
    test = T.transactions(spark, sf, since=cut).withColumn("split", F.lit("test"))
    return train, test


def naive_predictions(spark: SparkSession, sf: str, key: str = "town") -> DataFrame:
    """Test rows with the group-mean prediction fitted on the train rows."""
    train, test = train_test(spark, sf)
    return E.group_mean_model(train, test, key)


# ---------------------------------------------------------------- H: scalar functions


@register("storey_mid", with_views("""
SELECT tx_id, storey_range,
       (TRY_CAST(split_part(storey_range, ' TO ', 1) AS INTEGER)
        + TRY_CAST(split_part(storey_range, ' TO ', 2) AS INTEGER)) / 2.0 AS storey_mid
FROM tx""", "tx"))
def q_storey_mid(spark, sf):
    return T.transactions(spark, sf).select("tx_id", "storey_range", P.storey_mid("storey_range").alias("storey_mid"))


@register("lease_months", with_views("""
SELECT tx_id, remaining_lease,
       CAST(split_part(trim(remaining_lease), ' ', 1) AS INTEGER) * 12
       + CASE WHEN remaining_lease LIKE '%months%'
              THEN CAST(split_part(trim(remaining_lease), ' ', 3) AS INTEGER) ELSE 0 END AS lease_months
FROM tx""", "tx"))
def q_lease_months(spark, sf):
    return T.transactions(spark, sf).select(
        "tx_id", "remaining_lease", P.lease_months("remaining_lease").alias("lease_months")
    )


@register("yn_flags", with_views("""
SELECT blk_no, street,
       CASE WHEN residential = 'Y' THEN TRUE WHEN residential = 'N' THEN FALSE END AS residential,
       CASE WHEN commercial = 'Y' THEN TRUE WHEN commercial = 'N' THEN FALSE END AS commercial,
       CASE WHEN market_hawker = 'Y' THEN TRUE WHEN market_hawker = 'N' THEN FALSE END AS market_hawker,
       CASE WHEN miscellaneous = 'Y' THEN TRUE WHEN miscellaneous = 'N' THEN FALSE END AS miscellaneous,
       CASE WHEN multistorey_carpark = 'Y' THEN TRUE WHEN multistorey_carpark = 'N' THEN FALSE END AS multistorey_carpark,
       CASE WHEN precinct_pavilion = 'Y' THEN TRUE WHEN precinct_pavilion = 'N' THEN FALSE END AS precinct_pavilion
FROM property""", "property"))
def q_yn_flags(spark, sf):
    p = P.map_yn_columns(T.property_attributes(spark, sf))
    return p.select("blk_no", "street", *P.YN_COLUMNS)


@register("date_parts", with_views("""
SELECT tx_id, strftime(month, '%Y-%m') AS transaction_month,
       CAST(year(month) AS INTEGER) AS year, CAST(month(month) AS INTEGER) AS month_numeric
FROM tx""", "tx"))
def q_date_parts(spark, sf):
    d = P.expand_transaction_date(T.transactions(spark, sf).select("tx_id", "month"))
    return d.select("tx_id", P.month_key("transaction_month").alias("transaction_month"), "year", "month_numeric")


# ---------------------------------------------------------------- B: projections and filters


@register("month_range", with_views("""
SELECT strftime(month, '%Y-%m') AS month, count(*) AS n
FROM tx WHERE month BETWEEN DATE '1996-01-01' AND DATE '1999-12-01' GROUP BY 1""", "tx"))
def q_month_range(spark, sf):
    d = J.between_months(T.transactions(spark, sf), "1996-01", "1999-12")
    return d.groupBy(P.month_key("month").alias("month")).agg(F.count(F.lit(1)).alias("n"))


@register("time_split_counts", with_views("""
SELECT split, count(*) AS n FROM split_tx GROUP BY split""", "split"))
def q_time_split_counts(spark, sf):
    return split_tx(spark, sf).groupBy("split").agg(F.count(F.lit(1)).alias("n"))


@register("distinct_keys", with_views("""
SELECT DISTINCT block, street_name FROM tx""", "tx"))
def q_distinct_keys(spark, sf):
    return T.transactions(spark, sf).select("block", "street_name").distinct()


# ---------------------------------------------------------------- C: joins


@register("property_join", with_views("""
SELECT t.tx_id, t.block, p.max_floor_lvl, p.year_completed, p.residential, p.precinct_pavilion,
       p.bldg_contract_town
FROM tx t LEFT JOIN property p ON t.block = p.blk_no AND t.street_name = p.street""", "tx", "property"))
def q_property_join(spark, sf):
    j = J.merge_property_info(T.transactions(spark, sf), T.property_attributes(spark, sf))
    return j.select("tx_id", "block", "max_floor_lvl", "year_completed", "residential", "precinct_pavilion",
                    "bldg_contract_town")


@register("property_unmatched", with_views("""
SELECT count(*) FILTER (WHERE p.max_floor_lvl IS NULL) AS n_unmatched
FROM tx t LEFT JOIN property p ON t.block = p.blk_no AND t.street_name = p.street""", "tx", "property"))
def q_property_unmatched(spark, sf):
    j = J.merge_property_info(T.transactions(spark, sf), T.property_attributes(spark, sf))
    return J.unmatched_count(j)


@register("lagged_series_join", with_views("""
SELECT t.tx_id, strftime(t.month, '%Y-%m') AS month, s.sora_3m, s.cpi_all_items, s.cpi_housing, s.hdb_rpi,
       s.gdp_growth_qoq, s.unemployment_rate, s.cooling_measure
FROM tx t LEFT JOIN series s ON t.month = CAST(s.month + INTERVAL 1 MONTH AS DATE)""", "tx", "series"))
def q_lagged_series_join(spark, sf):
    j = J.lagged_join(T.transactions(spark, sf).select("tx_id", "month"), T.monthly_series(spark, sf), 1)
    return j.select("tx_id", P.month_key("month").alias("month"), *T.SERIES_MEASURES)


@register("missing_months", with_views("""
SELECT strftime(m.month, '%Y-%m') AS month FROM (SELECT DISTINCT month FROM tx) m
WHERE NOT EXISTS (SELECT 1 FROM series s WHERE CAST(s.month + INTERVAL 1 MONTH AS DATE) = m.month)""",
                                      "tx", "series"))
def q_missing_months(spark, sf):
    lagged = J.lag_series(T.monthly_series(spark, sf), 1)
    return J.missing_months(T.transactions(spark, sf), lagged).select(P.month_key("month").alias("month"))


@register("unseen_impute", with_views("""
SELECT tx_id,
       CASE WHEN flat_model IN (SELECT flat_model FROM split_tx WHERE split = 'train' AND flat_model IS NOT NULL)
            THEN flat_model ELSE 'Brand#1' END AS flat_model,
       CASE WHEN block IN (SELECT block FROM split_tx WHERE split = 'train' AND block IS NOT NULL)
            THEN block ELSE '0' END AS block
FROM split_tx WHERE split = 'test'""", "split"))
def q_unseen_impute(spark, sf):
    s = split_tx(spark, sf)
    train, test = s.filter("split = 'train'"), s.filter("split = 'test'")
    out = J.impute_unseen(test, train, "flat_model", "Brand#1")
    out = J.impute_unseen(out, train, "block", "0")
    return out.select("tx_id", "flat_model", "block")


# ---------------------------------------------------------------- G: set operations


@register("only_in_test", with_views("""
SELECT * FROM (SELECT 'town' AS column_name, town AS value FROM split_tx WHERE split = 'test'
               EXCEPT SELECT 'town', town FROM split_tx WHERE split = 'train')
UNION ALL
SELECT * FROM (SELECT 'flat_type', flat_type FROM split_tx WHERE split = 'test'
               EXCEPT SELECT 'flat_type', flat_type FROM split_tx WHERE split = 'train')
UNION ALL
SELECT * FROM (SELECT 'flat_model', flat_model FROM split_tx WHERE split = 'test'
               EXCEPT SELECT 'flat_model', flat_model FROM split_tx WHERE split = 'train')
UNION ALL
SELECT * FROM (SELECT 'block', block FROM split_tx WHERE split = 'test'
               EXCEPT SELECT 'block', block FROM split_tx WHERE split = 'train')""", "split"))
def q_only_in_test(spark, sf):
    from appraise.operators.sets import values_only_in

    s = split_tx(spark, sf)
    return values_only_in(s, "split", "test", "train", ["town", "flat_type", "flat_model", "block"])


@register("union_splits", with_views("""
SELECT split, count(*) AS n, count(prediction) AS n_pred FROM (
  SELECT split, NULL::DOUBLE AS prediction FROM split_tx WHERE split = 'train'
  UNION ALL BY NAME
  SELECT split, prediction FROM naive)
GROUP BY split""", "naive"))
def q_union_splits(spark, sf):
    from appraise.operators.sets import union_by_name

    s = split_tx(spark, sf)
    u = union_by_name([s.filter("split = 'train'"), naive_predictions(spark, sf)])
    return u.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.count("prediction").alias("n_pred"))


# ---------------------------------------------------------------- D: error breakdowns


@register("error_by_segment", with_views("""
SELECT segment_col, segment, count(res) AS n, round(avg(res), 4) AS mean_signed_error,
       round(avg(abs(res)), 4) AS mae, round(avg(abs(res) / resale_price) * 100, 4) AS mape_pct
FROM (SELECT 'town' AS segment_col, town AS segment, prediction - resale_price AS res, resale_price FROM naive
      UNION ALL
      SELECT 'flat_type', flat_type, prediction - resale_price, resale_price FROM naive)
WHERE segment IS NOT NULL GROUP BY 1, 2""", "naive"))
def q_error_by_segment(spark, sf):
    seg = E.error_by_segment(naive_predictions(spark, sf), segment_cols=["town", "flat_type"])
    return seg.select("segment_col", "segment", "n", r4("mean_signed_error").alias("mean_signed_error"),
                      r4("mae").alias("mae"), r4("mape_pct").alias("mape_pct"))


@register("error_by_band", with_views("""
WITH e AS (SELECT quantile_cont(resale_price, [0.2, 0.4, 0.6, 0.8]) AS q FROM naive),
b AS (SELECT n.*, CAST((resale_price > e.q[1])::INT + (resale_price > e.q[2])::INT
                       + (resale_price > e.q[3])::INT + (resale_price > e.q[4])::INT AS INTEGER) AS price_band
      FROM naive n, e)
SELECT price_band, round(min(resale_price), 4) AS price_min, round(max(resale_price), 4) AS price_max,
       count(*) AS n, round(avg(prediction - resale_price), 4) AS mean_signed_error,
       round(avg(abs(prediction - resale_price)), 4) AS mae
FROM b GROUP BY price_band""", "naive"))
def q_error_by_band(spark, sf):
    b = E.error_by_price_band(naive_predictions(spark, sf), n_bands=5)
    return b.select("price_band", r4("price_min").alias("price_min"), r4("price_max").alias("price_max"), "n",
                    r4("mean_signed_error").alias("mean_signed_error"), r4("mae").alias("mae"))


_METRICS_SQL = """
SELECT model, round(avg(abs(p - resale_price)), 2) AS MAE,
       round(sqrt(avg((p - resale_price) * (p - resale_price))), 2) AS RMSE,
       round(1 - sum((p - resale_price) * (p - resale_price)) / (var_pop(resale_price) * count(resale_price)), 4) AS R2,
       round(avg(abs(p - resale_price) / greatest(abs(resale_price), 2.220446049250313e-16)) * 100, 2) AS MAPE_pct,
       round(avg(p - resale_price), 2) AS signed_error, count(resale_price) AS n
FROM (SELECT 'town_mean' AS model, prediction AS p, resale_price FROM nt
      UNION ALL SELECT 'flat_type_mean', prediction, resale_price FROM nf
      UNION ALL SELECT 'blend', 0.5 * nt.prediction + 0.5 * nf.prediction, nt.resale_price
                FROM nt JOIN nf ON nt.tx_id = nf.tx_id)
GROUP BY model"""


@register("metrics_by_model", with_views("""
WITH nt AS (SELECT tx_id, resale_price, prediction FROM naive),
ftm AS (SELECT flat_type, avg(resale_price) AS m FROM split_tx WHERE split = 'train' GROUP BY flat_type),
g AS (SELECT avg(resale_price) AS m FROM split_tx WHERE split = 'train'),
nf AS (SELECT t.tx_id, t.resale_price, coalesce(ftm.m, g.m) AS prediction
       FROM split_tx t LEFT JOIN ftm ON t.flat_type = ftm.flat_type, g WHERE t.split = 'test')
""" + _METRICS_SQL, "naive"))
def q_metrics_by_model(spark, sf):
    train, test = train_test(spark, sf)
    test = test.select("town", "flat_type", "resale_price")
    p = E.group_mean_model(train, E.group_mean_model(train, test, "town", out="p_town"), "flat_type", out="p_flat")
    models = {"town_mean": F.col("p_town"), "flat_type_mean": F.col("p_flat"), "blend": P.blend("p_town", "p_flat")}
    one = F.explode(F.array(*[F.struct(F.lit(m).alias("model"), c.alias("p")) for m, c in models.items()]))
    return E.evaluate(p.select(one.alias("_m"), "resale_price").select("_m.*", "resale_price"), "p", "resale_price", ["model"])


@register("top_segments", with_views("""
WITH seg AS (
  SELECT town AS segment, count(*) AS n, avg(prediction - resale_price) AS mse FROM naive GROUP BY town)
SELECT segment, n, round(mse, 4) AS mean_signed_error FROM seg ORDER BY n DESC, segment LIMIT 20""", "naive"))
def q_top_segments(spark, sf):
    seg = E.error_by_segment(naive_predictions(spark, sf), segment_cols=["town"])
    return E.top_segments(seg, 20).select("segment", "n", r4("mean_signed_error").alias("mean_signed_error"))


@register("test_mean_price", with_views("""
SELECT round(avg(resale_price), 4) AS mean_price, count(*) AS n FROM split_tx WHERE split = 'test'""", "split"))
def q_test_mean_price(spark, sf):
    return split_tx(spark, sf).filter("split = 'test'").agg(
        r4(F.avg("resale_price")).alias("mean_price"), F.count(F.lit(1)).alias("n")
    )


_LOADED = False


def _load_all() -> None:
    """Import the query modules (each registers its queries on import)."""
    global _LOADED
    if not _LOADED:
        from appraise.plans import q_backtest, q_models, q_quality, q_sources, q_spatial  # noqa: F401

        _LOADED = True


def queries() -> dict[str, QueryFn]:
    _load_all()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    _load_all()
    return dict(ORACLE)
