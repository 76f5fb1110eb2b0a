"""Registered queries: data contracts, drift and collinearity."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from appraise.functions import parse as P
from appraise.operators import joins as J
from appraise.plans.catalog import r4, register, split_tx
from appraise.plans.oracle_views import with_views
from appraise.sources import tables as T

# bounds chosen for the driver's value ranges so that some rows fail
TX_BOUNDS = dict(area=(5.0, 45.0), lease_year=(1960, 2024), price=(1000.0, 100000.0))

_Q = "chr(39)"  # a single quote inside DuckDB string building


@register("contract_failures", with_views("""
SELECT 'floor_area_sqm' AS "column", 'in_range(5.0, 45.0)' AS "check",
       CAST(floor_area_sqm AS VARCHAR) AS failure_case, tx_id AS row_key
FROM tx WHERE floor_area_sqm IS NOT NULL AND NOT (floor_area_sqm >= 5.0 AND floor_area_sqm <= 45.0)
UNION ALL
SELECT 'resale_price', 'in_range(1000.0, 100000.0)', CAST(resale_price AS VARCHAR), tx_id
FROM tx WHERE resale_price IS NOT NULL AND NOT (resale_price >= 1000.0 AND resale_price <= 100000.0)""", "tx"))
def q_contract_failures(spark, sf):
    from appraise.operators import quality as Q

    return Q.failure_cases(T.transactions(spark, sf), Q.transaction_contract(**TX_BOUNDS), "tx_id")


@register("contract_summary", with_views(f"""
SELECT * FROM (
  SELECT 'floor_area_sqm' AS "column", 'in_range(5.0, 45.0)' AS "check",
         count(*) FILTER (WHERE NOT (floor_area_sqm >= 5.0 AND floor_area_sqm <= 45.0)) AS n_failed FROM tx
  UNION ALL SELECT 'resale_price', 'in_range(1000.0, 100000.0)',
         count(*) FILTER (WHERE NOT (resale_price >= 1000.0 AND resale_price <= 100000.0)) FROM tx
  UNION ALL SELECT 'lease_commence_date', 'in_range(1960, 2024)',
         count(*) FILTER (WHERE NOT (lease_commence_date >= 1960 AND lease_commence_date <= 2024)) FROM tx
  UNION ALL SELECT c, 'not_nullable', CAST(0 AS BIGINT) FROM (VALUES ('month'), ('town'), ('flat_type'), ('block'),
         ('street_name'), ('storey_range'), ('floor_area_sqm'), ('flat_model'), ('lease_commence_date'),
         ('remaining_lease'), ('resale_price')) v(c)
  UNION ALL SELECT c, 'coerce_dtype(' || {_Q} || t || {_Q} || ')', CAST(0 AS BIGINT) FROM (VALUES ('month', 'date'),
         ('floor_area_sqm', 'double'), ('lease_commence_date', 'int'), ('resale_price', 'double')) v(c, t))""", "tx"))
def q_contract_summary(spark, sf):
    from appraise.operators import quality as Q

    return Q.rule_summary(T.transactions(spark, sf), Q.transaction_contract(**TX_BOUNDS))


_SERIES_RANGES = [("sora_3m", -1, 15), ("cpi_all_items", 80, 150), ("cpi_housing", 80, 150), ("hdb_rpi", 80, 250),
                  ("gdp_growth_qoq", -20, 20), ("unemployment_rate", 0, 10)]


def _series_contract_sql() -> str:
    parts = [f"SELECT '{c}' AS \"column\", 'in_range({lo}, {hi})' AS \"check\", "
             f"count(*) FILTER (WHERE NOT ({c} >= {lo} AND {c} <= {hi})) AS n_failed FROM series"
             for c, lo, hi in _SERIES_RANGES]
    parts.append("SELECT 'cooling_measure', 'isin([0, 1])', count(*) FILTER (WHERE cooling_measure NOT IN (0, 1)) FROM series")
    cols = ["month"] + [c for c, _, _ in _SERIES_RANGES] + ["cooling_measure"]
    vals = ", ".join(f"('{c}')" for c in cols)
    parts.append(f"SELECT c, 'not_nullable', CAST(0 AS BIGINT) FROM (VALUES {vals}) v(c)")
    types = [("month", "date")] + [(c, "double") for c, _, _ in _SERIES_RANGES] + [("cooling_measure", "int")]
    tv = ", ".join(f"('{c}', '{t}')" for c, t in types)
    parts.append(f"SELECT c, 'coerce_dtype(' || {_Q} || t || {_Q} || ')', CAST(0 AS BIGINT) FROM (VALUES {tv}) v(c, t)")
    return with_views("SELECT * FROM (" + "\nUNION ALL ".join(parts) + ")", "series")


@register("series_contract", _series_contract_sql())
def q_series_contract(spark, sf):
    from appraise.operators import quality as Q

    return Q.rule_summary(T.monthly_series(spark, sf), Q.series_contract())


@register("coverage", with_views("""
SELECT avg(CASE WHEN latitude IS NOT NULL THEN 1.0 ELSE 0.0 END) >= 0.99 AS passed,
       round(avg(CASE WHEN latitude IS NOT NULL THEN 1.0 ELSE 0.0 END), 4) AS coverage FROM points""", "points"))
def q_coverage(spark, sf):
    from appraise.operators import quality as Q

    c = Q.coverage(T.building_points(spark, sf), "latitude", 0.99)
    return c.select("passed", r4("coverage").alias("coverage"))


@register("null_counts", with_views("""
WITH j AS (SELECT t.tx_id, p.max_floor_lvl, p.precinct_pavilion, b.latitude, s.sora_3m
           FROM tx t
           LEFT JOIN property p ON t.block = p.blk_no AND t.street_name = p.street
           LEFT JOIN points b ON t.block = b.block AND t.street_name = b.street_name
           LEFT JOIN series s ON t.month = CAST(s.month + INTERVAL 1 MONTH AS DATE))
SELECT 'tx_id' AS "column", count(*) FILTER (WHERE tx_id IS NULL) AS n_null FROM j
UNION ALL SELECT 'max_floor_lvl', count(*) FILTER (WHERE max_floor_lvl IS NULL) FROM j
UNION ALL SELECT 'precinct_pavilion', count(*) FILTER (WHERE precinct_pavilion IS NULL) FROM j
UNION ALL SELECT 'latitude', count(*) FILTER (WHERE latitude IS NULL) FROM j
UNION ALL SELECT 'sora_3m', count(*) FILTER (WHERE sora_3m IS NULL) FROM j""", "tx", "property", "points", "series"))
def q_null_counts(spark, sf):
    from appraise.operators import quality as Q

    t = T.transactions(spark, sf)
    j = J.merge_property_info(t, T.property_attributes(spark, sf))
    j = J.join_buildings(j, T.building_points(spark, sf).drop("postal_code"))
    j = J.lagged_join(j, T.monthly_series(spark, sf), 1)
    return Q.null_counts(j, ["tx_id", "max_floor_lvl", "precinct_pavilion", "latitude", "sora_3m"])


@register("gazetteer_lookup", with_views("""
SELECT b.block, b.street_name, coalesce(a.latitude, pc.latitude) AS latitude,
       coalesce(a.longitude, pc.longitude) AS longitude,
       CASE WHEN a.latitude IS NOT NULL THEN 'address' WHEN pc.latitude IS NOT NULL THEN 'postal' END AS geo_source
FROM points b
LEFT JOIN (SELECT block || ' ' || street_name AS address, latitude, longitude FROM points
           WHERE latitude IS NOT NULL AND CAST(block AS BIGINT) % 5 <> 0) a
  ON b.block || ' ' || b.street_name = a.address
LEFT JOIN (SELECT postal_code, latitude, longitude FROM points WHERE latitude IS NOT NULL) pc
  ON b.postal_code = pc.postal_code""", "points"))
def q_gazetteer_lookup(spark, sf):
    by_address, by_postal = T.gazetteer(spark, sf)
    b = T.building_points(spark, sf).select("block", "street_name", "postal_code")
    return J.gazetteer_lookup(b, by_address, by_postal).select("block", "street_name", "latitude", "longitude",
                                                               "geo_source")


# ---------------------------------------------------------------- feature frame for D5-D10

FEATURE_NUMERICS = ["floor_area_sqm", "storey_mid", "lease_months", "lease_commence_date", "year",
                    "month_numeric", "sora_3m", "cpi_all_items", "gdp_growth_qoq", "unemployment_rate"]

FX_SQL = """
fx AS (
  SELECT t.tx_id, t.split, t.resale_price, t.floor_area_sqm,
         (TRY_CAST(split_part(t.storey_range, ' TO ', 1) AS INTEGER)
          + TRY_CAST(split_part(t.storey_range, ' TO ', 2) AS INTEGER)) / 2.0 AS storey_mid,
         CAST(split_part(trim(t.remaining_lease), ' ', 1) AS INTEGER) * 12
          + CASE WHEN t.remaining_lease LIKE '%months%'
                 THEN CAST(split_part(trim(t.remaining_lease), ' ', 3) AS INTEGER) ELSE 0 END AS lease_months,
         t.lease_commence_date, CAST(year(t.month) AS INTEGER) AS year, CAST(month(t.month) AS INTEGER) AS month_numeric,
         s.sora_3m, s.cpi_all_items, s.gdp_growth_qoq, s.unemployment_rate
  FROM split_tx t LEFT JOIN series s ON t.month = CAST(s.month + INTERVAL 1 MONTH AS DATE))"""


def feature_frame(spark: SparkSession, sf: str) -> DataFrame:
    """Split sale records with parsed numerics and the lagged series (null in the first month, which has none)."""
    t = split_tx(spark, sf)
    t = J.lagged_join(t, T.monthly_series(spark, sf), 1,
                      measures=["sora_3m", "cpi_all_items", "gdp_growth_qoq", "unemployment_rate"])
    t = t.withColumns({"storey_mid": P.storey_mid("storey_range"), "lease_months": P.lease_months("remaining_lease")})
    t = P.expand_transaction_date(t)
    return t.select("tx_id", "split", "resale_price", *FEATURE_NUMERICS)


def _pairs(cols):
    return [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]


def _fx_sql(select: str) -> str:
    return with_views(f"WITH {FX_SQL.strip()}\n{select}", "split", "series")


CORR_THRESHOLD = 0.5


def _corr_sql() -> str:
    parts = [f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, abs(corr({a}, {b})) AS r FROM fx WHERE split = 'train'"
             for a, b in _pairs(FEATURE_NUMERICS)]
    return _fx_sql("SELECT feature_a, feature_b, round(r, 4) AS pearson_r, TRUE AS both_unprotected FROM ("
                   + "\nUNION ALL ".join(parts) + f") WHERE r >= {CORR_THRESHOLD}")


@register("corr_pairs", _corr_sql())
def q_corr_pairs(spark, sf):
    from appraise.operators.collinearity import correlation_screen

    fx = feature_frame(spark, sf).filter("split = 'train'")
    return correlation_screen(fx, FEATURE_NUMERICS, CORR_THRESHOLD, ["resale_price"])


def _gram_sql() -> str:
    parts = [f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, "
             f"round(sum(CAST({a} AS DOUBLE) * {b}) / sqrt(sum(CAST({a} AS DOUBLE) * {a}) * sum(CAST({b} AS DOUBLE) * {b})), 6) AS cosine "
             f"FROM fx WHERE split = 'train'" for a, b in _pairs(FEATURE_NUMERICS)]
    return _fx_sql("SELECT * FROM (" + "\nUNION ALL ".join(parts) + ")")


@register("gram_entries", _gram_sql())
def q_gram_entries(spark, sf):
    """D6 input: the Gramian X'X in one pass, reported as uncentred cosines."""
    from appraise.operators.collinearity import gramian_frame

    fx = feature_frame(spark, sf).filter("split = 'train'")
    g = gramian_frame(fx, FEATURE_NUMERICS)
    diag = g.filter(F.col("feature_a") == F.col("feature_b")).select(F.col("feature_a").alias("f"), F.col("g").alias("d"))
    off = g.filter(F.col("feature_a") != F.col("feature_b"))
    da = diag.withColumnsRenamed({"f": "feature_a", "d": "da"})
    db = diag.withColumnsRenamed({"f": "feature_b", "d": "db"})
    # the diagonal has one row per feature: bounded, broadcast
    return off.join(F.broadcast(da), "feature_a").join(F.broadcast(db), "feature_b").select(
        "feature_a", "feature_b", F.round(F.col("g") / F.sqrt(F.col("da") * F.col("db")), 6).alias("cosine"))


@register("vif_prune")
def q_vif_prune(spark, sf):
    """VIF before and after pruning (p x p algebra on one Gramian)."""
    from appraise.operators.collinearity import collinearity_tables

    fx = feature_frame(spark, sf).filter("split = 'train'")
    t = collinearity_tables(spark, fx, FEATURE_NUMERICS + ["resale_price"], target="resale_price")
    return t["vif"]


# ---------------------------------------------------------------- D8-D10: drift


def kolmogorov_sql(lam: str) -> str:
    big = " + ".join(f"{2.0 * (-1) ** (k - 1)!r} * exp({-2.0 * k * k!r} * {lam} * {lam})" for k in range(1, 11))
    small = " + ".join(f"exp({-((2 * k - 1) ** 2) * math.pi ** 2 / 8.0!r} / ({lam} * {lam}))" for k in range(1, 11))
    q = (f"CASE WHEN {lam} <= 0 THEN 1.0 WHEN {lam} < 1.18 THEN 1.0 - {math.sqrt(2 * math.pi)!r} / {lam} * ({small}) "
         f"ELSE {big} END")
    return f"least(1.0, greatest(0.0, {q}))"


def _drift_long_sql() -> str:
    parts = [f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS value, split = 'test' AS is_test FROM fx"
             for c in FEATURE_NUMERICS]
    return "lng AS (SELECT * FROM (" + "\nUNION ALL ".join(parts) + ") WHERE value IS NOT NULL AND NOT isnan(value))"


_KS_SQL = """
vc AS (SELECT feature, value, count(*) FILTER (WHERE NOT is_test) AS n1, count(*) FILTER (WHERE is_test) AS n2
       FROM lng GROUP BY feature, value),
cum AS (SELECT feature, value,
               sum(n1) OVER (PARTITION BY feature ORDER BY value) AS c1,
               sum(n2) OVER (PARTITION BY feature ORDER BY value) AS c2,
               sum(n1) OVER (PARTITION BY feature) AS t1, sum(n2) OVER (PARTITION BY feature) AS t2 FROM vc),
ks AS (SELECT feature, max(abs(c1 / t1 - c2 / t2)) AS d, max(t1) AS t1, max(t2) AS t2 FROM cum GROUP BY feature),
ksp AS (SELECT feature, d, t1, t2,
               (sqrt(t1 * t2 / (t1 + t2)) + 0.12 + 0.11 / sqrt(t1 * t2 / (t1 + t2))) * d AS lam FROM ks)"""

_PSI_SQL = """
st AS (SELECT feature, min(value) AS mn, max(value) AS mx, count(*) FILTER (WHERE NOT is_test) AS t1,
              count(*) FILTER (WHERE is_test) AS t2 FROM lng GROUP BY feature),
ed AS (SELECT feature, r.i, CAST(r.i AS DOUBLE) * ((mx - mn) / 10.0) + mn AS e FROM st, range(1, 10) r(i)),
bn AS (SELECT l.feature, l.is_test, (SELECT count(*) FROM ed WHERE ed.feature = l.feature AND ed.e <= l.value) AS bin
       FROM lng l),
cnt AS (SELECT feature, bin, count(*) FILTER (WHERE NOT is_test) AS c1, count(*) FILTER (WHERE is_test) AS c2
        FROM bn GROUP BY feature, bin),
grid AS (SELECT feature, t1, t2, b.bin FROM st, range(0, 10) b(bin)),
full_ AS (SELECT g.feature, coalesce(c.c1, 0) AS c1, coalesce(c.c2, 0) AS c2, g.t1, g.t2
          FROM grid g LEFT JOIN cnt c ON g.feature = c.feature AND g.bin = c.bin),
pe AS (SELECT feature, CASE WHEN c1 = 0 THEN 1e-4 ELSE c1 / t1 END AS e, CASE WHEN c2 = 0 THEN 1e-4 ELSE c2 / t2 END AS a
       FROM full_),
psi AS (SELECT feature, round(sum((a - e) * ln(a / e)), 4) AS psi FROM pe GROUP BY feature)"""


def _drift_sql(select: str) -> str:
    body = f"WITH {FX_SQL.strip()},\n{_drift_long_sql()},\n{_KS_SQL.strip()},\n{_PSI_SQL.strip()}\n{select}"
    return with_views(body, "split", "series")


def _long(spark, sf):
    from appraise.operators import drift as D

    fx = feature_frame(spark, sf)
    return D.unpivot_split(fx, F.col("split") == "test", FEATURE_NUMERICS)


@register("ks_by_feature", _drift_sql(f"""
SELECT feature, round(d, 4) AS ks_stat, round({kolmogorov_sql('lam')}, 4) AS ks_p, t1 AS n_train, t2 AS n_test FROM ksp"""))
def q_ks_by_feature(spark, sf):
    from appraise.operators import drift as D

    return D.ks_by_feature(_long(spark, sf))


@register("psi_by_feature", _drift_sql("SELECT feature, psi FROM psi"))
def q_psi_by_feature(spark, sf):
    from appraise.operators import drift as D

    return D.psi_by_feature(_long(spark, sf))


@register("drift_report", _drift_sql(f"""
SELECT k.feature, round(k.d, 4) AS ks_stat, round({kolmogorov_sql('k.lam')}, 4) AS ks_p, p.psi,
       p.psi > 0.2 AS flagged
FROM ksp k JOIN psi p USING (feature)"""))
def q_drift_report(spark, sf):
    from appraise.operators import drift as D

    return D.drift_of_long(_long(spark, sf), 0.2)
