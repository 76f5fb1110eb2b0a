"""Registered queries: distances and nearest-point joins."""

from __future__ import annotations


from appraise.functions.geo import VINCENTY_ITERATIONS, WGS84_A, WGS84_B, WGS84_F
from appraise.operators import joins as J
from appraise.operators.nearest import nearest_by_category, nearest_join
from appraise.plans.catalog import register
from appraise.plans.oracle_views import with_views
from appraise.sources import tables as T

LEVEL_COLUMNS = ["closest_pri_sch", "closest_sec_sch", "closest_mixed_sch"]


def vincenty_sql_ctes(src: str, keep: list[str], lat1: str, lng1: str, lat2: str, lng2: str,
                      out: str = "dist_km", prefix: str = "vn") -> tuple[list[str], str]:
    """Vincenty's inverse formula as chained DuckDB CTEs (same steps as the Spark expression)."""
    f = WGS84_F
    base = keep + ["L", "sU1", "cU1", "sU2", "cU2"]
    k = ", ".join(keep)
    ctes = [
        f"{prefix}0 AS (SELECT {k}, L, sin(U1) AS sU1, cos(U1) AS cU1, sin(U2) AS sU2, cos(U2) AS cU2, L AS lam FROM ("
        f"SELECT {k}, radians({lng2} - {lng1}) AS L, atan({1 - f!r} * tan(radians({lat1}))) AS U1, "
        f"atan({1 - f!r} * tan(radians({lat2}))) AS U2 FROM {src}))"
    ]

    def sigma(frm: str) -> str:
        return (
            "SELECT *, CASE WHEN cos2A = 0 THEN 0.0 ELSE cosS - 2.0 * sU1 * sU2 / cos2A END AS c2sm FROM ("
            "SELECT *, 1.0 - sinA * sinA AS cos2A FROM ("
            "SELECT *, atan2(sinS, cosS) AS sig, CASE WHEN sinS = 0 THEN 0.0 ELSE cU1 * cU2 * sl / sinS END AS sinA FROM ("
            "SELECT *, sqrt(pow(cU2 * sin(lam), 2) + pow(cU1 * sU2 - sU1 * cU2 * cos(lam), 2)) AS sinS, "
            f"sU1 * sU2 + cU1 * cU2 * cos(lam) AS cosS, sin(lam) AS sl FROM {frm})))"
        )

    bl = ", ".join(base)
    for i in range(VINCENTY_ITERATIONS):
        ctes.append(
            f"{prefix}{i + 1} AS (SELECT {bl}, L + (1.0 - C) * {f!r} * sinA * (sig + C * sinS * "
            f"(c2sm + C * cosS * (-1.0 + 2.0 * c2sm * c2sm))) AS lam FROM ("
            f"SELECT *, {f / 16!r} * cos2A * (4.0 + {f!r} * (4.0 - 3.0 * cos2A)) AS C FROM ({sigma(prefix + str(i))})))"
        )
    last = f"{prefix}{VINCENTY_ITERATIONS}"
    e2 = (WGS84_A ** 2 - WGS84_B ** 2) / WGS84_B ** 2
    ctes.append(
        f"{prefix}u AS (SELECT *, 1.0 + u2 / 16384 * (4096.0 + u2 * (-768.0 + u2 * (320.0 - 175.0 * u2))) AS A_, "
        f"u2 / 1024 * (256.0 + u2 * (-128.0 + u2 * (74.0 - 47.0 * u2))) AS B_ FROM ("
        f"SELECT *, cos2A * {e2!r} AS u2 FROM ({sigma(last)})))"
    )
    ctes.append(
        f"{prefix}d AS (SELECT {k}, CASE WHEN sinS = 0 THEN 0.0 ELSE {WGS84_B / 1000.0!r} * A_ * (sig - "
        f"B_ * sinS * (c2sm + B_ / 4 * (cosS * (-1.0 + 2.0 * c2sm * c2sm) - B_ / 6 * c2sm * (-3.0 + 4.0 * sinS * sinS) "
        f"* (-3.0 + 4.0 * c2sm * c2sm)))) END AS {out} FROM {prefix}u)"
    )
    return ctes, f"{prefix}d"


HAVERSINE_SQL = ("2 * 6371.0 * asin(sqrt(least(1.0, pow(sin((radians(r.lat) - radians(b.latitude)) / 2), 2) + "
                 "cos(radians(b.latitude)) * cos(radians(r.lat)) * pow(sin(radians(r.lng - b.longitude) / 2), 2))))")


def _points(spark, sf):
    return T.building_points(spark, sf).select("block", "street_name", "latitude", "longitude")


@register("nearest_ref_haversine", with_views(f"""
WITH pr AS (SELECT b.block, b.street_name, r.ref_name, r.ref_id, {HAVERSINE_SQL} AS d
            FROM points b, refs r WHERE b.latitude IS NOT NULL),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY block, street_name ORDER BY d, ref_id) AS rn FROM pr)
         WHERE rn = 1)
SELECT p.block, p.street_name, round(best.d, 4) AS dist_km, best.ref_name
FROM points p LEFT JOIN best ON p.block = best.block AND p.street_name = best.street_name""", "points", "refs"))
def q_nearest_ref_haversine(spark, sf):
    return nearest_join(_points(spark, sf), T.reference_points(spark, sf), ["block", "street_name"],
                        method="haversine")


def _geodesic_pairs_sql(extra_ref_cols: str = "", where: str = "") -> str:
    ctes, last = vincenty_sql_ctes(
        "pr0", ["block", "street_name", "ref_name", "ref_id"] + ([extra_ref_cols] if extra_ref_cols else []),
        "plat", "plng", "rlat", "rlng", "d")
    pr0 = ("pr0 AS (SELECT b.block, b.street_name, r.ref_name, r.ref_id" + (f", r.{extra_ref_cols}" if extra_ref_cols else "")
           + ", b.latitude AS plat, b.longitude AS plng, r.lat AS rlat, r.lng AS rlng "
           f"FROM points b, refs r WHERE b.latitude IS NOT NULL {where})")
    return ",\n".join([pr0] + ctes) + f",\npr AS (SELECT * FROM {last})"


@register("nearest_ref_geodesic", with_views(f"""
WITH {_geodesic_pairs_sql()},
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY block, street_name ORDER BY d, ref_id) AS rn FROM pr)
         WHERE rn = 1)
SELECT p.block, p.street_name, round(best.d, 4) AS dist_km, best.ref_name
FROM points p LEFT JOIN best ON p.block = best.block AND p.street_name = best.street_name""", "points", "refs"))
def q_nearest_ref_geodesic(spark, sf):
    return nearest_join(_points(spark, sf), T.reference_points(spark, sf), ["block", "street_name"],
                        method="geodesic")


_CAT_SQL = f"""
WITH {_geodesic_pairs_sql('level')},
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY block, street_name, level ORDER BY d, ref_id) AS rn
                        FROM pr) WHERE rn = 1),
piv AS (SELECT p.block, p.street_name,
               max(CASE WHEN b.level = 'PRIMARY' THEN b.ref_name END) AS closest_pri_sch,
               max(CASE WHEN b.level = 'SECONDARY' THEN b.ref_name END) AS closest_sec_sch,
               max(CASE WHEN b.level = 'MIXED LEVELS' THEN b.ref_name END) AS closest_mixed_sch
        FROM points p LEFT JOIN best b ON p.block = b.block AND p.street_name = b.street_name
        GROUP BY p.block, p.street_name)"""


@register("nearest_by_category", with_views(_CAT_SQL + "\nSELECT * FROM piv", "points", "refs"))
def q_nearest_by_category(spark, sf):
    return nearest_by_category(_points(spark, sf), T.reference_points(spark, sf), ["block", "street_name"],
                               "level", T.LEVELS, LEVEL_COLUMNS)


_ELITE_SQL = """,
fl AS (SELECT ref_name, (sap_ind = 'Yes' OR autonomous_ind = 'Yes' OR gifted_ind = 'Yes' OR ip_ind = 'Yes') AS flag
       FROM (SELECT *, row_number() OVER (PARTITION BY ref_name ORDER BY ref_id) AS rn FROM refs) WHERE rn = 1)
SELECT v.block, v.street_name,
       coalesce(f1.flag, FALSE) AS is_elite_closest_pri_sch,
       coalesce(f2.flag, FALSE) AS is_elite_closest_sec_sch,
       coalesce(f3.flag, FALSE) AS is_elite_closest_mixed_sch
FROM piv v LEFT JOIN fl f1 ON v.closest_pri_sch = f1.ref_name
LEFT JOIN fl f2 ON v.closest_sec_sch = f2.ref_name
LEFT JOIN fl f3 ON v.closest_mixed_sch = f3.ref_name"""


@register("elite_flags", with_views(_CAT_SQL + _ELITE_SQL, "points", "refs"))
def q_elite_flags(spark, sf):
    refs = T.reference_points(spark, sf)
    near = nearest_by_category(_points(spark, sf), refs, ["block", "street_name"], "level", T.LEVELS, LEVEL_COLUMNS)
    return J.add_elite_flags(near, refs, LEVEL_COLUMNS)


@register("building_join", with_views("""
WITH pr AS (SELECT b.block, b.street_name, r.ref_name, r.ref_id, """ + HAVERSINE_SQL + """ AS d
            FROM points b, refs r WHERE b.latitude IS NOT NULL),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY block, street_name ORDER BY d, ref_id) AS rn FROM pr)
         WHERE rn = 1),
bf AS (SELECT p.block, p.street_name, round(best.d, 4) AS dist_km, best.ref_name
       FROM points p LEFT JOIN best ON p.block = best.block AND p.street_name = best.street_name)
SELECT t.tx_id, bf.dist_km AS shortest_distance_to_closest_ref, bf.ref_name AS closest_ref
FROM tx t LEFT JOIN bf ON t.block = bf.block AND t.street_name = bf.street_name""", "tx", "points", "refs"))
def q_building_join(spark, sf):
    """C1 after C4: features computed once per distinct building, then joined to the sales."""
    tx = T.transactions(spark, sf)
    keys = tx.select("block", "street_name").distinct()  # B1: semi-reduction before the distance work
    pts = keys.join(_points(spark, sf), ["block", "street_name"], "left")
    feats = nearest_join(pts, T.reference_points(spark, sf), ["block", "street_name"], method="haversine")
    feats = feats.withColumnsRenamed({"dist_km": "shortest_distance_to_closest_ref", "ref_name": "closest_ref"})
    return J.join_buildings(tx.select("tx_id", "block", "street_name"), feats).select(
        "tx_id", "shortest_distance_to_closest_ref", "closest_ref")
