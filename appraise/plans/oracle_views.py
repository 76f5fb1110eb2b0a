"""DuckDB SQL for the derived views, used by the oracle statements.

Each entry restates, in plain SQL over the driver's tables, the view that
``appraise.sources.tables`` builds with the DataFrame API.
"""

from __future__ import annotations

VIEW_SQL = {
    "tx": """
tx AS (
  SELECT concat_ws('-', l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey) AS tx_id,
         CAST(date_trunc('month', o.o_orderdate) AS DATE) AS month,
         n.n_name AS town,
         o.o_orderpriority AS flat_type,
         CAST(o.o_custkey AS VARCHAR) AS block,
         'STREET ' || CAST(c.c_nationkey AS VARCHAR) AS street_name,
         lpad(CAST((l.l_linenumber - 1) * 3 + 1 AS VARCHAR), 2, '0') || ' TO ' ||
           lpad(CAST((l.l_linenumber - 1) * 3 + 3 AS VARCHAR), 2, '0') AS storey_range,
         l.l_quantity AS floor_area_sqm,
         p.p_brand AS flat_model,
         CAST(1960 + l.l_partkey % 65 AS INTEGER) AS lease_commence_date,
         CASE WHEN l.l_suppkey % 12 = 0 AND l.l_partkey % 2 = 0
                THEN CAST(45 + l.l_partkey % 50 AS VARCHAR) || ' years'
              WHEN l.l_suppkey % 12 = 1
                THEN CAST(45 + l.l_partkey % 50 AS VARCHAR) || ' years 01 month'
              ELSE CAST(45 + l.l_partkey % 50 AS VARCHAR) || ' years ' ||
                   lpad(CAST(l.l_suppkey % 12 AS VARCHAR), 2, '0') || ' months' END AS remaining_lease,
         l.l_extendedprice AS resale_price
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN part p ON l.l_partkey = p.p_partkey)""",
    "series": """
series AS (
  SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
         round(avg(o_totalprice) / 100000.0, 4) AS sora_3m,
         round(80.0 + 70.0 * avg(CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END), 4) AS cpi_all_items,
         round(80.0 + 70.0 * avg(CASE WHEN o_orderstatus = 'O' THEN 1.0 ELSE 0.0 END), 4) AS cpi_housing,
         round(max(o_totalprice) / 5000.0, 4) AS hdb_rpi,
         round((avg(o_totalprice) - 150000.0) / 10000.0, 4) AS gdp_growth_qoq,
         round(stddev_samp(o_totalprice) / 50000.0, 4) AS unemployment_rate,
         CAST(CASE WHEN avg(CASE WHEN o_orderpriority = '1-URGENT' THEN 1.0 ELSE 0.0 END) > 0.2
                   THEN 1 ELSE 0 END AS INTEGER) AS cooling_measure
  FROM orders GROUP BY 1)""",
    "points": """
points AS (
  SELECT CAST(c_custkey AS VARCHAR) AS block,
         'STREET ' || CAST(c_nationkey AS VARCHAR) AS street_name,
         CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE 1.22 + CAST(c_custkey * 7919 % 100003 AS DOUBLE) / 400012.0 END AS latitude,
         CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE 103.6 + CAST(c_custkey * 104729 % 100019 AS DOUBLE) / 250047.5 END AS longitude,
         lpad(CAST(c_custkey AS VARCHAR), 6, '0') AS postal_code
  FROM customer)""",
    "refs": """
refs AS (
  SELECT s_suppkey AS ref_id, s_name AS ref_name,
         1.22 + CAST(s_suppkey * 53 % 241 AS DOUBLE) / 964.0 AS lat,
         103.6 + CAST(s_suppkey * 29 % 389 AS DOUBLE) / 972.5 AS lng,
         CASE s_nationkey % 3 WHEN 0 THEN 'PRIMARY' WHEN 1 THEN 'SECONDARY' ELSE 'MIXED LEVELS' END AS level,
         CASE WHEN s_suppkey % 5 = 0 THEN 'Yes' ELSE 'No' END AS sap_ind,
         CASE WHEN s_suppkey % 7 = 0 THEN 'Yes' ELSE 'No' END AS autonomous_ind,
         CASE WHEN s_suppkey % 11 = 0 THEN 'Yes' ELSE 'No' END AS gifted_ind,
         CASE WHEN s_suppkey % 13 = 0 THEN 'Yes' ELSE 'No' END AS ip_ind
  FROM supplier)""",
    "property": """
property AS (
  SELECT CAST(c_custkey AS VARCHAR) AS blk_no,
         'STREET ' || CAST(c_nationkey AS VARCHAR) AS street,
         CAST(4 + c_custkey % 37 AS INTEGER) AS max_floor_lvl,
         CAST(1966 + c_custkey % 55 AS INTEGER) AS year_completed,
         CASE WHEN c_custkey % 2 = 0 THEN 'Y' ELSE 'N' END AS residential,
         CASE WHEN c_custkey % 3 = 0 THEN 'Y' ELSE 'N' END AS commercial,
         CASE WHEN c_custkey % 5 = 0 THEN 'Y' ELSE 'N' END AS market_hawker,
         CASE WHEN c_custkey % 6 = 0 THEN 'Y' ELSE 'N' END AS miscellaneous,
         CASE WHEN c_custkey % 4 = 0 THEN 'Y' ELSE 'N' END AS multistorey_carpark,
         CASE WHEN c_custkey % 13 = 0 THEN 'X' WHEN c_custkey % 9 = 0 THEN 'Y' ELSE 'N' END AS precinct_pavilion,
         c_mktsegment AS bldg_contract_town
  FROM customer WHERE c_custkey % 11 <> 0)""",
}

# Train/test cutoff used by the registered queries (orders span 1995-01..2001-08).
CUTOFF = "2001-01"

VIEW_SQL["split"] = f"""
split_tx AS (
  SELECT *, CASE WHEN month < DATE '{CUTOFF}-01' THEN 'train' ELSE 'test' END AS split FROM tx)"""

VIEW_SQL["naive"] = """
naive AS (
  WITH tm AS (SELECT town, avg(resale_price) AS m FROM split_tx WHERE split = 'train' GROUP BY town),
       g AS (SELECT avg(resale_price) AS m FROM split_tx WHERE split = 'train')
  SELECT t.*, coalesce(tm.m, g.m) AS prediction
  FROM split_tx t LEFT JOIN tm ON t.town = tm.town, g
  WHERE t.split = 'test')"""

_DEPS = {"split": ["tx"], "naive": ["tx", "split"]}


def with_views(body: str, *views: str) -> str:
    """Prefix ``body`` with the CTEs it needs (dependencies first, no repeats)."""
    order: list[str] = []

    def add(v: str) -> None:
        for d in _DEPS.get(v, []):
            add(d)
        if v not in order:
            order.append(v)

    for v in views:
        add(v)
    ctes = ",\n".join(VIEW_SQL[v].strip() for v in order)
    body = body.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
