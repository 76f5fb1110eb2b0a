"""Registered queries: sources and sinks."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from appraise.functions import parse as P
from appraise.plans.catalog import register
from appraise.plans.oracle_views import with_views
from appraise.session import scratch_path, shuffles_removed, written
from appraise.sources import readers as RD
from appraise.sources import tables as T


@register("csv_roundtrip", with_views("""
SELECT strftime(month, '%Y-%m') AS month, count(*) AS n, round(sum(resale_price), 2) AS total_price
FROM tx GROUP BY month""", "tx"))
def q_csv_roundtrip(spark, sf):
    """A5 then A1: sales written as CSV (months in two formats), read back with the declared schema."""
    tx = T.transactions(spark, sf)
    text_month = F.when(F.abs(F.hash("tx_id")) % 2 == 0, F.date_format("month", "yyyy-MM")).otherwise(
        F.date_format("month", "yyyy-MM-dd"))
    out = tx.select(text_month.alias("month"), *[c for c in T.TX_COLUMNS if c not in ("tx_id", "month")])
    path = scratch_path(spark, f"csv-{abs(hash(sf))}")
    out.write.mode("overwrite").option("header", True).csv(path)
    back = RD.read_transactions_csv(spark, path)
    return back.groupBy(P.month_key("month").alias("month")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("resale_price"), 2).alias("total_price"))


RERUN_DAY = "2001-02-01"


@register("report_history", with_views(f"""
SELECT town, count(*) AS n, strftime(month, '%Y-%m-%d') AS date FROM tx
WHERE month <> DATE '{RERUN_DAY}' GROUP BY town, month""", "tx"))
def q_report_history(spark, sf):
    """A6 + A11: a report per month of the sales, all read as one table; one date is run again and then has no rows."""
    from appraise.plans import report as R

    base = scratch_path(spark, f"history-{uuid.uuid4().hex}")
    day = F.date_format("month", "yyyy-MM-dd").alias("date")
    rows = T.transactions(spark, sf).groupBy("town", day).agg(F.count(F.lit(1)).alias("n"))
    R.write_report_dates(rows, base, "sales_by_town")
    R.write_report(spark.createDataFrame([], "town string, n long"), base, "sales_by_town", RERUN_DAY)
    return R.read_report_history(spark, base, "sales_by_town")


PAGE_KEYS = 400
"""Order keys a page of sales holds; pages stay small however many there are."""


@register("record_pages", with_views(f"""
WITH p AS (SELECT *, CAST(split_part(tx_id, '-', 1) AS BIGINT) // {PAGE_KEYS} AS page FROM tx),
g AS (SELECT max(page) AS gap FROM p WHERE page <= (SELECT max(page) * 3 // 4 FROM p))
SELECT strftime(month, '%Y-%m') AS month, count(*) AS n, round(sum(resale_price), 2) AS total_price
FROM p, g WHERE page < gap AND month BETWEEN DATE '1996-01-01' AND DATE '2000-12-01' GROUP BY month""", "tx"))
def q_record_pages(spark, sf):
    """A2: the sales as JSON pages without a page field, one of them empty; read up to that page, a range of months."""
    key = F.split("tx_id", "-")[0].cast("long")
    tx = written(T.transactions(spark, sf, orders_first=True))  # the joins' shuffle files are gone before the pages are gathered
    tx = tx.withColumn("page", F.floor(key / PAGE_KEYS))
    record = F.struct(F.date_format("month", "yyyy-MM").alias("month"), *[
        F.col(f.name).cast("string").alias(f.name) for f in RD.TX_CSV_SCHEMA.fields[1:]])
    pages = tx.groupBy("page").agg(F.to_json(F.struct(F.struct(F.collect_list(record).alias("records")).alias("result"))).alias("value"))
    path = scratch_path(spark, f"pages-{uuid.uuid4().hex}")
    with shuffles_removed(spark):
        pages.write.partitionBy("page").text(path, compression="gzip")  # names and values repeat in every record
    files = spark.read.format("binaryFile").load(path)  # of the files only their folders' numbers are asked for
    if "page" not in files.columns:
        return spark.createDataFrame([], "month string, n long, total_price double")
    last = files.agg(F.max("page").alias("m")).first()["m"]
    gap = files.where(F.col("page") <= last * 3 // 4).agg(F.max("page").alias("m")).first()["m"]
    if gap is not None:
        spark.createDataFrame([('{"result":{"records":[]}}',)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/page={gap}")
    back = RD.read_record_pages(spark, path, "1996-01", "2000-12")
    return back.groupBy(P.month_key("month").alias("month")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("resale_price"), 2).alias("total_price"))


@register("series_csv", with_views("""
SELECT strftime(month, '%Y-%m-%d') AS month, sora_3m, cpi_all_items, cooling_measure FROM series""", "series"))
def q_series_csv(spark, sf):
    """A4: the monthly series written as CSV (months as ``yyyy-MM``) and read back."""
    path = scratch_path(spark, f"series-{uuid.uuid4().hex}")
    out = T.monthly_series(spark, sf).withColumn("month", F.date_format("month", "yyyy-MM"))
    out.select([f.name for f in RD.SERIES_CSV_SCHEMA.fields]).write.option("header", True).csv(path)
    back = RD.read_series_csv(spark, path)
    return back.select(F.date_format("month", "yyyy-MM-dd").alias("month"), "sora_3m", "cpi_all_items", "cooling_measure")


@register("lookup_csv", with_views("SELECT ref_id, ref_name, level, sap_ind FROM refs", "refs"))
def q_lookup_csv(spark, sf):
    """A3: the reference lookup written as CSV with a leading index column, read back without it."""
    path = scratch_path(spark, f"lookup-{uuid.uuid4().hex}")
    refs = T.reference_points(spark, sf).select(F.col("ref_id").alias("_index"), "ref_id", "ref_name", "level", "sap_ind")
    refs.write.option("header", True).csv(path)
    return RD.read_lookup_csv(spark, path, "_index long, ref_id long, ref_name string, level string, sap_ind string")
