"""Readers for the reference's at-rest formats (A1-A4).

Every reader declares its schema (no inference) and normalises NaN to NULL.

* A1 ``read_transactions_csv``: sale records as CSV; the month column may be
  written in several formats and is snapped to the month start.
* A2 ``read_record_pages``: pages of API responses stored as JSON files
  ``{"result": {"records": [...]}}``; records are exploded, cast to the sale
  schema and kept when ``start <= month <= end``. Pages from the first
  empty page on are ignored, as the paging loop would stop there. Pages are ordered by their
  field ``page`` (or folder ``page=N``), else by the last number in the file's name, else by the path.
* A3 ``read_lookup_csv``: stations, schools, buildings (an index column is dropped).
* A4 ``read_series_csv``: the monthly series.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from appraise.functions.parse import parse_month

TX_CSV_SCHEMA = T.StructType([
    T.StructField("month", T.StringType()),
    T.StructField("town", T.StringType()),
    T.StructField("flat_type", T.StringType()),
    T.StructField("block", T.StringType()),
    T.StructField("street_name", T.StringType()),
    T.StructField("storey_range", T.StringType()),
    T.StructField("floor_area_sqm", T.DoubleType()),
    T.StructField("flat_model", T.StringType()),
    T.StructField("lease_commence_date", T.IntegerType()),
    T.StructField("remaining_lease", T.StringType()),
    T.StructField("resale_price", T.DoubleType()),
])

SERIES_CSV_SCHEMA = T.StructType([
    T.StructField("month", T.StringType()),
    T.StructField("sora_3m", T.DoubleType()),
    T.StructField("cpi_all_items", T.DoubleType()),
    T.StructField("cpi_housing", T.DoubleType()),
    T.StructField("hdb_rpi", T.DoubleType()),
    T.StructField("gdp_growth_qoq", T.DoubleType()),
    T.StructField("unemployment_rate", T.DoubleType()),
    T.StructField("cooling_measure", T.IntegerType()),
])

STATIONS_SCHEMA = "station_name string, lat double, lng double, line string"
SCHOOLS_SCHEMA = ("school_name string, mainlevel_code string, lat double, long double, sap_ind string, "
                  "autonomous_ind string, gifted_ind string, ip_ind string, postal_code string")
BUILDINGS_SCHEMA = "_index long, block string, street_name string, latitude double, longitude double"


def _nan_to_null(df: DataFrame) -> DataFrame:
    dbl = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None).cast("double")) for c in dbl}) if dbl else df


def read_transactions_csv(spark: SparkSession, path: str, extra_columns: T.StructType | None = None) -> DataFrame:
    """A1: sale records from CSV (header), month parsed from mixed formats."""
    schema = TX_CSV_SCHEMA
    if extra_columns:
        schema = T.StructType(schema.fields + extra_columns.fields)
    df = spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").csv(path)
    return _nan_to_null(df.withColumn("month", parse_month("month")))


def read_record_pages(spark: SparkSession, path: str, start: str = "2017-01", end: str = "2024-03") -> DataFrame:
    """A2: explode ``result.records`` of page files, parse ``yyyy-MM`` months, keep start..end (inclusive)."""
    rec = T.StructType([T.StructField(f.name, T.StringType()) for f in TX_CSV_SCHEMA.fields])
    page_schema = T.StructType([
        T.StructField("page", T.LongType()),
        T.StructField("result", T.StructType([T.StructField("records", T.ArrayType(rec))])),
    ])
    pages = spark.read.schema(page_schema).option("multiLine", True).json(path)
    named = F.regexp_extract(F.col("_metadata.file_name"), r"(\d+)[^0-9]*$", 1)
    number = F.coalesce(F.col("page"), F.when(named != "", named.try_cast("long")))
    pages = pages.select(F.struct(number.alias("number"), F.col("_metadata.file_path").alias("path")).alias("_at"), "result")
    # the paging loop stops at the first empty page; its place is one small row
    empty = F.coalesce(F.size("result.records"), F.lit(0)) <= 0
    stop = pages.filter(empty).agg(F.min("_at").alias("_stop")).first()["_stop"]
    if stop is None:
        kept = pages
    else:
        at = F.struct(F.lit(stop["number"]).cast("long").alias("number"), F.lit(stop["path"]).alias("path"))
        kept = pages.filter(F.col("_at") < at)
    rows = kept.select(F.explode("result.records").alias("r")).select("r.*")
    typed = rows.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) if f.name != "month" else F.col("month")
                          for f in TX_CSV_SCHEMA.fields])
    typed = typed.withColumn("month", F.to_date(F.try_to_timestamp(F.col("month"), F.lit("yyyy-MM"))))
    lo, hi = F.to_date(F.lit(start + "-01")), F.to_date(F.lit(end + "-01"))
    return _nan_to_null(typed.filter(F.col("month").between(lo, hi)))


def read_lookup_csv(spark: SparkSession, path: str, schema: str, drop_index: bool = True) -> DataFrame:
    """A3: a lookup table with a declared schema; a leading index column is dropped."""
    df = spark.read.schema(schema).option("header", True).csv(path)
    if drop_index and "_index" in df.columns:
        df = df.drop("_index")
    return _nan_to_null(df)


def read_series_csv(spark: SparkSession, path: str) -> DataFrame:
    """A4: the monthly series, month parsed to the month start."""
    df = spark.read.schema(SERIES_CSV_SCHEMA).option("header", True).csv(path)
    return _nan_to_null(df.withColumn("month", parse_month("month")))
