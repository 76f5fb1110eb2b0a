"""Readers (A1-A4) on small files written by the test."""

from __future__ import annotations

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from appraise.sources import readers as RD

ROW = {"town": "A", "flat_type": "4 ROOM", "block": "1", "street_name": "X ST", "storey_range": "01 TO 03",
       "floor_area_sqm": "90", "flat_model": "Model A", "lease_commence_date": "1990",
       "remaining_lease": "70 years", "resale_price": "400000"}


def test_transactions_csv_mixed_months(spark, scratch):
    p = os.path.join(scratch, "tx.csv")
    with open(p, "w") as fh:
        fh.write(",".join(f.name for f in RD.TX_CSV_SCHEMA.fields) + "\n")
        for m in ("2020-01", "2020-02-15", "03/2020"):
            fh.write(",".join([m] + [ROW[f.name] for f in RD.TX_CSV_SCHEMA.fields[1:]]) + "\n")
    df = RD.read_transactions_csv(spark, p)
    assert [r.month for r in df.collect()] == [dt.date(2020, 1, 1), dt.date(2020, 2, 1), dt.date(2020, 3, 1)]
    assert df.schema["resale_price"].dataType.simpleString() == "double"


def test_record_pages_stop_and_range(spark, scratch):
    d = os.path.join(scratch, "pages")
    os.makedirs(d)
    pages = {1: ["2016-12", "2017-01"], 2: ["2024-03", "2024-04"], 3: [], 4: ["2020-01"]}
    for k, months in pages.items():
        with open(os.path.join(d, f"p{k}.json"), "w") as fh:
            json.dump({"page": k, "result": {"records": [dict(ROW, month=m) for m in months]}}, fh)
    df = RD.read_record_pages(spark, d, "2017-01", "2024-03")
    assert sorted(r.month for r in df.collect()) == [dt.date(2017, 1, 1), dt.date(2024, 3, 1)]


def _pages(folder, named):
    os.makedirs(folder)
    for name, months in named.items():
        with open(os.path.join(folder, name), "w") as fh:
            json.dump({"result": {"records": [dict(ROW, month=m) for m in months]}}, fh)
    return folder


def test_record_pages_without_a_page_field(spark, scratch):
    """Order from file names: by number (10 after 9, not after 1), or by path where no name has one."""
    months = {f"p{k}.json": [f"2020-{k:02d}"] for k in range(1, 13)}
    numbered = _pages(os.path.join(scratch, "numbered"), months | {"p10.json": []})
    assert sorted(r.month.month for r in RD.read_record_pages(spark, numbered).collect()) == list(range(1, 10))
    plain = _pages(os.path.join(scratch, "plain"), {"a.json": ["2020-01"], "b.json": [], "c.json": ["2020-03"]})
    assert [r.month.month for r in RD.read_record_pages(spark, plain).collect()] == [1]
    full = _pages(os.path.join(scratch, "full"), {"a.json": ["2020-01"], "b.json": ["2020-02"]})
    assert RD.read_record_pages(spark, full).count() == 2


def test_lookup_and_series(spark, scratch):
    p = os.path.join(scratch, "b.csv")
    with open(p, "w") as fh:
        fh.write(",block,street_name,latitude,longitude\n0,1,X ST,1.3,103.8\n1,2,Y ST,,\n")
    b = RD.read_lookup_csv(spark, p, RD.BUILDINGS_SCHEMA)
    assert b.columns == ["block", "street_name", "latitude", "longitude"]
    assert [r.latitude for r in b.collect()] == [1.3, None]
    s = os.path.join(scratch, "s.csv")
    with open(s, "w") as fh:
        fh.write("month,sora_3m,cpi_all_items,cpi_housing,hdb_rpi,gdp_growth_qoq,unemployment_rate,cooling_measure\n")
        fh.write("2021-01-01,0.4,100,101,150,1.2,2.8,0\n")
    assert RD.read_series_csv(spark, s).first().month == dt.date(2021, 1, 1)


def test_record_pages_make_the_sales_once(spark, monkeypatch):
    from appraise.plans import q_sources as Q

    rows = [(f"{k}-1-1-1", f"{1996 + k % 4}-0{1 + k % 9}-01", float(k)) for k in range(0, 2400, 50)]
    df = spark.createDataFrame(rows, "tx_id string, month string, resale_price double").withColumn("month", F.to_date("month"))
    df = df.withColumns({f.name: F.lit("1").cast(f.dataType) for f in RD.TX_CSV_SCHEMA.fields if f.name not in df.columns})
    read = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            read.add(len(batch))
            yield batch

    monkeypatch.setattr(Q.T, "transactions", lambda *a, **k: df.mapInPandas(count, df.schema))
    got = {r.month: (r.n, r.total_price) for r in Q.q_record_pages(spark, "unused").collect()}
    want = {}
    for tx, month, price in rows:
        if int(tx.split("-")[0]) // Q.PAGE_KEYS < 3:  # pages 0 to 5: the empty one is 5 * 3 // 4
            n, total = want.get(month[:7], (0, 0.0))
            want[month[:7]] = (n + 1, total + price)
    assert got == want and read.value == len(rows)
    monkeypatch.setattr(Q.T, "transactions", lambda *a, **k: df.limit(0))
    assert Q.q_record_pages(spark, "unused").count() == 0


def _bytes(folder):
    return sum(os.path.getsize(os.path.join(at, f)) for at, _, files in os.walk(folder) for f in files)


def test_record_pages_are_compressed(spark, monkeypatch):
    from appraise import session
    from appraise.plans import q_sources as Q

    sf = "/root/testdata/sf0.001"
    paths = []
    scratch = session.scratch_path
    monkeypatch.setattr(Q, "scratch_path", lambda s, name: paths.append(scratch(s, name)) or paths[-1])
    got = Q.q_record_pages(spark, sf).count()
    assert got > 0 and len(paths) == 1
    records = spark.read.text(paths[0]).selectExpr("sum(octet_length(value)) AS n").first()["n"]
    assert _bytes(paths[0]) < records / 2
