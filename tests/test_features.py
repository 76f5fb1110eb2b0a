"""Scalar functions and feature-stage joins."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from appraise.functions import parse as P
from appraise.operators import joins as J

from .conftest import SF_SMALL


def test_storey_mid(spark):
    df = spark.createDataFrame([("01 TO 03",), ("10 TO 12",), ("19 TO 21",), ("04 TO 06",), ("bad",)], "s string")
    got = [r[0] for r in df.select(P.storey_mid("s")).collect()]
    assert got == [2.0, 11.0, 20.0, 5.0, None]


def test_lease_months(spark):
    rows = [("73 years 05 months",), ("60 years",), ("50 years 00 months",), ("80 years 11 months",),
            ("61 years 1 month",), ("junk",)]
    df = spark.createDataFrame(rows, "s string")
    got = [r[0] for r in df.select(P.lease_months("s")).collect()]
    assert got == [881, 720, 600, 971, 732, None]


def test_lease_months_lenient(spark):
    df = spark.createDataFrame([("61 years 1 month",)], "s string")
    assert df.select(P.lease_months("s", strict_plural=False)).first()[0] == 733


def test_yn_to_bool_and_absent_columns(spark):
    df = spark.createDataFrame([("Y", "1"), ("N", "2"), ("Y", "3"), ("x", "4")], "residential string, other string")
    out = P.map_yn_columns(df)
    assert [r.residential for r in out.collect()] == [True, False, True, None]
    assert out.columns == ["residential", "other"]


def test_expand_transaction_date(spark):
    df = spark.createDataFrame([(dt.date(2021, 4, 1),), (dt.date(2023, 9, 1),)], "month date")
    out = P.expand_transaction_date(df)
    assert "month" not in out.columns
    assert [(r.year, r.month_numeric) for r in out.collect()] == [(2021, 4), (2023, 9)]


def test_parse_month_formats(spark):
    df = spark.createDataFrame([("2020-01",), ("2020-02-17",), ("03/2020",), ("nope",)], "m string")
    got = [r[0] for r in df.select(P.parse_month("m")).collect()]
    assert got == [dt.date(2020, 1, 1), dt.date(2020, 2, 1), dt.date(2020, 3, 1), None]


def test_request_month(spark):
    df = spark.createDataFrame([("2024-01",), (None,)], "m string")
    got = [r[0] for r in df.select(P.request_month("m", "2024-03-15")).collect()]
    assert got == [dt.date(2024, 1, 1), dt.date(2024, 3, 15)]


def _series(spark, months, values):
    return spark.createDataFrame([(m, v) for m, v in zip(months, values)], "month date, sora_3m double")


def test_lagged_join_uses_previous_month(spark):
    s = _series(spark, [dt.date(2021, 1, 1), dt.date(2021, 2, 1)], [1.0, 2.0])
    tx = spark.createDataFrame([(dt.date(2021, 2, 1),)], "month date")
    out = J.lagged_join(tx, s, 1, measures=["sora_3m"]).first()
    assert out.sora_3m == 1.0


def test_lagged_join_no_nulls_within_series(spark):
    months = [dt.date(2020 + (i // 12), i % 12 + 1, 1) for i in range(51)]  # 2020-01 .. 2024-03
    s = _series(spark, months, [float(i) for i in range(51)])
    tx = spark.createDataFrame([(dt.date(2021, 6, 1),), (dt.date(2022, 12, 1),), (dt.date(2023, 9, 1),)], "month date")
    out = J.lagged_join(tx, s, 1, measures=["sora_3m"])
    assert out.filter(F.col("sora_3m").isNull()).count() == 0


def test_missing_months_anti_join(spark):
    s = _series(spark, [dt.date(2021, 1, 1)], [1.0])
    tx = spark.createDataFrame([(dt.date(2021, 1, 1),), (dt.date(2021, 2, 1),)], "month date")
    lagged = J.lag_series(s, 1)
    assert [r.month for r in J.missing_months(tx, lagged).collect()] == [dt.date(2021, 1, 1)]


def test_impute_unseen(spark):
    train = spark.createDataFrame([("Model A",), ("Improved",), ("Standard",)], "flat_model string")
    test = spark.createDataFrame([(1, "2-room"), (2, "3Gen"), (3, "Improved"), (4, None)], "id int, flat_model string")
    out = {r.id: r.flat_model for r in J.impute_unseen(test, train, "flat_model", "Model A").collect()}
    assert out == {1: "Model A", 2: "Model A", 3: "Improved", 4: "Model A"}


def test_impute_unseen_in_split(spark):
    df = spark.createDataFrame([("train", "a"), ("test", "a"), ("test", "b"), ("train", "c")], "split string, v string")
    out = sorted((r.split, r.v) for r in J.impute_unseen_in_split(df, "v", "z").collect())
    assert out == [("test", "a"), ("test", "z"), ("train", "a"), ("train", "c")]


def test_impute_unseen_columns(spark):
    df = spark.createDataFrame([("train", "a", None), ("test", "a", "p"), ("test", None, "q"), ("train", "c", "q")],
                               "split string, v string, w string")
    out = J.impute_unseen_columns(df, {"v": "z", "w": "y"})
    assert out.columns == df.columns
    assert sorted(map(tuple, out.collect()), key=str) == sorted(
        [("train", "a", None), ("test", "a", "y"), ("test", "z", "q"), ("train", "c", "q")], key=str)


def test_join_measured_with_a_hot_key(spark):
    """Broadcast, and split with the hot key apart, give the plain join; neither shuffles the hot key's facts."""
    facts = spark.range(3000).selectExpr(
        "id", "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 100 = 1 THEN NULL ELSE concat('k', id % 40) END AS k")
    small = spark.range(30).selectExpr("concat('k', id) AS k", "id * 2 AS m").unionByName(
        spark.sql("SELECT 'hot' AS k, CAST(-1 AS BIGINT) AS m"))
    for how in ("left", "inner"):
        exp = sorted(map(tuple, facts.join(small, ["k"], how).collect()), key=str)
        assert sorted(map(tuple, J.join_measured(facts, small, ["k"], how).collect()), key=str) == exp
        apart = J.join_measured(facts, small, ["k"], how, max_bytes=10)
        assert sorted(map(tuple, apart.collect()), key=str) == exp
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = J.join_measured(facts, small, ["k"])._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_elite_flags(spark):
    refs = spark.createDataFrame(
        [(1, "Elite Primary", "Yes", "No", "No", "No"), (2, "Plain Primary", "No", "No", "No", "No"),
         (3, "Elite Primary", "No", "No", "No", "No")],
        "ref_id int, ref_name string, sap_ind string, autonomous_ind string, gifted_ind string, ip_ind string")
    df = spark.createDataFrame([(1, "Elite Primary"), (2, "Plain Primary"), (3, "Unknown"), (4, None)],
                               "id int, closest_pri_sch string")
    out = {r.id: r.is_elite_closest_pri_sch for r in J.add_elite_flags(df, refs, ["closest_pri_sch"]).collect()}
    assert out == {1: True, 2: False, 3: False, 4: False}


def test_gazetteer_fallback(spark):
    b = spark.createDataFrame([("1", "A ST", "000001"), ("2", "B ST", "000002"), ("3", "C ST", "000003")],
                              "block string, street_name string, postal_code string")
    by_addr = spark.createDataFrame([("1 A ST", 1.3, 103.8)], "address string, g_lat double, g_lng double")
    by_post = spark.createDataFrame([("000002", 1.31, 103.81)], "postal_code string, p_lat double, p_lng double")
    out = {r.block: (r.latitude, r.geo_source) for r in J.gazetteer_lookup(b, by_addr, by_post).collect()}
    assert out == {"1": (1.3, "address"), "2": (1.31, "postal"), "3": (None, None)}


def test_split_and_range(spark):
    df = spark.createDataFrame([(dt.date(2023, 8, 1),), (dt.date(2023, 9, 1),), (dt.date(2024, 1, 1),)], "month date")
    s = J.split_by_cutoff(df, "2023-09-01")
    assert [r.split for r in s.orderBy("month").collect()] == ["train", "test", "test"]
    assert J.between_months(df, "2023-09", "2023-12").count() == 1


def test_first_per_key(spark):
    df = spark.createDataFrame([("k", 2, "b"), ("k", 1, "a"), ("j", 5, "c")], "k string, o int, v string")
    out = {r.k: r.v for r in J.first_per_key(df, ["k"], "o").collect()}
    assert out == {"k": "a", "j": "c"}


def test_sql_functions(spark):
    P.register_sql_functions(spark)
    r = spark.sql("SELECT storey_mid('07 TO 09') AS a, lease_months('73 years 05 months') AS b, "
                  "lease_months('61 years 1 month') AS c, storey_mid('bad') AS d").first()
    assert (r.a, r.b, r.c, r.d) == (8.0, 881, 732, None)


def test_joins_of_the_feature_stage_run_once(spark):
    """Rows of sales that carry a counter: read once for all passes of the feature stage and of its readers."""
    from appraise.plans.features import FeatureConfig, processed_frame

    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    rows = [(f"t{i}", dt.date(2000 + i % 2, 1 + i % 12, 1), f"Brand#{i % 4 + 10 * (i % 2)}", "01 TO 03", "60 years", float(i)) for i in range(60)]
    schema = "tx_id string, month date, flat_model string, storey_range string, remaining_lease string, resale_price double"
    sales = spark.createDataFrame(rows, schema).mapInArrow(counted, schema)
    out = processed_frame(spark, SF_SMALL, FeatureConfig(), sales, write=True)
    assert out.count() == 60 and out.filter("split = 'test'").select("flat_model").distinct().collect() == [("Brand#1",)]
    assert seen.value == 60


def test_enriched_by_building_gives_the_same_rows(spark):
    from appraise.plans.features import enriched_by_building, enriched_sales

    a, b = enriched_sales(spark, SF_SMALL), enriched_by_building(spark, SF_SMALL)
    assert a.schema == b.schema
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_written_frames_leave_no_shuffle_files(spark, tmp_path):
    from pyspark.sql import functions as F

    from appraise.session import CLEANUP_CONF, written

    tracker = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker()
    before = {str(i) for i in range(10_000) if tracker.containsShuffle(i)}
    out = written(spark.range(2000).repartition(3).groupBy((F.col("id") % 700).alias("k")).count())
    assert out.count() == 700 and {f for f in out.inputFiles() if f.endswith(".zstd.parquet")}
    made = {str(i) for i in range(10_000) if tracker.containsShuffle(i)} - before
    assert len(made) <= 1  # of the count only
    assert spark.conf.get(CLEANUP_CONF, None) in (None, "false")


def test_orders_first_gives_the_same_sales(spark):
    from appraise.sources import tables as T

    a, b = T.transactions(spark, SF_SMALL), T.transactions(spark, SF_SMALL, orders_first=True)
    assert a.schema == b.schema and sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_large_tables_take_the_written_frame(spark, monkeypatch):
    """The same rows without the columns that name a sale."""
    from appraise.plans import q_models as Q

    small = Q._frame_of_size(spark, SF_SMALL)
    monkeypatch.setattr(Q, "WRITTEN", 0)
    large = Q._frame_of_size(spark, SF_SMALL)
    assert [c for c in small.columns if c not in large.columns] == ["block", "street_name", "tx_id"]
    assert sorted(map(str, small.select(large.columns).collect())) == sorted(map(str, large.collect()))
