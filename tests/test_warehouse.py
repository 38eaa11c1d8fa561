"""Warehouse models: golden figures, dense keys, calendar and attribute rules."""

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF001, SF01
from roomstar.operators.keys import dense_keys
from roomstar.plans import reports, warehouse
from roomstar.plans.dimensions import dimensions
from roomstar.queries import warehouse_for
from roomstar.schema import EVENT_SCHEMA


def _ev(spark, rows):
    """Raw events from (event_id, type, ts, room, user, country, gift, coins) tuples."""
    out = []
    for eid, typ, ts, room, user, country, gift, coins in rows:
        t = dt.datetime.fromisoformat(ts).replace(tzinfo=dt.timezone.utc) if ts else None
        out.append((eid, typ, t, t, room, user, country, gift, coins, 0))
    return spark.createDataFrame(out, EVENT_SCHEMA)


@pytest.mark.parametrize("sf,stg,dims,fact_rows,coins,lag", [
    (SF001, 1000, (30, 50, 15, 5), 981, 52915, 3.03228),
    (SF01, 10000, (30, 50, 150, 5), 9850, 547939, 3.06638),
])
def test_golden_figures(spark, sf, stg, dims, fact_rows, coins, lag):
    wh = warehouse_for(spark, sf)
    assert wh.rows["stg_events"] == stg
    assert tuple(wh.rows[d] for d in ["dim_date", "dim_room", "dim_user", "dim_gift"]) == dims
    assert wh.rows["fact_live_engagement"] == fact_rows
    f = wh.table("fact_live_engagement").agg(F.sum("coins").alias("c"), F.avg("avg_ingest_lag_s").alias("l"),
                                             F.sum("event_count").alias("n")).first()
    assert f["c"] == coins and f["n"] == stg
    assert f["l"] == pytest.approx(lag, abs=1e-5)


def test_top_rooms_golden(spark):
    top = reports.top_rooms(warehouse_for(spark, SF01), 3).collect()
    assert [(r["room"], r["coins"], r["users"]) for r in top] == [
        ("room_0043", 19820, 122), ("room_0029", 14577, 99), ("room_0005", 14420, 111)]


def test_country_golden(spark):
    got = {r["country"]: (r["users"], r["coins"], r["comments"])
           for r in reports.by_country(warehouse_for(spark, SF01)).collect()}
    assert got["MY"] == (27, 112211, 335) and got["SG"] == (24, 73118, 348)


def test_dense_keys_match_row_number(spark):
    df = spark.range(20000).select(F.when(F.col("id") % 997 == 0, None)
                                   .otherwise(F.sha1(F.col("id").cast("string"))).alias("k")).distinct()
    keyed = dense_keys(df, "k", "key", num_partitions=7)
    ref = df.withColumn("rn", F.row_number().over(Window.orderBy(F.col("k").asc_nulls_last())))
    bad = keyed.join(ref, keyed["k"].eqNullSafe(ref["k"])).where(F.col("key") != F.col("rn")).count()
    n = df.count()
    stats = keyed.agg(F.min("key"), F.max("key"), F.countDistinct("key")).first()
    assert bad == 0 and tuple(stats) == (1, n, n)


def test_null_natural_key_sorts_last(spark):
    df = spark.createDataFrame([(None,), ("a",)], "k string")
    got = {r["k"]: r["key"] for r in dense_keys(df, "k", "key").collect()}
    assert got == {"a": 1, None: 2}


def test_dim_date_weekend(spark):
    stg = warehouse.staging(_ev(spark, [("1", "join", "2024-01-07T10:00:00", "r", "u", "SG", None, 0),
                                        ("2", "join", "2024-01-08T10:00:00", "r", "u", "SG", None, 0)]))
    got = {r["date_key"]: (r["day_of_week"], r["is_weekend"]) for r in dimensions(stg)[0]["dim_date"].collect()}
    assert got == {20240107: (0, True), 20240108: (1, False)}


def test_gift_tier_edges(spark):
    from roomstar.functions import tier
    vals = [1000, 999, 100, 99, 10, 9, 1, 0, -1]
    df = spark.createDataFrame([(v,) for v in vals], "c int")
    got = [r["t"] for r in df.select(tier("c").alias("t")).collect()]
    assert got == ["premium", "high", "high", "mid", "mid", "low", "low", "none", "none"]


def test_user_country_is_first_known(spark):
    stg = warehouse.staging(_ev(spark, [
        ("1", "join", "2024-01-01T00:00:01", "r", "u1", None, None, 0),
        ("2", "join", "2024-01-01T00:00:02", "r", "u1", "VN", None, 0),
        ("3", "join", "2024-01-01T00:00:03", "r", "u1", "SG", None, 0),
        ("4", "join", "2024-01-01T00:00:01", "r", "u2", None, None, 0)]))
    got = {r["user_id"]: r["country"] for r in dimensions(stg)[0]["dim_user"].collect()}
    assert got == {"u1": "VN", "u2": None}


def test_countries_that_tie_go_to_the_smaller_event_id(spark):
    at, later = "2024-01-01T00:00:01", "2024-01-01T00:00:02"
    stg = warehouse.staging(_ev(spark, [
        ("7", "join", at, "r", "u1", "AA", None, 0), ("3", "join", at, "r", "u1", "ZZ", None, 0),
        ("1", "join", later, "r", "u1", "AA", None, 0), ("5", "join", at, "r", None, "MY", None, 0),
        ("4", "join", at, "r", None, "PH", None, 0), ("2", "join", at, "r", "u2", None, None, 0),
        ("6", "join", later, "r", "u2", "TH", None, 0), ("8", "join", at, "r", "u3", None, None, 0)]))
    dims, rows = dimensions(stg)
    got = {r["user_id"]: (r["user_key"], r["country"], r["first_seen_ts"].second) for r in dims["dim_user"].collect()}
    assert got == {"u1": (1, "ZZ", 1), "u2": (2, "TH", 1), "u3": (3, None, 1), None: (4, "PH", 1)}
    assert rows == {"dim_date": 1, "dim_room": 1, "dim_user": 4, "dim_gift": 1}


def test_dimensions_of_no_events(spark):
    dims, rows = dimensions(warehouse.staging(_ev(spark, [])))
    assert set(rows.values()) == {0} and {n: d.count() for n, d in dims.items()} == rows


def test_dimensions_read_staging_once(spark, scratch):
    from roomstar.plans.dimensions import natural_keys
    wh = warehouse_for(spark, SF001)
    plan = natural_keys(wh.table("stg_events"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and plan.count("Expand") == 1
    assert "HashAggregate" in plan.split("Expand")[0].splitlines()[-2]  # over the events: no sort


def test_dense_keys_within_tables(spark):
    df = spark.range(3000).selectExpr("concat('t', id % 3) AS t", "if(id < 3, null, sha1(string(id))) AS k")
    keyed = dense_keys(df, "k", "key", num_partitions=8, within="t")
    want = df.withColumn("rn", F.row_number().over(Window.partitionBy("t").orderBy(F.col("k").asc_nulls_last())))
    both = keyed.join(want, (keyed.t == want.t) & keyed.k.eqNullSafe(want.k))
    assert both.count() == 3000 and both.where("key != rn").count() == 0


def test_null_room_dropped_from_fact(spark, scratch):
    raw = _ev(spark, [("1", "gift", "2024-01-01T00:00:01", "r1", "u1", "SG", "rose", 1),
                      ("2", "join", "2024-01-01T00:00:02", None, "u1", "SG", None, 0),
                      ("3", None, None, "r1", "u1", "SG", None, 0)])
    from roomstar.plans.warehouse import QualityGateError
    with pytest.raises(QualityGateError):
        warehouse.build(spark, raw, scratch)
    import glob
    report_dir = glob.glob(f"{scratch}/builds/*/_quality")[0]
    rep = {r["check_name"]: r["violations"] for r in spark.read.parquet(report_dir).collect()}
    assert rep["staging_reconciliation"] == 1
    assert sum(rep.values()) == 1
    assert not glob.glob(f"{scratch}/builds/*/_published")


def test_publish_and_latest(spark, scratch):
    raw = _ev(spark, [("1", "gift", "2024-01-01T00:00:01", "r1", "u1", "SG", "rose", 1),
                      ("2", "comment", "2024-01-02T00:00:02", "r2", "u2", "VN", None, 0)])
    wh = warehouse.build(spark, raw, scratch)
    again = warehouse.latest(spark, scratch)
    assert again.path == wh.path and again.rows["fact_live_engagement"] == 2
