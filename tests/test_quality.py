"""Data-quality checks: each one fails on a fact broken on purpose."""

from pyspark.sql import functions as F

from conftest import SF001
from roomstar.plans import quality
from roomstar.queries import warehouse_for


def _report(stg, fact, dims):
    return {r["check_name"]: (r["violations"], r["status"])
            for r in quality.quality_report(stg, fact, dims).collect()}


def test_clean_build_passes_all(spark):
    wh = warehouse_for(spark, SF001)
    rep = _report(wh.table("stg_events"), wh.table("fact_live_engagement"), wh.dims())
    assert len(rep) == 8 and all(v == (0, "PASS") for v in rep.values())


def test_injected_faults_are_reported(spark):
    wh = warehouse_for(spark, SF001)
    stg, fact = quality.inject_faults(wh.table("stg_events"), wh.table("fact_live_engagement"))
    rep = {k: v[0] for k, v in _report(stg, fact, wh.dims()).items()}
    assert rep == {"null_fact_keys": 1, "duplicate_event_ids": 1, "orphan_room_keys": 1,
                   "orphan_user_keys": 1, "negative_coins": 1, "staging_reconciliation": 3,
                   "orphan_date_keys": 0, "orphan_gift_keys": 1}


def test_duplicate_null_ids_count(spark):
    stg = spark.createDataFrame([("a",), ("a",), ("a",), ("b",), (None,)], "event_id string")
    fact = spark.createDataFrame([], "date_key int, room_key long, user_key long, gift_key long, "
                                     "coins long, event_count long")
    dims = {n: spark.createDataFrame([], f"{k} long") for n, k in
            [("dim_date", "date_key"), ("dim_room", "room_key"), ("dim_user", "user_key"),
             ("dim_gift", "gift_key")]}
    rep = {r["check_name"]: r["violations"] for r in quality.violations(stg, fact, dims).collect()}
    # COUNT(*) - COUNT(DISTINCT event_id) = 5 - 2
    assert rep["duplicate_event_ids"] == 3


def test_colliding_digests_do_not_count_as_duplicates(spark, monkeypatch):
    rows = [(f"e{i % 90}",) for i in range(100)] + [(None,), (None,)]
    stg = spark.createDataFrame(rows, "event_id string")
    assert quality.duplicate_ids(stg) == (12, 102)
    monkeypatch.setattr(quality, "digest", lambda c: F.crc32(c) % 7)  # every digest is shared by many ids
    assert quality.duplicate_ids(stg) == (12, 102)
    assert quality.duplicate_ids(stg.distinct().where("event_id IS NOT NULL")) == (0, 90)
    assert quality.duplicate_ids(stg.where("false")) == (0, 0)


def test_duplicate_check_shuffles_no_id(spark, monkeypatch):
    stg = warehouse_for(spark, SF001).table("stg_events")
    plans = []
    first = type(stg).first
    monkeypatch.setattr(type(stg), "first", lambda df: plans.append(
        df._jdf.queryExecution().executedPlan().toString()) or first(df))
    assert quality.duplicate_ids(stg) == (0, stg.count())
    assert len(plans) == 1  # ids are not looked at again
    grouped = [line for line in plans[0].splitlines() if "Exchange hashpartitioning" in line]
    assert grouped and all("event_id" not in line and "_id#" not in line for line in grouped)


def test_orphans_read_each_table_once(spark):
    wh = warehouse_for(spark, SF001)
    df = quality.orphan_rows(wh.table("fact_live_engagement"), wh.dims(), wh.rows)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 5 and "CartesianProduct" not in plan


def test_passing_summary(spark):
    wh = warehouse_for(spark, SF001)
    rep = quality.quality_report(wh.table("stg_events"), wh.table("fact_live_engagement"), wh.dims())
    row = quality.passing(rep).first()
    assert (row["passing"], row["checks"]) == (8, 8)
    assert rep.where(F.col("status") == "FAIL").count() == 0
