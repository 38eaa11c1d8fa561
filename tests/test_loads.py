"""Loads by Spark's commit protocol: whole-folder replacement, empty loads, refreshes, exact users."""

import os

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from roomstar.operators import bitmaps, sketches
from roomstar.plans import serving
from roomstar.schema import OLAP_DETAIL
from roomstar.sinks import states


def _load(spark, root, load_id, coins, writer="w", days=("2024-01-05",)):
    rows = spark.createDataFrame([(int(d[:4] + d[5:7]), d, "r", coins, 0, 0, "u") for d in days],
                                 "ym int, event_date string, room_id string, coins long, gifts long, "
                                 "comments long, u string").withColumn("event_date", F.to_date("event_date"))
    part = (rows.groupBy("ym", "event_date", "room_id")
            .agg(F.sum("coins").alias("coins"), F.sum("gifts").alias("gifts"), F.sum("comments").alias("comments"),
                 sketches.sketch("u").alias("users_sketch")))
    states.write_load(root, writer, load_id, part)


def _coins(spark, root):
    return states.read(spark, root).agg(F.sum("coins")).first()[0]


def test_a_rerun_replaces_its_load_and_no_other(spark, scratch):
    assert states.read(spark, scratch).count() == 0  # nothing written yet
    _load(spark, scratch, 1, 10, days=("2024-01-05", "2024-02-05"))
    _load(spark, scratch, 2, 1)
    _load(spark, scratch, 1, 100, writer="other checkpoint")
    _load(spark, scratch, 1, 7)  # fewer months than before
    assert _coins(spark, scratch) == 108
    assert {r["ym"] for r in states.read(spark, scratch).select("ym").collect()} == {202401}


def test_an_empty_load_replaces_too(spark, scratch):
    _load(spark, scratch, 1, 10)
    _load(spark, scratch, 2, 5)
    _load(spark, scratch, 1, 0, days=())
    assert _coins(spark, scratch) == 5
    folder = states.load_path(scratch, "agg_room_daily", "w", 1)
    assert [f for f in os.listdir(folder) if not f.startswith(".")] == ["_SUCCESS"]


def test_a_write_that_does_not_commit_is_invisible(spark, scratch):
    _load(spark, scratch, 1, 10)
    part = states.load_path(scratch, "agg_room_daily", "w", 2) + "/_temporary/0/task_0/ym=202401"
    states.read(spark, scratch).drop("ym").write.parquet(part)  # a task's output before its job commits
    assert _coins(spark, scratch) == 10


def test_a_write_lists_no_other_load(spark, scratch):
    """What a load costs does not depend on the loads before: it opens nothing but its own folder."""
    for i in range(3):
        _load(spark, scratch, i, 1)
    before = {f: os.stat(f"{scratch}/agg_room_daily/writer=w/{f}").st_mtime_ns for f in ("load_id=0", "load_id=1")}
    _load(spark, scratch, 2, 5)
    assert before == {f: os.stat(f"{scratch}/agg_room_daily/writer=w/{f}").st_mtime_ns for f in before}
    assert _coins(spark, scratch) == 7


def test_fold_keeps_the_totals(spark, scratch):
    for i in range(4):
        _load(spark, f"{scratch}/a", i, i, days=("2024-01-05", "2024-02-05"))
    states.fold(spark, f"{scratch}/a", f"{scratch}/b")
    assert states.read(spark, f"{scratch}/b").count() == 2 and _coins(spark, f"{scratch}/b") == 12
    merged = states.merge(states.read(spark, f"{scratch}/b"), "room_id").select(sketches.estimate("users_sketch"))
    assert merged.first()[0] == 1


def _detail(spark, months, users=1):
    rows = [(f"2024-{m:02d}-03", "r", f"u{k}", "rose", "low", "SG", 1, 0, 0, 1, 10 * m, k, 202400 + m)
            for m in months for k in range(1, users + 1)]
    return (spark.createDataFrame(rows, "event_date string, room_id string, user_id string, gift_name string, "
                                  "gift_tier string, country string, event_count long, joins long, comments long, "
                                  "gifts long, coins long, user_key long, ym int")
            .withColumn("event_date", F.to_date("event_date")))


def _totals(s):
    return (s.detail().agg(F.sum("coins")).first()[0], s.rollup().agg(F.sum("coins")).first()[0],
            serving.country_exact(s).first()["coins"])


def test_a_rerun_load_with_fewer_months_leaves_nothing_behind(spark, scratch):
    s = serving.Serving(spark, scratch)
    serving.append(s, _detail(spark, [1, 2]), 1)
    serving.append(s, _detail(spark, [2]), 1)
    assert _totals(s) == (20, 20, 20)


def test_a_load_whose_states_are_missing_is_made_whole_by_sending_it_again(spark, scratch):
    s = serving.Serving(spark, scratch)
    serving.append(s, _detail(spark, [1]), 1)
    _detail(spark, [2]).write.partitionBy("ym").parquet(states.load_path(scratch, OLAP_DETAIL, "load", 2))  # then it failed
    s.invalidate()
    row = serving.rollup_reconcile(s).first()
    assert (row["detail_only"], row["rollup_only"]) == (1, 0)
    serving.append(s, _detail(spark, [2]), 2)
    row = serving.rollup_reconcile(s).first()
    assert (row["detail_only"], row["sum_mismatches"], row["user_mismatches"], row["groups"]) == (0, 0, 0, 2)


def test_a_refresh_replaces_the_layer_when_it_is_complete(spark, scratch):
    s = serving.refresh(spark, _detail(spark, [1]), scratch)
    serving.append(s, _detail(spark, [2]), 1)
    reader = serving.latest(spark, scratch).detail()
    serving.append(serving.Serving(spark, f"{scratch}/layers/999-unfinished"), _detail(spark, [5]), 0)
    serving.refresh(spark, _detail(spark, [3]), scratch)
    assert _totals(serving.latest(spark, scratch)) == (30, 30, 30)
    assert reader.count() == 2  # the layer before stays for running readers
    serving.refresh(spark, _detail(spark, [4]), scratch)
    assert _totals(serving.latest(spark, scratch)) == (40, 40, 40)
    kept = [d for d in os.listdir(f"{scratch}/layers") if d != "999-unfinished"]
    assert len(kept) == 2


def test_exact_users_merge_over_loads_and_buckets(spark, scratch):
    s = serving.Serving(spark, scratch)
    serving.append(s, _detail(spark, [1, 2], users=5), 0)
    far = _detail(spark, [1], users=3).withColumn("user_key", F.col("user_key") + 32_768 * 4 - 1)  # over a bucket's edge
    serving.append(s, far.unionByName(_detail(spark, [1], users=7)), 1)
    got = {str(r["event_date"]): r["users"] for r in serving.exact_users(s, "event_date").collect()}
    assert got == {"2024-01-03": 10, "2024-02-03": 5}
    assert serving.exact_users(s, "room_id").first()["users"] == 10
    assert serving.country_exact(s).first()["users"] == 10


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.integers(1, 200_000), max_size=30), min_size=1, max_size=4))
def test_bitmaps_count_unions_exactly(spark, sets):
    rows = [(i, k) for i, keys in enumerate(sets) for k in keys]
    df = spark.createDataFrame(rows, "part int, key long")
    parts = df.groupBy("part", bitmaps.bucket("key")).agg(bitmaps.construct("key").alias("bits"))
    got = bitmaps.count_distinct(parts.withColumn("all", F.lit(1)), "bits", "all").collect()
    assert [r["users"] for r in got] == ([len({k for _, k in rows})] if rows else [])
