"""Real-time layer: decoding, late data against the watermark, sinks, restart."""

import json
import os
import time

from pyspark.sql import functions as F

from roomstar.sources.stream import decode, file_stream, undecodable
from roomstar.streaming import job, rollup
from roomstar.sinks import states as state_store
from roomstar.streaming.job import room_windows


def _event(eid, ts, room="room_0001", user="user_000001", etype="join", coins=0):
    return {"event_id": str(eid), "event_type": etype, "event_ts": ts,
            "ingest_ts": ts, "room_id": room, "user_id": user, "country": "SG",
            "gift_name": "rose" if coins else None, "coins": coins, "comment_len": 0}


def _write_batches(indir, batches):
    """One NDJSON file per batch, with increasing modification times, so a stream with
    one file per trigger reads them as separate micro-batches in this order."""
    os.makedirs(indir, exist_ok=True)
    now = time.time() - 1000
    for i, events in enumerate(batches):
        p = os.path.join(indir, f"events-{i:03d}.json")
        with open(p, "w") as f:
            for e in events:
                f.write((e if isinstance(e, str) else json.dumps(e)) + "\n")
        os.utime(p, (now + i * 10, now + i * 10))


def _ts(mmss):
    return f"2024-01-01T00:{mmss}+00:00"


def _run_windows(spark, scratch, batches):
    indir = f"{scratch}/in"
    _write_batches(indir, batches)
    src = decode(file_stream(spark, indir, files_per_trigger=1))
    late = job.LateRows()
    spark.streams.addListener(late)
    q, = job.supervise([lambda: job.start_metrics_sink(src, f"{scratch}/out", f"{scratch}/ck", available_now=True)])
    dropped = job.settled(spark, late, q)
    spark.streams.removeListener(late)
    assert q.exception() is None
    out = spark.read.parquet(f"{scratch}/out")
    got = {r["window_start"].strftime("%M:%S"): r["events"] for r in out.collect()}
    return got, dropped


def test_late_row_dropped_after_watermark_passed(spark, scratch):
    batches = [[_event(1, _ts("00:05"))], [_event(2, _ts("02:00"))], [_event(3, _ts("02:10"))],
               [_event(4, _ts("00:06")), _event(5, _ts("02:20"))]]
    got, dropped = _run_windows(spark, scratch, batches)
    assert got["00:00"] == 1
    assert dropped == 1


def test_late_row_admitted_one_batch_after_jump(spark, scratch):
    batches = [[_event(1, _ts("00:05")), _event(2, _ts("00:40"))],
               [_event(3, _ts("01:10"))],
               [_event(4, _ts("00:35")), _event(5, _ts("00:06")), _event(6, _ts("02:30"))],
               [_event(7, _ts("00:45")), _event(8, "2024-01-01T00:05:00+00:00")]]
    got, dropped = _run_windows(spark, scratch, batches)
    assert got == {"00:00": 2, "00:30": 3, "01:00": 1, "02:30": 1}
    assert dropped == 0


def test_decode_bad_lines_and_offsets(spark):
    lines = ['not json', '', 'null',
             json.dumps(_event(1, "2024-01-01T08:00:00+08:00")),
             json.dumps({**_event(2, "yesterday"), "coins": "many"})]
    df = decode(spark.createDataFrame([(x,) for x in lines], "json string"))
    rows = df.collect()
    assert undecodable(df).count() == 3
    ok = [r for r in rows if r["event_id"] == "1"][0]
    assert ok["event_ts"].strftime("%H:%M:%S") == "00:00:00"  # session zone is UTC
    bad = [r for r in rows if r["event_id"] == "2"][0]
    assert bad["event_ts"] is None and bad["coins"] is None and bad["room_id"] == "room_0001"


def test_tmp_files_ignored_and_sink_directory_read(spark, scratch):
    indir = f"{scratch}/in"
    _write_batches(indir, [[_event(1, _ts("00:05")), _event(2, _ts("00:06"))]])
    with open(f"{indir}/events-999.json.tmp", "w") as f:
        f.write(json.dumps(_event(3, _ts("00:07"))) + "\n")
    src = decode(file_stream(spark, indir))
    q = job.start_raw_sink(src, f"{scratch}/lake", f"{scratch}/ck", available_now=True)
    q.awaitTermination()
    assert spark.read.parquet(f"{scratch}/lake").count() == 2
    # a stray file in the sink folder (e.g. from a failed batch) is not committed
    part = [p for p in os.listdir(f"{scratch}/lake") if p.endswith(".parquet")][0]
    with open(f"{scratch}/lake/{part}", "rb") as a, open(f"{scratch}/lake/stray.parquet", "wb") as b:
        b.write(a.read())
    assert spark.read.parquet(f"{scratch}/lake").count() == 2


def test_restart_resumes_from_checkpoint(spark, scratch):
    indir = f"{scratch}/in"
    _write_batches(indir, [[_event(1, _ts("00:05"))]])
    for _ in range(2):
        q = job.start_raw_sink(decode(file_stream(spark, indir)), f"{scratch}/lake",
                               f"{scratch}/ck", available_now=True)
        q.awaitTermination()
    _write_batches(f"{scratch}/more", [[_event(2, _ts("00:06"))]])
    os.replace(f"{scratch}/more/events-000.json", f"{indir}/events-100.json")
    q = job.start_raw_sink(decode(file_stream(spark, indir)), f"{scratch}/lake",
                           f"{scratch}/ck", available_now=True)
    q.awaitTermination()
    ids = sorted(r["event_id"] for r in spark.read.parquet(f"{scratch}/lake").collect())
    assert ids == ["1", "2"]


def test_incremental_rollup_equals_batch_and_replay_is_idempotent(spark, scratch):
    events = [_event(i, _ts(f"{i % 50:02d}:{i % 60:02d}"), room=f"room_{i % 3:04d}",
                     user=f"user_{i % 7:06d}", etype="gift" if i % 4 == 0 else "comment",
                     coins=10 if i % 4 == 0 else 0) for i in range(60)]
    batches = [events[:20], events[20:45], events[45:]]
    indir = f"{scratch}/in"
    _write_batches(indir, batches)
    src = decode(file_stream(spark, indir, files_per_trigger=1))
    q = rollup.start(src, f"{scratch}/rollup", f"{scratch}/ck", available_now=True)
    q.awaitTermination()
    states = state_store.read(spark, f"{scratch}/rollup")
    writer = rollup.query_id(spark, f"{scratch}/ck")
    loads = os.listdir(f"{scratch}/rollup/agg_room_daily/writer={writer}")
    assert sorted(loads) == ["load_id=0", "load_id=1", "load_id=2"]
    inc = {(r["event_date"], r["room_id"]): (r["coins"], r["gifts"], r["comments"], r["users"])
           for r in rollup.merged(states).collect()}
    whole = decode(spark.read.text(indir).select(F.col("value").alias("json")))
    batch = {(r["event_date"], r["room_id"]): (r["coins"], r["gifts"], r["comments"], r["users"])
             for r in rollup.merged(rollup.event_states(whole)).collect()}
    assert inc == batch
    # replaying batch 1 rewrites its own partitions only
    rollup.write_batch(decode(spark.read.text(f"{indir}/events-001.json").select(
        F.col("value").alias("json"))), 1, f"{scratch}/rollup",
        rollup.query_id(spark, f"{scratch}/ck"))
    again = {(r["event_date"], r["room_id"]): (r["coins"], r["gifts"], r["comments"], r["users"])
             for r in rollup.merged(state_store.read(spark, f"{scratch}/rollup")).collect()}
    assert again == batch


def test_aggregate_columns(spark):
    df = decode(spark.createDataFrame([(json.dumps(_event(1, _ts("00:05"))),)], "json string"))
    assert room_windows(df).columns == ["window_start", "window_end", "room_id", "unique_viewers",
                                     "events", "gifts", "coins", "comments", "last_ingest_ts",
                                     "viewers_sketch", "day"]


def test_corrupt_lines_reach_lake_not_staging_or_windows(spark, scratch):
    from roomstar.plans.warehouse import staging
    indir = f"{scratch}/in"
    good = [_event(1, _ts("00:05")), _event(2, _ts("02:00"))]
    _write_batches(indir, [good + ["{broken", "null"]])
    src = decode(file_stream(spark, indir))
    raw_q = job.start_raw_sink(src, f"{scratch}/lake", f"{scratch}/ck1", available_now=True)
    agg_q = job.start_metrics_sink(src, f"{scratch}/out", f"{scratch}/ck2", available_now=True)
    raw_q.awaitTermination()
    agg_q.awaitTermination()
    lake = spark.read.parquet(f"{scratch}/lake")
    assert lake.count() == 4 and undecodable(lake).count() == 2
    assert staging(lake).count() == 2
    out = spark.read.parquet(f"{scratch}/out")
    assert out.agg(F.sum("events")).first()[0] == 1  # only window 00:00 is released


def test_window_coins_stay_null_without_values(spark, scratch):
    e = _event(1, _ts("00:05"))
    e.pop("coins")
    _write_batches(f"{scratch}/in", [[e, _event(2, _ts("02:00"))]])
    q = job.start_metrics_sink(decode(file_stream(spark, f"{scratch}/in")), f"{scratch}/out",
                               f"{scratch}/ck", available_now=True)
    q.awaitTermination()
    row = spark.read.parquet(f"{scratch}/out").first()
    assert row["events"] == 1 and row["coins"] is None


def test_windows_with_rocksdb_state(spark, scratch):
    old = spark.conf.get("spark.sql.streaming.stateStore.providerClass", None)
    job.use_rocksdb_state(spark)
    try:
        batches = [[_event(1, _ts("00:05"))], [_event(2, _ts("02:00"))], [_event(3, _ts("02:10"))],
                   [_event(4, _ts("00:06")), _event(5, _ts("02:20"))]]
        got, dropped = _run_windows(spark, scratch, batches)
        assert got["00:00"] == 1 and dropped == 1
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
        if old:
            spark.conf.set("spark.sql.streaming.stateStore.providerClass", old)


def test_state_is_in_rocksdb_off_local_mode_unless_set():
    from types import SimpleNamespace

    class Conf(dict):
        def set(self, key, value):
            self[key] = value

    def provider(master, **conf):
        spark = SimpleNamespace(sparkContext=SimpleNamespace(master=master), conf=Conf(conf))
        job.default_state_store(spark)
        return spark.conf.get(job.PROVIDER)

    assert provider("yarn") == provider("spark://h:1") == job.ROCKSDB
    assert provider("local[8]") is None
    assert provider("yarn", **{job.PROVIDER: "own"}) == "own"


def test_sliced_replay_equals_one_batch(spark, scratch):
    from conftest import SF001
    from roomstar.sources.lake import fixture_events
    from roomstar.streaming.replay import replay
    ev = fixture_events(spark, SF001)
    assert replay(ev, f"{scratch}/one") == 0
    assert replay(ev, f"{scratch}/four", rows_per_batch=300) == 0
    assert len([p for p in os.listdir(f"{scratch}/four/_slices") if p.startswith("_slice=")]) == 4
    for sub in ["lake", "room_metrics"]:
        # a sketch's bytes depend on the order of its rows; its estimate is a column beside it
        a = spark.read.parquet(f"{scratch}/one/{sub}").drop("viewers_sketch")
        b = spark.read.parquet(f"{scratch}/four/{sub}").drop("viewers_sketch")
        assert a.count() == b.count() > 0 and a.exceptAll(b).count() == 0
    ra = rollup.merged(state_store.read(spark, f"{scratch}/one/rollup"))
    rb = rollup.merged(state_store.read(spark, f"{scratch}/four/rollup"))
    assert ra.exceptAll(rb).count() == 0 and rb.exceptAll(ra).count() == 0


def test_replay_slices_split_a_burst(spark):
    from roomstar.streaming.replay import with_slices
    # a third of the events fall inside one minute; the rest spread over a day
    rows = [(i, f"2024-01-01 00:00:{i % 60:02d}") for i in range(3000)]
    rows += [(3000 + i, f"2024-01-01 {1 + i // 261:02d}:{(i // 5) % 60:02d}:00") for i in range(6000)]
    df = spark.createDataFrame(rows, "id long, ts string").select(
        "id", F.to_timestamp("ts").alias("event_ts"))
    sizes = [r["count"] for r in with_slices(df, 6).groupBy("_slice").count().collect()]
    assert len(sizes) == 6 and max(sizes) < 2 * 9000 / 6


def test_a_repeated_replay_adds_nothing(spark, scratch):
    from conftest import SF001
    from roomstar.sources.lake import fixture_events
    from roomstar.streaming.replay import replay
    ev = fixture_events(spark, SF001)
    for _ in range(2):
        assert replay(ev, scratch, rows_per_batch=500) == 0
    assert spark.read.parquet(f"{scratch}/lake").count() == ev.count()


def test_a_replay_writes_a_slice_anew_whose_write_has_not_committed(spark, scratch):
    from conftest import SF001
    from roomstar.sinks.events import write_ndjson
    from roomstar.sources.lake import fixture_events
    from roomstar.streaming.replay import replay
    ev = fixture_events(spark, SF001)
    write_ndjson(ev.limit(10), f"{scratch}/in/slice=0")
    for name in ("_SUCCESS", "._SUCCESS.crc"):
        os.remove(f"{scratch}/in/slice=0/{name}")
    assert replay(ev, scratch) == 0
    assert spark.read.parquet(f"{scratch}/lake").count() == ev.count()


def test_a_replay_is_taken_up_by_another_session(spark, scratch):
    from conftest import SF001
    from roomstar.queries import resumed_windows, stream_replay
    got = resumed_windows(spark, SF001)
    whole = spark.read.parquet(f"{stream_replay(spark, SF001)}/room_metrics")
    assert got.count() == whole.count() > 0
    assert got.agg(F.sum("events")).first()[0] == whole.agg(F.sum("events")).first()[0]


def test_newest_windows_read_the_newest_days_only(spark):
    from conftest import SF001
    from roomstar.plans import reports
    from roomstar.queries import _metrics, stream_replay
    metrics = _metrics(spark, stream_replay(spark, SF001))
    plan = reports.realtime_latest(metrics)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan
    want = (metrics.orderBy(F.desc("window_start"), F.desc_nulls_last("coins"), "room_id").limit(70)
            .select("window_start", "room_id").collect())
    got = reports.realtime_latest(metrics, 70).select("window_start", "room_id").collect()
    assert got == want and reports.newest_days(metrics, 70).select("day").distinct().count() < 30
    assert reports.newest_days(metrics, 10**9).count() == metrics.count()
    assert reports.realtime_latest(metrics.where("false")).count() == 0


def test_viewers_of_a_span_come_from_the_sink_alone(spark, scratch):
    from roomstar.plans import reports
    batches = [[_event(i, _ts(f"{i % 50:02d}:{i % 60:02d}"), user=f"user_{i % 9:06d}") for i in range(90)],
               [_event(900, "2024-01-01T09:00:00Z")]]
    _write_batches(f"{scratch}/in", batches)
    src = decode(file_stream(spark, f"{scratch}/in", files_per_trigger=1))
    job.start_metrics_sink(src, f"{scratch}/out", f"{scratch}/ck", available_now=True).awaitTermination()
    metrics = spark.read.parquet(f"{scratch}/out")
    hours = reports.viewers_by_hour(metrics).collect()
    assert sum(r["events"] for r in hours) == metrics.agg(F.sum("events")).first()[0]
    assert max(r["viewers"] for r in hours) == 9 < metrics.agg(F.sum("unique_viewers")).first()[0]


def test_a_failing_start_leaves_no_query_running(spark, scratch):
    import pytest
    _write_batches(f"{scratch}/in", [[_event(1, _ts("00:05"))]])
    src = decode(file_stream(spark, f"{scratch}/in"))

    def fails():
        raise RuntimeError("cannot start")

    with pytest.raises(RuntimeError, match="cannot start"):
        job.run(src, f"{scratch}/lake", f"{scratch}/out", f"{scratch}/ck", trigger="1 second", seconds=30,
                also=[fails])
    assert spark.streams.active == []
