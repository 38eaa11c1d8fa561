"""Properties from the test strategy: stream = batch when nothing is late; dense keys."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from roomstar.operators.keys import dense_keys
from roomstar.sources.stream import decode, file_stream
from roomstar.streaming import job
from test_streaming import _event, _write_batches


def test_stream_over_ordered_files_equals_batch(spark, scratch):
    base = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    events = [_event(i, (base + dt.timedelta(seconds=7 * i)).isoformat(),
                     room=f"room_{i % 4:04d}", user=f"user_{i % 9:06d}",
                     etype=["join", "comment", "gift"][i % 3], coins=5 if i % 3 == 2 else 0)
              for i in range(120)]
    batches = [events[i:i + 30] for i in range(0, 120, 30)]
    _write_batches(f"{scratch}/in", batches)
    late = job.LateRows()
    spark.streams.addListener(late)
    q, = job.supervise([lambda: job.start_metrics_sink(
        decode(file_stream(spark, f"{scratch}/in", 1)), f"{scratch}/out", f"{scratch}/ck", available_now=True)])
    assert job.settled(spark, late, q) == 0
    spark.streams.removeListener(late)
    streamed = spark.read.parquet(f"{scratch}/out")
    whole = decode(spark.read.text(f"{scratch}/in").select(F.col("value").alias("json")))
    cut = whole.agg(F.max("event_ts")).first()[0] - dt.timedelta(seconds=20)
    batch = (whole.groupBy(F.window("event_ts", "30 seconds").alias("w"), "room_id")
                  .agg(F.count(F.lit(1)).alias("events"), F.sum("coins").cast("long").alias("coins"))
                  .where(F.col("w.end") <= F.lit(cut))
                  .select(F.col("w.start").alias("window_start"), "room_id", "events", "coins"))
    a = streamed.select("window_start", "room_id", "events", "coins")
    assert a.count() == batch.count() > 0
    assert a.exceptAll(batch).count() == 0


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.sets(st.text(alphabet="abcxyz", min_size=0, max_size=4), min_size=1, max_size=40),
       st.booleans(), st.integers(min_value=1, max_value=6))
def test_dense_keys_are_rank_order(spark, keys, with_null, parts):
    rows = [(k,) for k in keys] + ([(None,)] if with_null else [])
    got = dense_keys(spark.createDataFrame(rows, "k string"), "k", "key", parts).collect()
    ordered = sorted(keys) + ([None] if with_null else [])
    assert {r["k"]: r["key"] for r in got} == {k: i + 1 for i, k in enumerate(ordered)}
