"""Replay a closed table of events through the real-time layer, slice by slice.

The events are cut into k slices by a time column (event time by default). Slice i is encoded as
NDJSON into its own folder below the watched one, then the raw sink, the window sink and the
rollup run until that slice is consumed (``availableNow``); state carries over in their
checkpoints. In event-time order nothing is late, the window state only holds windows near the
current slice, and the result equals one batch over all events: every window ending at or
before max(event time) - watermark. In arrival order, rows of windows that the watermark has
passed by the end of the slice before are dropped.

Slices are cut at approximate quantiles, so a burst that holds a third of all events is spread
over many slices (only events sharing one timestamp stay together). The k-1 cut points are the
only values that reach the driver. Sliced rows are staged once, and a slice whose write has
committed is not written again: a replay that is run again after a failure, or repeated, neither
cuts nor writes a slice twice.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roomstar.schema import WATERMARK, WINDOW
from roomstar.sinks.events import write_ndjson
from roomstar.sinks.files import committed
from roomstar.sources.stream import decode, file_stream
from roomstar.streaming import job, rollup

ROWS_PER_BATCH = 500_000_000


def slice_count(rows: int, rows_per_batch: int) -> int:
    return max(1, math.ceil(rows / rows_per_batch))


def slice_of(micros: Column, cuts: list[int]) -> Column:
    """Number of cut points <= micros, by binary search written as nested conditions (0 for
    null)."""
    def within(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(micros < F.lit(cuts[mid]), within(lo, mid)).otherwise(within(mid + 1, hi))
    return F.when(micros.isNull(), F.lit(0)).otherwise(within(0, len(cuts)))


def with_slices(events: DataFrame, k: int, by: str = "event_ts") -> DataFrame:
    """Column ``_slice`` in 0..k-1 at approximate quantiles of a time column."""
    t = F.unix_micros(F.col(by))
    probs = [i / k for i in range(1, k)]
    cuts = events.agg(F.percentile_approx(t, probs, 10_000).alias("q")).first()["q"] if probs else None
    return events.withColumn("_slice", slice_of(t, sorted(set(cuts or []))))


def replay(events: DataFrame, base: str, rows_per_batch: int | None = None) -> int:
    """Run the three real-time queries over ``events`` in event-time order under ``base``
    (folders in/, lake/, room_metrics/, rollup/, _checkpoints/). Returns rows dropped as late
    (0, as the slices are in order)."""
    spark = events.sparkSession
    per = rows_per_batch or int(spark.conf.get("roomstar.replay.rowsPerBatch", str(ROWS_PER_BATCH)))
    return replay_slices(spark, lambda: with_slices(events, slice_count(events.count(), per)), base)


def replay_slices(spark, sliced, base: str, window: str = WINDOW, watermark: str = WATERMARK,
                  upto: int | None = None) -> int:
    """Run the queries over ``sliced()`` (events with ``_slice``), one slice after another; only
    slices below ``upto`` if given. What an earlier call has consumed is not read again."""
    staged = f"{base}/_slices"
    if not committed(spark, staged):
        sliced().write.mode("overwrite").partitionBy("_slice").parquet(staged)
    part = spark.read.parquet(staged)
    numbers = sorted(r["_slice"] for r in part.select("_slice").distinct().collect() if upto is None or r["_slice"] < upto)
    dropped = 0
    for i in numbers:
        folder = f"{base}/in/slice={i}"
        if not committed(spark, folder):
            write_ndjson(part.where(F.col("_slice") == i).drop("_slice"), folder, "overwrite")
        src = decode(file_stream(spark, f"{base}/in", files_per_trigger=None, nested=True))
        dropped += job.run(
            src, f"{base}/lake", f"{base}/room_metrics", f"{base}/_checkpoints", window, watermark,
            available_now=True,
            also=[lambda: rollup.start(src, f"{base}/rollup", f"{base}/_checkpoints/rollup",
                                       available_now=True)]).dropped
    return dropped
