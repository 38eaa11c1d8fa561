"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Warehouse queries serve from a published build made once per session and input folder,
the way a dashboard serves from the last nightly build; the build itself reads the whole
``events`` table through the fixture adapter.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roomstar.functions.types import ntz_times
from roomstar.plans import quality, reports, serving, warehouse
from roomstar.operators import sketches
from roomstar.operators.joins import maybe_broadcast
from roomstar.schema import ARRIVAL_SLICES, ARRIVAL_WATERMARK, FACT, METRICS_SCHEMA, WINDOW
from roomstar.session import configure, partitions_for, work_dir
from roomstar.sinks import states as state_store
from roomstar.sinks.events import to_json_lines
from roomstar.sources.lake import driver_table, fixture_events, read_lake, read_parquet_dir
from roomstar.sources.stream import decode
from roomstar.streaming import rollup as stream_rollup
from roomstar.streaming.replay import replay as stream_replay_run
from roomstar.streaming.job import use_rocksdb_state
from roomstar.streaming.replay import replay_slices, with_slices

_BUILDS: dict[tuple[str, str], warehouse.Warehouse] = {}


def _key(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    return spark.sparkContext.applicationId, os.path.abspath(sf_dir)


def _tag(sf_dir: str) -> str:
    return hashlib.sha1(os.path.abspath(sf_dir).encode()).hexdigest()[:12]


def warehouse_for(spark: SparkSession, sf_dir: str) -> warehouse.Warehouse:
    configure(spark)
    key = _key(spark, sf_dir)
    if key not in _BUILDS:
        base = work_dir(spark, "warehouse", _tag(sf_dir))
        warehouse.build(spark, fixture_events(spark, sf_dir), base)
        _BUILDS[key] = warehouse.latest(spark, base)  # as another process would open it
    return _BUILDS[key]


_SERVING: dict[tuple[str, str], serving.Serving] = {}
_ORDERS: dict[tuple[str, str], str] = {}

# The order-date window of the month-pruning query (inclusive ISO dates).
ORDERS_WINDOW = ("1996-03-15", "1996-09-10")


def serving_for(spark: SparkSession, sf_dir: str) -> serving.Serving:
    key = _key(spark, sf_dir)
    if key not in _SERVING:
        wh = warehouse_for(spark, sf_dir)
        base = work_dir(spark, "serving", _tag(sf_dir))
        serving.load(wh, base)
        _SERVING[key] = serving.latest(spark, base)
    return _SERVING[key]


def orders_layout(spark: SparkSession, sf_dir: str) -> str:
    configure(spark)
    key = _key(spark, sf_dir)
    if key not in _ORDERS:
        path = work_dir(spark, "orders_by_month", _tag(sf_dir))
        serving.write_orders_by_month(driver_table(spark, sf_dir, "orders"), path)
        _ORDERS[key] = path
    return _ORDERS[key]


_STREAMS: dict[tuple[str, str], str] = {}


def stream_replay(spark: SparkSession, sf_dir: str) -> str:
    """Replay the fixture events through the real-time layer once, in event-time slices of
    bounded size; see streaming/replay.py."""
    configure(spark)
    key = _key(spark, sf_dir)
    if key not in _STREAMS:
        base = work_dir(spark, "stream", _tag(sf_dir))
        stream_replay_run(fixture_events(spark, sf_dir), base)
        _STREAMS[key] = base
    return _STREAMS[key]


def _metrics(spark: SparkSession, base: str) -> DataFrame:
    return read_parquet_dir(spark, f"{base}/room_metrics", METRICS_SCHEMA, required=False)


def _lake_between(spark: SparkSession, base: str, windows: DataFrame) -> DataFrame:
    """The lake's events in the time span of some windows (pushed down to its files)."""
    span = windows.agg(F.min("window_start").alias("lo"), F.max("window_end").alias("hi")).first()
    ts = F.col("event_ts")
    return read_lake(spark, f"{base}/lake").where((ts >= F.lit(span["lo"])) & (ts < F.lit(span["hi"])))


def checked_windows(spark: SparkSession, sf_dir: str, metrics=lambda df: df) -> DataFrame:
    """``metrics`` of the window sink, with the exact viewers counted from the lake, and whether
    the sink's estimate is near them."""
    base = stream_replay(spark, sf_dir)
    found = metrics(_metrics(spark, base)).drop("viewers_sketch", "day").withColumnRenamed("unique_viewers", "_estimate")
    exact = (_lake_between(spark, base, found).groupBy(F.window("event_ts", WINDOW), "room_id")
             .agg(F.countDistinct("user_id").alias("unique_viewers"))
             .select(F.col("window.start").alias("window_start"), F.col("room_id").alias("_room"), "unique_viewers"))
    near = sketches.within_tolerance("_estimate", "unique_viewers")
    same_room = F.col("_room").eqNullSafe(F.col("room_id"))
    return ntz_times(found.join(exact, [found.window_start == exact.window_start, same_room])
                     .drop(exact.window_start).withColumn("estimate_ok", near).drop("_room", "_estimate"))


def hourly_viewers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Viewers per (hour, room) merged from the sink's sketches, with the exact number of the lake."""
    base = stream_replay(spark, sf_dir)
    metrics = _metrics(spark, base)
    found = reports.viewers_by_hour(metrics).withColumnRenamed("viewers", "_estimate")
    exact = (_lake_between(spark, base, metrics).groupBy(F.date_trunc("hour", "event_ts").alias("_hour"), F.col("room_id").alias("_room"))
             .agg(F.countDistinct("user_id").alias("viewers")))
    same = (F.col("_hour") == F.col("hour")) & F.col("_room").eqNullSafe(F.col("room_id"))
    return ntz_times(found.join(exact, same).withColumn("estimate_ok", sketches.within_tolerance("_estimate", "viewers"))
                     .drop("_hour", "_room", "_estimate"))


def resumed_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A replay that stops after half of its slices and is taken up again by another session,
    with the state in RocksDB."""
    configure(spark)
    base = work_dir(spark)
    events = fixture_events(spark, sf_dir)
    sliced = lambda: with_slices(events, 4)
    for session, upto in ((spark.newSession(), 2), (spark.newSession(), 4)):
        use_rocksdb_state(configure(session))
        replay_slices(session, sliced, base, upto=upto)
    return ntz_times(_metrics(spark, base)).drop("unique_viewers", "viewers_sketch", "day")


def arrival_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events in the order of their ``ingest_ts``, in slices of equal time, under a watermark
    shorter than the lags; ``dropped`` is the number of rows that came too late, over all slices."""
    configure(spark)
    base = work_dir(spark)
    events = fixture_events(spark, sf_dir)
    came = F.unix_micros("ingest_ts")

    def sliced() -> DataFrame:
        lo, hi = events.agg(F.min(came), F.max(came)).first()
        width = max(1, (hi - lo) // ARRIVAL_SLICES) if lo is not None else 1
        cut = F.least(F.floor((came - F.lit(lo or 0)) / F.lit(width)), F.lit(ARRIVAL_SLICES - 1))
        return events.withColumn("_slice", F.coalesce(cut, F.lit(0)).cast("int"))

    dropped = replay_slices(spark, sliced, base, watermark=ARRIVAL_WATERMARK)
    return ntz_times(_metrics(spark, base)).select(
        "window_start", "window_end", "room_id", "events", "gifts", "coins", "comments", F.lit(dropped).cast("long").alias("dropped"))


def multi_load_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R10 and K5 over many loads: the detail arrives in three loads, of which the second is sent
    again with only a part of its rows and then as a whole; sums and exact users are merged from the states."""
    rows = serving_for(spark, sf_dir).detail()
    part = F.pmod(F.xxhash64("room_id", "user_id"), F.lit(3))
    with partitions_for(spark, warehouse_for(spark, sf_dir).rows[FACT]):
        s = serving.refresh(spark, rows.where(part == 0), work_dir(spark))
        serving.append(s, rows.where(part == 1), 1)
        serving.append(s, rows.where((part == 1) & (F.col("coins") > 0)), 1)
        serving.append(s, rows.where(part == 1), 1)
        serving.append(s, rows.where(part == 2), 2)
    merged = stream_rollup.merged(s.rollup()).withColumnRenamed("users", "_estimate")
    return _with_check(merged.join(serving.exact_users(s, "event_date", "room_id"), ["event_date", "room_id"]))


def _with_check(df: DataFrame) -> DataFrame:
    """``_estimate`` replaced by whether it is near the exact ``users``."""
    return df.withColumn("estimate_ok", sketches.within_tolerance("_estimate", "users")).drop("_estimate")


def _exact_users(found: DataFrame, exact: DataFrame, *keys: str) -> DataFrame:
    """A serving query's rows with the exact users of the bitmaps, and the flag of its estimate."""
    exact = exact.select(*[F.col(k).alias(f"_{k}") for k in keys], "users")
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return _with_check(found.withColumnRenamed("users", "_estimate").join(exact, same)
                       .drop(*[f"_{k}" for k in keys]))


def _users_by(*keys: str):
    return lambda s: serving.exact_users(s, *keys)


def incremental_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = stream_replay(spark, sf_dir)
    exact = (warehouse.staging(read_lake(spark, f"{base}/lake")).where("room_id IS NOT NULL")
             .groupBy(F.to_date("event_ts").alias("event_date"), "room_id")
             .agg(F.countDistinct("user_id").alias("users")))
    found = stream_rollup.merged(state_store.read(spark, f"{base}/rollup"))
    return _with_check(found.withColumnRenamed("users", "_estimate").join(exact, ["event_date", "room_id"]))


def lake_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S4 hand-over: a warehouse built from the streamed lake, its fact with natural keys."""
    wh = warehouse.build(spark, read_lake(spark, f"{stream_replay(spark, sf_dir)}/lake"), work_dir(spark))
    f = wh.table("fact_live_engagement").drop("avg_ingest_lag_s")
    for dim, key, cols in (("dim_room", "room_key", ["room_id"]), ("dim_user", "user_key", ["user_id", "country"]),
                           ("dim_gift", "gift_key", ["gift_name", "gift_tier"])):
        f = f.join(maybe_broadcast(wh.table(dim).select(key, *cols), wh.rows[dim]), key).drop(key)
    return f


def json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6 encode + S3 decode of every event (batch)."""
    configure(spark)
    return ntz_times(decode(to_json_lines(fixture_events(spark, sf_dir)), "value"))


def dq_report(spark: SparkSession, sf_dir: str, broken: bool = False) -> DataFrame:
    wh = warehouse_for(spark, sf_dir)
    stg, fact = wh.table("stg_events"), wh.table("fact_live_engagement")
    if broken:
        stg, fact = quality.inject_faults(stg, fact)
    return quality.quality_report(stg, fact, wh.dims(), wh.rows)


def orphan_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    wh = warehouse_for(spark, sf_dir)
    _, fact = quality.inject_faults(wh.table("stg_events"), wh.table("fact_live_engagement"))
    return quality.orphan_rows(fact, wh.dims(), wh.rows)


def _serve(fn) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf: fn(serving_for(spark, sf))


def _model(name: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf: warehouse_for(spark, sf).table(name)


def _report(fn) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf: fn(warehouse_for(spark, sf))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    **{m: _model(m) for m in ["stg_events", "dim_date", "dim_room", "dim_user", "dim_gift",
                              "fact_live_engagement"]},
    "model_row_counts": lambda spark, sf: warehouse_for(spark, sf).row_counts(),
    "model_rows_text": _report(reports.model_rows_text),
    "headline": _report(reports.headline),
    "engagement_mix": _report(reports.engagement_mix),
    "avg_ingest_lag": _report(reports.avg_ingest_lag),
    "top_rooms": _report(reports.top_rooms),
    "top_rooms_brief": _report(reports.top_rooms_brief),
    "top_rooms_ranked": _report(reports.top_rooms_ranked),
    "gift_mix": _report(reports.gift_mix),
    "by_country": _report(reports.by_country),
    "dq_report": dq_report,
    "dq_report_broken": lambda spark, sf: dq_report(spark, sf, broken=True),
    "orphan_rows": orphan_rows,
    "olap_detail": _serve(lambda s: s.detail().select(*serving.DETAIL_COLUMNS, "ym")),
    "olap_revenue_by_tier": _serve(serving.revenue_by_tier),
    "olap_top_rooms": _serve(lambda s: _exact_users(serving.top_rooms(s), _users_by("room_id")(s), "room_id")),
    "olap_country": _serve(lambda s: _exact_users(serving.country_breakdown(s), serving.country_exact(s), "country")),
    "olap_country_exact": _serve(serving.country_exact),
    "room_daily_rollup": _serve(lambda s: _exact_users(
        serving.daily_rollup(s), _users_by("event_date", "room_id")(s), "event_date", "room_id")),
    "rollup_multi_load": multi_load_rollup,
    "olap_running_total": _serve(serving.running_total),
    "olap_running_total_first10": _serve(lambda s: serving.running_total(s, 10)),
    "rollup_reconcile": _serve(serving.rollup_reconcile),
    "partition_rows": _serve(serving.partition_rows),
    "partition_bytes": _serve(lambda s: serving.partition_bytes(s).select(
        "ym", "rows", (F.col("files") >= 1).alias("has_files"), (F.col("bytes") > 0).alias("has_bytes"))),
    "month_pruned_orders": lambda spark, sf: serving.orders_window_summary(
        spark, orders_layout(spark, sf), *ORDERS_WINDOW),
    "stream_raw_append": lambda spark, sf: ntz_times(read_lake(spark, f"{stream_replay(spark, sf)}/lake")),
    "stream_room_windows": checked_windows,
    "realtime_latest": lambda spark, sf: checked_windows(spark, sf, reports.realtime_latest),
    "stream_incremental_rollup": incremental_rollup,
    "stream_late_drop": arrival_windows,
    "stream_resume": resumed_windows,
    "viewers_by_hour": hourly_viewers,
    "lake_fact": lake_fact,
    "json_roundtrip": json_roundtrip,
}
