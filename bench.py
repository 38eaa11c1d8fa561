"""Benchmark: build the pipeline once at $BENCH_SF_DIR, then time the serving queries.

Prints one JSON line: {"metric", "value", "unit", "queries": {name: sec}, "sf", ...}.
every other query and each pipeline stage is reported alongside.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
RUNS = int(os.environ.get("BENCH_RUNS", "5"))

HEADLINE = ["olap_revenue_by_tier", "olap_top_rooms", "olap_country", "room_daily_rollup",
            "olap_running_total_first10"]


def _sf(path: str) -> float | str:
    tail = os.path.basename(path.rstrip("/"))
    try:
        return float(tail.replace("sf", ""))
    except ValueError:
        return tail


def _consume(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    from roomstar import queries as Q
    from roomstar.plans import serving
    from roomstar.session import build_session

    spark = build_session(f"local[{CPUS}]", app="roomstar-bench", shuffle_partitions=CPUS,
                          extra={"spark.driver.memory": "16g"})
    times: dict[str, float] = {}

    def stage(name, fn):
        t0 = time.perf_counter()
        out = fn()
        times[name] = round(time.perf_counter() - t0, 4)
        return out

    # JVM warm-up unrelated to the data (class loading, first-job setup), so stage times
    # measure the pipeline rather than process start-up.
    spark.range(100_000).selectExpr("id % 97 AS k", "id").groupBy("k").count().collect()

    # Pipeline stages, each once (cold): warehouse build + quality gate, serving load,
    # orders layout, and the streaming replay (NDJSON encode + both sinks + rollup).
    stage("stage_warehouse_build", lambda: Q.warehouse_for(spark, SF_DIR))
    stage("stage_serving_load", lambda: Q.serving_for(spark, SF_DIR))
    stage("stage_orders_layout", lambda: Q.orders_layout(spark, SF_DIR))
    stage("stage_stream_replay", lambda: Q.stream_replay(spark, SF_DIR))

    # The five published queries are timed as the reference runs them; the registered forms of
    # three of them also count users exactly, to check the estimates against the oracle.
    registry = {**Q.QUERIES, **{name: Q._serve(fn) for name, fn in {
        "olap_revenue_by_tier": serving.revenue_by_tier, "olap_top_rooms": serving.top_rooms,
        "olap_country": serving.country_breakdown, "room_daily_rollup": serving.daily_rollup,
        "olap_running_total_first10": lambda s: serving.running_total(s, 10)}.items()}}
    for slow in ("rollup_multi_load", "stream_late_drop", "stream_resume", "lake_fact"):  # each run builds anew
        registry.pop(slow)
    order = HEADLINE + [n for n in registry if n not in HEADLINE]
    for name in order:  # warm-up pass over every query: JIT, codegen and reader caches
        _consume(registry[name](spark, SF_DIR))
    for name in order:
        fn = registry[name]
        runs = []
        for _ in range(RUNS):
            t0 = time.perf_counter()
            _consume(fn(spark, SF_DIR))
            runs.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(runs), 4)

    value = round(sum(times[n] for n in HEADLINE), 4)
    events = spark.read.parquet(f"{SF_DIR}/events.parquet").count()
    throughput = {f"{k.removeprefix('stage_')}_events_per_sec": round(events / times[k])
                  for k in ("stage_warehouse_build", "stage_stream_replay")}
    print(json.dumps({"metric": "serving_5_query_total", "value": value, "unit": "sec",
                      "queries": times, "sf": _sf(SF_DIR), "cpus": CPUS, "runs": RUNS,
                      "events": events, "throughput": throughput}))
    spark.stop()


if __name__ == "__main__":
    main()
