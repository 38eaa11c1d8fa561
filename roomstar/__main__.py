"""Command line: ``python -m roomstar <command> ...``.

    produce    --sf DIR --root DIR              fixture events -> NDJSON files
    stream     --root DIR [--source kafka --bootstrap HOST:PORT] [--seconds N | --available-now]
    warehouse  --root DIR                       build + quality gate (exit 1 on failure)
    serve      --root DIR                       serving layout, rollup, serving queries
    report     --root DIR                       dashboard tiles and the quality panel
    fold       --root DIR --to DIR              the streamed rollup's loads as one load elsewhere
    lineage    [--column NAME] [--json]         lineage, impact, catalog gaps
    all        --sf DIR --root DIR              every step above, in order
"""

from __future__ import annotations

import argparse
import sys

from roomstar.schema import WATERMARK, WINDOW


def _spark(args):
    from roomstar.session import build_session
    extra = {"spark.checkpoint.dir": args.checkpoint_dir} if args.checkpoint_dir else None
    return build_session(args.master, extra=extra)


def _show(title, df, n=50):
    """Print a report whole; ``n`` is only where counting its rows would be dearer."""
    print(f"\n--- {title} ---")
    df.show(max(n, df.count()), truncate=False)


def cmd_serve_queries(sv):
    from roomstar.plans import serving as S
    _show("partitions", S.partition_bytes(sv))
    _show("revenue by gift tier", S.revenue_by_tier(sv))
    _show("top rooms by coins", S.top_rooms(sv))
    _show("country breakdown", S.country_breakdown(sv))
    _show("daily rollup (merged states)", S.daily_rollup(sv))
    _show("running total per room", S.running_total(sv, 10))


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="roomstar")
    ap.add_argument("--master", default=None)
    ap.add_argument("--checkpoint-dir", default=None)
    sub = ap.add_subparsers(dest="cmd", required=True)
    for name in ["produce", "stream", "warehouse", "serve", "report", "all"]:
        p = sub.add_parser(name)
        p.add_argument("--root", required=True)
        if name in ("produce", "all"):
            p.add_argument("--sf", required=True)
        if name == "stream":
            p.add_argument("--source", choices=["file", "kafka"], default="file")
            p.add_argument("--bootstrap", default="localhost:9092")
            p.add_argument("--seconds", type=float, default=90)
            p.add_argument("--available-now", action="store_true")
            p.add_argument("--window", default=WINDOW)
            p.add_argument("--watermark", default=WATERMARK)
            p.add_argument("--rocksdb", action="store_true", help="RocksDB state store")
            p.add_argument("--starting-offsets", default="latest")
            p.add_argument("--max-offsets", type=int, default=None, help="Kafka records per trigger")
    fp = sub.add_parser("fold")
    fp.add_argument("--root", required=True)
    fp.add_argument("--to", required=True)
    lp = sub.add_parser("lineage")
    lp.add_argument("--column", action="append", help="show what derives from it (repeatable)")
    lp.add_argument("--json", action="store_true")
    args = ap.parse_args(argv)

    spark = _spark(args)
    from roomstar.plans import quality, reports, runner, warehouse
    if args.cmd == "lineage":
        from roomstar.plans import governance as g
        from roomstar.schema import MODELS
        edges = g.lineage_edges(spark)
        for column in args.column or []:
            if args.json:
                print(g.impact_json(edges, column).first()["json"])
            else:
                _show(f"columns derived from {column}", g.impact_one_hop(edges, column))
        if args.column:
            return 0
        models = spark.createDataFrame([(m,) for m in MODELS], "model string")
        gaps = g.catalog_gaps(models, g.catalog_table(spark))
        if args.json:
            print(g.governance_json(g.lineage_leaves(edges), gaps).first()["json"])
            return 0
        _show("column lineage", g.lineage_leaves(edges).orderBy("model", "column"), 100)
        _show("catalog gaps", gaps)
        return 0

    p = runner.Paths(args.root)
    if args.cmd == "fold":
        from roomstar.sinks import states
        states.fold(spark, p.rollup, args.to)
        print(f"rollup folded into {args.to}")
    elif args.cmd == "produce":
        runner.produce(spark, args.sf, p.inbox)
    elif args.cmd == "stream":
        if args.rocksdb:
            from roomstar.streaming.job import use_rocksdb_state
            use_rocksdb_state(spark)
        src = runner.source(spark, args.source, p.inbox, args.bootstrap,
                            starting_offsets=args.starting_offsets,
                            max_offsets_per_trigger=args.max_offsets)
        run = runner.stream(src, p, args.window, args.watermark, seconds=args.seconds,
                              available_now=args.available_now)
        print(f"late rows dropped: {run.dropped}")
    elif args.cmd in ("warehouse", "all"):
        if args.cmd == "all":
            out = runner.run_all(spark, args.sf, args.root)
            wh = out["warehouse"]
        else:
            try:
                wh = runner.build_warehouse(spark, p)
            except warehouse.QualityGateError as err:
                print(err)
                return 1
        _show("model rows", wh.row_counts())
        _show("data quality", wh.table("_quality"))
        if args.cmd == "all":
            cmd_serve_queries(out["serving"])
    elif args.cmd == "serve":
        cmd_serve_queries(runner.load_serving(spark, p))
    elif args.cmd == "report":
        wh = warehouse.latest(spark, p.warehouse)
        _show("headline", reports.headline(wh))
        _show("top rooms", reports.top_rooms(wh))
        _show("engagement mix", reports.engagement_mix(wh))
        _show("by country", reports.by_country(wh))
        _show("gift revenue mix", reports.gift_mix(wh))
        from roomstar.schema import METRICS_SCHEMA
        from roomstar.sources.lake import read_parquet_dir
        rt = read_parquet_dir(spark, p.metrics, METRICS_SCHEMA, required=False)
        _show("real-time windows", reports.realtime_latest(rt))
        rep = wh.table("_quality")
        _show("data quality", rep)
        _show("checks passing", quality.passing(rep))
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
