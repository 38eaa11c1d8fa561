"""The end-to-end pipeline: events -> stream -> lake -> warehouse -> gate -> serving.

Every step hands over through Parquet folders, so each can run as its own scheduled job.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from roomstar.plans import serving, warehouse
from roomstar.schema import FILES_PER_TRIGGER, TRIGGER, WATERMARK, WINDOW
from roomstar.sinks.events import write_ndjson
from roomstar.sources.lake import fixture_events, read_lake
from roomstar.sources.stream import decode, file_stream, kafka_stream
from roomstar.streaming import job, rollup


@dataclass
class Paths:
    root: str

    def __post_init__(self):
        self.root = self.root.rstrip("/")

    @property
    def inbox(self): return f"{self.root}/raw"            # NDJSON events
    @property
    def lake(self): return f"{self.root}/lake/events"      # raw sink
    @property
    def metrics(self): return f"{self.root}/lake/room_metrics"
    @property
    def rollup(self): return f"{self.root}/lake/room_daily_stream"
    @property
    def checkpoints(self): return f"{self.root}/checkpoints"
    @property
    def warehouse(self): return f"{self.root}/warehouse"
    @property
    def serving(self): return f"{self.root}/serving"


def produce(spark: SparkSession, sf_dir: str, outdir: str) -> None:
    """Write the fixture events as NDJSON files (the stand-in for the live producer)."""
    write_ndjson(fixture_events(spark, sf_dir), outdir)


def source(spark: SparkSession, kind: str = "file", indir: str | None = None,
           bootstrap: str | None = None, files_per_trigger: int | None = FILES_PER_TRIGGER,
           starting_offsets: str = "latest", max_offsets_per_trigger: int | None = None) -> DataFrame:
    if kind == "kafka":
        return decode(kafka_stream(spark, bootstrap, starting_offsets=starting_offsets,
                                   max_offsets_per_trigger=max_offsets_per_trigger))
    return decode(file_stream(spark, indir, files_per_trigger))


def stream(events: DataFrame, p: Paths, window: str = WINDOW, watermark: str = WATERMARK,
           trigger: str = TRIGGER, seconds: float | None = None,
           available_now: bool = False, with_rollup: bool = True) -> job.StreamRun:
    """Raw sink + windowed sink (+ per-batch rollup) over one source."""
    also = [lambda: rollup.start(events, p.rollup, f"{p.checkpoints}/rollup", trigger, available_now)]
    return job.run(events, p.lake, p.metrics, p.checkpoints, window, watermark, trigger, seconds,
                   available_now, also if with_rollup else None)


def build_warehouse(spark: SparkSession, p: Paths, gate: bool = True) -> warehouse.Warehouse:
    """Star schema from the raw lake (a missing lake is an error, not an empty build)."""
    return warehouse.build(spark, read_lake(spark, p.lake), p.warehouse, gate)


def load_serving(spark: SparkSession, p: Paths) -> serving.Serving:
    return serving.load(warehouse.latest(spark, p.warehouse), p.serving)


def run_all(spark: SparkSession, sf_dir: str, root: str) -> dict:
    """Replay the fixture through every layer; returns the handles of each layer."""
    p = Paths(root)
    produce(spark, sf_dir, p.inbox)
    run = stream(source(spark, "file", p.inbox, files_per_trigger=None), p, available_now=True)
    wh = build_warehouse(spark, p)
    sv = load_serving(spark, p)
    return {"paths": p, "stream": run, "warehouse": wh, "serving": sv}
