"""Star-schema warehouse over the raw event lake: staging, four dimensions, one fact.

Each model is a DataFrame function. ``build`` writes them once, in dependency order, to a
new build folder (so no model recomputes staging), checks data quality and only then
publishes the build. Readers always open the newest published build, so the six tables
they see come from one run (surrogate keys are reassigned on every build).
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.util import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roomstar.functions import indicator, seconds_between
from roomstar.operators.joins import maybe_broadcast
from roomstar.plans.dimensions import dimensions
from roomstar.schema import COMMENT, FACT, GIFT, JOIN, MODELS, NO_GIFT, STAGING
from roomstar.session import partitions_for
from roomstar.sinks.files import TARGET_ROWS_PER_FILE

# ---------------------------------------------------------------- models


def staging(raw: DataFrame) -> DataFrame:
    """Typed, defaulted events; rows without id or event time are dropped."""
    return (raw.where(F.col("event_id").isNotNull() & F.col("event_ts").isNotNull())
               .select("event_id", "event_type",
                       F.col("event_ts").cast("timestamp_ntz").alias("event_ts"),
                       F.col("ingest_ts").cast("timestamp_ntz").alias("ingest_ts"),
                       "room_id", "user_id", "country",
                       F.coalesce("gift_name", F.lit(NO_GIFT)).alias("gift_name"),
                       F.coalesce("coins", F.lit(0)).alias("coins"),
                       F.coalesce("comment_len", F.lit(0)).alias("comment_len")))


FACT_MEASURES = ["event_count", "joins", "comments", "gifts", "coins", "comment_chars",
                 "avg_ingest_lag_s"]


def fact(stg: DataFrame, dims: dict[str, DataFrame],
         rows: dict[str, int] | None = None) -> DataFrame:
    """One row per (date, room, user, gift).

    Events are aggregated on the natural keys first (partial aggregation before the
    shuffle), and only the aggregated rows are joined to the dimensions: natural and
    surrogate keys are 1:1, so this equals joining first. Rows with a null room or user
    match no dimension row and are dropped, as an inner join does.
    """
    rows = rows or {}
    grain = (stg.where(F.col("room_id").isNotNull() & F.col("user_id").isNotNull())
                .groupBy(F.to_date("event_ts").alias("full_date"), "room_id", "user_id", "gift_name")
                .agg(F.count(F.lit(1)).alias("event_count"),
                     F.sum(indicator("event_type", JOIN)).cast("long").alias("joins"),
                     F.sum(indicator("event_type", COMMENT)).cast("long").alias("comments"),
                     F.sum(indicator("event_type", GIFT)).cast("long").alias("gifts"),
                     F.sum("coins").cast("long").alias("coins"),
                     F.sum("comment_len").cast("long").alias("comment_chars"),
                     F.avg(seconds_between("event_ts", "ingest_ts")).alias("avg_ingest_lag_s")))
    link = [("dim_date", "full_date", "date_key"), ("dim_room", "room_id", "room_key"),
            ("dim_user", "user_id", "user_key"), ("dim_gift", "gift_name", "gift_key")]
    out = grain
    for name, natural, key in link:
        out = out.join(maybe_broadcast(dims[name].select(natural, key), rows.get(name)), natural)
    return out.select("date_key", "room_key", "user_key", "gift_key", *FACT_MEASURES)


# ---------------------------------------------------------------- build / publish


@dataclass
class Warehouse:
    """A published build: table paths and their row counts. A build never changes after
    publication, so each table's reader (file listing, footer schema) is made once."""
    spark: SparkSession
    path: str
    rows: dict[str, int] = field(default_factory=dict)
    _tables: dict[str, DataFrame] = field(default_factory=dict, repr=False)

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.path}/{name}")
        return self._tables[name]

    def dims(self) -> dict[str, DataFrame]:
        return {n: self.table(n) for n in ("dim_date", "dim_room", "dim_user", "dim_gift")}

    def row_counts(self) -> DataFrame:
        return self.table("_model_row_counts")


class QualityGateError(RuntimeError):
    pass


def _write(df: DataFrame, path: str, rows_per_file: int | None = None) -> None:
    w = df.write.mode("overwrite")
    if rows_per_file:
        w = w.option("maxRecordsPerFile", rows_per_file)
    w.parquet(path)


def side_by_side(spark: SparkSession, jobs: list[Callable[[], None]]) -> None:
    """Run small jobs at the same time: each alone leaves most cores idle."""
    with ThreadPoolExecutor(len(jobs)) as pool:
        for done in [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]:
            done.result()


def _rows_per_file(spark: SparkSession, rows: int) -> int:
    """File size cap for a table of at most ``rows`` rows: one file per core at small
    sizes (parallel scans), TARGET_ROWS_PER_FILE at large ones."""
    return min(TARGET_ROWS_PER_FILE, max(1, -(-rows // spark.sparkContext.defaultParallelism)))


def _count_models(spark: SparkSession, path: str) -> DataFrame:
    """Rows per model, one job (Parquet counts come from footers)."""
    parts = [spark.read.parquet(f"{path}/{m}").select(F.lit(m).alias("model"),
                                                      F.lit(i).alias("_order"))
             for i, m in enumerate(MODELS)]
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    return (union.groupBy("model", "_order").agg(F.count(F.lit(1)).alias("rows"))
                 .orderBy("_order").select("model", "rows"))


def build(spark: SparkSession, raw: DataFrame, base: str, gate: bool = True) -> Warehouse:
    """Build all six models from ``raw`` events into ``base``/builds/<id>, run the quality
    checks, publish. Raises QualityGateError (after writing the report) if a check fails."""
    from roomstar.plans.quality import quality_report

    build_id = f"{int(time.time() * 1000):015d}-{uuid.uuid4().hex[:8]}"
    path = f"{base.rstrip('/')}/builds/{build_id}"
    events = raw.count()  # from Parquet footers
    cap = _rows_per_file(spark, events)
    wh = Warehouse(spark, path)
    with partitions_for(spark, events):
        _write(staging(raw), f"{path}/{STAGING}", cap)
        stg = spark.read.parquet(f"{path}/{STAGING}")
        dims, dim_rows = dimensions(stg, f"{path}/_natural_keys")
        side_by_side(spark, [lambda name=name, dim=dim: _write(dim, f"{path}/{name}") for name, dim in dims.items()])
        _write(fact(stg, wh.dims(), dim_rows), f"{path}/{FACT}", cap)
        side_by_side(spark, [
            lambda: _write(_count_models(spark, path), f"{path}/_model_row_counts"),
            lambda: _write(quality_report(wh.table(STAGING), wh.table(FACT), wh.dims(), dim_rows), f"{path}/_quality")])
    wh.rows = {r["model"]: r["rows"] for r in wh.row_counts().collect()}
    failed = wh.table("_quality").where(F.col("status") == "FAIL").count()
    if gate and failed:
        raise QualityGateError(f"{failed} data-quality check(s) failed; build {build_id} not published")
    spark.createDataFrame([(build_id,)], "build_id string").write.mode("overwrite").json(
        f"{path}/_published")
    return wh


def latest(spark: SparkSession, base: str) -> Warehouse:
    """The newest published build under ``base`` (build ids sort by time)."""
    marks = (spark.read.json(f"{base.rstrip('/')}/builds/*/_published")
                  .select(F.max("build_id").alias("b")).first())
    if marks is None or marks["b"] is None:
        raise FileNotFoundError(f"no published warehouse under {base}")
    wh = Warehouse(spark, f"{base.rstrip('/')}/builds/{marks['b']}")
    wh.rows = {r["model"]: r["rows"] for r in wh.row_counts().collect()}
    return wh
