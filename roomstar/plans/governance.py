"""Governance over metadata tables: column lineage, impact analysis, catalog gaps.

Lineage is an edge table ``(model, column, upstream)`` where ``upstream`` is
``table.column`` (or ``table.*`` for an output that depends on rows, not on a column).
Edges are declared next to the model code (below) and checked against the schemas of a
real build, so a model change that the edges do not follow is reported, not ignored.
Every operator here is a DataFrame job over those tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roomstar.functions import qualify
from roomstar.operators.joins import one_row
from roomstar.schema import MODELS, STAGING

# Column lineage of the six models in plans/warehouse.py (projection inputs
# only; join and filter columns are not lineage). Staging reads the lake, so it has none.
# dim_user.country also lists stg_events.event_id, which breaks ties on the first event.
LINEAGE = {
    "dim_date": {c: ["stg_events.event_ts"] for c in
                 ["date_key", "full_date", "year", "month", "day", "day_of_week", "is_weekend"]},
    "dim_room": {"room_key": ["stg_events.room_id"], "room_id": ["stg_events.room_id"],
                 "first_seen_ts": ["stg_events.event_ts"], "last_seen_ts": ["stg_events.event_ts"]},
    "dim_user": {"user_key": ["stg_events.user_id"], "user_id": ["stg_events.user_id"],
                 "country": ["stg_events.country", "stg_events.event_ts", "stg_events.event_id"],
                 "first_seen_ts": ["stg_events.event_ts"]},
    "dim_gift": {"gift_key": ["stg_events.gift_name"], "gift_name": ["stg_events.gift_name"],
                 "coin_value": ["stg_events.coins"], "gift_tier": ["stg_events.coins"]},
    "fact_live_engagement": {
        "date_key": ["dim_date.date_key"], "room_key": ["dim_room.room_key"],
        "user_key": ["dim_user.user_key"], "gift_key": ["dim_gift.gift_key"],
        "event_count": ["stg_events.*"], "joins": ["stg_events.event_type"],
        "comments": ["stg_events.event_type"], "gifts": ["stg_events.event_type"],
        "coins": ["stg_events.coins"], "comment_chars": ["stg_events.comment_len"],
        "avg_ingest_lag_s": ["stg_events.event_ts", "stg_events.ingest_ts"]},
}

# Tables each model reads.
SOURCES = {
    "stg_events": [],
    "dim_date": ["stg_events"], "dim_room": ["stg_events"], "dim_user": ["stg_events"],
    "dim_gift": ["stg_events"],
    "fact_live_engagement": ["dim_date", "dim_gift", "dim_room", "dim_user", "stg_events"],
}

# Catalog entries (owner, grain, freshness target, classification).
# The dim_user entry lacks a classification on purpose: the gap report has to list it.
CATALOG = [
    ("stg_events", "data-platform", "one row per raw engagement event", "15 minutes", "internal"),
    ("dim_date", "data-platform", "one row per calendar date", "daily", "public"),
    ("dim_room", "data-platform", "one row per room_id", "daily", "internal"),
    ("dim_user", "data-platform", "one row per user_id", "daily", None),
    ("dim_gift", "data-platform", "one row per gift_name", "daily", "public"),
    ("fact_live_engagement", "analytics-engineering", "one row per (date, room, user, gift)",
     "hourly", "internal"),
]
CATALOG_FIELDS = ["owner", "grain", "freshness_target", "classification"]


# ---------------------------------------------------------------- metadata tables


def lineage_edges(spark: SparkSession, lineage: dict = LINEAGE) -> DataFrame:
    rows = [(m, c, u) for m, cols in lineage.items() for c, ups in cols.items() for u in ups]
    return spark.createDataFrame(rows, "model string, column string, upstream string")


def catalog_table(spark: SparkSession, entries: list = CATALOG) -> DataFrame:
    return spark.createDataFrame(entries, "table string, owner string, grain string, "
                                          "freshness_target string, classification string")


def model_sources(spark: SparkSession, sources: dict = SOURCES) -> DataFrame:
    rows = [(m, s) for m, ss in sources.items() for s in (ss or [None])]
    return spark.createDataFrame(rows, "model string, source string")


def model_columns(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """(model, column, position) from the schemas of built tables."""
    rows = [(m, c, i) for m in MODELS if m in tables for i, c in enumerate(tables[m].columns)]
    return spark.createDataFrame(rows, "model string, column string, position int")


# ---------------------------------------------------------------- operators


def lineage_leaves(edges: DataFrame) -> DataFrame:
    """Sorted distinct upstream leaves per output column."""
    return (edges.groupBy("model", "column")
                 .agg(F.array_sort(F.collect_set("upstream")).alias("leaves")))


def impact_one_hop(edges: DataFrame, upstream: str) -> DataFrame:
    """The columns that read ``upstream`` directly, per model. A bare column name
    means a staging column."""
    target = qualify(F.lit(upstream), STAGING)
    return (edges.where(F.col("upstream") == target)
                 .groupBy("model").agg(F.array_sort(F.collect_set("column")).alias("columns")))


def impact_transitive(edges: DataFrame, upstream: str, max_rounds: int = 64,
                      row_edges: bool = False, checkpoint_every: int = 8) -> DataFrame:
    """Every column reached from ``upstream`` through any number of hops.

    Breadth-first over the edge table: each round joins the frontier to the edges it
    feeds and keeps only columns not reached before, so cycles end. ``row_edges`` also
    follows ``table.*`` edges (outputs that depend on the row set of a table the change
    reaches). Lineage is cut every few rounds so long chains keep a short plan.
    """
    e = edges.select("model", "column", "upstream").cache()
    target = qualify(F.lit(upstream), STAGING)
    seed_cond = F.col("upstream") == target
    if row_edges:
        seed_cond = seed_cond | (F.col("upstream") == F.concat(
            F.element_at(F.split(target, r"\."), 1), F.lit(".*")))
    reached = e.where(seed_cond).select("model", "column").distinct()
    frontier = reached
    for rnd in range(1, max_rounds + 1):
        node = F.concat(F.col("f.model"), F.lit("."), F.col("f.column"))
        cond = F.col("e.upstream") == node
        if row_edges:
            cond = cond | (F.col("e.upstream") == F.concat(F.col("f.model"), F.lit(".*")))
        nxt = (e.alias("e").join(frontier.alias("f"), cond)
                .select(F.col("e.model").alias("model"), F.col("e.column").alias("column"))
                .distinct()
                .join(reached, ["model", "column"], "left_anti"))
        if rnd % checkpoint_every == 0:
            nxt = nxt.checkpoint()
        else:
            nxt = nxt.cache()
        if nxt.isEmpty():
            break
        reached = reached.unionByName(nxt)
        if rnd % checkpoint_every == 0:
            reached = reached.checkpoint()
        frontier = nxt
    else:
        raise RuntimeError(f"lineage deeper than {max_rounds} hops from {upstream}")
    return reached.groupBy("model").agg(F.array_sort(F.collect_set("column")).alias("columns"))


def catalog_gaps(models: DataFrame, catalog: DataFrame) -> DataFrame:
    """Per model, the catalog fields that are missing or empty, or
    ``not in catalog``. Catalog entries without a model are ignored."""
    c = catalog.withColumn("_in", F.lit(True))
    m = models.select("model").distinct()
    j = m.join(c, m["model"] == c["table"], "left")
    missing = F.filter(F.array(*[F.when(F.coalesce(F.trim(F.col(f)), F.lit("")) == "", F.lit(f))
                                 for f in CATALOG_FIELDS]), lambda x: x.isNotNull())
    gaps = F.when(F.col("_in").isNull(), F.array(F.lit("not in catalog"))).otherwise(missing)
    return j.select("model", gaps.alias("gaps"))


def model_summary(columns: DataFrame, sources: DataFrame, gaps: DataFrame) -> DataFrame:
    """Per model, column count, its sources (``(lake)`` when none) and gap count."""
    ncols = columns.groupBy("model").agg(F.count(F.lit(1)).alias("columns"))
    srcs = (sources.groupBy("model")
                   .agg(F.array_sort(F.collect_set("source")).alias("_s"))
                   .select("model", F.when(F.size("_s") > 0, F.array_join("_s", ", "))
                           .otherwise(F.lit("(lake)")).alias("sources")))
    return (ncols.join(srcs, "model", "left").join(gaps, "model", "left")
                 .select("model", "columns", F.coalesce("sources", F.lit("(lake)")).alias("sources"),
                         F.coalesce(F.size("gaps"), F.lit(0)).alias("gap_count")))


def lineage_drift(edges: DataFrame, columns: DataFrame) -> DataFrame:
    """Disagreements between declared edges and built schemas: model columns without an
    edge, edges for columns the model lacks, and upstream columns that do not exist."""
    has_edge = edges.select("model", "column").distinct()
    modelled = columns.where(F.col("model") != STAGING).select("model", "column")
    no_edge = modelled.join(has_edge, ["model", "column"], "left_anti").select(
        "model", "column", F.lit("column has no lineage").alias("problem"))
    stale = has_edge.join(columns.select("model", "column"), ["model", "column"], "left_anti").select(
        "model", "column", F.lit("lineage for a column the model lacks").alias("problem"))
    up = edges.select("model", "column", "upstream",
                      F.element_at(F.split("upstream", r"\."), 1).alias("u_model"),
                      F.element_at(F.split("upstream", r"\."), 2).alias("u_column"))
    known = columns.select(F.col("model").alias("u_model"), F.col("column").alias("u_column"))
    bad_up = (up.where(F.col("u_column") != "*").join(known, ["u_model", "u_column"], "left_anti")
                .select("model", "column", F.concat(F.lit("unknown upstream "), F.col("upstream"))
                        .alias("problem")))
    return no_edge.unionByName(stale).unionByName(bad_up)


def governance_json(leaves: DataFrame, gaps: DataFrame) -> DataFrame:
    """K8: one JSON document {lineage: {model: {column: [leaf]}}, catalog_gaps: {model: [gap]}}."""
    per_model = (leaves.groupBy("model")
                       .agg(F.map_from_entries(F.collect_list(F.struct("column", "leaves"))).alias("cols")))
    lineage = per_model.agg(F.map_from_entries(F.collect_list(F.struct("model", "cols"))).alias("lineage"))
    gapmap = (gaps.where(F.size("gaps") > 0)
                  .agg(F.map_from_entries(F.collect_list(F.struct("model", "gaps"))).alias("catalog_gaps")))
    return one_row(lineage, gapmap).select(
        F.to_json(F.struct("lineage", "catalog_gaps")).alias("json"))


def impact_json(edges: DataFrame, upstream: str) -> DataFrame:
    """One JSON document {column: qualified upstream, impact: {model: [column]}}."""
    hits = impact_one_hop(edges, upstream).select(F.struct("model", "columns").alias("hit"))
    found = hits.agg(F.map_from_entries(F.array_sort(F.collect_list("hit"))).alias("impact"))
    return found.select(F.to_json(F.struct(qualify(F.lit(upstream), STAGING).alias("column"), "impact"))
                         .alias("json"))
