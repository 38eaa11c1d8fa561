"""Dashboard queries over the star schema (each tile is one DataFrame).

Top-N lists order by the measure and then by the natural key, so ties are deterministic.
Dimension joins broadcast only when the build manifest says the dimension is small.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roomstar.functions import rank_label, safe_ratio, thousands
from roomstar.operators import sketches
from roomstar.operators.joins import maybe_broadcast, one_row
from roomstar.plans.warehouse import Warehouse
from roomstar.schema import FACT, NO_GIFT

# Report precision: the headline lag is shown with 2 decimals, other averages with 4.
LAG_DIGITS = 2
AVG_DIGITS = 4


def _dim(wh: Warehouse, name: str, *cols: str) -> DataFrame:
    return maybe_broadcast(wh.table(name).select(*cols), wh.rows.get(name))


def model_rows_text(wh: Warehouse) -> DataFrame:
    """G3 as the dashboard shows it: each model's rows with thousands separators."""
    return wh.row_counts().select("model", thousands("rows").alias("rows_text"))


def headline(wh: Warehouse) -> DataFrame:
    """Totals plus distinct users and rooms. Each distinct count is its own aggregation
    over one pruned column (pre-aggregated on the map side), instead of one Expand that
    would copy every fact row once per distinct column."""
    f = wh.table(FACT)
    sums = f.agg(F.sum("coins").alias("coins"), F.sum("gifts").alias("gifts"),
                 F.sum("comments").alias("comments"),
                 F.round(F.avg("avg_ingest_lag_s"), LAG_DIGITS).alias("ingest_lag_s"))
    users = f.select("user_key").distinct().agg(F.count("user_key").alias("users"))
    rooms = f.select("room_key").distinct().agg(F.count("room_key").alias("rooms"))
    return one_row(sums, users, rooms).select("coins", "gifts", "comments", "users", "rooms",
                                              "ingest_lag_s")


def engagement_mix(wh: Warehouse) -> DataFrame:
    f = wh.table(FACT)
    return f.agg(F.sum("joins").alias("joins"), F.sum("comments").alias("comments"),
                 F.sum("gifts").alias("gifts"))


def avg_ingest_lag(wh: Warehouse) -> DataFrame:
    """The unweighted mean of per-row means (the dashboard's number) and the mean over
    events (weighted by event_count); they differ whenever rows have unequal counts."""
    f = wh.table(FACT)
    return f.agg(
        F.round(F.avg("avg_ingest_lag_s"), AVG_DIGITS).alias("avg_ingest_lag_s"),
        F.round(F.sum(F.col("avg_ingest_lag_s") * F.col("event_count"))
                / F.sum(F.when(F.col("avg_ingest_lag_s").isNotNull(), F.col("event_count"))),
                AVG_DIGITS).alias("event_weighted_lag_s"))


def _room_totals(wh: Warehouse) -> DataFrame:
    """Per room: coins, gifts, distinct users. Grouped on the surrogate key first; the
    dimension is joined to one row per room, not to every fact row."""
    per_key = (wh.table(FACT).groupBy("room_key")
                 .agg(F.sum("coins").alias("coins"), F.sum("gifts").alias("gifts"),
                      F.countDistinct("user_key").alias("users")))
    return (per_key.join(_dim(wh, "dim_room", "room_key", "room_id"), "room_key")
                   .select("room_id", "coins", "gifts", "users"))


def top_rooms(wh: Warehouse, n: int = 15) -> DataFrame:
    t = _room_totals(wh)
    return (t.select(F.col("room_id").alias("room"), "coins", "gifts", "users",
                     safe_ratio("coins", "users", 1).alias("coins_per_user"))
             .orderBy(F.desc("coins"), F.asc("room")).limit(n))


def top_rooms_brief(wh: Warehouse, n: int = 5) -> DataFrame:
    t = _room_totals(wh)
    return (t.select("room_id", "coins", "gifts", F.col("users").alias("unique_users"))
             .orderBy(F.desc("coins"), F.asc("room_id")).limit(n))


def top_rooms_ranked(wh: Warehouse, n: int = 15) -> DataFrame:
    """Rank labels '01 room_x' for the top-N list; numbered after the limit, so the
    window runs over N rows only."""
    top = top_rooms(wh, n)
    w = Window.orderBy(F.desc("coins"), F.asc("room"))
    return (top.withColumn("rank", F.row_number().over(w).cast("long"))
               .select("rank", rank_label("rank", "room").alias("label"), "room", "coins"))


def gift_mix(wh: Warehouse) -> DataFrame:
    """Per gift (names are unique per key, so no regrouping after the join)."""
    per_key = (wh.table(FACT).groupBy("gift_key")
                 .agg(F.sum("gifts").alias("sent"), F.sum("coins").alias("coins")))
    g = _dim(wh, "dim_gift", "gift_key", "gift_name", "gift_tier").where(F.col("gift_name") != NO_GIFT)
    return (per_key.join(g, "gift_key")
                   .select(F.col("gift_tier").alias("tier"), F.col("gift_name").alias("gift"),
                           "sent", "coins")
                   .orderBy(F.desc("coins"), "tier", "gift"))


def by_country(wh: Warehouse) -> DataFrame:
    """Per country of the user dimension. The fact is first reduced to one row per user,
    so distinct users become a plain count and the user join sees one row per user."""
    per_user = (wh.table(FACT).groupBy("user_key")
                  .agg(F.sum("coins").alias("coins"), F.sum("comments").alias("comments")))
    u = _dim(wh, "dim_user", "user_key", "country")
    return (per_user.join(u, "user_key")
                    .groupBy("country")
                    .agg(F.count("user_key").alias("users"), F.sum("coins").alias("coins"),
                         F.sum("comments").alias("comments"))
                    .orderBy(F.desc("coins"), F.asc_nulls_last("country")))


def newest_days(metrics: DataFrame, n: int) -> DataFrame:
    """The newest days of the real-time sink that hold at least ``n`` rows together (all days, if
    fewer). Days are taken from the sink's listing; rows are counted from the footers of one day at a time."""
    found = {m[1] for f in metrics.inputFiles() if (m := re.search(r"/day=(\d{4}-\d\d-\d\d)/", f))}
    for day in sorted(found, reverse=True):
        n -= metrics.where(F.col("day") == F.lit(day).cast("date")).count()
        if n <= 0:
            return metrics.where(F.col("day") >= F.lit(day).cast("date"))
    return metrics


def realtime_latest(metrics: DataFrame, n: int = 20) -> DataFrame:
    """O3: the newest windows of the real-time sink, richest room first."""
    return (newest_days(metrics, n).select("window_start", "window_end", "room_id", "unique_viewers", "gifts", "coins")
                   .orderBy(F.desc("window_start"), F.desc_nulls_last("coins"), "room_id").limit(n))


def viewers_by_hour(metrics: DataFrame) -> DataFrame:
    """Estimated viewers and events per (hour, room), from the sketches of the sink's windows alone."""
    return (metrics.groupBy(F.date_trunc("hour", "window_start").alias("hour"), "room_id")
                   .agg(sketches.estimate(sketches.merge("viewers_sketch")).alias("viewers"), F.sum("events").alias("events")))
