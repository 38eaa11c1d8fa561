"""Event schema, table names and the fixed values the pipeline must agree on."""

from __future__ import annotations

from pyspark.sql.types import (
    BinaryType, DateType, IntegerType, LongType, StringType, StructField, StructType, TimestampType,
)

# The event contract. Field names, order and types of one decoded event.
EVENT_SCHEMA = StructType([
    StructField("event_id", StringType()),
    StructField("event_type", StringType()),
    StructField("event_ts", TimestampType()),
    StructField("ingest_ts", TimestampType()),
    StructField("room_id", StringType()),
    StructField("user_id", StringType()),
    StructField("country", StringType()),
    StructField("gift_name", StringType()),
    StructField("coins", IntegerType()),
    StructField("comment_len", IntegerType()),
])

# Real-time metrics sink, one row per (window, room).
METRICS_SCHEMA = StructType([
    StructField("window_start", TimestampType()),
    StructField("window_end", TimestampType()),
    StructField("room_id", StringType()),
    StructField("unique_viewers", LongType()),
    StructField("events", LongType()),
    StructField("gifts", LongType()),
    StructField("coins", LongType()),
    StructField("comments", LongType()),
    StructField("last_ingest_ts", TimestampType()),
    StructField("viewers_sketch", BinaryType()),  # mergeable: viewers of any span of windows
    StructField("day", DateType()),               # of the window's start; the sink's partitions
])

# Event types that have their own measure column in the fact.
JOIN, COMMENT, GIFT = "join", "comment", "gift"

# Gift tier thresholds on the largest coin value seen for a gift,
# checked from the top; below the last one the tier is "none".
GIFT_TIERS = [(1000, "premium"), (100, "high"), (10, "mid"), (1, "low")]
NO_GIFT = "none"

# Star schema models, in build order.
STAGING = "stg_events"
DIMENSIONS = ["dim_date", "dim_room", "dim_user", "dim_gift"]
FACT = "fact_live_engagement"
MODELS = [STAGING, *DIMENSIONS, FACT]

# Serving layer tables.
OLAP_DETAIL = "olap_detail"
ROOM_DAILY = "agg_room_daily"        # sums and a user sketch per (day, room)
ROOM_USERS = "agg_room_users"        # user bitmaps per (day, room)
COUNTRY_USERS = "agg_country_users"  # coins and user bitmaps per (month, country)

# Stream defaults: window, watermark, trigger cadence, files per trigger.
WINDOW = "30 seconds"
WATERMARK = "20 seconds"
TRIGGER = "10 seconds"
FILES_PER_TRIGGER = 4
TOPIC = "live_events"

# Distinct-count sketches: every writer and reader uses the same size so that sketches
# from different loads and batches can be unioned (HLL, 2^12 buckets, ~1.6 % error).
HLL_LG_K = 12
HLL_RSE = 1.04 / (2 ** HLL_LG_K) ** 0.5
# The replay in arrival order: slices of equal arrival time, and a watermark below the lags.
ARRIVAL_SLICES = 6
ARRIVAL_WATERMARK = "0 seconds"
