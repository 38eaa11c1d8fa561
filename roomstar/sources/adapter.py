"""Fixture adapter: the driver's ``events`` table re-shaped into live engagement events.

Deterministic, row-local (no shuffle), and written with built-in expressions only, so the
same rule can be stated in DuckDB SQL for the oracle. Output has EVENT_SCHEMA.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Countries, picked by event_id % 6.
COUNTRIES = ["SG", "VN", "ID", "MY", "TH", "PH"]
# Gift names and coin values, picked by event_id % 4.
GIFT_NAMES = ["rose", "star", "rocket", "castle"]
GIFT_COINS = [1, 10, 100, 1000]
# Source event type -> engagement type; anything else is a leave.
TYPE_MAP = {"view": "join", "click": "comment", "purchase": "gift"}
OTHER_TYPE = "leave"
ROOMS = 50


def _pick(values: list, index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def ingest_lag_seconds(event_id: Column) -> Column:
    """3 % of events arrive 20-90 s late, the rest 0-3 s."""
    return F.when(event_id % 100 < 3, 20 + event_id % 71).otherwise(event_id % 4).cast("int")


def live_events(events: DataFrame) -> DataFrame:
    eid = F.col("event_id")
    src_type = F.col("event_type")
    etype = None
    for src, dst in TYPE_MAP.items():
        etype = F.when(src_type == src, dst) if etype is None else etype.when(src_type == src, dst)
    is_gift = src_type == "purchase"
    room_no = F.get_json_object("props", "$.k").try_cast("int") % ROOMS
    return events.select(
        eid.cast("string").alias("event_id"),
        etype.otherwise(OTHER_TYPE).alias("event_type"),
        F.col("ts").cast("timestamp").alias("event_ts"),
        F.timestamp_add("SECOND", ingest_lag_seconds(eid), F.col("ts")).cast("timestamp").alias("ingest_ts"),
        F.concat(F.lit("room_"), F.lpad(room_no.cast("string"), 4, "0")).alias("room_id"),
        F.concat(F.lit("user_"), F.lpad(F.col("user_id").cast("string"), 6, "0")).alias("user_id"),
        _pick(COUNTRIES, eid % 6).alias("country"),
        F.when(is_gift, _pick(GIFT_NAMES, eid % 4)).alias("gift_name"),
        F.when(is_gift, _pick(GIFT_COINS, eid % 4)).otherwise(0).cast("int").alias("coins"),
        F.when(src_type == "click", 1 + eid % 120).otherwise(0).cast("int").alias("comment_len"),
    )


# The same rule in DuckDB SQL, over the ``events`` view (used by the oracle).
LIVE_EVENTS_SQL = """
SELECT CAST(event_id AS VARCHAR) AS event_id,
       CASE event_type WHEN 'view' THEN 'join' WHEN 'click' THEN 'comment'
                       WHEN 'purchase' THEN 'gift' ELSE 'leave' END AS event_type,
       ts AS event_ts,
       ts + to_seconds(CASE WHEN event_id % 100 < 3 THEN 20 + event_id % 71
                            ELSE event_id % 4 END) AS ingest_ts,
       'room_' || lpad(CAST(TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) % 50 AS VARCHAR), 4, '0')
           AS room_id,
       'user_' || lpad(CAST(user_id AS VARCHAR), 6, '0') AS user_id,
       (['SG', 'VN', 'ID', 'MY', 'TH', 'PH'])[event_id % 6 + 1] AS country,
       CASE WHEN event_type = 'purchase'
            THEN (['rose', 'star', 'rocket', 'castle'])[event_id % 4 + 1] END AS gift_name,
       CAST(CASE WHEN event_type = 'purchase' THEN ([1, 10, 100, 1000])[event_id % 4 + 1]
                 ELSE 0 END AS INTEGER) AS coins,
       CAST(CASE WHEN event_type = 'click' THEN 1 + event_id % 120 ELSE 0 END AS INTEGER) AS comment_len
FROM events
"""
