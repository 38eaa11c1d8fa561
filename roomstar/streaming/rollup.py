"""Rollup maintained with every micro-batch (the insert-trigger pattern).

Each micro-batch's events become partial states per (day, room): sums plus an HLL sketch
of users, written as load <batch id> of the query. A batch replayed after a failure replaces
its own folder and touches no other; a query with a new checkpoint has a new id, so its batches
stand beside the old ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from roomstar.functions import indicator, year_month
from roomstar.operators import sketches
from roomstar.plans.warehouse import staging
from roomstar.schema import COMMENT, GIFT, TRIGGER
from roomstar.sinks import states as state_store


def event_states(events: DataFrame) -> DataFrame:
    """Partial (day, room) states of raw events, with the fact's grain rules: only rows
    that reach the fact (id, time, room and user present) are counted."""
    stg = staging(events).where(F.col("room_id").isNotNull() & F.col("user_id").isNotNull())
    day = F.to_date("event_ts")
    return (stg.groupBy(year_month(day).alias("ym"), day.alias("event_date"), "room_id")
               .agg(F.sum("coins").cast("long").alias("coins"),
                    F.sum(indicator("event_type", GIFT)).cast("long").alias("gifts"),
                    F.sum(indicator("event_type", COMMENT)).cast("long").alias("comments"),
                    sketches.sketch("user_id").alias("users_sketch")))


def write_batch(events: DataFrame, batch_id: int, out: str, writer: str) -> None:
    state_store.write_load(out, writer, batch_id, event_states(events))


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """Id of the streaming query that owns a checkpoint folder (there before its first batch)."""
    return spark.read.schema("id string").json(f"{checkpoint}/metadata").first()["id"]


def start(events: DataFrame, out: str, checkpoint: str, trigger: str | None = TRIGGER,
          available_now: bool = False) -> StreamingQuery:
    writer: list[str] = []

    def batch(df: DataFrame, batch_id: int) -> None:
        if not writer:
            writer.append(query_id(df.sparkSession, checkpoint))
        write_batch(df, batch_id, out, writer[0])

    w = events.writeStream.option("checkpointLocation", checkpoint).foreachBatch(batch)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=trigger)
    return w.start()


def merged(states: DataFrame) -> DataFrame:
    """Per (day, room) totals merged over all loads."""
    return (states.groupBy("event_date", "room_id")
                  .agg(F.sum("coins").alias("coins"), F.sum("gifts").alias("gifts"),
                       F.sum("comments").alias("comments"),
                       sketches.estimate(sketches.merge("users_sketch")).alias("users")))
