"""Event encoders: NDJSON files (K6) and Kafka records (K7)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roomstar.schema import TOPIC

ISO_TS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def to_json_lines(events: DataFrame) -> DataFrame:
    """One JSON object per event, as a string column ``value``; absent values are left out."""
    return events.select(F.to_json(F.struct(*events.columns), {"timestampFormat": ISO_TS})
                         .alias("value"))


def write_ndjson(events: DataFrame, outdir: str, mode: str = "append") -> None:
    """K6: NDJSON files, published by the writer's commit protocol (task output is renamed
    into place on commit, so a reader never sees a partial file)."""
    events.write.mode(mode).option("timestampFormat", ISO_TS).json(outdir)


def kafka_records(events: DataFrame, key: str | None = "room_id") -> DataFrame:
    """K7: (key, value) columns for ``write.format("kafka")``; keyed by room so one room's
    events keep their order within a partition."""
    return events.select(
        *([F.col(key).cast("string").alias("key")] if key else []),
        F.to_json(F.struct(*events.columns), {"timestampFormat": ISO_TS}).alias("value"))


def write_kafka(events: DataFrame, bootstrap: str, topic: str = TOPIC, **extra: str) -> None:
    """K7: publish events to Kafka (needs the spark-sql-kafka connector)."""
    w = kafka_records(events).write.format("kafka").option("kafka.bootstrap.servers", bootstrap)
    w = w.option("topic", topic)
    for k, v in {"kafka.linger.ms": "50", **extra}.items():
        w = w.option(k, v)
    w.save()
