"""Streaming sources: NDJSON file tail and Kafka, both decoded to EVENT_SCHEMA."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roomstar.schema import EVENT_SCHEMA, FILES_PER_TRIGGER, TOPIC

# JSON timestamps: ISO-8601 with a UTC offset and microseconds, e.g.
# 2024-01-01T08:00:07.179575+08:00 (the offset is honoured when decoding).
JSON_OPTIONS = {"mode": "PERMISSIVE"}


def file_stream(spark: SparkSession, indir: str,
                files_per_trigger: int | None = FILES_PER_TRIGGER,
                nested: bool = False) -> DataFrame:
    """Tail a folder of NDJSON files (``nested``: and its subfolders), one string column
    ``json``. Only ``*.json`` is read: a producer's ``*.json.tmp`` file would otherwise be picked
    up half-written."""
    r = spark.readStream.format("text").option("pathGlobFilter", "*.json")
    if nested:
        r = r.option("recursiveFileLookup", "true")
    if files_per_trigger:
        r = r.option("maxFilesPerTrigger", files_per_trigger)
    return r.load(indir).select(F.col("value").alias("json"))


def kafka_options(bootstrap: str, topic: str = TOPIC, starting_offsets: str = "latest",
                  max_offsets_per_trigger: int | None = None, **extra: str) -> dict[str, str]:
    """S1 options; ``extra`` passes through (``kafka.security.protocol`` etc.)."""
    opts = {"kafka.bootstrap.servers": bootstrap, "subscribe": topic,
            "startingOffsets": starting_offsets}
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    opts.update(extra)
    return opts


def kafka_stream(spark: SparkSession, bootstrap: str, topic: str = TOPIC,
                 starting_offsets: str = "latest", max_offsets_per_trigger: int | None = None,
                 **extra: str) -> DataFrame:
    """Message values as one string column ``json``. Needs the Kafka connector on the
    classpath (spark-sql-kafka); it is not bundled with PySpark."""
    r = spark.readStream.format("kafka")
    for k, v in kafka_options(bootstrap, topic, starting_offsets, max_offsets_per_trigger,
                              **extra).items():
        r = r.option(k, v)
    return kafka_value_as_json(r.load())


def kafka_value_as_json(records: DataFrame) -> DataFrame:
    return records.select(F.col("value").cast("string").alias("json"))


def decode(raw: DataFrame, column: str = "json") -> DataFrame:
    """S3: JSON text -> EVENT_SCHEMA columns. A malformed line becomes an all-null row, a
    bad field a null in that field; staging removes rows without id or event time."""
    return raw.select(F.from_json(F.col(column), EVENT_SCHEMA, JSON_OPTIONS).alias("e")).select("e.*")


def undecodable(decoded: DataFrame) -> DataFrame:
    """Rows that carry no usable field (malformed JSON, empty line, ``null``)."""
    return decoded.where(F.col("event_id").isNull() & F.col("event_ts").isNull())
