"""Mergeable states, written load by load.

``<root>/<table>/writer=W/load_id=N/ym=YYYYMM`` holds what one load adds to a table. A load is one
folder, written as a whole by Spark's commit protocol: its files appear when the job commits, a
failed job leaves none, and writing the load again replaces all of it, whatever months either has.
A load without rows is a folder with the commit marker alone. A write touches its own folder
only, so what it costs does not depend on the loads before it, and several writers (each with
its own name) need not know of each other. While a load is replaced, readers that list it then miss it.

Readers open a table as one partitioned dataset and merge by grouping.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BinaryType, DateType, IntegerType, LongType, StringType, StructField, StructType,
)

from roomstar.operators import sketches
from roomstar.schema import COUNTRY_USERS, ROOM_DAILY, ROOM_USERS
from roomstar.sources.lake import read_parquet_dir

KEYS = ["ym", "event_date", "room_id"]
_ROOM_DAY = [StructField("event_date", DateType()), StructField("room_id", StringType())]
_MONTH = [StructField("ym", IntegerType())]
# Columns of the state tables; ``ym`` is a partition column.
SCHEMAS = {
    ROOM_DAILY: StructType([*_ROOM_DAY, StructField("coins", LongType()), StructField("gifts", LongType()),
                            StructField("comments", LongType()), StructField("users_sketch", BinaryType()), *_MONTH]),
    ROOM_USERS: StructType([*_ROOM_DAY, StructField("bucket", LongType()), StructField("users", BinaryType()), *_MONTH]),
    COUNTRY_USERS: StructType([StructField("country", StringType()), StructField("bucket", LongType()),
                               StructField("coins", LongType()), StructField("users", BinaryType()), *_MONTH]),
}
SCHEMA = SCHEMAS[ROOM_DAILY]
# Folder levels above a table's own partitions.
_LEVELS = [StructField("writer", StringType()), StructField("load_id", LongType())]


def load_path(root: str, table: str, writer: str, load_id: int) -> str:
    return f"{root.rstrip('/')}/{table}/writer={writer}/load_id={load_id}"


def write_load(root: str, writer: str, load_id: int, states: DataFrame, table: str = ROOM_DAILY) -> None:
    """Write the states of one load, in place of an earlier attempt of it."""
    (states.select(*SCHEMAS[table].names).write.mode("overwrite").partitionBy("ym")
           .parquet(load_path(root, table, writer, load_id)))


def read_table(spark: SparkSession, root: str, table: str, schema: StructType) -> DataFrame:
    """All loads of a table, with the columns of ``schema`` (none written yet: no rows)."""
    everything = read_parquet_dir(spark, f"{root.rstrip('/')}/{table}", StructType([*schema.fields, *_LEVELS]), required=False)
    return everything.select(*schema.names)


def read(spark: SparkSession, root: str, table: str = ROOM_DAILY) -> DataFrame:
    return read_table(spark, root, table, SCHEMAS[table])


def merge(states: DataFrame, *keys: str) -> DataFrame:
    return (states.groupBy(*keys)
                  .agg(F.sum("coins").alias("coins"), F.sum("gifts").alias("gifts"),
                       F.sum("comments").alias("comments"),
                       sketches.merge("users_sketch").alias("users_sketch")))


def fold(spark: SparkSession, root: str, to: str) -> None:
    """All loads' (day, room) states as one row each, as load 0 of a root of its own: what a writer
    with very many small loads is replaced by. Readers switch by opening ``to``; ``root`` is left as it is."""
    write_load(to, "folded", 0, merge(read(spark, root), *KEYS))
