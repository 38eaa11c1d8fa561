"""OLAP serving layer: the flattened fact in a month-partitioned sorted layout, mergeable states
written with every load, and the serving queries.

A layer is ``<base>/layers/<id>``: ``olap_detail/writer=load/load_id=N/ym=YYYYMM`` sorted by (event_date,
room_id, user_id), and beside it the states of each load (``sinks/states.py``): sums with HLL
sketches and exact user bitmaps per (day, room), coins with user bitmaps per (month, country).
A load writes its detail, then the states from the rows it has written; each is one folder that is
replaced as a whole, so a load that failed in between is made whole by sending it again.

A full refresh is a new layer with one load, published by a marker once it is complete. Readers
open the newest published layer; the one before stays for those that run, older ones are deleted.
User bitmaps are over ``user_key``, so the loads of a layer come from one warehouse build.
"""

from __future__ import annotations

import datetime as dt
import time
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, LongType, StringType, StructField, StructType

from roomstar.functions import month_bounds, readable_size, year_month
from roomstar.operators import bitmaps, sketches
from roomstar.operators.joins import fits_broadcast, maybe_broadcast
from roomstar.plans.warehouse import Warehouse, side_by_side
from roomstar.schema import COUNTRY_USERS, FACT, GIFT_TIERS, OLAP_DETAIL, ROOM_DAILY, ROOM_USERS
from roomstar.session import partitions_for
from roomstar.sinks import states
from roomstar.sinks.files import delete, files_for, write_partitioned_sorted

DETAIL_SORT = ["event_date", "room_id", "user_id"]
DETAIL_BLOOM = ["user_id"]  # user lookups across dates and rooms
DETAIL_COLUMNS = ["event_date", "room_id", "user_id", "gift_name", "gift_tier", "country",
                  "event_count", "joins", "comments", "gifts", "coins"]
_TYPES = {"event_date": DateType(), **dict.fromkeys(DETAIL_COLUMNS[6:], LongType())}
DETAIL_SCHEMA = StructType([*[StructField(c, _TYPES.get(c, StringType())) for c in DETAIL_COLUMNS],
                            StructField("user_key", LongType()), StructField("ym", IntegerType())])
WRITER = "load"


_DIM_COLUMNS = {
    "dim_date": ["date_key", "full_date AS event_date"], "dim_room": ["room_key", "room_id"],
    "dim_user": ["user_key", "user_id", "country"], "dim_gift": ["gift_key", "gift_name", "gift_tier"]}


def detail_rows(wh: Warehouse, num_files: int | None = None) -> tuple[DataFrame, bool]:
    """The fact joined to all four dimensions, as one wide row per fact row, and whether
    the rows are dealt into ``num_files`` ranges of DETAIL_SORT.

    Surrogate keys are numbered in the order of their natural keys, so ranges of the keys are ranges
    of the layout. The narrow fact is dealt out before the joins if all of these are broadcasts, which
    leave rows where they are: range bounds are sampled from the fact alone, and the joins run once."""
    dims = {name: wh.table(name).selectExpr(*cols) for name, cols in _DIM_COLUMNS.items()}
    f = wh.table(FACT).select("date_key", "room_key", "user_key", "gift_key",
                              "event_count", "joins", "comments", "gifts", "coins")
    in_ranges = num_files is not None and all(fits_broadcast(d, wh.rows.get(n)) for n, d in dims.items())
    if in_ranges:
        f = f.repartitionByRange(num_files, "date_key", "room_key", "user_key")
    for name, dim in dims.items():
        f = f.join(maybe_broadcast(dim, wh.rows.get(name)), dim.columns[0])
    return f.select(*DETAIL_COLUMNS, "user_key", year_month("event_date").alias("ym")), in_ranges


def room_daily_states(detail: DataFrame) -> DataFrame:
    """Partial states of one load: sums and a user sketch per (day, room)."""
    return (detail.groupBy("ym", "event_date", "room_id")
                  .agg(F.sum("coins").alias("coins"), F.sum("gifts").alias("gifts"),
                       F.sum("comments").alias("comments"),
                       sketches.sketch("user_id").alias("users_sketch")))


def room_users(detail: DataFrame) -> DataFrame:
    """Exact users of one load per (day, room), as bitmaps."""
    return (detail.groupBy("ym", "event_date", "room_id", bitmaps.bucket("user_key"))
                  .agg(bitmaps.construct("user_key").alias("users")))


def country_users(detail: DataFrame) -> DataFrame:
    """Coins and exact users of one load per (month, country)."""
    return (detail.groupBy("ym", "country", bitmaps.bucket("user_key"))
                  .agg(F.sum("coins").alias("coins"), bitmaps.construct("user_key").alias("users")))


_STATES = {ROOM_DAILY: room_daily_states, ROOM_USERS: room_users, COUNTRY_USERS: country_users}


@dataclass
class Serving:
    """Readers of one layer, made once and dropped whenever this process writes to it (a reader
    keeps the file list it was made with)."""
    spark: SparkSession
    path: str
    _readers: dict[str, DataFrame] = field(default_factory=dict, repr=False)

    def invalidate(self) -> None:
        self._readers.clear()

    def table(self, name: str) -> DataFrame:
        if name not in self._readers:
            schema = DETAIL_SCHEMA if name == OLAP_DETAIL else states.SCHEMAS[name]
            self._readers[name] = states.read_table(self.spark, self.path, name, schema)
        return self._readers[name]

    def detail(self) -> DataFrame:
        return self.table(OLAP_DETAIL)

    def rollup(self) -> DataFrame:
        """(day, room) states of all loads."""
        return self.table(ROOM_DAILY)

    def detail_between(self, lo: str, hi: str) -> DataFrame:
        return in_date_range(self.detail(), "event_date", lo, hi)


def append(s: Serving, rows: DataFrame, load_id: int, num_files: int | None = None, in_ranges: bool = False) -> None:
    """K5 + insert trigger: add detail rows (DETAIL_SCHEMA) and the states of exactly these rows.
    A load id that is there already is replaced as a whole."""
    folder = states.load_path(s.path, OLAP_DETAIL, WRITER, load_id)
    write_partitioned_sorted(rows.select(*DETAIL_SCHEMA.names), folder, "ym", DETAIL_SORT, bloom_cols=DETAIL_BLOOM,
                             num_files=num_files, in_ranges=in_ranges)
    written = s.spark.read.schema(DETAIL_SCHEMA).parquet(folder)
    side_by_side(s.spark, [lambda t=t, make=make: states.write_load(s.path, WRITER, load_id, make(written), t)
                           for t, make in _STATES.items()])
    s.invalidate()


def refresh(spark: SparkSession, rows: DataFrame, base: str, load_id: int = 0, num_files: int | None = None,
            in_ranges: bool = False) -> Serving:
    """A new layer that holds one load, published when it is complete."""
    layers = f"{base.rstrip('/')}/layers"
    name = f"{int(time.time() * 1000):015d}-{uuid.uuid4().hex[:8]}"  # names sort by time
    s = Serving(spark, f"{layers}/{name}")
    append(s, rows, load_id, num_files, in_ranges)
    (spark.createDataFrame([(name,)], "layer string").coalesce(1).write.mode("overwrite").json(f"{s.path}/_published"))
    for old in _published(spark, base)[:-2]:
        delete(spark, f"{layers}/{old}")
    return s


def _published(spark: SparkSession, base: str) -> list[str]:
    """Published layers, oldest first (at most three are there)."""
    marks = spark.read.schema("layer string").json(f"{base.rstrip('/')}/layers/*/_published")
    return sorted(r["layer"] for r in marks.collect())


def latest(spark: SparkSession, base: str) -> Serving:
    """The newest published layer under ``base``."""
    return Serving(spark, f"{base.rstrip('/')}/layers/{_published(spark, base)[-1]}")


def load(wh: Warehouse, base: str, load_id: int = 0) -> Serving:
    """Full refresh of the serving layer from a published warehouse build."""
    num_files = files_for(wh.spark, wh.rows.get(FACT))
    rows, in_ranges = detail_rows(wh, num_files)
    with partitions_for(wh.spark, wh.rows.get(FACT, 0)):
        return refresh(wh.spark, rows, base, load_id, num_files, in_ranges)


# ---------------------------------------------------------------- month pruning


def read_date_range(spark: SparkSession, path: str, date_col: str, lo: str, hi: str,
                    part_col: str = "ym") -> DataFrame:
    """Rows with lo <= date_col <= hi (ISO dates, inclusive) from a month-partitioned
    table. The implied month bounds are added on the partition column, because a predicate
    on the date alone does not prune partitions."""
    return in_date_range(spark.read.parquet(path), date_col, lo, hi, part_col)


def in_date_range(df: DataFrame, date_col: str, lo: str, hi: str, part_col: str = "ym") -> DataFrame:
    """``read_date_range`` of a frame."""
    lo_ym, hi_ym = month_bounds(lo, hi)
    end = (dt.date.fromisoformat(hi) + dt.timedelta(days=1)).isoformat()
    kind = df.schema[date_col].dataType.simpleString()
    lo_v, end_v = F.lit(lo).cast(kind), F.lit(end).cast(kind)
    return df.where((F.col(part_col) >= lo_ym) & (F.col(part_col) <= hi_ym)
                    & (F.col(date_col) >= lo_v) & (F.col(date_col) < end_v))


def write_orders_by_month(orders: DataFrame, path: str) -> None:
    """Orders in the serving layout: month partitions, sorted by order date (the row count
    comes from the Parquet footers)."""
    write_partitioned_sorted(orders.withColumn("ym", year_month("o_orderdate")), path, "ym",
                             ["o_orderdate", "o_orderkey"],
                             num_files=files_for(orders.sparkSession, orders.count()))


def orders_window_summary(spark: SparkSession, path: str, lo: str, hi: str) -> DataFrame:
    o = read_date_range(spark, path, "o_orderdate", lo, hi)
    return (o.groupBy("ym", "o_orderstatus")
             .agg(F.count(F.lit(1)).alias("orders"),
                  F.round(F.sum("o_totalprice"), 2).alias("revenue")))


# ---------------------------------------------------------------- serving queries


def revenue_by_tier(s: Serving) -> DataFrame:
    """Coins and gifts of each tier. Tiers are a closed set of labels, so the order is that of a
    top-n over all of them: no range exchange and no sampling job for a handful of rows."""
    return (s.detail().groupBy("gift_tier")
             .agg(F.sum("coins").alias("coins"), F.sum("gifts").alias("gifts"))
             .orderBy(F.desc("coins"), "gift_tier").limit(len(GIFT_TIERS) + 1))


def top_rooms(s: Serving, n: int = 10) -> DataFrame:
    """Coins and estimated users of the best rooms, from the states of all loads."""
    return (s.rollup().groupBy("room_id")
             .agg(F.sum("coins").alias("coins"), sketches.estimate(sketches.merge("users_sketch")).alias("users"))
             .orderBy(F.desc("coins"), "room_id").limit(n))


def country_breakdown(s: Serving) -> DataFrame:
    """Estimated users and coins of each country, from the detail."""
    return (s.detail().groupBy("country")
             .agg(sketches.approx_distinct("user_id").alias("users"), F.sum("coins").alias("coins"))
             .orderBy(F.desc("coins"), F.asc_nulls_last("country")))


def country_exact(s: Serving) -> DataFrame:
    """Exact users and coins of each country, from the states alone."""
    return (s.table(COUNTRY_USERS).groupBy("country", bitmaps.BUCKET)
             .agg(F.sum("coins").alias("coins"), F.bitmap_count(F.bitmap_or_agg("users")).alias("users"))
             .groupBy("country").agg(F.sum("users").alias("users"), F.sum("coins").alias("coins"))
             .orderBy(F.desc("coins"), F.asc_nulls_last("country")))


def exact_users(s: Serving, *keys: str) -> DataFrame:
    """Exact users for each value of ``keys`` (of day and room), from the bitmaps of all loads."""
    return bitmaps.count_distinct(s.table(ROOM_USERS), "users", *keys)


def daily_rollup(s: Serving, n: int | None = 10) -> DataFrame:
    """Per (day, room) merged from the rollup states of all loads."""
    out = (s.rollup().groupBy("event_date", "room_id")
             .agg(F.sum("coins").alias("coins"),
                  sketches.estimate(sketches.merge("users_sketch")).alias("users"))
             .orderBy(F.desc("coins"), "event_date", "room_id"))
    return out.limit(n) if n else out


def running_total(s: Serving, n: int | None = None) -> DataFrame:
    """Coins per (room, day) and their running sum per room in date order, from the rollup's
    states: one row for each room-day and load is read, and a hot room is one row a day in the window."""
    daily = s.rollup().groupBy("room_id", "event_date").agg(F.sum("coins").alias("coins"))
    w = (Window.partitionBy("room_id").orderBy("event_date")
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    out = (daily.withColumn("running", F.sum("coins").over(w))
                .orderBy("room_id", "event_date"))
    return out.limit(n) if n else out


def partition_rows(s: Serving) -> DataFrame:
    return s.detail().groupBy("ym").agg(F.count(F.lit(1)).alias("rows")).orderBy("ym")


def partition_bytes(s: Serving) -> DataFrame:
    """Rows, files and bytes on disk per month partition. Files and bytes come from the
    listing, rows from the Parquet footers; no column of the detail is read."""
    listed = (s.spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(f"{s.path}/{OLAP_DETAIL}")
               .groupBy("ym").agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes")))
    return (partition_rows(s).join(listed, "ym").select("ym", "rows", "files", "bytes")
                             .withColumn("size", readable_size("bytes")).orderBy("ym"))


def rollup_reconcile(s: Serving) -> DataFrame:
    """The states of all loads against the detail re-aggregated, per (day, room): sums and
    users must be equal."""
    keys = ["event_date", "room_id"]
    sums = ["coins", "gifts", "comments"]
    r = (s.rollup().groupBy(*keys).agg(*[F.sum(c).alias(f"r_{c}") for c in sums])
          .join(exact_users(s, *keys).withColumnRenamed("users", "r_users"), keys, "full_outer"))
    d = s.detail().groupBy(*keys).agg(*[F.sum(c).alias(f"d_{c}") for c in sums], F.countDistinct("user_id").alias("d_users"))
    def differ(names):
        same = F.lit(True)
        for c in names:
            same &= F.col(f"r_{c}") == F.col(f"d_{c}")
        return F.count_if(~F.coalesce(same, F.lit(False)))
    return r.join(d, keys, "full_outer").agg(
        F.count(F.lit(1)).alias("groups"),
        F.count_if(F.col("d_coins").isNull()).alias("rollup_only"),
        F.count_if(F.col("r_coins").isNull()).alias("detail_only"),
        differ(sums).alias("sum_mismatches"), differ(["users"]).alias("user_mismatches"),
        F.sum("d_coins").alias("coins"))
