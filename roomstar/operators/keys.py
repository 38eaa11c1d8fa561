"""Dense surrogate keys 1..N in the order of a natural key, without a single-task sort.

``ROW_NUMBER() OVER (ORDER BY k)`` plans as one global window: every row goes through one
task. Here the rows are range-partitioned on the key and sorted inside each partition;
a row's key is (rows in all earlier partitions) + (its position in its partition) + 1. Several
tables can be numbered in one go: their rows are told apart by a column ``within``, which leads
the sort, and each table's keys start at 1.

The ranged rows are written first, as a table in the shared folder: range bounds come from a
sample, so a recompute (e.g. after a lost executor) must not be allowed to move rows between partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roomstar.session import work_dir


def dense_keys(df: DataFrame, order_by: str, key: str, num_partitions: int | None = None,
               within: str | None = None, path: str | None = None) -> DataFrame:
    """Add ``key`` (bigint, 1..N) numbering the rows of df by ``order_by`` ascending, nulls last,
    for each value of ``within`` apart if given (never null). ``order_by`` must be unique in df (it
    is a grouped natural key), or unique for each value of ``within``. The ranged rows are kept at
    ``path`` (a new folder of the work folder if not given)."""
    spark = df.sparkSession
    path = path or work_dir(spark)
    table = F.col(within) if within else F.lit(0)
    order = [*([F.col(within)] if within else []), F.col(order_by).asc_nulls_last()]
    # Without an explicit count AQE may merge adjacent ranges; merged ranges stay contiguous
    # and in order, which is all the numbering needs.
    ranged = df.repartitionByRange(num_partitions, *order) if num_partitions else df.repartitionByRange(*order)
    (ranged.sortWithinPartitions(*order).withColumn("_rid", F.monotonically_increasing_id())
           .write.mode("overwrite").parquet(path))
    ranged = spark.read.parquet(path)
    # Ids rise with the partition and the position in it, so a table's first id in a partition
    # names both. One row for each partition and table reaches the driver: bounded by their
    # numbers, not by the data. This count and the keys below read the written rows.
    part = F.shiftright("_rid", 33)
    counts = ranged.groupBy(part.alias("_part"), table.alias("_table")).agg(
        F.count("*").alias("_n"), F.min("_rid").alias("_first")).collect()
    before: dict = {}
    offsets = []
    for r in sorted(counts, key=lambda r: r["_part"]):
        offsets.append((r["_part"], r["_table"], before.get(r["_table"], 0) - r["_first"] + 1))
        before[r["_table"]] = before.get(r["_table"], 0) + r["_n"]
    kind = df.schema[within].dataType.simpleString() if within else "int"
    shifts = spark.createDataFrame(offsets, f"_part long, _table {kind}, _shift long")
    return (ranged.join(F.broadcast(shifts), (part == F.col("_part")) & (table == F.col("_table")))
                  .withColumn(key, F.col("_rid") + F.col("_shift"))
                  .drop("_rid", "_part", "_table", "_shift"))
