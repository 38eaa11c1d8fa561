"""Rows in ascending id order as contiguous buckets, one after the other in each task.

The cut points are quantiles of the id column (ids only are read for them; one value per bucket
reaches the driver). They are actual ids, so the first rows of the next bucket are known by
their id and can be sent to the bucket before it too, where an operator needs to look one row
ahead. No row is numbered by a global sort, and a lost executor's buckets are dealt out again
by the same cuts.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LOWEST = -(1 << 63)  # where a null id stands: before all others


def bucket_count(docs: DataFrame) -> int:
    return max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def cut_points(docs: DataFrame, buckets: int) -> list[int]:
    """Ascending distinct first ids of at most ``buckets`` buckets of ``doc_id``."""
    ids = docs.select(F.coalesce(F.col("doc_id"), F.lit(LOWEST)).alias("_id"))
    at = [i / buckets for i in range(buckets)]
    row = ids.agg(F.min("_id").alias("low"),
                  F.percentile_approx("_id", at, max(10_000, 20 * buckets)).alias("cuts")).first()
    return sorted({row["low"], *row["cuts"]}) if row["cuts"] else []


def in_order(docs: DataFrame, look_ahead: bool = False) -> DataFrame:
    """Columns ``_bucket, _ahead, doc_id, text`` with each bucket's rows sorted by (doc_id,
    text) inside one task. With ``look_ahead``, rows with the next bucket's first id follow
    with ``_ahead`` true (after the last bucket: those with the smallest id)."""
    cuts = np.array(cut_points(docs, bucket_count(docs)) or [LOWEST], np.int64)
    k = len(cuts)

    @F.pandas_udf("long")
    def place(ids: pd.Series) -> pd.Series:
        ids = ids.to_numpy()
        bucket = np.searchsorted(cuts, ids, "right") - 1
        return pd.Series(2 * bucket + (cuts[bucket] == ids))

    order = F.coalesce(F.col("doc_id"), F.lit(LOWEST))
    rows = docs.withColumn("_place", place(order))
    bucket = F.shiftright("_place", 1)
    here = F.struct(bucket.alias("_bucket"), F.lit(False).alias("_ahead"))
    if look_ahead:
        before = F.struct(F.pmod(bucket - 1, F.lit(k)).alias("_bucket"), F.lit(True).alias("_ahead"))
        both = F.when(F.col("_place").bitwiseAND(1) == 1, F.array(here, before)).otherwise(F.array(here))
        rows = rows.withColumn("_to", F.explode(both)).select("_to.*", "doc_id", "text")
    else:
        rows = rows.withColumn("_to", here).select("_to.*", "doc_id", "text")
    # Bucket i is partition i: hashed, some tasks would get several buckets and others none.
    return rows.repartitionById(k, F.col("_bucket").cast("int")).sortWithinPartitions(
        "_bucket", "_ahead", F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first())
