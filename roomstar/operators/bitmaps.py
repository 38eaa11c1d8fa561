"""Exact, mergeable distinct counts: bitmaps over a dense integer key.

A set of keys is a row for each bucket of 32,768 consecutive keys that it touches, with one
bit for each key. Sets merge by OR, bucket by bucket, so counts over any union of rows (days, rooms,
loads) are exact without going back to the rows that were counted. Dense keys (1..N) keep buckets
full; a row is 4 KiB, which compresses to its occupied bytes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKET = "bucket"


def bucket(key: str) -> Column:
    return F.bitmap_bucket_number(F.col(key)).alias(BUCKET)


def construct(key: str) -> Column:
    """Aggregate: the bitmap of the keys of a group, which must share a bucket."""
    return F.bitmap_construct_agg(F.bitmap_bit_position(F.col(key)))


def count_distinct(states: DataFrame, bits: str, *keys: str, name: str = "users") -> DataFrame:
    """``keys`` and the exact number of distinct keys in the merged bitmaps of each."""
    merged = states.groupBy(*keys, BUCKET).agg(F.bitmap_count(F.bitmap_or_agg(bits)).alias("_n"))
    return merged.groupBy(*keys).agg(F.sum("_n").alias(name))
