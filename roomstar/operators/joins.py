"""Join helpers: size-checked broadcast, one-row frames side by side."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A dimension is broadcast only when its row count is known (e.g. from the build
# manifest) and its estimated size is under this bound; otherwise the join is left to the
# shuffle join AQE plans (which it may still turn into a broadcast from runtime sizes, and
# splits when skewed).
BROADCAST_MAX_BYTES = 64 * 1024 * 1024
_WIDTH = {"string": 32, "binary": 32, "boolean": 1, "tinyint": 1, "smallint": 2, "int": 4,
          "date": 4, "float": 4}


def max_broadcast_bytes(spark) -> int:
    return int(spark.conf.get("roomstar.broadcast.maxBytes", str(BROADCAST_MAX_BYTES)))


def row_width(df: DataFrame) -> int:
    """Rough bytes per row of a frame's schema, plus per-row hash-table overhead."""
    return 16 + sum(_WIDTH.get(f.dataType.simpleString(), 8) for f in df.schema.fields)


def fits_broadcast(dim: DataFrame, rows: int | None) -> bool:
    """Whether ``rows`` (a known count) times the row width is within the bound."""
    return rows is not None and rows * row_width(dim) <= max_broadcast_bytes(dim.sparkSession)


def maybe_broadcast(dim: DataFrame, rows: int | None) -> DataFrame:
    """Broadcast ``dim`` if its known size is within the bound; an unknown size means no hint."""
    return F.broadcast(dim) if fits_broadcast(dim, rows) else dim


def one_row(*frames: DataFrame) -> DataFrame:
    """Columns of several one-row aggregates (distinct column names) side by side, as one
    row: a union of the rows, other columns null, folded by taking each column's only
    non-null value. No join is planned."""
    cols = [c for f in frames for c in f.columns]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out.agg(*[F.first(c, ignorenulls=True).alias(c) for c in cols])
