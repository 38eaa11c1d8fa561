"""Mergeable distinct-count states (HLL sketches) with one fixed size everywhere."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from roomstar.schema import HLL_LG_K, HLL_RSE


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sketch(c) -> Column:
    """Aggregate: distinct-count state of a column (binary, mergeable)."""
    return F.hll_sketch_agg(_c(c), HLL_LG_K)


def merge(sketch_col) -> Column:
    """Aggregate: union of states."""
    return F.hll_union_agg(_c(sketch_col), False)


def estimate(sketch_value) -> Column:
    return F.hll_sketch_estimate(_c(sketch_value))


def approx_distinct(c) -> Column:
    """Aggregate: approximate distinct count through the same sketch as the rollups, so
    detail queries and merged rollups report the same numbers."""
    return estimate(sketch(c))


def within_tolerance(estimate_col, exact_col, sigmas: float = 3.0, rse: float = HLL_RSE) -> Column:
    """|estimate - exact| within ``sigmas`` relative standard errors (at least 1)."""
    e, x = _c(estimate_col).cast("double"), _c(exact_col).cast("double")
    return F.abs(e - x) <= F.greatest(F.lit(1.0), x * F.lit(sigmas * rse))
