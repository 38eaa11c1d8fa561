"""Conditional and arithmetic column expressions."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from roomstar.schema import GIFT_TIERS, NO_GIFT


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def indicator(c, value) -> Column:
    """1 when c equals value, else 0 (a null c gives 0)."""
    return F.when(_c(c) == F.lit(value), 1).otherwise(0)


def any_null(*cols) -> Column:
    return reduce(or_, [_c(c).isNull() for c in cols])


def tier(c, thresholds=GIFT_TIERS, default: str = NO_GIFT) -> Column:
    """First label whose threshold c reaches, checked from the largest; else default."""
    expr = None
    for bound, label in thresholds:
        expr = (F.when(_c(c) >= bound, label) if expr is None
                else expr.when(_c(c) >= bound, label))
    return expr.otherwise(default)


def safe_ratio(num, den, digits: int | None = None) -> Column:
    """num / den as double, null when den is 0 or null; optionally rounded."""
    r = _c(num).cast("double") / F.nullif(_c(den).cast("double"), F.lit(0.0))
    return F.round(r, digits) if digits is not None else r
