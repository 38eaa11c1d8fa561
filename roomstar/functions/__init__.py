from roomstar.functions.conditions import any_null, indicator, safe_ratio, tier
from roomstar.functions.dates import (
    date_key, day_of_week, is_weekend, month_bounds, seconds_between, year_month,
)
from roomstar.functions.formatting import last_part, qualify, rank_label, readable_size, thousands

__all__ = [
    "any_null", "indicator", "safe_ratio", "tier", "date_key", "day_of_week", "is_weekend",
    "month_bounds", "seconds_between", "year_month", "last_part", "qualify", "rank_label",
    "readable_size", "thousands",
]
