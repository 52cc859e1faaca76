from tidemark.functions.calendar import date_spine, time_spine
from tidemark.functions.scalar import (
    add_money,
    less_money,
    local_date,
    mean_of,
    money,
    month_start,
    order_measures,
    safe_divide,
    share_pct,
    sum_money,
    surrogate_key,
)
from tidemark.functions.stats import normal_quantile, two_sided_p

__all__ = [
    "add_money",
    "date_spine",
    "less_money",
    "local_date",
    "mean_of",
    "money",
    "month_start",
    "normal_quantile",
    "order_measures",
    "safe_divide",
    "share_pct",
    "sum_money",
    "surrogate_key",
    "time_spine",
    "two_sided_p",
]
