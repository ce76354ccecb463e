"""Scalar expressions. All are built-in Spark columns, so they stay inside generated code."""

from stratalake.functions.calendar import (
    days_between,
    month_number,
    month_of,
    order_day,
    weekday_name,
    weekday_sort,
    year_month,
)
from stratalake.functions.flags import any_changed, changed, is_delivered, is_late, sentinel_for
from stratalake.functions.keys import row_hash, scd_id, spread_hash
from stratalake.functions.money import (
    add_money,
    cents,
    from_cents,
    rate,
    ratio,
    round_money,
    safe_ratio,
)
from stratalake.functions.text import norm_city, norm_state, or_unknown

__all__ = [
    "add_money",
    "any_changed",
    "cents",
    "changed",
    "days_between",
    "from_cents",
    "is_delivered",
    "is_late",
    "month_number",
    "month_of",
    "norm_city",
    "norm_state",
    "or_unknown",
    "order_day",
    "rate",
    "ratio",
    "round_money",
    "row_hash",
    "safe_ratio",
    "scd_id",
    "sentinel_for",
    "spread_hash",
    "weekday_name",
    "weekday_sort",
    "year_month",
]
