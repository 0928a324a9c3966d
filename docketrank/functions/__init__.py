"""Column functions; nothing in here touches a session or runs a job."""

from docketrank.functions.dates import calendar_year, floor_date, month_start, parse_date, years_before
from docketrank.functions.display import (
    count_text,
    currency_text,
    date_text,
    map_label,
    millions_text,
    percent_text,
)
from docketrank.functions.money import exact_cents, exact_sum, exact_total, implausible, outstanding, parse_double, parse_money
from docketrank.functions.text import is_nonblank, normalize_key, trim_text

__all__ = [
    "calendar_year",
    "count_text",
    "currency_text",
    "date_text",
    "exact_cents",
    "exact_sum",
    "exact_total",
    "floor_date",
    "implausible",
    "is_nonblank",
    "map_label",
    "millions_text",
    "month_start",
    "normalize_key",
    "outstanding",
    "parse_date",
    "parse_double",
    "parse_money",
    "percent_text",
    "trim_text",
    "years_before",
]
