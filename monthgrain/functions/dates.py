"""Date checks, bins and ages. ``month`` is ``yyyyMM`` text."""

from __future__ import annotations

from collections.abc import Sequence

from monthgrain.functions.text import text
from monthgrain.months import month_end, month_start

ISO_DATE = "yyyy-MM-dd"

# Open dates strictly between these two are read as the later one.
OPEN_DATE_FLOOR = "DATE'1917-01-01'"
OPEN_DATE_EARLIEST = "DATE'1980-01-01'"

# Fixed value: average days per month used for account ages.
DAYS_PER_MONTH = "30.44D"


def parse_date(value: str, formats: Sequence[str] = (ISO_DATE,)) -> str:
    """Date by the first format that fits; null if none does."""
    tried = [f"try_to_date(string({value}), {text(f)})" for f in formats]
    return f"coalesce({', '.join(tried)})"


def inside_month(day: str, month: str) -> str:
    """Keep a date of the month, the day before it and the day after it; else null."""
    first = month_start(month)
    return (
        f"CASE WHEN {day} BETWEEN date_sub({first}, 1) AND add_months({first}, 1) "
        f"THEN {day} END"
    )


def third_of_month(day: str) -> str:
    """1 for days 1-10, 2 for 11-20, 3 for later days, -1 without a date."""
    number = f"dayofmonth({day})"
    return (
        f"CASE WHEN {number} <= 10 THEN 1 WHEN {number} <= 20 THEN 2 "
        f"WHEN {number} > 20 THEN 3 ELSE -1 END"
    )


def weekday_name(day: str) -> str:
    """English weekday name."""
    return f"date_format({day}, 'EEEE')"


def clamp_open_date(day: str, month: str) -> str:
    """Lift implausibly old open dates to 1980 and drop those after the month's end.

    Dates up to 1917-01-01 are placeholders and pass unchanged.
    """
    return (
        f"CASE WHEN {day} > {OPEN_DATE_FLOOR} AND {day} < {OPEN_DATE_EARLIEST} "
        f"THEN {OPEN_DATE_EARLIEST} WHEN {day} > {month_end(month)} THEN NULL ELSE {day} END"
    )


def age_in_months(day: str, month: str) -> str:
    """Months from a date to the end of the snapshot month."""
    return f"datediff({month_end(month)}, {day}) / {DAYS_PER_MONTH}"
