"""Reporting calendar: Python helpers that turn ``as_of`` into literals, and date columns.

Every report takes ``as_of`` explicitly, so that window edges are literals which reach
the scan as pushed filters, and a rerun gives the same rows.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

MONTH_NAMES = [
    "january", "february", "march", "april", "may", "june",
    "july", "august", "september", "october", "november", "december",
]
MONTH_ABBR = [name[:3].capitalize() for name in MONTH_NAMES]


def month_start(day: date) -> date:
    return day.replace(day=1)


def add_months(day: date, months: int) -> date:
    """Shift by calendar months; the day is clamped to the target month's length."""
    index = day.year * 12 + day.month - 1 + months
    first = date(index // 12, index % 12 + 1, 1)
    following = date((index + 1) // 12, (index + 1) % 12 + 1, 1)
    return first.replace(day=min(day.day, (following - first).days))


def quarter_start(day: date) -> date:
    return date(day.year, (day.month - 1) // 3 * 3 + 1, 1)


def reporting_day(as_of: date, cutover_day: int) -> date:
    """``as_of`` itself, or the last day of the month before while the month is too young."""
    return as_of if as_of.day >= cutover_day else month_start(as_of) - timedelta(days=1)


def reporting_month(as_of: date, cutover_day: int) -> date:
    return month_start(reporting_day(as_of, cutover_day))


def closed_month(as_of: date, cutover_day: int = 6) -> date:
    """Month whose books are closed: one month back, or two before the cut-over day."""
    return add_months(reporting_month(as_of, cutover_day), -1)


def last_week(as_of: date) -> tuple[date, date]:
    """Monday and Sunday of the last full week before ``as_of``."""
    monday = as_of - timedelta(days=as_of.weekday() + 7)
    return monday, monday + timedelta(days=6)


def comparison_periods(as_of: date) -> list[tuple[str, date, date]]:
    """The four overlapping sales periods of the weekly comparison (name, start, end)."""
    this_month = month_start(as_of)
    prior_month = add_months(this_month, -1)
    return [
        ("PM", prior_month, add_months(as_of - timedelta(days=1), -1)),
        ("IN-BETWEEN-1", prior_month, add_months(as_of + timedelta(days=7), -1)),
        ("CM", this_month, as_of - timedelta(days=1)),
        ("IN-BETWEEN-2", this_month, as_of - timedelta(days=7)),
    ]


# --- columns -----------------------------------------------------------------


def month_of(col: Column) -> Column:
    """First day of the month as DATE (``date_trunc`` would give a zoned timestamp)."""
    return F.trunc(col, "month")


def last_days(col: Column, days: int, as_of: date) -> Column:
    return F.to_date(col) >= F.lit(as_of - timedelta(days=days))


def between_days(col: Column, start: date, end: date) -> Column:
    return F.to_date(col).between(F.lit(start), F.lit(end))


def last_months(col: Column, months: int, as_of: date) -> Column:
    return col >= F.lit(add_months(month_start(as_of), -months))


def quarter_months(col: Column, as_of: date) -> Column:
    """Closed months of the current quarter, or quarter-end months of earlier quarters."""
    start = quarter_start(as_of)
    current = col.between(F.lit(start), F.lit(add_months(month_start(as_of), -1)))
    earlier = F.month(col).isin(3, 6, 9, 12) & (col < F.lit(start))
    return current | earlier


def year_month_to_date(period: Column) -> Column:
    """``YYYYMM`` text to the first day of that month; NULL when it is not one."""
    return F.try_to_date(F.concat(period, F.lit("01")), "yyyyMMdd")


def quarter_label(col: Column) -> Column:
    return F.coalesce(F.concat(F.lit("Q"), F.quarter(col).cast("string")), F.lit("Unk"))


PERIOD_OFFSETS = {"PM": -1, "CM": 0, "PY": -12}
MONTH_END_PERIOD_OFFSETS = {"PM": -2, "CM": -1, "PY": -12}


def period_label(month: Column, as_of: date, offsets: dict[str, int] = PERIOD_OFFSETS) -> Column:
    base = month_start(as_of)
    label = F
    for name, offset in offsets.items():
        label = label.when(month == F.lit(add_months(base, offset)), name)
    return label.otherwise("ERROR")


def period_filter(
    month: Column, status: Column, as_of: date, offsets: dict[str, int] = PERIOD_OFFSETS, open_status: str = "G"
) -> Column:
    """Months to compare; the current one leaves out units in the ``open_status``."""
    base = month_start(as_of)
    closed = [add_months(base, off) for name, off in offsets.items() if name != "CM"]
    current = add_months(base, offsets["CM"])
    return month.isin(closed) | ((month == F.lit(current)) & (F.upper(status) != open_status))
