"""Row filters shared by the reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import add_months, month_start


def ci_in(col: Column, values: Sequence[str]) -> Column:
    """Case-insensitive IN, as the source database compares."""
    return F.upper(col).isin(*[v.upper() for v in values])


def ci_not_in(col: Column, values: Sequence[str]) -> Column:
    """Case-insensitive NOT IN; a NULL is neither in nor out and so drops the row."""
    return ~ci_in(col, values)


def ci_equal(col: Column, value: str) -> Column:
    return F.upper(col) == value.upper()


def eligible_units(
    df: DataFrame, excluded_markets: Sequence[str], excluded_region: str, min_year: int | None = None
) -> DataFrame:
    """Units whose list price can be reported: priced, valid, recent and in a retail market."""
    rule = (
        (F.col("msrp") > 0)
        & (F.col("valid_for_group") == 1)
        & (F.col("valid_for_pricing") == 1)
        & (F.upper("region_name") != excluded_region.upper())
        & ci_not_in(F.col("market_name"), excluded_markets)
    )
    return df.filter(rule if min_year is None else rule & (F.col("year") > min_year))


def exclude_values(df: DataFrame, values: Mapping[str, Sequence[str]]) -> DataFrame:
    """Drop rows holding one of the listed values; a NULL is kept, as a data-frame mask keeps it."""
    keep = [F.coalesce(~F.col(c).isin(*v), F.lit(True)) for c, v in values.items()]
    return df.filter(reduce(lambda a, b: a & b, keep))


def drop_overlap(df: DataFrame, as_of: date, year: str = "sale_year", month: str = "sale_month") -> DataFrame:
    """Drop last year's rows of the two months before ``as_of``; history already has them."""
    recent = [add_months(month_start(as_of), -n).month for n in (1, 2)]
    overlap = (F.col(year) == as_of.year - 1) & F.col(month).isin(*recent)
    return df.filter(~F.coalesce(overlap, F.lit(False)))


def on_days(col: Column, days: Sequence[date]) -> Column:
    return F.to_date(col).isin(*list(days))


def not_like_any(col: Column, fragments: Sequence[str]) -> Column:
    """None of the fragments occurs in the text, ignoring case."""
    return reduce(lambda a, b: a & b, [~F.upper(col).contains(f.upper()) for f in fragments])
