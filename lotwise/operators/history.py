"""History tables: rolling, replacing and extending them.

Each function returns the next version; write it to a new path or replace partitions
(see ``sources.sinks``), never over the files it was read from.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import month_start


def roll_history(history: DataFrame, new: DataFrame, date_col: str, as_of: date) -> DataFrame:
    """Drop the oldest snapshot, append the new one, and restamp the current month's first
    day with ``as_of``.  The oldest date is a scalar subquery over one pruned column."""
    oldest = history.agg(F.min(date_col)).scalar()
    kept = history.filter(F.col(date_col) > oldest)
    stacked = kept.unionByName(new.withColumn(date_col, F.lit(as_of)), allowMissingColumns=True)
    restamped = F.when(F.col(date_col) == F.lit(month_start(as_of)), F.lit(as_of)).otherwise(F.col(date_col))
    return stacked.withColumn(date_col, restamped)


def replace_period(history: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Delete the periods that ``new`` covers, then append it.  Running it twice changes nothing."""
    periods = new.select(*keys).distinct()
    return history.join(periods, list(keys), "left_anti").unionByName(new, allowMissingColumns=True)


def replace_named_period(history: DataFrame, new: DataFrame, period: dict[str, object]) -> DataFrame:
    """As :func:`replace_period` for one known period: a pushed filter on both sides, no join."""
    same = F.lit(True)
    for name, value in period.items():
        same = same & F.col(name).eqNullSafe(F.lit(value))
    return history.filter(~same).unionByName(new.filter(same), allowMissingColumns=True)


def append_months(
    current: DataFrame, history: DataFrame, months: Sequence[int], years: Sequence[int],
    month: str = "sale_month", year: str = "sale_year",
) -> DataFrame:
    """Move the chosen months of the current file into history."""
    chosen = current.filter(F.col(month).isin(*months) & F.col(year).isin(*years))
    return history.unionByName(chosen, allowMissingColumns=True)
