"""Days met with the intervals of a table, by equality joins on an index of bins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# Classes of sums: a day's sums are copied for each class, so there are fewer of them, three binary digits apart.
SUM_STEP = 3


def interval_bins(intervals: DataFrame, start: str, end: str, step: int = 1) -> DataFrame:
    """One row per bin that an interval lies in, with ``_class`` and ``_bin``.

    An interval of up to 2^c days and more than 2^(c-``step``) is of class c, a multiple of ``step``, whose bins are
    2^c days wide: it lies in one bin or two, however long it is.  Both ends belong to the interval.  One that lacks
    an end, or ends before it starts, holds no day and has no row.
    """
    first, last = _day(F.col(start)), _day(F.col(end))
    classed = (
        intervals.withColumn("_first", first).withColumn("_last", last).filter(F.col("_first") <= F.col("_last"))
        .withColumn("_class", F.ceil(_bits(F.col("_last") - F.col("_first")) / step).cast("int") * step)
    )
    both = F.array_distinct(F.array(_bin(F.col("_first"), F.col("_class")), _bin(F.col("_last"), F.col("_class"))))
    return classed.withColumn("_bin", F.explode(both))


def _day(col: Column) -> Column:
    return F.unix_date(F.to_date(col))


def _bits(number: Column) -> Column:
    """Binary digits of a number that is not negative, none for 0: exact, unlike a logarithm."""
    return F.when(number == 0, 0).otherwise(F.length(F.bin(number)))


def _bin(day: Column, size: Column) -> Column:
    """A shift to the right rounds down, days before 1970 included."""
    return F.call_function("shiftright", day, size)


def days_in_intervals(
    df: DataFrame, day: str, intervals: DataFrame, start: str, end: str, keys: Sequence[str] = ()
) -> DataFrame:
    """(keys, ``_day``, interval columns): every day that ``df`` has for a key, with each interval of that key that holds it.

    Every distinct (keys, day) looks into one bin of each class that occurs.  Less than four days lie in
    an interval's bins for each day of its own, so the equality join tries no more than that many pairs for
    an answer where days are spread evenly, and no pair of days and intervals is compared outside a bin.  A key
    with most of the intervals is spread over its bins.  Rows without a day or with a NULL key meet nothing.
    """
    _refuse_taken(df, intervals, keys)
    days = df.select(*keys, _day(F.col(day)).alias("_day")).dropna().distinct()
    met = _in_bins(days, interval_bins(intervals, start, end), keys)
    return met.select(*keys, F.date_from_unix_date("_day").alias("_day"), *[c for c in intervals.columns if c not in keys])


def _refuse_taken(df: DataFrame, intervals: DataFrame, keys: Sequence[str]) -> None:
    shared = ({*df.columns} & {*intervals.columns}) - {*keys}
    taken = {*df.columns, *intervals.columns} & {"_first", "_last", "_class", "_bin", "_day"}
    if shared or taken:
        raise ValueError(f"columns on both sides or reserved: {sorted(shared | taken)}")


def _in_bins(days: DataFrame, index: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``days`` (keys, ``_day``, ...) with each interval of the index that holds the day."""
    classes = index.agg(F.collect_set("_class")).scalar()  # at most 32 of them
    probes = days.withColumn("_class", F.explode(classes)).withColumn("_bin", _bin(F.col("_day"), F.col("_class")))
    return probes.join(index, [*keys, "_class", "_bin"]).filter(F.col("_day").between(F.col("_first"), F.col("_last")))


def assign_intervals(
    df: DataFrame, day: str, intervals: DataFrame, start: str, end: str, keys: Sequence[str] = ()
) -> DataFrame:
    """One row of ``df`` per interval of its keys that holds its day, with the interval's columns.

    Rows meet their intervals by (keys, day).  Repeated intervals count each; rows in no interval go.  For sums,
    sum to (keys, day) first: :func:`sums_in_intervals`.
    """
    held = days_in_intervals(df, day, intervals, start, end, keys)
    return df.withColumn("_day", F.to_date(F.col(day))).join(held, [*keys, "_day"]).select(
        *df.columns, *[c for c in intervals.columns if c not in keys]
    )


def sums_in_intervals(
    df: DataFrame, day: str, measures: Sequence[str], intervals: DataFrame, start: str, end: str, keys: Sequence[str] = ()
) -> DataFrame:
    """Sums and row count (``rows``) of each interval that holds a row.

    The rows shrink to their days, which carry the sums into the bins of their intervals; an interval's days meet it in
    one bin or two and are summed there, before any shuffle.  So what is shuffled grows with the days and the
    intervals, not with the days that the intervals hold.
    """
    daily = df.groupBy(*keys, F.to_date(F.col(day)).alias(day)).agg(
        *[F.sum(m).alias(m) for m in measures], F.count(F.lit(1)).alias("rows")
    )
    _refuse_taken(daily, intervals, keys)
    days = daily.withColumn("_day", _day(F.col(day))).drop(day).dropna(subset=[*keys, "_day"])
    columns = [*keys, *[c for c in intervals.columns if c not in keys]]
    return _in_bins(days, interval_bins(intervals, start, end, SUM_STEP), keys).groupBy(*columns).agg(
        *[F.sum(m).alias(m) for m in (*measures, "rows")]
    )
