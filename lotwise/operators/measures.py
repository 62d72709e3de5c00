"""Aggregates, ratios, shares and year-to-date figures."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import MONTH_ABBR
from ..session import written


def sum_when(condition: Column, value: Column) -> Column:
    """Conditional sum; rows outside the condition count as 0."""
    return F.sum(F.when(condition, value).otherwise(F.lit(0).cast("int")))


def pivot_sum(df: DataFrame, keys: Sequence[str], code: str, value: str, codes: Mapping[str, str]) -> DataFrame:
    """One sum column per code (``{code: column}``) in a single partial/final aggregate."""
    return df.groupBy(*keys).agg(
        *[sum_when(F.col(code) == wanted, F.col(value)).alias(out) for wanted, out in codes.items()]
    )


def group_sum(df: DataFrame, keys: Sequence[str], measures: Sequence[str], drop_null_keys: bool = False) -> DataFrame:
    """Sums per group; data-frame style grouping drops groups with a NULL key."""
    rows = df.dropna(subset=list(keys)) if drop_null_keys else df
    return rows.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in measures])


def any_nonzero(*measures: Column) -> Column:
    return reduce(lambda a, b: a | b, [m != 0 for m in measures])


def total_nonzero(*measures: Column) -> Column:
    """Tests the sum of the measures, which may cancel out and is NULL when one part is."""
    return reduce(lambda a, b: a + b, measures) != 0


def per_unit(total: Column, units: Column) -> Column:
    """Ratio of two sums as a double, NULL when there are no units."""
    return F.try_divide(total.cast("double"), units.cast("double"))


def cap(value: Column, limit: Column) -> Column:
    """The limit where the value exceeds it.  ``least`` would skip NULLs."""
    return F.when(value > limit, limit).otherwise(value)


def sum_if_max(guard: Column, limit: int, measure: Column) -> Column:
    """Sum of a measure where the group's largest absolute guard exceeds the limit, else 0."""
    return F.when(F.max(F.abs(guard)) > limit, F.coalesce(F.sum(measure), F.lit(0))).otherwise(0)


def recon_cost(units: Column, *costs: Column) -> Column:
    parts = [F.sum(F.when(c.isNull() | (units != 1) | units.isNull(), 0).otherwise(c)) for c in costs]
    return reduce(lambda a, b: a + b, parts)


def row_mean(*cols: Column) -> Column:
    """Mean of the values present in a row."""
    total = reduce(lambda a, b: a + b, [F.coalesce(c, F.lit(0)) for c in cols])
    return F.try_divide(total.cast("double"), row_nonnull(*cols).cast("double"))


def row_nonnull(*cols: Column) -> Column:
    return reduce(lambda a, b: a + b, [c.isNotNull().cast("int") for c in cols])


METRIC_OPERATIONS = {"sum": F.sum, "mean": F.avg, "max": F.max, "min": F.min, "count": F.count}


def metric_answer(df: DataFrame, metric: str, operation: str, out: str = "value") -> DataFrame:
    """One aggregate of one metric, chosen by name."""
    return df.agg(METRIC_OPERATIONS[operation](metric).cast("double").alias(out))


def arg_extreme(entity: Column, metric: Column, largest: bool = True) -> Column:
    """Entity holding the extreme metric; the alphabetically first on a tie, NULL metrics ignored."""
    order = F.when(metric.isNotNull(), F.struct(metric.alias("m"), entity.alias("e")))
    if largest:
        order = F.when(metric.isNotNull(), F.struct((-metric).alias("m"), entity.alias("e")))
    return F.min(order)["e"]


def round_half_even(col: Column, digits: int) -> Column:
    return F.bround(col, digits)


def share_of_total(
    df: DataFrame, keys: Sequence[str], measure: str, total: str, share: str, digits: int | None = 3, stored: bool = False
) -> DataFrame:
    """Total of the group and each row's share of it; NULL keys form a group of their own.

    The totals are a second aggregate joined back, not a window: a group holding a third
    of the rows is summed map-side and its rows stay spread over many tasks.  With ``stored``, for a table of many rows a group,
    it and its totals are written first: the rows are computed once, and joined where they are if the totals' file is small.
    """
    df = written(df, "of-total") if stored else df
    totals = df.groupBy(*keys).agg(F.sum(measure).alias(total))
    totals = written(totals, "totals") if stored else totals
    right = totals.select(*[F.col(k).alias(f"_{k}") for k in keys], total)
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    ratio = per_unit(F.col(measure), F.col(total))
    joined = df.join(right, same, "inner").drop(*[f"_{k}" for k in keys])
    return joined.withColumn(share, ratio if digits is None else round_half_even(ratio, digits))


def ytd_by_month(
    monthly: DataFrame, keys: Sequence[str], month: str, measure: str, as_of: date, out: str, label: str
) -> DataFrame:
    """Year-to-date sums up to every month 1..month(as_of), for every year in the data.

    A month's row counts towards itself and all later months, so an entity without sales
    in a month still carries its figure.  One row per key is shuffled, with a sum for every month; it
    fans out into its months afterwards, in place.
    """
    return ytd_rows(ytd_sums(monthly, keys, month, measure, as_of), keys, out, label)


def ytd_sums(df: DataFrame, keys: Sequence[str], month: str, measure: str, as_of: date) -> DataFrame:
    """Per key ``_first``, its first month up to ``as_of``'s, and ``_sums``, the measure up to each of months 1..month(as_of)."""
    months = range(1, as_of.month + 1)
    summed = df.filter(F.col(month).between(1, as_of.month)).groupBy(*keys).agg(
        F.min(month).cast("int").alias("_first"), *[F.sum(F.when(F.col(month) <= m, F.col(measure))).alias(f"_m{m}") for m in months]
    )
    return summed.select(*keys, "_first", F.array(*[f"_m{m}" for m in months]).alias("_sums"))


def ytd_rows(sums: DataFrame, keys: Sequence[str], out: str, label: str, *more: str) -> DataFrame:
    """A row per key and month from the key's first on, labelled ``YTDJan``..; ``more`` arrays by month become columns of their name."""
    names = F.array(*[F.lit(f"YTD{name}") for name in MONTH_ABBR])
    at = F.explode(F.sequence(F.col("_first"), F.size("_sums")))
    return sums.withColumn("_upto", at).select(
        *keys, F.element_at("_sums", F.col("_upto")).alias(out), F.element_at(names, F.col("_upto")).alias(label),
        *[F.element_at(m, F.col("_upto")).alias(m) for m in more],
    )


def sales_mix(sales: DataFrame, store: str, keys: Sequence[str], units: str) -> DataFrame:
    """Units per key and their share of the store's units; empty stores and keys are left out."""
    sold = sales.groupBy(store, *keys).agg(F.sum(units).alias("sold_count"))
    stores = sold.groupBy(store).agg(F.sum("sold_count").alias("denominator")).filter(F.col("denominator") != 0)
    return (
        sold.filter(F.col("sold_count") != 0)
        .join(stores, store, "left")
        .withColumn("sales_mix", per_unit(F.col("sold_count"), F.col("denominator")))
    )


def duration_components(days: Column, counted: Column, bands: Mapping[str, tuple[int | None, int]]) -> list[Column]:
    """Numerator (days) and denominator (records) per band ``name: (above, up to)``, as doubles."""
    columns = []
    for name, (above, upto) in bands.items():
        inside = counted & (days <= upto)
        if above is not None:
            inside = inside & (days > above)
        columns += [
            F.coalesce(F.sum(F.when(inside, days)), F.lit(0)).cast("double").alias(f"{name}_num"),
            F.count(F.when(inside, 1)).cast("double").alias(f"{name}_den"),
        ]
    return columns


def distinct_states(df: DataFrame, keys: Sequence[str], column: str, precision: int = 12) -> DataFrame:
    """Per key a sketch of the distinct values (``state``), to be stored and merged later, beside their exact number (``exact``).

    Counts of distinct values cannot be added over months or stores; sketches can.  One has at most 2^precision bytes
    and a few more, however many values it saw, and a relative standard error of 1.04 / sqrt(2^precision): 1.6 % at 12.  NULLs do not
    count.  Sketches of different precision merge at the lower one.
    """
    return df.groupBy(*keys).agg(
        F.hll_sketch_agg(column, precision).alias("state"), F.countDistinct(column).alias("exact")
    )


def merge_distinct(states: DataFrame, keys: Sequence[str], out: str) -> DataFrame:
    """Estimated number of distinct values per key from any selection of stored states, each one read once."""
    merged = F.hll_union_agg("state", F.lit(True))
    return states.groupBy(*keys).agg(F.hll_sketch_estimate(merged).alias(out))
