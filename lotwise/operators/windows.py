"""Rows picked and numbered along a key's history.

First and last rows are ``min_by``/``max_by`` aggregates, which combine map-side.
Numbering a whole history is cut into date chunks: rows are numbered inside
(key, chunk) and shifted by the rows of earlier chunks, so a unit that holds a third of
the table is spread over its chunks instead of landing in one window task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written


def latest_per(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Last row per key in ``order``; give enough columns to break ties."""
    return _pick(df, keys, order, F.max_by)


def earliest_per(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row per key in ``order``; NULLs sort first."""
    return _pick(df, keys, order, F.min_by)


def _pick(df, keys, order, pick):
    rest = [c for c in df.columns if c not in keys]
    row = pick(F.struct(*rest), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(row).select(*keys, "_row.*")


def prefer_source(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """One row per key, the first in ``order``; rows without a key are all kept."""
    keyed = earliest_per(df.filter(F.col(key).isNotNull()), [key], order)
    return keyed.unionByName(df.filter(F.col(key).isNull()))


def _keyed(df: DataFrame, keys: Sequence[str], chunk: str) -> DataFrame:
    """Adds ``_cell``, the key and chunk as one struct.  A struct is never NULL and its NULL
    fields are equal to each other, so one equality join keeps rows without a key, and the
    window that follows finds its rows already placed by the join."""
    return df.withColumn("_cell", F.struct(*keys, chunk))


def chunked_row_number(
    df: DataFrame, keys: Sequence[str], chunk: str, order: Sequence[str], out: str, total: str | None = None,
    count_from: DataFrame | None = None,
) -> DataFrame:
    """``row_number`` over ``keys`` ordered by (chunk, order), computed chunk by chunk.

    The running count is over one row per (key, chunk).  ``total`` adds the key's row count,
    which the same small table provides.  ``count_from`` names a cheaper frame with the same
    rows to count, where ``df`` already went through a join.
    """
    keyed = _keyed(df, keys, chunk)
    counted = keyed if count_from is None else _keyed(count_from, keys, chunk)
    cells = counted.groupBy("_cell").agg(F.count(F.lit(1)).alias("_n"))
    history = Window.partitionBy(*[F.col(f"_cell.{k}") for k in keys])
    before = history.orderBy(F.col(f"_cell.{chunk}")).rowsBetween(Window.unboundedPreceding, -1)
    shifts = [F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")]
    if total is not None:
        shifts.append(F.sum("_n").over(history).alias(total))
    inside = Window.partitionBy("_cell").orderBy(*order)
    return (
        keyed.join(cells.select("_cell", *shifts), "_cell")
        .withColumn(out, (F.row_number().over(inside) + F.col("_before")).cast("int"))
        .drop("_before", "_cell")
    )


def chunked_lag(
    df: DataFrame, keys: Sequence[str], chunk: str, order: Sequence[str], value: str, out: str
) -> DataFrame:
    """``lag`` over ``keys`` ordered by (chunk, order): inside a chunk a window, across chunks
    the last value of the chunk before."""
    keyed = _keyed(df, keys, chunk)
    cells = keyed.groupBy("_cell").agg(F.max_by(F.struct(value), F.struct(*order)).alias("_last"))
    across = Window.partitionBy(*[F.col(f"_cell.{k}") for k in keys]).orderBy(F.col(f"_cell.{chunk}"))
    carried = cells.select("_cell", F.lag("_last").over(across).alias("_carry"))
    inside = Window.partitionBy("_cell").orderBy(*order)
    first = F.row_number().over(inside) == 1
    previous = F.when(first, F.col("_carry")[value]).otherwise(F.lag(value).over(inside))
    return keyed.join(carried, "_cell").withColumn(out, previous).drop("_carry", "_cell")


def price_runs(df: DataFrame, unit: str, store: str, price: str, day: str, tie: Sequence[str]) -> DataFrame:
    """Number a unit's appearances in a store and at each price.

    Adds ``appearance`` (per unit and store), ``days_at_price`` and ``from_last`` (per price,
    counted from the first and from the last record) and ``price_change_flag``.  The backward
    count is the group size minus the forward count, which saves a second numbering.
    """
    numbered = chunked_row_number(df, [unit, store], day, [day, *tie], "appearance")
    numbered = chunked_row_number(
        numbered, [unit, store, price], day, [day, *tie], "days_at_price", total="_size", count_from=df
    )
    return (
        numbered.withColumn("from_last", (F.col("_size") - F.col("days_at_price") + 1).cast("int"))
        .withColumn("price_change_flag", (F.col("days_at_price") == 1).cast("int"))
        .drop("_size")
    )


def price_changes(runs: DataFrame, unit: str, store: str) -> DataFrame:
    """Records that open a new price or close one, for units with more than one such record
    in a store.  The flag's maximum per unit is always 1, so it filters nothing.  These few records are
    written once, so that whatever reads them again does not number the runs again."""
    kept = runs.filter(
        ((F.col("days_at_price") == 1) & (F.col("appearance") != 1)) | (F.col("from_last") == 1)
    )
    kept = written(kept, "price-changes")
    busy = (
        kept.groupBy(unit, store)
        .agg(F.count(F.lit(1)).alias("_n"))
        .groupBy(unit)
        .agg(F.max("_n").alias("max_changes"))
        .filter(F.col("max_changes") > 1)
    )
    return kept.join(busy, unit, "inner")


def price_deltas(df: DataFrame, unit: str, price: str, day: str, tie: Sequence[str]) -> DataFrame:
    """Previous price of the unit, whether it changed, and the discount given."""
    lagged = chunked_lag(df, [unit], day, [day, *tie], price, "previous_price")
    changed = ~F.col(price).eqNullSafe(F.col("previous_price"))
    return lagged.withColumn("price_changed", changed).withColumn(
        "discount", F.when(changed, F.col("previous_price") - F.col(price)).otherwise(0)
    )


def carry_last_valid(
    df: DataFrame, unit: str, days: str, changed: Column, discount: Column, tie: Sequence[str], out: str
) -> DataFrame:
    """Day count of the last change without a discount, moved to the next discounted change.

    Walks a unit's changes from the longest day count down.  A discounted change uses the
    remembered count up, so every stretch between two discounted changes remembers anew.

    What a row does to the remembered count is to set it, to clear it or nothing, and such steps compose to
    the last one that does anything.  So the steps of each (unit, day count) cell are summed up in one row, those rows are
    combined along the unit, and each cell is walked alone from what the cells before it leave: the rows of a unit,
    however many, are spread over its day counts.
    """
    empty = changed & (discount.isNull() | (discount == 0))
    real = changed & ~empty
    step = F.when(real, F.struct(F.lit(None).cast(df.schema[days].dataType).alias("v"))).when(empty, F.struct(F.col(days).alias("v")))
    keyed = _keyed(df, [unit], days).withColumn("_step", step)
    cells = keyed.groupBy("_cell").agg(F.max_by("_step", F.when(F.col("_step").isNotNull(), F.struct("_cell", *tie))).alias("_last"))
    along = Window.partitionBy(F.col(f"_cell.{unit}")).orderBy(F.desc(f"_cell.{days}")).rowsBetween(Window.unboundedPreceding, -1)
    carried = cells.select("_cell", F.last("_last", ignorenulls=True).over(along).alias("_carry"))
    inside = Window.partitionBy("_cell").orderBy("_cell", *tie).rowsBetween(Window.unboundedPreceding, -1)
    seen = F.coalesce(F.last("_step", ignorenulls=True).over(inside), F.col("_carry"))
    return (
        keyed.join(carried, "_cell")
        .withColumn("_seen", seen)
        .withColumn(out, F.when(real, F.coalesce("_seen.v", F.col(days))).otherwise(F.col(days)))
        .drop("_seen", "_step", "_carry", "_cell")
    )


def flag_latest(df: DataFrame, day: str, out: str) -> DataFrame:
    """1 on rows of the newest date.  The maximum is a scalar subquery, not a global window."""
    newest = df.agg(F.max(day)).scalar()
    return df.withColumn(out, F.coalesce((F.col(day) == newest).cast("int"), F.lit(0)))
