"""Stacking of facts and files with different columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..session import written


def stack_facts(frames: Sequence[DataFrame], fill: Mapping[str, object] | None = None) -> DataFrame:
    """UNION ALL by column name; a measure one side lacks is filled with its neutral value."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    for column, value in (fill or {}).items():
        stacked = stacked.withColumn(column, F.coalesce(F.col(column), F.lit(value)))
    return stacked


def union_distinct(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.unionByName(right).distinct()


def drop_empty_columns(df: DataFrame) -> DataFrame:
    """``df`` without the columns that have no value.  It is written once, its values counted on the way, and
    the table is read without the empty columns."""
    seen = Observation("values")
    table = written(df.observe(seen, *[F.count(F.col(f"`{c}`")).alias(f"n{i}") for i, c in enumerate(df.columns)]), "stack")
    return table.select(*[f"`{c}`" for i, c in enumerate(df.columns) if seen.get.get(f"n{i}", 0) > 0])


def combine_frames(frames: Sequence[DataFrame]) -> DataFrame:
    """Append frames by name, without columns that are empty everywhere, in sorted column order."""
    if not frames:
        raise ValueError("no valid frames to combine")
    combined = drop_empty_columns(stack_facts(frames))
    if not combined.columns:
        raise ValueError("no frame has a value to combine")
    return combined.select(*[f"`{c}`" for c in sorted(combined.columns)])


def fill_placeholders(df: DataFrame, keys: Sequence[str], measures: Sequence[str], placeholder: str) -> DataFrame:
    """Keys without a value become a placeholder and measures 0, so that grouping keeps every row."""
    types = dict(df.dtypes)
    cols = []
    for name in df.columns:
        col = F.col(name)
        if name in measures:
            col = F.coalesce(col, F.lit(0).cast(types[name]))
        elif name in keys:
            col = F.coalesce(col.cast("string"), F.lit(placeholder))
        cols.append(col.alias(name))
    return df.select(*cols)
