"""Lookups, overrides and dense spines.

No broadcast hints: a dimension is broadcast when Catalyst or AQE has measured it to be
small, and joined by a shuffle (with AQE splitting hot keys) when it is not.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dedupe_last(dim: DataFrame, keys: Sequence[str], position: Sequence[str]) -> DataFrame:
    """Last row per key in ``position`` order, as building a dictionary from rows keeps it."""
    rest = [c for c in dim.columns if c not in keys]
    last = F.max_by(F.struct(*rest), F.struct(*position)).alias("_last")
    return dim.groupBy(*keys).agg(last).select(*keys, "_last.*")


def lookup(
    df: DataFrame,
    dim: DataFrame,
    on: Sequence[str],
    cols: Mapping[str, str] | Sequence[str],
    default: object = None,
) -> DataFrame:
    """Left lookup of ``cols`` (``{dim column: new name}``) with a default for misses.

    Rows multiply when ``dim`` repeats a key, as in a table merge; pass it through
    :func:`dedupe_last` first for dictionary behaviour.  NULL keys never match.
    """
    names = cols if isinstance(cols, Mapping) else {c: c for c in cols}
    right = dim.select(*on, *[F.col(old).alias(f"_{new}") for old, new in names.items()])
    joined = df.join(right, list(on), "left")
    for new in names.values():
        value = F.col(f"_{new}")
        joined = joined.withColumn(new, value if default is None else F.coalesce(value, F.lit(default)))
    return joined.drop(*[f"_{new}" for new in names.values()])


def map_from_table(
    df: DataFrame, key: Column, table: DataFrame, table_key: str, value: str, out: str, default: str | None = None
) -> DataFrame:
    """Dictionary map against a table whose keys are unique (see :func:`dedupe_last`)."""
    right = table.select(F.col(table_key).alias("_map_key"), F.col(value).alias("_map_value"))
    joined = df.withColumn("_probe", key).join(right, F.col("_probe") == F.col("_map_key"), "left")
    found = F.col("_map_value") if default is None else F.coalesce("_map_value", F.lit(default))
    return joined.withColumn(out, found).drop("_probe", "_map_key", "_map_value")


def first_contained(text: Column, ordered: Mapping[str, str]) -> Column:
    """Value of the first entry, in map order, whose key occurs in the text."""
    chain = F
    for key, value in ordered.items():
        chain = chain.when(text.contains(key), value)
    return chain.otherwise(F.lit(None).cast("string"))


def restrict_to_allowed(df: DataFrame, allowed: DataFrame, on: Sequence[str]) -> DataFrame:
    """Keep rows whose key is on the list; a repeated list entry does not multiply rows."""
    return df.join(allowed.select(*on), list(on), "left_semi")


def override_blank(df: DataFrame, dim: DataFrame, on: Sequence[str], pairs: Mapping[str, str]) -> DataFrame:
    """Replace empty text in each column by the override from ``dim``; NULL is left alone."""
    right = dim.select(*on, *[F.col(src).alias(f"_{src}") for src in pairs.values()])
    joined = df.join(right, list(on), "left")
    for col, src in pairs.items():
        joined = joined.withColumn(col, F.when(F.col(col) == "", F.col(f"_{src}")).otherwise(F.col(col)))
    return joined.drop(*[f"_{src}" for src in pairs.values()])


def backfill_from_history(
    df: DataFrame, history: DataFrame, key: str, value: str, newest: Sequence[str], missing: str
) -> DataFrame:
    """Second-chance lookup: rows still at ``missing`` take the newest historical value.

    History is cut down to the keys that need it before it is reduced to one row each.
    """
    unmatched = F.lower(F.col(value)) == missing
    wanted = df.filter(unmatched).select(key).distinct()
    latest = (
        history.join(wanted, key, "left_semi")
        .groupBy(key)
        .agg(F.max_by(F.col(value), F.struct(*newest, value)).alias("_found"))
    )
    joined = df.join(latest, key, "left").withColumn("was_missing", F.coalesce(unmatched, F.lit(False)))
    filled = F.when(unmatched, F.coalesce("_found", F.lit(missing))).otherwise(F.col(value))
    return joined.withColumn(value, filled).drop("_found")


def densify(dates: DataFrame, date_col: str, label_col: str, labels: Sequence[str]) -> DataFrame:
    """Every label on every date: the fixed label list is exploded, nothing is cross joined."""
    spine = dates.select(date_col).distinct()
    return spine.withColumn(label_col, F.explode(F.array(*[F.lit(label) for label in labels])))


def attach_coordinates(df: DataFrame, zips: DataFrame, zip_col: str, prefix: str) -> DataFrame:
    """Latitude and longitude of the first five characters of a postal code."""
    right = zips.select(
        F.col("zip_code").alias("_zip"),
        F.col("latitude").alias(f"{prefix}_latitude"),
        F.col("longitude").alias(f"{prefix}_longitude"),
    )
    return df.join(right, F.left(F.col(zip_col), F.lit(5)) == F.col("_zip"), "left").drop("_zip")


def zero_unless_marked(measure: Column, needs_marker: Column, marker: Column) -> Column:
    """The measure, or 0 on rows that need a marker and found none in a left join."""
    return F.when(needs_marker & marker.isNull(), 0).otherwise(measure)


def max_per(df: DataFrame, keys: Sequence[str], col: str, out: str) -> DataFrame:
    """Group maximum on every row.  Partial aggregates and a join: a hot group is never one task."""
    top = df.groupBy(*keys).agg(F.max(col).alias(out))
    return df.join(top.select(*[F.col(k).alias(f"_{k}") for k in keys], out), _null_safe(df, keys), "inner").drop(
        *[f"_{k}" for k in keys]
    )


def _null_safe(df: DataFrame, keys: Sequence[str]) -> Column:
    condition = F.lit(True)
    for i, key in enumerate(keys):
        same = F.col(key).eqNullSafe(F.col(f"_{key}"))
        condition = same if i == 0 else condition & same
    return condition
