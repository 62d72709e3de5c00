"""Tables by name, dimension pulls, named query sets."""

from __future__ import annotations

import os
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from ..schemas import ROLES


def read_table(spark: SparkSession, name: str, root: str | None = None) -> DataFrame:
    """A parquet table under ``root``, or a catalog table.  A known role is read with its
    explicit schema, without a look into the files; filters and column choices made on the
    result reach the scan."""
    if root is None:
        return spark.table(name)
    reader = spark.read.schema(ROLES[name]) if name in ROLES else spark.read
    return reader.parquet(os.path.join(root, f"{name}.parquet"))


def read_jdbc(
    spark: SparkSession, url: str, table: str, partition_column: str, lower: str, upper: str, partitions: int,
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """A server table read in parallel ranges; filters and columns are pushed to the server."""
    reader = spark.read.format("jdbc").options(
        url=url, dbtable=table, partitionColumn=partition_column, lowerBound=lower, upperBound=upper,
        numPartitions=str(partitions), **(properties or {}),
    )
    return reader.load()


def read_dims(spark: SparkSession, names: Sequence[str], root: str | None = None) -> dict[str, DataFrame]:
    return {name: read_table(spark, name, root) for name in names}


def run_queries(
    queries: Mapping[str, Callable[[], DataFrame]], register: bool = False
) -> dict[str, DataFrame]:
    """Named lazy frames; with ``register`` each becomes a temporary view as well."""
    frames = {name: build() for name, build in queries.items()}
    if register:
        for name, frame in frames.items():
            frame.createOrReplaceTempView(name)
    return frames


def select_rename(df: DataFrame, mapping: Mapping[str, str], front: Sequence[str] = ()) -> DataFrame:
    """Rename columns and move some to the front."""
    renamed = df.withColumnsRenamed(dict(mapping))
    return renamed.select(*front, *[c for c in renamed.columns if c not in front])
