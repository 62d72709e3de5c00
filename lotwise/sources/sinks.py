"""Writers.  A table is replaced by swapping whole partitions or versions, and a run that
is repeated after a failure writes the same result."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import written
from .files import list_files


def write_csv(df: DataFrame, path: str, sort: Sequence[str] = ()) -> None:
    """CSV with header, one file per task; ``sort`` orders the rows across the files."""
    (df.orderBy(*sort) if sort else df).write.mode("overwrite").option("header", True).csv(path)


def replace_table(df: DataFrame, path: str) -> None:
    """Full replacement.  ``df`` must not read from ``path``."""
    df.write.mode("overwrite").parquet(path)


def replace_partitions(df: DataFrame, path: str, keys: Sequence[str], writers: int = 32) -> None:
    """Replace only the partitions present in ``df``; the same input gives the same table.
    Rows are gathered per partition value plus a hash, so a big period is written by up to ``writers`` tasks."""
    spread = df.withColumn("_salt", F.pmod(F.xxhash64(*df.columns), F.lit(writers)))
    spread.repartition(*keys, "_salt").drop("_salt").write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy(*keys).parquet(path)


def fingerprints(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, rows, ``_sum``, ``_bits``): per period a fingerprint of its rows as a multiset, in any order.

    Rows are hashed to 64 bits twice, with NULLs and their places: one hash is summed, the other combined bit by bit.  Two
    periods with equal fingerprints hold the same rows but for a chance of about 2^-64.  Hashes combine before the shuffle.
    """
    values = [F.col(c) for c in df.columns if c not in keys]
    marked = [*values, *[v.isNull() for v in values]]
    hashed = df.select(
        *keys, F.xxhash64(F.lit(1), *marked).cast("decimal(20,0)").alias("_one"), F.xxhash64(F.lit(2), *marked).alias("_two")
    )
    return hashed.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"), F.sum("_one").cast("decimal(38,0)").alias("_sum"), F.bit_xor("_two").alias("_bits")
    )


def upsert_changed(df: DataFrame, path: str, keys: Sequence[str], writers: int = 32) -> DataFrame:
    """Replace the periods of the table at ``path`` whose rows differ in ``df``; files of all others stay as they are.

    Returns a written report with one row per period of ``df``: ``keys``, ``rows`` and ``action`` ('added', 'replaced'
    or 'kept').  What decides is the fingerprint of the rows that the table holds now, of the delivered periods
    alone, so a run that broke off is made good by the next one, and a run that is repeated writes nothing.  Periods that ``df``
    lacks stay.  ``df`` is read twice and must give the same rows; it must not read from ``path``.  A
    first run creates the table.  Columns may come in another order; other columns than the table's raise.
    """
    spark = df.sparkSession
    delivered = written(fingerprints(df, keys), "delivered")
    held = _read_or_none(spark, path)
    if held is None:
        known = delivered.limit(0)
    elif {*held.columns} != {*df.columns}:
        raise ValueError(f"columns differ from the table's: {sorted({*held.columns} ^ {*df.columns})}")
    else:
        held = spark.read.schema(df.schema).parquet(path).select(*df.columns)
        known = fingerprints(held.filter(_in_periods(delivered, keys)), keys)
    state = delivered.alias("d").join(known.alias("k"), _all_same("d", "k", keys), "left").select(
        *[F.col(f"d.{c}") for c in keys], F.col("d.rows").alias("rows"),
        F.when(F.col("k.rows").isNull(), "added").when(_all_same("d", "k", ["rows", "_sum", "_bits"]), "kept").otherwise("replaced").alias("action"),
    )
    report = written(state, "upsert")
    replace_partitions(df.filter(_in_periods(report.filter("action <> 'kept'"), keys)), path, keys, writers)
    return report


def _in_periods(periods: DataFrame, keys: Sequence[str]) -> Column:
    """Whether a row is of one of the periods, NULL being one as well: a filter on the keys alone, so a scan of the
    partitioned table skips all others.  The driver holds a name per period, as it does for the table's partitions."""
    name = F.to_json(F.struct(*keys))
    return name.isin([r[0] for r in periods.select(name).collect()])


def _all_same(left: str, right: str, columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in columns])


def archive_snapshot(df: DataFrame, root: str, as_of: date, if_absent: bool = True, source: str | None = None) -> None:
    """Dated copy ``root/as_of=YYYY-MM-DD``, written once per day unless told to replace it.

    A day is there when its success marker is; one that a crash left half-written is written again.
    With ``source``, the file or folder that ``df`` comes from, only a stale one is archived: its newest
    file was modified before the day ``as_of`` (in the session's time zone).
    """
    if source is not None:
        stale = F.to_date(F.max("modified")) < F.lit(as_of)
        if not list_files(df.sparkSession, source).agg(stale.alias("stale")).first()["stale"]:
            return
    path = f"{root}/as_of={as_of.isoformat()}"
    if not (if_absent and _is_complete(df.sparkSession, path)):
        df.write.mode("overwrite").parquet(path)


def _is_complete(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    marker = jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")
    return marker.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(marker)


def read_archive(spark: SparkSession, root: str) -> DataFrame | None:
    """All dated copies with their ``as_of`` column, or None before the first one."""
    return _read_or_none(spark, root)


def _read_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``; None where nothing is, or no file holds a row yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def snapshot_at(df: DataFrame, day_col: str, as_of: date, days_back: int = 7) -> DataFrame:
    """Snapshot of ``days_back`` days before; empty when there was none.  Prunes partitions."""
    return df.filter(F.col(day_col) == F.lit(as_of - timedelta(days=days_back)))
