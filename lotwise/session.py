"""Session builder and the one place that decides where shared scratch data lives."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "lotwise", cores: str = "*", shuffle_partitions: int | None = None) -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", "12g")
    )
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``.  Only a local master, where
    driver and executors share one disk, may fall back to a temporary folder.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = context.getCheckpointDir() or tempfile.mkdtemp(prefix="lotwise-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(configured)
    return configured


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder; nothing is ever overwritten in place."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")


#: Shuffle files of a query go when it ends, not when the driver happens to collect its garbage.
_CLEANED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a compressed table in the shared folder, read back: computed once, and never again for a lost executor.

    The shuffle files behind it go with the write, as the table is read from then on.
    """
    spark = df.sparkSession
    path, before = new_path(spark, name), spark.conf.get(_CLEANED, None)
    spark.conf.set(_CLEANED, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.unset(_CLEANED) if before is None else spark.conf.set(_CLEANED, before)
    return spark.read.schema(df.schema).parquet(path)
