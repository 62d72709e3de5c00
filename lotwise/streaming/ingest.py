"""Folder ingestion: each new file once; the newest file of a period wins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir
from ..sources.sinks import replace_partitions

FILES_PER_BATCH = 1000
#: Spark leaves out files this much older than the newest one it has seen; no file is that old.
NO_FILE_TOO_OLD = "3650000d"


def read_folder(spark: SparkSession, folder: str, schema: str, files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """Files of a folder as a stream, oldest first, each row with its file (``_file``).
    Keep checkpoint and folder on shared storage."""
    return (
        spark.readStream.schema(schema)
        .option("header", True)
        .option("maxFilesPerTrigger", files_per_batch)
        .option("maxFileAge", NO_FILE_TOO_OLD)
        .option("escape", '"')
        .csv(folder)
        .withColumn("_file", F.struct(F.col("_metadata.file_modification_time"), F.col("_metadata.file_path")))
    )


def newest_per_period(batch: DataFrame, period_keys: Sequence[str]) -> DataFrame:
    """Rows of the newest file that covers their period."""
    newest = batch.groupBy(F.struct(*period_keys).alias("_period")).agg(F.max("_file").alias("_file"))
    rows = batch.withColumn("_period", F.struct(*period_keys))
    return rows.join(newest, ["_period", "_file"], "left_semi").drop("_period", "_file")


def _periods_loaded(spark: SparkSession, path: str) -> DataFrame | None:
    """(period, file) of every replacement so far, or None before the first one."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def ingest_new_files(
    spark: SparkSession, folder: str, schema: str, table_path: str, checkpoint: str, period_keys: Sequence[str],
    files_per_batch: int = FILES_PER_BATCH,
) -> None:
    """Bring the files that arrived since the last run into a table partitioned by period.

    A file replaces the periods it covers unless a newer file has.  Inside a batch the newest file of a
    period counts; across batches the table ``<table_path>_files`` remembers which file each period came
    from, so a file that arrives late never overwrites a newer one.  A batch repeated after a crash meets
    its own files there at most and leaves the same table.  The checkpoint remembers the files handled.
    """
    ledger = f"{table_path.rstrip('/')}_files"

    def upsert(batch: DataFrame, _batch_id: int) -> None:
        period = F.struct(*period_keys).alias("period")
        files = batch.groupBy(period).agg(F.max("_file").alias("file"))
        known = _periods_loaded(batch.sparkSession, ledger)
        if known is not None:
            last = known.groupBy("period").agg(F.max("file").alias("last"))
            files = files.join(last, "period", "left").where(F.col("last").isNull() | (F.col("file") >= F.col("last")))
        files = files.select("period", "file").checkpoint()
        rows = batch.withColumn("period", period).join(
            files.withColumnRenamed("file", "_file"), ["period", "_file"], "left_semi"
        )
        replace_partitions(rows.drop("period", "_file"), table_path, period_keys)
        files.write.mode("append").parquet(ledger)

    shared_dir(spark)
    query = (
        read_folder(spark, folder, schema, files_per_batch)
        .writeStream.foreachBatch(upsert)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
