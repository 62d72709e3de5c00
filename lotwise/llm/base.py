"""What the operators of this subpackage share: word patterns, written tables and small column helpers."""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lotwise.session import new_path

#: A word is a run of characters that are not ASCII white space (Java and Python syntax).
WORD = r"[^\x20\x09-\x0D]+"
WHITE = r"[\x20\x09-\x0D]+"

#: Rows of an Arrow batch: whole texts are held in the JVM and again in Python, so batches are kept small.
BATCH_ROWS = 512
#: While a table is written: its shuffle files go when the write ends (the table is read instead), and batches are small.
_WRITING = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": str(BATCH_ROWS),
}


@contextmanager
def _set_for_writing(spark: SparkSession) -> Iterator[None]:
    before = {key: spark.conf.get(key, None) for key in _WRITING}
    for key, value in _WRITING.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the folder all executors share and read it back.

    This cuts the lineage (a lost executor costs no recomputation of what came before), keeps only
    columnar, compressed bytes on disk, and tells the planner the true size, so that later joins
    broadcast the table only if it is below ``spark.sql.autoBroadcastJoinThreshold``.
    """
    spark = df.sparkSession
    path = new_path(spark, f"llm-{name}")
    with _set_for_writing(spark):
        df.write.option("compression", "zstd").parquet(path)
    kept = spark.read.schema(df.schema).parquet(path)
    kept.kept_at = path
    return kept


def forget(*tables: DataFrame | None) -> None:
    """Remove tables that ``keep`` wrote, after all that was made of them is written too."""
    for table in tables:
        if table is not None:
            spark = table.sparkSession
            path = spark._jvm.org.apache.hadoop.fs.Path(table.kept_at)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def fresh(name: str, *tables: DataFrame) -> str:
    """``name``, or a like name that no column of the tables has."""
    taken = {c.lower() for table in tables for c in table.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def with_row(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a key of each row, and that column's name: 128 bits of its file and place, so that rows which
    are equal in all values differ, and each has the same key whenever it is read.  A table that is not read
    from Parquet files is written first."""
    name = fresh("row_key", docs)
    try:
        place = docs.metadataColumn("_metadata")
        docs.select(place["row_index"])
    except AnalysisException:
        docs = keep(docs, "rows")
        place = docs.metadataColumn("_metadata")
    key = F.concat_ws(":", place["row_index"].cast("string"), place["file_path"])
    return docs.withColumn(name, F.unhex(F.md5(key.cast("binary")))), name


def places(rows: DataFrame) -> DataFrame:
    """``rows`` with place, 0 to their number less one, in the order of (part, row); row is gapless within part."""
    per = rows.groupBy(F.col("part").alias("of_part")).agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.orderBy("of_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = per.select("of_part", F.coalesce(before, F.lit(0)).cast("long").alias("start"))  # one row per task
    joined = rows.join(starts, F.col("part") == F.col("of_part"))
    return joined.withColumn("place", F.col("start") + F.col("row")).drop("part", "row", "of_part", "start")


def with_unique_id(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with an id of each row, and that column's name: its doc_id, but of rows that repeat a doc_id one
    alone has it, and the others and those without a doc_id have numbers above all doc_ids."""
    name = fresh("unique_id", docs)
    counts = docs.groupBy(F.col("doc_id").alias("repeated")).agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("most"))
    most = keep(counts, "id-counts").agg(F.max("most"), F.max(F.when(F.col("repeated").isNull(), F.lit(2)).otherwise(F.col("n")))).first()
    if (most[1] or 0) < 2:
        return docs.withColumn(name, F.col("doc_id")), name
    rows, key = with_row(docs)
    ids = rows.select("doc_id", F.col(key).alias("key"))
    firsts = keep(ids.where("doc_id is not null").groupBy("doc_id").agg(F.min("key").alias("key")).select("key"), "first-rows")
    others = ids.select("key").join(firsts, "key", "left_anti").withColumn("at", F.monotonically_increasing_id())
    others = keep(others.select("key", F.shiftright("at", 33).alias("part"), F.col("at").bitwiseAND(F.lit((1 << 33) - 1)).alias("row")), "other-rows")
    top = most[0] if most[0] is not None else -1
    numbers = keep(places(others).select(F.col("key").alias("other_key"), (F.col("place") + F.lit(top + 1)).alias("number")), "other-numbers")
    renamed = {c: fresh(c, docs, rows) for c in numbers.columns}
    joined = rows.join(numbers.withColumnsRenamed(renamed), F.col(key) == F.col(renamed["other_key"]), "left")
    return joined.withColumn(name, F.coalesce(F.col(renamed["number"]), F.col("doc_id"))).drop(key, *renamed.values()), name


def without(docs: DataFrame, column: str, gone: DataFrame, name: str) -> DataFrame:
    """The rows of ``docs`` whose ``column`` is not in ``gone`` (one column), and without that column."""
    key = fresh("gone_key", docs)
    gone = keep(gone.toDF(key), name)
    return docs.join(gone, F.col(column) == F.col(key), "left_anti").drop(column)


def _give_back() -> None:
    """Freed memory returns to the system (where the C library offers it), not only to this process."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A ``mapInArrow`` function whose worker keeps no freed memory when a task ends: executors keep idle
    workers for the next stage, so what each has grown to adds up with what that stage needs."""

    @functools.wraps(run)
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        _give_back()

    return task


def lean_group(run: Callable[[pa.Table], pa.Table]) -> Callable[[pa.Table], pa.Table]:
    """The same for an ``applyInArrow`` function, after each group."""

    @functools.wraps(run)
    def task(group: pa.Table) -> pa.Table:
        out = run(group)
        _give_back()
        return out

    return task


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list:
    """A text column of an Arrow batch; NULL as empty bytes."""
    return [b"" if t is None else t for t in batch.column(column).to_pylist()]


def lists_of(parts: list[np.ndarray]) -> pa.ListArray:
    """An Arrow column of 64-bit integer lists."""
    ends = np.cumsum([0, *map(len, parts)]).astype(np.int32)
    return pa.ListArray.from_arrays(ends, np.concatenate(parts) if parts else np.empty(0, np.int64))


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def word_array(text: Column) -> Column:
    """The words of a text; none for an empty text."""
    return F.array_remove(F.split(text, WHITE), "")


def word_count(text: Column) -> Column:
    """Number of words, 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
