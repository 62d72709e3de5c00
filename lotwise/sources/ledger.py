"""Loads of delimited files that may be repeated at any time: known files are skipped, changed files replace their rows.

``root`` holds three things.  ``rows``: a partition per load, written once and never changed, of the rows of its files, good
and bad.  ``ledger``: numbered versions, one row per known file: its length, time and content mark, and the load
that its rows lie in.  A row counts if the newest version names its file with its load, so one rename makes a
whole load visible, and a load that was cut off leaves a partition that nobody reads.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import written

LEDGER = "path string, length long, modified timestamp, mark decimal(38,0), load string, good long, bad long"
_LINE = "_line"


@dataclass(frozen=True)
class Loaded:
    """What a load did: files read, files that were touched only, rows added and rows rejected."""

    files: int
    touched: int
    rows: int
    rejected: int


def _store(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def _newest(spark: SparkSession, root: str) -> int | None:
    """Number of the newest ledger version; a version appears by a rename and is whole."""
    store, folder = _store(spark, f"{root}/ledger")
    names = [s.getPath().getName() for s in store.listStatus(folder)] if store.exists(folder) else []
    return max((int(n.removeprefix("v")) for n in names if n.removeprefix("v").isdigit()), default=None)


def ledger(spark: SparkSession, root: str) -> DataFrame:
    """The known files (columns of ``LEDGER``)."""
    version = _newest(spark, root)
    if version is None:
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(f"{root}/ledger/v{version}")


def _publish(df: DataFrame, root: str) -> None:
    """``df`` as the next version.  Of two loads at once the second one's rename fails, and it may be repeated."""
    spark = df.sparkSession
    number = (_newest(spark, root) or 0) + 1
    draft = f"{root}/ledger/draft-{uuid4().hex}"
    df.coalesce(1).write.parquet(draft)  # one row per file
    store, source = _store(spark, draft)
    target = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/ledger/v{number}")
    if store.exists(target) or not store.rename(source, target):
        raise RuntimeError(f"another load has written {target} meanwhile; load again")


def _listed(spark: SparkSession, folder: str) -> DataFrame:
    """(path, name, modified, length) of a folder's files; path is encoded as in a row's metadata, name is as read.
    A file without a byte has no time and no name, as it is never opened."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    files = listed.select(F.col("_metadata.file_path").alias("path"), F.col("path").alias("name"), F.col("modificationTime").alias("modified"), "length")
    every = spark.createDataFrame([(re.sub("^file:/+", "file:/", f),) for f in listed.inputFiles()], "path string")
    empty = every.join(files, "path", "left_anti").withColumn("length", F.lit(0).cast("long"))
    return files.unionByName(empty, allowMissingColumns=True)


def _names(files: DataFrame) -> list[str]:
    """The names of files with a byte, as patterns that match nothing else."""
    return [re.sub(r"([\\*?\[\]{}])", r"\\\1", r["name"]) for r in files.where("length > 0").select("name").collect()]


def _parsed(spark: SparkSession, paths: list[str], schema: str, header: bool, multi_line: bool) -> DataFrame:
    """The rows of the files, those that cannot be read with their ``_line`` and what could be read of them."""
    marked = T.StructType.fromDDL(schema).add(_LINE, T.StringType())
    rows = (
        spark.read.schema(marked)
        .options(header=str(header).lower(), mode="PERMISSIVE", quote='"', escape='"', multiLine=multi_line, columnNameOfCorruptRecord=_LINE)
        .csv(paths)
    )
    return rows.select(*rows.columns, F.col("_metadata.file_path").alias("_file"))


def _none(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], T.StructType.fromDDL(schema).add(_LINE, T.StringType()).add("_file", T.StringType()))


def _mark(rows: DataFrame) -> Column:
    """A sum of row hashes: the same for the same rows in any order."""
    cells = F.struct(*[f"`{c}`" for c in rows.columns if c != "_file"])
    return F.sum(F.xxhash64(cells).cast("decimal(38,0)"))


def load_files(spark: SparkSession, folder: str, schema: str, root: str, header: bool = True, multi_line: bool = False) -> Loaded:
    """Load what is new in ``folder`` and return what was done.

    A file with the length and time of the ledger is not opened.  One of the same length and another time is read, but not
    written, and only its time is noted if its rows are the same.  All others are read once: rows that fit ``schema`` and
    rows that do not are written side by side and counted on the way.  A file that was loaded before is replaced
    by its new rows, also if it has none any more.  Files that are gone keep their rows.
    """
    known = ledger(spark, root).withColumnsRenamed({c: f"old_{c}" for c in ("length", "modified", "mark", "load", "good", "bad")})
    files = _listed(spark, folder).join(known, "path", "left")
    same_length = F.col("length").eqNullSafe(F.col("old_length"))
    files = files.where(~(same_length & F.col("modified").eqNullSafe(F.col("old_modified"))))
    files = written(files.withColumn("same_length", same_length), "files")
    doubtful = _names(files.where("same_length"))
    touched: DataFrame | None = None
    if doubtful:
        rows = _parsed(spark, doubtful, schema, header, multi_line)
        marks = rows.groupBy(F.col("_file").alias("path")).agg(_mark(rows).alias("mark"))
        equal = files.join(marks, "path").where("mark <=> old_mark")
        touched = written(equal.select("path", "length", "modified", "mark", F.col("old_load").alias("load"), F.col("old_good").alias("good"), F.col("old_bad").alias("bad")), "touched")
        files = files.join(touched.select("path"), "path", "left_anti")
    wanted, entries = _names(files), [] if touched is None else [touched]
    done = Loaded(files.count(), 0 if touched is None else touched.count(), 0, 0)
    if done.files:
        load = uuid4().hex
        rows = _parsed(spark, wanted, schema, header, multi_line) if wanted else _none(spark, schema)
        seen = Observation(f"load-{load}")
        bad = F.col(_LINE).isNotNull()
        target = f"{root}/rows/load={load}"
        if wanted:
            rows = rows.observe(seen, F.count_if(~bad).alias("good"), F.count_if(bad).alias("bad"))
        rows.write.parquet(target)
        stored = spark.read.schema(rows.schema).parquet(target)
        counts = stored.groupBy(F.col("_file").alias("path")).agg(_mark(stored).alias("mark"), F.count_if(~bad).alias("good"), F.count_if(bad).alias("bad"))
        entries.append(files.select("path", "length", "modified").join(counts, "path", "left").select(
            "path", "length", "modified", "mark", F.lit(load).alias("load"), F.coalesce("good", F.lit(0)).cast("long").alias("good"), F.coalesce("bad", F.lit(0)).cast("long").alias("bad")
        ))
        done = Loaded(done.files, done.touched, *((seen.get["good"], seen.get["bad"]) if wanted else (0, 0)))
    if entries:
        new = entries[0] if len(entries) == 1 else entries[0].unionByName(entries[1])
        new = written(new, "entries")
        _publish(ledger(spark, root).join(new.select("path"), "path", "left_anti").unionByName(new), root)
    return done


def _current(spark: SparkSession, schema: str, root: str) -> DataFrame | None:
    """Rows of the loads that the ledger names; the loads it names are read, no others."""
    files = ledger(spark, root)
    loads = [r["load"] for r in files.select("load").distinct().collect()]
    store, folder = _store(spark, f"{root}/rows")
    if not loads or not store.exists(folder):
        return None
    marked = T.StructType.fromDDL(schema).add(_LINE, T.StringType()).add("_file", T.StringType())
    rows = spark.read.option("basePath", f"{root}/rows").schema(marked.add("load", T.StringType())).parquet(*[f"{root}/rows/load={n}" for n in loads])
    named = files.select(F.col("path").alias("_file"), "load")
    return rows.join(named, ["_file", "load"], "left_semi")


def loaded_rows(spark: SparkSession, schema: str, root: str) -> DataFrame:
    """All good rows, with the file each came from as ``source_file``."""
    rows, names = _current(spark, schema, root), T.StructType.fromDDL(schema).fieldNames()
    if rows is None:
        return spark.createDataFrame([], f"{schema}, source_file string")
    return rows.where(F.col(_LINE).isNull()).select(*[f"`{c}`" for c in names], F.col("_file").alias("source_file"))


def rejected_lines(spark: SparkSession, schema: str, root: str) -> DataFrame:
    """(source_file, line) of the rows that do not fit the schema."""
    rows = _current(spark, schema, root)
    if rows is None:
        return spark.createDataFrame([], "source_file string, line string")
    return rows.where(F.col(_LINE).isNotNull()).select(F.col("_file").alias("source_file"), F.col(_LINE).alias("line"))
