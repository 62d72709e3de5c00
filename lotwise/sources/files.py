"""Delimited files: one file, the newest file, many files of many tenants."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.lookup import first_contained
from ..session import written
from .records import assemble_records


def read_delimited(
    spark: SparkSession, path: str | list[str], schema: str | T.StructType, sep: str = ",", quote: str = '"',
    encoding: str = "UTF-8", header: bool = True, multi_line: bool = False,
) -> DataFrame:
    """Typed read without inference; pass an all-string schema for the text mode.

    A doubled quote inside a quoted cell is one quote.  ``multi_line`` reads quoted line breaks; such
    files are not split, so leave it off where no cell has one.
    """
    return (
        spark.read.schema(schema)
        .options(header=str(header).lower(), sep=sep, quote=quote, escape=quote, encoding=encoding, multiLine=multi_line)
        .csv(path)
    )


def string_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """(path, modified, length) of a folder's files; their content is never read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(folder)
        .select("path", F.col("modificationTime").alias("modified"), "length")
    )


def latest_file(
    spark: SparkSession, folder: str, include: Sequence[str] = (), exclude: Sequence[str] = ()
) -> str | None:
    """Newest file whose name holds every ``include`` and no ``exclude`` fragment."""
    name = F.element_at(F.split("path", "/"), -1)
    files = list_files(spark, folder)
    for fragment in include:
        files = files.filter(name.contains(fragment))
    for fragment in exclude:
        files = files.filter(~name.contains(fragment))
    return files.agg(F.max_by("path", F.struct("modified", "path"))).first()[0]


def append_csv(
    spark: SparkSession, path: str, schema: str, table_path: str, header: bool = True, multi_line: bool = False
) -> int:
    """Append the readable rows of a file and report how many; broken rows are skipped.

    The count rides along with the write instead of a second pass.  Cells are quoted as in
    :func:`read_delimited`; :func:`rejected_rows` returns what is skipped here.
    """
    rows = (
        spark.read.schema(schema)
        .options(header=str(header).lower(), mode="DROPMALFORMED", quote='"', escape='"', multiLine=multi_line)
        .csv(path)
    )
    seen = Observation("append_csv")
    rows.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("append").parquet(table_path)
    return seen.get["rows"]


def rejected_rows(spark: SparkSession, path: str, schema: str, header: bool = True, multi_line: bool = False) -> DataFrame:
    """(file_path, line) of the rows that :func:`append_csv` cannot read."""
    marked = T.StructType.fromDDL(schema).add("_line", T.StringType())
    rows = (
        spark.read.schema(marked)
        .options(header=str(header).lower(), mode="PERMISSIVE", quote='"', escape='"', multiLine=multi_line)
        .option("columnNameOfCorruptRecord", "_line")
        .csv(path)
    )
    # All columns take part, or the parser would not read the cells that are broken.
    cells = F.concat_ws("", *[F.col(f"`{c}`").cast("string") for c in rows.columns if c != "_line"])
    return rows.where(F.col("_line").isNotNull() & (F.length(cells) >= 0)).select(
        F.col("_metadata.file_path").alias("file_path"), F.col("_line").alias("line")
    )


def append_csv_once(spark: SparkSession, path: str, schema: str, table_path: str, header: bool = True, multi_line: bool = False) -> int:
    """:func:`append_csv` that may be repeated: each file has its own partition ``source_file`` of the table, which a
    second load of the file replaces, also by nothing.  For files that come again and again see ``ledger``."""
    rows = (
        spark.read.schema(schema)
        .options(header=str(header).lower(), mode="DROPMALFORMED", quote='"', escape='"', multiLine=multi_line)
        .csv(path)
    )
    columns = rows.columns
    # The file's own name alone would let two folders' files replace each other.
    source = lambda path: F.concat_ws("-", F.xxhash64(path), F.element_at(F.split(F.url_decode(path), "/"), -1))
    read = spark.createDataFrame([(re.sub("^file:/+", "file:/", f),) for f in rows.inputFiles()], "path string")
    before = _files_of(spark, table_path, read.select(source(F.col("path")).alias("source_file")))
    seen = Observation("append_csv_once")
    rows = rows.select(*columns, source(F.col("_metadata.file_path")).alias("source_file")).observe(seen, F.count(F.lit(1)).alias("rows"))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("source_file").parquet(table_path)
    for uri in before:  # of files that have no row any more
        old = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(uri))
        old.getFileSystem(spark._jsc.hadoopConfiguration()).delete(old, False)
    return seen.get["rows"]


def _files_of(spark: SparkSession, table_path: str, partitions: DataFrame) -> list[str]:
    """The files that hold these partitions (source_file) of the table, none if there is no table yet."""
    table = spark._jvm.org.apache.hadoop.fs.Path(table_path)
    if not table.getFileSystem(spark._jsc.hadoopConfiguration()).exists(table):
        return []
    files = spark.read.schema("source_file string").parquet(table_path).select("source_file", F.col("_metadata.file_path").alias("path"))
    return [r["path"] for r in files.join(partitions, "source_file", "left_semi").select("path").distinct().collect()]


def _located_lines(spark: SparkSession, paths: str | list[str], encoding: str) -> DataFrame:
    """Text lines with file and position.  Files are split as usual: inside a split rows keep
    their order, and splits are ordered by their start."""
    text = F.col("value")
    if encoding.upper() not in ("UTF-8", "UTF8"):
        text = F.decode(text.cast("binary"), encoding)
    return spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("file_path"),
        F.element_at(F.split(F.col("_metadata.file_name"), "/"), -1).alias("file_name"),
        F.struct(
            F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row")
        ).alias("position"),
        text.alias("line"),
    )


BROADCAST_FILES = 20_000


def combine_tenant_files(
    spark: SparkSession,
    paths: str | list[str],
    columns: Sequence[str] | None,
    tenant_map: Mapping[str, str],
    extra_maps: Mapping[str, Mapping[str, str]] | None = None,
    encoding: str = "ISO-8859-1",
    text_limits: Mapping[str, int] | None = None,
    match_on: str = "file_name",
) -> DataFrame:
    """Rows of many tenants' CSV files as one table of text columns.

    Every file has its own header; cells are matched by header name, and a column a file lacks is
    NULL.  With ``columns=None`` the table has the union of all files' headers, sorted: headers that
    differ in case only are one column, a header that its own file repeats gets a number (``ID.1``), an
    empty one its place (``Unnamed: 2``), and a header named like a column added here gives way
    to it.  A list of ``columns`` selects exactly these.  The last line of each file is a footer total and is
    dropped, files without rows vanish.  ``tenant`` (and the columns of ``extra_maps``) come
    from the first map entry found in the file name (with ``match_on="file_path"`` in the whole
    path, for a folder per tenant); a filled file of an unknown tenant is an
    error that names it.  Quoted cells may hold separators and line breaks (read as line feeds); files are split
    all the same (see ``records``).

    Lines with their positions are written once, because positions are only comparable
    within one read.  Header and footer of each file are then two aggregates over the records,
    joined back by file: no file passes through one task.
    """
    lines = assemble_records(written(_located_lines(spark, paths, encoding), "lines")).filter(F.trim("line") != "")
    stem = F.regexp_replace(match_on, r"\.[^./]*$", "")
    ends = written(lines.groupBy("file_path").agg(
        F.min("position").alias("first"), F.max("position").alias("last"),
        F.min_by("line", "position").alias("header"),
        F.min(first_contained(stem, tenant_map)).alias("tenant"),
    ), "file-ends")  # one short row per file, read three times
    filled = F.col("first") < F.col("last")
    facts = ends.agg(
        F.count(F.lit(1)).alias("files"),
        F.max(F.when(filled, F.size(F.split("header", ",")))).alias("width"),
        F.min(F.when(filled & F.col("tenant").isNull(), F.col("file_path"))).alias("unknown"),
    ).first()
    if facts["unknown"] is not None:
        raise ValueError(f"tenant could not be determined for file: {facts['unknown']}")
    width = facts["width"] or 1
    cells_schema = ", ".join(f"c{i} string" for i in range(width))
    # One parse per line: the struct is a column of its own before its fields become an array.
    as_row = lambda c: F.from_csv(c, cells_schema, {"escape": '"', "multiLine": "true", "maxCharsPerColumn": "-1"})
    as_array = F.array(*[F.col(f"_row.c{i}") for i in range(width)])
    names = F.transform(as_array, lambda name: F.trim(name))
    heads = ends.withColumn("_row", as_row(F.col("header")))
    if columns is None:
        heads = heads.withColumn("_names", _own_names(names, F.col("header")))
        key = F.lower("name")
        found = heads.filter(filled).select(F.explode("_names").alias("name")).groupBy(key.alias("key")).agg(F.min("name").alias("name")).collect()
        added = {c.lower() for c in (*(extra_maps or {}), "tenant", "file_path")}
        keys = {r["name"]: r["key"] for r in sorted(found, key=lambda r: r["name"]) if r["key"] not in added}
        names = F.transform("_names", lambda name: F.lower(name))
    else:
        heads, keys = heads.withColumn("_names", names), {c: c for c in columns}
        names = F.col("_names")
    places = F.array(*[F.nullif(F.array_position(names, k), F.lit(0)).cast("int") for k in keys.values()])
    heads = heads.withColumn("places", places).drop("header", "_row", "_names")
    if facts["files"] <= BROADCAST_FILES:  # one short row per file
        heads = F.broadcast(heads)
    body = (
        lines.join(heads, "file_path")
        .filter((F.col("position") > F.col("first")) & (F.col("position") < F.col("last")))
        .withColumn("_row", as_row(F.col("line")))
        .withColumn("cells", as_array)
    )
    picked: list[Column] = []
    for i, name in enumerate(keys):
        value = F.nullif(F.try_element_at(F.col("cells"), F.col("places")[i]), F.lit(""))
        limit = (text_limits or {}).get(name)
        picked.append((F.substring(value, 1, limit) if limit else value).alias(name))
    extras = [first_contained(stem, m).alias(c) for c, m in (extra_maps or {}).items()]
    return body.select(*picked, *extras, "tenant", "file_path")


def _own_names(names: Column, header: Column) -> Column:
    """The headers of a file under different names; ``names`` may be longer than the header."""
    cells = F.size(F.split(F.regexp_replace(header, '"[^"]*"', ""), ","))
    named = F.transform(
        F.slice(names, F.lit(1), cells),
        lambda name, i: F.coalesce(F.nullif(name, F.lit("")), F.concat(F.lit("Unnamed: "), i.cast("string"))),
    )

    def numbered(name: Column, i: Column) -> Column:
        earlier = F.size(F.filter(F.slice(named, F.lit(1), i), lambda other: F.lower(other) == F.lower(name)))
        return F.when(earlier == 0, name).otherwise(F.concat(name, F.lit("."), earlier.cast("string")))

    return F.transform(named, numbered)


def standardize(df: DataFrame, rename: Mapping[str, str], types: Mapping[str, str]) -> DataFrame:
    """Rename and cast the columns that exist; a value that does not convert becomes NULL."""
    out = []
    for name in df.columns:
        new = rename.get(name, name)
        col = F.col(f"`{name}`")
        out.append((col.try_cast(types[new]) if new in types else col).alias(new))
    return df.select(*out)
