"""Records of delimited files whose quoted cells may hold line breaks, found in splits read in parallel.

Whether a line begins a record depends on every line before it.  A line is a function from "outside" or "inside a
quoted cell" at its start to the same at its end, and such functions compose: the functions of a split's
lines are combined inside the split, those of the splits over the splits of a file, and both give each line its state.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..session import written


def ends_inside(line: Column, sep: str = ",", quote: str = '"') -> Column:
    """Whether a quoted cell is open at the end of a line that starts outside one.

    A quote opens a cell only where the cell begins; a doubled quote inside is one quote; what follows a closing quote
    up to the separator belongs to the cell.
    """
    s, q = (f"\\x{ord(c):02x}" for c in (sep, quote))
    closed = rf"(^|{s}){q}[^{q}]*+(?:{q}{q}[^{q}]*+)*+{q}"
    return F.when(F.contains(line, F.lit(quote)), F.regexp_replace(line, closed, "$1").rlike(rf"(^|{s}){q}")).otherwise(F.lit(False))


def _after(function: Column, state: Column) -> Column:
    return F.when(state == 1, function["inside"]).otherwise(function["outside"])


def _states(rows: DataFrame, order: WindowSpec) -> DataFrame:
    """``rows`` (with ``function``) and fixed, flips of the functions before each row, composed: the state before the
    row is ``fixed`` if that is not NULL (a function before ends in one state, whatever came before it), else the
    first state, turned if ``flips`` is 1."""
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    up_to = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    outside, inside = F.col("function.outside"), F.col("function.inside")
    turns = F.when(outside > inside, 1).otherwise(0)
    rows = rows.withColumn("_turned", F.sum(turns).over(up_to)).withColumn("_turns", F.col("_turned") - turns)
    constant = F.when(outside == inside, F.struct(outside.alias("state"), F.col("_turned").alias("turned")))
    rows = rows.withColumn("_latest", F.last(constant, ignorenulls=True).over(before))
    fixed = (F.col("_latest.state") + F.col("_turns") - F.col("_latest.turned")) % 2
    return rows.withColumn("fixed", fixed).withColumn("flips", F.col("_turns") % 2).drop("_turned", "_turns", "_latest")


def assemble_records(lines: DataFrame, sep: str = ",", quote: str = '"') -> DataFrame:
    """``lines`` with the lines of a record joined by a line feed, at the position of the first.

    ``lines`` has file_path, position (block: where the split of the file begins; row: ascending within it), line and any
    columns that are the same in a whole file, and must give the same rows whenever it is read.  A file without a line
    that ends inside a quoted cell is left as it is.  In others the lines of each split are ordered in one task,
    which a split bounds, and the splits of a file in another, one short row per split.  A file that ends inside a
    quoted cell is an error that names it.
    """
    opened = lines.where(ends_inside(F.col("line"), sep, quote)).select("file_path").distinct()
    opened = written(opened, "opened-files")
    if opened.isEmpty():
        return lines
    function = F.struct(
        ends_inside(F.col("line"), sep, quote).cast("int").alias("outside"),
        ends_inside(F.concat(F.lit(quote), F.col("line")), sep, quote).cast("int").alias("inside"),
    )
    inside_split = Window.partitionBy("file_path", "position.block").orderBy("position.row")
    scanned = _states(lines.join(opened, "file_path", "left_semi").withColumn("function", function), inside_split)
    scanned = written(scanned, "scanned-lines")

    # Of each split, for both states it may begin with: the state at its end, and its last line that begins a record.
    state = {s: F.coalesce("fixed", (F.lit(s) + F.col("flips")) % 2) for s in (0, 1)}
    splits = scanned.groupBy("file_path", F.col("position.block").alias("block")).agg(
        F.max_by(F.struct(_after(F.col("function"), state[0]).alias("outside"), _after(F.col("function"), state[1]).alias("inside")), "position.row").alias("function"),
        *[F.max(F.when(state[s] == 0, F.col("position"))).alias(f"last_{s}") for s in (0, 1)],
    )
    over_splits = Window.partitionBy("file_path").orderBy("block")
    splits = _states(splits, over_splits).withColumn("begins", F.coalesce("fixed", "flips"))  # a file begins outside
    last = F.when(F.col("begins") == 1, F.col("last_1")).otherwise(F.col("last_0"))
    earlier = F.last(last, ignorenulls=True).over(over_splits.rowsBetween(Window.unboundedPreceding, -1))
    splits = splits.withColumn("earlier", earlier).withColumn("ends", _after(F.col("function"), F.col("begins")))
    splits = written(splits.select(F.col("file_path").alias("of_file"), "block", "begins", "earlier", "ends"), "split-states")
    wrong = splits.groupBy("of_file").agg(F.max_by("ends", "block").alias("ends")).where("ends = 1").agg(F.min("of_file")).first()[0]
    if wrong is not None:
        raise ValueError(f"a quoted cell is still open at the end of file: {wrong}")

    joined = scanned.join(splits, (F.col("file_path") == F.col("of_file")) & (F.col("position.block") == F.col("block")))
    joined = joined.withColumn("state", F.coalesce("fixed", (F.col("begins") + F.col("flips")) % 2))
    joined = joined.withColumn("after", _after(F.col("function"), F.col("state")))
    begun = F.last(F.when(F.col("state") == 0, F.col("position")), ignorenulls=True).over(inside_split.rowsBetween(Window.unboundedPreceding, 0))
    whole = (F.col("state") == 0) & (F.col("after") == 0)
    joined = joined.withColumn("record", F.coalesce(begun, F.col("earlier"))).withColumn("whole", whole)
    joined = written(joined.select(*lines.columns, "record", "whole"), "record-lines")
    shared = [c for c in lines.columns if c not in ("file_path", "position", "line")]
    parts = joined.where("not whole").groupBy("file_path", "record").agg(
        F.array_sort(F.collect_list(F.struct("position", "line"))).alias("parts"), *[F.first(c).alias(c) for c in shared]
    )
    parts = parts.withColumn("line", F.array_join(F.col("parts.line"), "\n")).withColumn("position", F.col("record"))
    single = joined.where("whole").select(*lines.columns)
    untouched = lines.join(opened, "file_path", "left_anti")
    return untouched.unionByName(written(single.unionByName(parts.select(*lines.columns)), "records"))
