"""Exact dedup: group by a 128-bit content hash, keep the smallest id, compare bytes inside the groups."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import WHITE, keep, text_or_empty, with_unique_id, without


def normalised(text: Column) -> Column:
    """Each run of ASCII white space becomes one space."""
    return F.regexp_replace(text, WHITE, " ")


def md5_128(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


def exact_dedup(docs: DataFrame, content_hash: Callable[[Column], Column] = md5_128, carry: Sequence[str] = ()) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, and the columns ``carry``.

    Reads ``doc_id`` and ``text`` only.  NULL text counts as empty, so all empty texts form a group.
    Rows that repeat a doc_id and its text are one document: they count in ``group_size`` and share
    the verdict.  A NULL doc_id is never the smallest; a group of only NULL ids keeps NULL.  An empty
    table gives an empty result.

    Hashes are grouped with partial aggregation, so a group that holds a third of all rows is summed
    before the shuffle.  Only members of groups of two or more are compared: each member's text meets
    the text of its group's smallest id in an equi-join whose skewed side Spark can split.  Members
    that differ from it (a collision) are grouped by their whole text.
    """
    texts = docs.select("doc_id", *carry, normalised(text_or_empty()).alias("norm")).withColumn("hash", content_hash(F.col("norm")))
    sha = F.sha2(F.col("norm").cast("binary"), 256).alias("text_sha256")
    keys = keep(texts.select("doc_id", *carry, "hash", sha), "dedup-keys")
    groups = keep(
        keys.groupBy("hash").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n")).where("n > 1"), "dedup-groups"
    )
    members = keep(texts.join(groups, "hash").select("doc_id", *carry, "hash", "first_id", "norm", sha), "dedup-members")
    first = members.where(F.col("doc_id").eqNullSafe(F.col("first_id"))).groupBy("hash").agg(F.min("norm").alias("first_norm"))
    first = keep(first, "dedup-first")  # a join of two shuffles, whose hot key Spark splits
    compared = keep(
        members.join(first, "hash").select(
            "doc_id", *carry, "hash", "text_sha256", F.when(F.col("norm") != F.col("first_norm"), F.col("norm")).alias("other")
        ),
        "dedup-compared",
    )
    classes = (
        compared.groupBy("hash", "other")
        .agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .withColumnsRenamed({"hash": "class_hash", "other": "class_other"})
    )
    classes = keep(classes, "dedup-classes")
    same_class = (F.col("hash") == F.col("class_hash")) & F.col("other").eqNullSafe(F.col("class_other"))
    grouped = compared.join(classes, same_class).select("doc_id", *carry, "keep_id", "group_size", "text_sha256")
    single = keys.join(groups, "hash", "left_anti").select(
        "doc_id", *carry, F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), "text_sha256"
    )
    return (
        grouped.unionByName(single)
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id")))
        .select("doc_id", "keep_id", "group_size", "kept", "text_sha256", *carry)
    )


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that ``exact_dedup`` keeps.

    Decides row by row: of rows that repeat a doc_id each goes or stays by its own text, equal rows of a
    doc_id stay together, and a copy without a doc_id goes.  Any column name may occur beside doc_id and text.
    """
    rows, unique = with_unique_id(docs)
    judged = exact_dedup(rows.select("doc_id", "text", F.col(unique).alias("row")), carry=("row",))
    return without(rows, unique, judged.where("not kept").select("row"), "dedup-gone")
