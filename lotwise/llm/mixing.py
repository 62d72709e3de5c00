"""Mixing sources to target weights: repetition rates per source, hash-seeded copies per document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .base import keep, word_count

#: Weights of the sources in code point order, repeating.
WEIGHTS = (3, 1, 2)
#: The mix as a multiple of all sizes, and the most that a source is repeated.
SHARE, MOST = 1.5, 2


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """From (source, size) rows: source, source_size, target (double).

    Sources by code point, NULL last, take ``weights`` in turn.  ``share`` times all sizes is split by
    weight; a target stops at ``most`` times its source's size and its excess is shared again.  The
    fixed point of that: order the sources by limit / weight; a prefix of them is at the limit, and the
    others have the level (what is left) / (weights that are left) times their weight.  The windows run
    over one row per source.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), ((place - 1) % len(weights)) + 1)
    per = per.withColumn("weight", weight.cast("double")).withColumn("most", (F.col("source_size") * most).cast("double"))
    order = [F.col("most") / F.col("weight"), F.col("source").asc_nulls_last()]
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    per = (
        per.withColumn("rank", F.row_number().over(Window.orderBy(*order)))
        .withColumn("left", F.lit(share) * F.sum("source_size").over(whole) - F.coalesce(F.sum("most").over(before), F.lit(0.0)))
        .withColumn("level", F.col("left") / (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
        .withColumn("full", F.col("most") <= F.col("level") * F.col("weight"))
        .withColumn("level", F.min_by(F.when(~F.col("full"), F.col("level")), F.when(~F.col("full"), F.col("rank"))).over(whole))
    )
    return per.select(
        "source", "source_size", F.when(F.col("full"), F.col("most")).otherwise(F.col("level") * F.col("weight")).alias("target")
    )


def unit_hash(key: Column, seed: str) -> Column:
    """A number in [0, 1) that depends on key and seed alone: 52 bits of an MD5."""
    text = F.concat(F.lit(seed), F.coalesce(key.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double") / F.lit(float(2**52))


def copies(docs: DataFrame, seed: str = "mix-", **shares) -> DataFrame:
    """``docs`` with size, source_size, target and copies.

    rate = target / source_size; a document gets floor(rate) copies and one more if its hash, seeded by
    ``seed`` and the doc_id, is below the fraction: a Bernoulli draw that a rerun repeats.  NULL text has
    size 0; NULL source is a source of its own; rows that repeat a doc_id draw alike.  The rates are a
    written table, joined null-safely: Spark broadcasts it if it is small, else splits hot sources.
    Columns of ``docs`` with the names of the results are replaced.
    """
    plain = docs.drop("size", "source_size", "target", "copies")
    rates = keep(source_targets(plain.select("source", word_count(F.col("text")).alias("size")), **shares), "mix-rates")
    rates = rates.withColumnRenamed("source", "rate_source")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    extra = (unit_hash(F.col("doc_id"), seed) < rate - F.floor(rate)).cast("long")
    return (
        plain.withColumn("size", word_count(F.col("text")))
        .join(rates, F.col("source").eqNullSafe(F.col("rate_source")))
        .drop("rate_source")
        .withColumn("copies", F.floor(rate) + extra)
    )


def mix(docs: DataFrame, seed: str = "mix-", **shares) -> DataFrame:
    """The mixed rows: each row of ``docs`` as often as its ``copies``, with all its columns, whatever their names.

    Rows that repeat a doc_id draw alike, each by its own source; those without a doc_id draw alike, too.
    """
    whole = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("whole"))
    drawn = copies(whole.select("whole", "whole.doc_id", "whole.text", "whole.source"), seed, **shares)
    return drawn.select("whole", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int")))).select("whole.*")
