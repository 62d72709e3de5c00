"""Resampling towards a target distribution: hashed-feature importance weights, Gumbel noise, and a radix sort.

Weights come from two arrays of bucket counts, that of all documents and that of the target texts.  The scores
are ranked by a distributed radix sort, least significant digit first: each pass counts the digits of each
block of places, adds the counts up to global offsets, and moves every row to its place.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .base import keep, lean, lean_group, places, texts_of

#: Features are runs of one to so many words; hashed to so many buckets.
LONGEST, BUCKETS = 1, 10_000
#: Documents with fewer words are not drawn; percentage of the others that is.
LEAST_WORDS, PERCENT = 20, 10
SEED = "2024:"
#: Rows of a block of places (what one task sorts by a digit), and bits of a digit.
BLOCK_ROWS, DIGIT_BITS = 1 << 16, 11
#: Distinct features whose bucket a task remembers.
REMEMBERED = 1 << 18

#: A-Z become a-z; bytes that are neither letters, digits nor part of a longer character become spaces.
_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


class Buckets:
    """The buckets of a text's features, remembered by feature."""

    def __init__(self, longest: int, buckets: int):
        self.longest, self.buckets, self.known = longest, buckets, {}

    def of(self, text: bytes) -> tuple[int, np.ndarray, np.ndarray]:
        """The number of words; the buckets that occur, and how often each does."""
        words = text.translate(_WORDS).split()
        found: Counter[bytes] = Counter(words)
        for size in range(2, self.longest + 1):
            found.update(b" ".join(words[k : k + size]) for k in range(len(words) - size + 1))
        if len(self.known) > REMEMBERED:
            self.known = {}
        out: dict[int, int] = {}
        for feature, n in found.items():
            bucket = self.known.get(feature)
            if bucket is None:
                bucket = self.known[feature] = zlib.crc32(feature) % self.buckets
            out[bucket] = out.get(bucket, 0) + n
        return len(words), np.fromiter(out, np.int64, len(out)), np.fromiter(out.values(), np.int64, len(out))


def bucket_counts(texts: DataFrame, longest: int = LONGEST, buckets: int = BUCKETS) -> DataFrame:
    """bucket, n over all rows of ``texts`` (text); each task adds up its own texts first."""

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, total = Buckets(longest, buckets), np.zeros(buckets, np.int64)
        for batch in batches:
            for text in texts_of(batch):
                _, found, counts = features.of(text)
                total[found] += counts
        bucket = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(bucket), pa.array(total[bucket])], names=["bucket", "n"])

    return texts.select(F.col("text").cast("binary")).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(docs: DataFrame, target: DataFrame, longest: int = LONGEST, buckets: int = BUCKETS) -> np.ndarray:
    """floor(1000 ln of the ratio of smoothed shares) of each bucket: target over documents.

    The two count arrays have ``buckets`` numbers each, whatever the data; only they reach the driver.
    """
    counts = []
    for texts in (docs, target):
        array = np.zeros(buckets, np.int64)
        for row in bucket_counts(texts, longest, buckets).collect():
            array[row["bucket"]] = row["n"]
        counts.append(array)
    s, t = counts
    all_s, all_t = float(s.sum() + buckets), float(t.sum() + buckets)
    ratios = [(b + 1.0) * all_s / ((a + 1.0) * all_t) for a, b in zip(s.tolist(), t.tolist(), strict=True)]
    return np.array([math.floor(1000 * math.log(r)) for r in ratios], np.int64)


def noise(doc_id: int | None, seed: str) -> int:
    """floor(1000 times a Gumbel number), from the first 32 bits of SHA-256 of seed and doc_id."""
    h = int(hashlib.sha256(f"{seed}{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scores(docs: DataFrame, gains: np.ndarray, longest: int = LONGEST, least_words: int = LEAST_WORDS, seed: str = SEED) -> DataFrame:
    """doc_id, n_features, weight, score, and part, row: a number of the task, and of the row in it among those
    with ``least_words`` words or more (others: NULL).

    The gains are broadcast: one number per bucket, the count of which is a parameter.
    """
    spread = docs.sparkSession.sparkContext.broadcast(gains)

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = spread.value
        features, part, row = Buckets(longest, len(gain)), TaskContext.get().partitionId(), 0
        for batch in batches:
            ids, rows, sizes, weights = batch.column("doc_id").to_pylist(), [], [], []
            for text in texts_of(batch):
                n, found, counts = features.of(text)
                rows.append(row if n >= least_words else None)
                row += n >= least_words
                sizes.append(int(counts.sum()))
                weights.append(int(gain[found] @ counts))
            total = [w + noise(i, seed) for w, i in zip(weights, ids, strict=True)]
            columns = [ids, sizes, weights, total, [part] * len(ids), rows]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=_SCORED)

    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(run, ", ".join(f"{c} long" for c in _SCORED))


_SCORED = ["doc_id", "n_features", "weight", "score", "part", "row"]


def _digits(key: str, low: int, high: int, bits: int) -> Iterator[Column]:
    """The digits of a long column between two bounds, least significant first, in its ascending order."""
    if high - low < 1 << 63:
        number, size = F.col(key) - F.lit(low), (high - low).bit_length()
    else:  # the distance would not fit: the whole number with its sign turned
        number, size = F.col(key).bitwiseXOR(F.lit(-1 << 63)), 64
    for shift in range(0, size, bits):
        yield F.shiftrightunsigned(number, shift).bitwiseAND(F.lit((1 << bits) - 1).cast("long"))


def _one_pass(rows: DataFrame, digit: Column, block_rows: int) -> DataFrame:
    """One stable counting sort by ``digit``: ``rows`` with a new place.

    Rows lie in blocks of ``block_rows`` consecutive places, so no digit, however frequent, fills a task.  The
    counts per (block, digit) are added up: over the blocks within a digit, and over the digits.  A row's new
    place is the offset of its block and digit and the number of rows of that digit before it in the block.
    """
    rows = rows.withColumn("block", F.floor(F.col("place") / block_rows)).withColumn("digit", digit)
    cells = keep(rows.groupBy("block", "digit").agg(F.count(F.lit(1)).alias("n")), "radix-counts")
    digits = cells.groupBy("digit").agg(F.sum("n").alias("n"))  # as many rows as a digit has values
    earlier = F.sum("n").over(Window.orderBy("digit").rowsBetween(Window.unboundedPreceding, -1))
    bases = digits.select(F.col("digit").alias("of_digit"), F.coalesce(earlier, F.lit(0)).alias("base"))
    blocks = Window.partitionBy("digit").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cells.withColumn("before", F.coalesce(F.sum("n").over(blocks), F.lit(0)))
    offsets = offsets.join(F.broadcast(bases), F.col("digit") == F.col("of_digit"))  # bounded by 2 ** DIGIT_BITS rows
    offsets = offsets.select("block", "digit", (F.col("base") + F.col("before")).cast("long").alias("offset"))
    schema = rows.drop("block", "digit").schema

    def place(block: pa.Table, offset: pa.Table) -> pa.Table:
        block = block.combine_chunks()
        first = block.column("block")[0].as_py() * block_rows
        order = np.empty(block.num_rows, np.int64)
        order[block.column("place").to_numpy() - first] = np.arange(block.num_rows)  # by place, without comparing
        digit = block.column("digit").to_numpy()[order]
        size = int(digit.max()) + 1
        counts = np.bincount(digit, minlength=size)
        starts = np.zeros(size, np.int64)
        starts[offset.column("digit").to_numpy()] = offset.column("offset").to_numpy()
        # Stable within the block: numpy sorts 16-bit numbers by counting.
        by_digit = np.argsort(digit.astype(np.uint16), kind="stable")
        rank = np.empty(len(digit), np.int64)
        rank[by_digit] = np.arange(len(digit)) - np.repeat(np.cumsum(counts) - counts, counts)
        to = np.empty(len(digit), np.int64)
        to[order] = starts[digit] + rank
        out = block.drop_columns(["block", "digit", "place"]).append_column("place", pa.array(to))
        return out.select(schema.names)

    pairs = rows.groupBy("block").cogroup(offsets.groupBy("block"))
    return pairs.applyInArrow(lean_group_pair(place), schema)


def lean_group_pair(run: Callable[[pa.Table, pa.Table], pa.Table]) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """``lean_group`` for a pair of groups."""
    one = lean_group(lambda pair: run(*pair))

    def task(left: pa.Table, right: pa.Table) -> pa.Table:
        return one((left, right))

    return task


def radix_sort(rows: DataFrame, keys: Sequence[str], block_rows: int = BLOCK_ROWS, digit_bits: int = DIGIT_BITS) -> DataFrame:
    """``rows`` with place in the order of the long columns ``keys``, the first counting most, all ascending.

    ``rows`` has a gapless place from 0, which decides ties.  NULL keys come last.  The composite key's digits
    are taken from the last column up, each column as its distance from its minimum, so that a column costs
    one pass per ``digit_bits`` of its range.  Every pass is written, so a lost executor repeats one pass at most.
    """
    if not 1 <= digit_bits <= 16:
        raise ValueError("a digit has 1 to 16 bits")
    bounds = rows.agg(*[f(k).alias(f"{f.__name__}_{k}") for k in keys for f in (F.min, F.max)], *[F.count_if(F.col(k).isNull()).alias(f"null_{k}") for k in keys])
    bounds = bounds.first()
    for key in reversed(keys):
        low, high = bounds[f"min_{key}"], bounds[f"max_{key}"]
        if low is None:
            continue  # all equal
        for digit in _digits(key, low, high, digit_bits):
            rows = keep(_one_pass(rows, F.coalesce(digit, F.lit(0)), block_rows), "radix")
        if bounds[f"null_{key}"]:
            rows = keep(_one_pass(rows, F.col(key).isNull().cast("long"), block_rows), "radix")
    return rows


def importance_resample(
    docs: DataFrame, target: DataFrame, longest: int = LONGEST, buckets: int = BUCKETS, least_words: int = LEAST_WORDS,
    percent: int = PERCENT, seed: str = SEED, block_rows: int = BLOCK_ROWS, digit_bits: int = DIGIT_BITS,
) -> DataFrame:
    """doc_id, n_features, weight, score, rank, one row per row of ``docs``.

    Words are maximal runs of ASCII letters (A-Z lower-cased), digits and all characters beyond ASCII; features
    are runs of 1 to ``longest`` words, hashed by CRC-32.  weight is the sum of its features' gains towards
    ``target``, score that plus Gumbel noise that depends on seed and doc_id alone.  Of the N documents with
    ``least_words`` words or more, the ``percent`` * N // 100 highest scores (ties: smaller doc_id) have
    ranks from 1; all others NULL.

    Reads doc_id and text of ``docs`` and text of ``target``.  NULL and empty texts have no features and weight
    0.  A NULL doc_id is written as nothing in the noise and comes last among ties.  Rows that repeat a doc_id
    are judged each, equal ones in any order.  An empty table gives an empty result; an empty target has equal
    shares in all buckets.
    """
    gains = bucket_gains(docs, target, longest, buckets)
    scored = keep(scores(docs, gains, longest, least_words, seed), "importance-scores")
    columns = ["doc_id", "n_features", "weight", "score"]
    eligible = places(scored.where("row is not null"))
    numbered = keep(eligible.withColumn("down", -F.col("score")).select(*columns, "down", "place"), "importance-places")
    ranked = radix_sort(numbered, ["down", "doc_id"], block_rows, digit_bits)
    drawn = numbered.count() * percent // 100
    rank = F.when(F.col("place") < drawn, F.col("place") + 1).alias("rank")
    rest = scored.where("row is null").select(*columns, F.lit(None).cast("long").alias("rank"))
    return ranked.select(*columns, rank).unionByName(rest)
