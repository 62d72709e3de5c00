"""Spelling variants of words by permuterm rotations: words one edit apart, and the form each variant stands for.

A word is marked with a terminator and rotated at each place.  Two words that differ in one place have
rotations that differ in their last character only; a word with one character more has a rotation that is a
rotation of the shorter word and a last character.  So replacements and indels are prefix ranges of the sorted
rotations: rotations without their last character, and whole ones, are sorted across the cluster, and a
scan meets all near words side by side.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import keep, lean, texts_of

#: Runs that count as words; only A-Z are lower-cased, so that capitals beyond ASCII stay as they are.
RUN = "[A-Za-zÀ-ÿ]+"
#: Of one in so many (document, run) pairs, by hash, a code point is deleted.
DELETE_ONE_IN = 97
#: Code points of a word, and how often it occurs in all documents, at least.
LEAST_LENGTH, LEAST_COUNT = 5, 3
#: A word's form occurs at least so many times as often as the word.
FORM_FACTOR = 2
#: Distinct words that a task sums before it hands them on.
SUMMED = 1 << 17

#: Sorts before every character of a word.
TERMINATOR = "$"
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def word_counts(docs: DataFrame, delete_one_in: int = DELETE_ONE_IN, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """word, n of the words of whole texts.

    Let h be the CRC-32 of ``<doc_id>:<run>``, run lower-cased; if ``delete_one_in`` divides h, the run's code
    point h modulo its length is deleted.  Reads doc_id and text only.  NULL text has no words; a NULL doc_id
    is written as nothing.  Rows that repeat a doc_id count each.  Tasks sum words before the shuffle.
    """
    runs = re.compile(RUN)

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch), strict=True):
                start = zlib.crc32(b":" if doc_id is None else b"%d:" % doc_id)
                for word, n in Counter(runs.findall(text.translate(_LOWER).decode())).items():
                    h = zlib.crc32(word.encode(), start)
                    if not h % delete_one_in:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                    if len(word) >= least_length:
                        total[word] += n
                if len(total) > SUMMED:
                    yield _counts(total)
                    total = Counter()
        yield _counts(total)

    texts = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))
    found = texts.mapInArrow(run, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def _counts(total: Counter[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["word", "n"])


def rotations(word: str) -> Iterator[tuple[str, str]]:
    """(key, edit): each rotation of the marked word whole (no edit), and without its last character, which is
    the edit and never the terminator."""
    marked = word + TERMINATOR
    for k in range(len(marked)):
        rotated = marked[k:] + marked[:k]
        yield rotated, ""
        if k:
            yield rotated[:-1], rotated[-1]


def _words_of(key: str, edits: list[str]) -> list[str]:
    after, _, before = key.partition(TERMINATOR)
    return [before + e + after for e in edits]


def _is_first(key: str, edit: str) -> bool:
    """Whether deleting the edit is the first way to this shorter word: of a run of equal characters, any
    one leaves the same."""
    return not key.endswith(edit)


def scan_group(key: str, members: list[tuple[str, int]]) -> Iterator[tuple[str, int, int, str]]:
    """(word, number of near words, n and name of the most frequent) of a group of equal keys, each pair of
    near words counted in exactly one group of theirs.

    A group has one edit per character at most, as key and edit give the word.
    """
    words = _words_of(key, [e for e, _ in members])
    ranked = sorted((-n, word, e) for (e, n), word in zip(members, words, strict=True))
    edits = [r for r in ranked if r[2]]
    whole = next((r for r in ranked if not r[2]), None)
    firsts = [r for r in edits if _is_first(key, r[2])] if whole else []
    for r in edits:
        near = [edits[1] if r is edits[0] else edits[0]] if len(edits) > 1 else []
        shorter = [whole] if r in firsts else []
        if near or shorter:
            n, word, _ = min(near + shorter)
            yield r[1], len(edits) - 1 + len(shorter), -n, word
    if firsts:
        n, word, _ = firsts[0]
        yield whole[1], len(firsts), -n, word


_NEAR = ("word", "n_near", "near_n", "near")


def near_words(words: DataFrame) -> DataFrame:
    """word, n_near, near_n, near of the ``words`` (word, n) that have a near word: how many differ from it by one
    inserted, deleted or replaced code point, and the most frequent of them (ties: smallest by code point).

    Keys are sorted across the cluster by range, equal keys in one partition; a group is no larger than
    the alphabet, so no word, however frequent, fills a task.  ``words`` holds each word once, no word with the
    terminator, and no NULL.
    """

    @lean
    def rotate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, edits, counts = [], [], []
            for word, n in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist(), strict=True):
                for key, edit in rotations(word):
                    keys.append(key)
                    edits.append(edit)
                    counts.append(n)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(edits, pa.string()), pa.array(counts, pa.int64())], names=["key", "edit", "n"])

    @lean
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, members = None, []
        for batch in batches:
            found = []
            for new, edit, n in _candidates(batch):
                if new != key:
                    if len(members) > 1:
                        found += scan_group(key, members)
                    key, members = new, []
                members.append((edit, n))
            yield _near_batch(found)
        yield _near_batch(list(scan_group(key, members)) if len(members) > 1 else [])

    rotated = words.mapInArrow(rotate, "key string, edit string, n long")
    ranges = rotated.repartitionByRange("key").sortWithinPartitions("key")
    found = ranges.mapInArrow(scan, "word string, n_near long, near_n long, near string")
    best = F.min(F.struct((-F.col("near_n")).alias("minus"), "near")).alias("best")
    found = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
    return found.select("word", "n_near", (-F.col("best.minus")).alias("near_n"), F.col("best.near").alias("near"))


def _candidates(batch: pa.RecordBatch) -> Iterator[tuple[str, str, int]]:
    """Rows of a sorted batch whose key its neighbour has too, and those at its ends, where the neighbour
    lies in another batch."""
    if not batch.num_rows:
        return
    keys = batch.column("key")
    same = pc.equal(keys.slice(1), keys.slice(0, len(keys) - 1))
    ends = pa.array([True])
    before, after = pa.concat_arrays([ends, same]), pa.concat_arrays([same, ends])
    picked = batch.filter(pc.or_(before, after))
    yield from zip(*(picked.column(k).to_pylist() for k in ("key", "edit", "n")), strict=True)


def _near_batch(rows: list[tuple[str, int, int, str]]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * 4
    types = (pa.string(), pa.int64(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=_NEAR)


def follow(forms: DataFrame) -> DataFrame:
    """word, root from (word, form): each word's last form, by doubling: every round, a form is replaced by the
    form that the round before found for it.  A form is more frequent than its word, so there are no cycles, and
    the rounds are the logarithm of the longest chain.  Every round is written."""
    steps = keep(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        to = steps.select(F.col("word").alias("via"), F.col("root").alias("further"))
        joined = steps.join(to, F.col("root") == F.col("via"), "left")
        steps = keep(joined.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "spelling-roots")
        if steps.where("moved").isEmpty():
            return steps.select("word", "root")
        steps = steps.drop("moved")


def spelling_forms(words: DataFrame, factor: int = FORM_FACTOR) -> DataFrame:
    """word, n, n_near, form, form_n, root, one row per row of ``words`` (word, n; each word once).

    A word's form is its near word of largest n (ties: smallest by code point) if that n is ``factor``
    times the word's or more, else NULL; ``factor`` is above 1, so that forms are more frequent.  root is the
    last of the forms that follow from the word, the word itself if it has none.
    """
    if factor <= 1:
        raise ValueError("a form must be more frequent than its word")
    words = words.select("word", "n")
    near = keep(near_words(words).withColumnRenamed("word", "near_word"), "spelling-near")
    is_form = F.col("near_n") >= factor * F.col("n")
    formed = words.join(near, F.col("word") == F.col("near_word"), "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, F.col("near")).alias("form"), F.when(is_form, F.col("near_n")).alias("form_n"),
    )
    formed = keep(formed, "spelling-forms")
    roots = keep(follow(formed.where("form is not null")).withColumnRenamed("word", "root_word"), "spelling-last")
    joined = formed.join(roots, F.col("word") == F.col("root_word"), "left")
    return joined.select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))


def spelling_variants(docs: DataFrame, **counting) -> DataFrame:
    """``spelling_forms`` of the ``word_counts`` of all documents.  An empty table gives an empty result."""
    return spelling_forms(keep(word_counts(docs, **counting), "spelling-words"))
