"""Passages that documents share, for operators that look for equal windows of a fixed length.

Units are words or bytes.  A window of ``length`` units has an anchor: the least hash of its grams of
``gram`` units.  Equal windows have equal anchors, so only windows whose anchor occurs in two documents
can be equal, and all windows that can be equal to one another meet under their anchor.  This cuts the
corpus into segments (runs of windows with one anchor) that are sharded by anchor, each shard small
enough for an index in one task, and none of the windows is lost.  Anchors of very many different segments are
dealt again by longer grams, as distinct segments, so that documents cost the same rows whatever they share.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .base import forget, keep, texts_of
from .hashing import U, chunks, mix, prefix_sums, word_table

_FACTORS = mix(np.arange(101, 165, dtype=np.uint64)) | U(1)

#: From the distinct segments of a shard, joined, with their sizes and the smallest doc_id of each: the
#: smallest doc_id of each of their windows, all in one array, and the number of windows of each segment.
Index = Callable[[bytes, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]

#: "Up to the last window" in a span.
END = -1
#: An anchor of so many distinct segments is dealt again by longer grams.
CROWD = 2048


@dataclass(frozen=True)
class Units:
    """How a text is cut: windows of ``length`` units, anchored by grams of ``gram`` units."""

    length: int
    gram: int
    words: bool

    def __post_init__(self) -> None:
        if not 0 < self.gram <= self.length:
            raise ValueError("a gram must fit into a window")

    @property
    def span(self) -> int:
        """Grams in a window."""
        return self.length - self.gram + 1

    def _grams(self, texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Gram hashes at each unit; where units start and end in the texts joined by one byte each; and the
        place of each text's first unit."""
        if self.words:
            units, starts, ends, first = word_table(texts)
            out = np.zeros(max(len(units) - self.gram + 1, 0), dtype=np.uint64)
            for k in range(self.gram):
                out += units[k : k + len(out)] * _FACTORS[k]
            return mix(out), starts, ends, first
        data = np.frombuffer(b"\n".join(texts), dtype=np.uint8)
        sums, down = prefix_sums(data)
        n = max(len(data) - self.gram + 1, 0)
        starts = np.arange(len(data) + 1)  # the byte between two texts counts as a unit that no window holds
        return mix((sums[self.gram : self.gram + n] - sums[:n]) * down[:n]), starts, starts + 1, np.cumsum([0, *(len(t) + 1 for t in texts)])

    def windows(self, texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of all windows of the texts in order: number of the text, place in it, anchor, and where the window
        starts and ends in the texts joined by one byte each."""
        low, starts, ends, first = self._grams(texts)
        reach = 1
        while reach < self.span and len(low):
            step = min(reach, self.span - reach)
            low = np.minimum(low[:-step], low[step:]) if len(low) > step else low[:0]
            reach += step
        counts = np.maximum(np.diff(first) - self.length + 1 - (not self.words), 0)
        text = np.repeat(np.arange(len(texts)), counts)
        place = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)
        unit = place + np.repeat(first[:-1], counts)
        return text, place, low[unit], starts[unit], ends[unit + self.length - 1]


def _begins(*columns: np.ndarray) -> np.ndarray:
    """Where a run of rows begins that are equal in all columns."""
    if not len(columns[0]):
        return np.empty(0, np.int64)
    changed = np.zeros(len(columns[0]), dtype=bool)
    changed[0] = True
    for c in columns:
        changed[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(changed)


def _lists(kind: type[pa.Array], sizes: np.ndarray, values) -> pa.Array:
    return kind.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)), values)


def _all_anchors(texts: DataFrame, units: Units) -> DataFrame:
    """id, first, anchor and key of each run of windows with one anchor.

    The key is the anchor, under which texts meet.  If texts of one batch with different ``first`` have an anchor,
    all of them know that it is shared: those with the smallest and the largest ``first`` speak for the others, whose
    key is a number of their own and whose anchor is stated beside it (else NULL).  So an anchor of a third of all
    texts meets itself twice per batch, not once per text.
    """
    own = "first" in texts.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = texts_of(batch)
            parts = [(np.empty(0, np.int64), np.empty(0, np.uint64))]
            for a, b in chunks(data):
                text, _, anchors, _, _ = units.windows(data[a:b])
                begin = _begins(text, anchors)
                parts.append((a + text[begin], anchors[begin]))
            text, anchors = (np.concatenate(p) for p in zip(*parts, strict=True))
            first = batch.column("first" if own else "id").to_numpy()[text]
            order = np.lexsort((first, anchors))
            low, among = first[order], _begins(anchors[order])
            last = np.append(among[1:], len(order)) - 1
            silent = np.empty(0, bool)
            if len(order):
                silent = np.repeat(low[among] < low[last], last - among + 1)
                silent[among], silent[last] = False, False
            spoken = np.empty(len(order), bool)
            spoken[order] = ~silent
            key = np.where(spoken, anchors, mix(anchors ^ mix(text.astype(np.uint64) + U(1))))
            columns = {"id": batch.column("id").take(pa.array(text))} | ({"first": pa.array(first)} if own else {})
            columns |= {"key": pa.array(key.view(np.int64)), "anchor": pa.array(anchors.view(np.int64), mask=spoken)}
            yield pa.RecordBatch.from_pydict(columns)

    return texts.mapInArrow(run, f"id {_id_type(texts)}, {'first long, ' if own else ''}key long, anchor long")


def _id_type(texts: DataFrame) -> str:
    return texts.schema["id"].dataType.simpleString()


def _segments(texts: DataFrame, units: Units) -> DataFrame:
    """id, first, start, windows (their number), anchor and bytes of each run of windows whose anchor is in ``shared``."""
    own = "first" in texts.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = texts_of(batch)
            shared = batch.column("shared")
            for a, b in chunks(data):
                text, place, anchors, starts, ends = units.windows(data[a:b])
                begin = _begins(text, anchors)
                last = np.append(begin[1:], len(text)) - 1
                lists = shared.slice(a, b - a)
                # One number for (text, anchor): a clash would only add a segment.
                owner = np.repeat(np.arange(b - a), lists.value_lengths().to_numpy())
                pairs = mix(lists.flatten().to_numpy().view(np.uint64) ^ mix(owner.astype(np.uint64)))
                asked = np.isin(mix(anchors[begin] ^ mix(text[begin].astype(np.uint64))), pairs)
                begin, last = begin[asked], last[asked]
                size = ends[last] - starts[begin]
                at = np.arange(int(size.sum())) + np.repeat(starts[begin] - (np.cumsum(size) - size), size)
                content = np.frombuffer(b"\n".join(data[a:b]), dtype=np.uint8)[at]
                offsets = np.concatenate(([0], np.cumsum(size))).astype(np.int32)
                rows = pa.array(a + text[begin])
                columns = {"id": batch.column("id").take(rows)} | ({"first": batch.column("first").take(rows)} if own else {})
                columns |= {"start": pa.array(place[begin]), "windows": pa.array(last - begin + 1), "anchor": pa.array(anchors[begin].view(np.int64))}
                columns["content"] = pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(content)])
                yield pa.RecordBatch.from_pydict(columns)

    first = "first long, " if own else ""
    return texts.mapInArrow(run, f"id {_id_type(texts)}, {first}start long, windows long, anchor long, content binary")


def first_documents(distinct: DataFrame, index: Index, shards: int) -> DataFrame:
    """mark (of a distinct segment's content) and runs (low, high, first): its windows low to high first
    occur in document ``first``.  A segment that is the only one of its anchor shares no window, so that it needs
    no index."""

    def run(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        _, of, times = np.unique(group.column("anchor").to_numpy(), return_inverse=True, return_counts=True)
        asked = np.flatnonzero(times[of] > 1)
        own, windows = group.column("first").to_numpy(), group.column("windows").to_numpy()
        firsts = np.repeat(own, windows)
        segment = np.repeat(np.arange(len(own)), windows)
        if len(asked):
            contents = group.column("content").combine_chunks().take(pa.array(asked))
            found, counts = index(b"".join(contents.to_pylist()), pc.binary_length(contents).to_numpy().astype(np.int64), own[asked])
            if (counts != windows[asked]).any():
                raise ValueError("an index must give every window of a segment")
            firsts[(times[of] > 1)[segment]] = found
        begin = _begins(segment, firsts)
        last = np.append(begin[1:], len(firsts)) - 1
        before = (np.cumsum(windows) - windows)[segment[begin]]
        runs = pa.StructArray.from_arrays([pa.array(x) for x in (begin - before, last - before, firsts[begin])], names=["low", "high", "first"])
        per = np.bincount(segment[begin], minlength=len(own))
        return pa.table({"mark": group.column("mark"), "runs": _lists(pa.ListArray, per, runs)})

    dealt = distinct.withColumn("mark", _mark("content")).withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards)))
    return dealt.groupBy("shard").applyInArrow(run, f"mark binary, runs {_RUNS}")


def _mark(content: str) -> Column:
    return F.unhex(F.md5(content))


_RUNS = "array<struct<low: long, high: long, first: long>>"


def _copies(texts: DataFrame) -> DataFrame:
    """doc_id of each document whose whole text a smaller doc_id has (equal in two hashes, MD5 and 64 bits)."""
    marks = keep(texts.select("doc_id", F.unhex(F.md5("text")).alias("mark"), F.xxhash64("text").alias("more")), "text-marks")
    groups = marks.groupBy("mark", "more").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).where("least < most")
    return marks.join(keep(groups, "text-groups"), ["mark", "more"]).where("doc_id > least").select("doc_id").distinct()


def first_runs(texts: DataFrame, levels: Sequence[Units], index: Index, shard_bytes: int) -> DataFrame:
    """id, runs (low, high, first): its windows low to high first occur in document ``first``, which is smaller than
    its own.  Only texts with such windows are returned, and runs may overlap.

    ``texts`` has id, text and first, the smallest document that the text occurs in; without first, id is that.  Equal segments are one
    row before they reach a shard, so a passage in a third of all documents is indexed once.  An anchor of CROWD
    distinct segments or more (a gram that many different windows share, as around a passage that stands in many
    different documents) is dealt again: its distinct segments, not the texts that hold them, are the
    texts of the next level, whose anchors are longer grams.  At the last level a gram is a window.
    """
    units, first = levels[0], "first" if "first" in texts.columns else "id"
    by_key = Window.partitionBy("key")
    anchors = (
        _all_anchors(texts, units)
        .withColumn("least", F.min(first).over(by_key))
        .withColumn("most", F.max(first).over(by_key))
        .where("anchor is not null or least < most")
        .select("id", F.coalesce("anchor", "key").alias("anchor"))
    )
    anchors = keep(anchors, "anchors")
    segments = keep(_segments(texts.join(anchors.groupBy("id").agg(F.collect_set("anchor").alias("shared")), "id"), units), "segments")
    forget(anchors)
    distinct = keep(segments.groupBy("anchor", "content").agg(F.min(first).alias("first"), F.min("windows").alias("windows")), "segments-distinct")
    shards = max(1, -(-(distinct.agg(F.sum(F.octet_length("content"))).first()[0] or 0) // shard_bytes))
    crowded = keep(distinct.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= CROWD).select("anchor"), "crowded-anchors")
    again = None
    if len(levels) == 1 or crowded.isEmpty():
        firsts = first_documents(distinct, index, shards)
    else:
        again = distinct.join(crowded, "anchor", "left_semi").select(_mark("content").alias("id"), F.col("content").alias("text"), "first", "windows")
        again = keep(again, "crowded")
        found = first_runs(again.select("id", "text", "first"), levels[1:], index, shard_bytes)
        whole = F.array(F.struct(F.lit(0).cast("long").alias("low"), (F.col("windows") - 1).alias("high"), F.col("first").alias("first")))
        dealt = again.join(found, "id", "left").select(F.col("id").alias("mark"), F.concat(whole, F.coalesce("runs", F.array())).alias("runs"))
        firsts = first_documents(distinct.join(crowded, "anchor", "left_anti"), index, shards).unionByName(dealt)
    firsts = keep(firsts, "segment-runs")
    forget(distinct, crowded, again)
    earlier = F.transform(
        F.filter("runs", lambda r: r["first"] < F.col(first)),
        lambda r: F.struct((F.col("start") + r["low"]).alias("low"), (F.col("start") + r["high"]).alias("high"), r["first"].alias("first")),
    )
    marked = segments.select(*{"id": 0, first: 0}, "start", _mark("content").alias("mark"))
    runs = marked.join(firsts, "mark").select("id", earlier.alias("runs")).where(F.size("runs") > 0)
    runs = keep(runs.groupBy("id").agg(F.flatten(F.collect_list("runs")).alias("runs")), "runs")
    forget(segments, firsts)
    return runs


def repeated_windows(docs: DataFrame, levels: Sequence[Units], index: Index, shard_bytes: int) -> DataFrame:
    """doc_id, spans (low, high): its windows that also start in a document with a smaller doc_id.

    ``docs`` has doc_id and text.  Rows with a NULL doc_id take no part.  Only documents with such windows
    are returned.  Equal texts are one text, that of the smallest doc_id, before anything is indexed; all
    windows of the others (span 0 to END) start in it.  ``levels`` are the units of one window length with ever
    longer grams, the last a whole window.
    """
    texts = docs.where("doc_id is not null").select("doc_id", F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))
    copies = keep(_copies(texts), "copies")
    texts = texts.join(copies, "doc_id", "left_anti").withColumnRenamed("doc_id", "id")
    runs = first_runs(texts, levels, index, shard_bytes)
    span = F.transform("runs", lambda r: F.struct(r["low"].alias("low"), r["high"].alias("high")))
    spans = runs.select(F.col("id").alias("doc_id"), span.alias("spans"))
    whole = F.array(F.struct(F.lit(0).cast("long").alias("low"), F.lit(END).cast("long").alias("high")))
    return spans.unionByName(copies.select("doc_id", whole.alias("spans")))


def covered(batch: pa.RecordBatch, at: int, length: int, n: int) -> np.ndarray:
    """Which of n units of the text in row ``at`` lie in a window that starts in one of its ``spans``."""
    found = batch.column("spans").slice(at, 1)
    change = np.zeros(n + 1, dtype=np.int64)
    if n >= length and not found.is_null()[0].as_py():
        spans = found.flatten()
        low, high = (spans.field(k).to_numpy(zero_copy_only=False) for k in (0, 1))
        np.add.at(change, low, 1)
        np.add.at(change, np.where(high == END, n - length, high) + length, -1)
    return np.cumsum(change[:n]) > 0
