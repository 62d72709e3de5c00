"""Substring dedup by suffix automata of reference shards.

The reference is the corpus itself, which has no size bound, so its automata are not broadcast: the
reference passages are sharded by anchor, a shard's automaton is built in the task that streams the
shard's passages through it, and each distinct passage is indexed and streamed once.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import keep, texts_of
from .passages import Units, covered, repeated_windows

#: Words of a window; words of the grams that anchor it, level by level; bytes of distinct passages in an automaton.
LENGTH, GRAMS, SHARD_BYTES = 13, (5, 9), 1 << 19


class SuffixAutomaton:
    """A generalised suffix automaton over integer symbols; each state has the smallest document in which
    its substrings end."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.first = [-1], [0], [np.iinfo(np.int64).max]

    def _state(self, length: int, steps: dict[int, int], link: int, first: int) -> int:
        self.next.append(steps)
        self.link.append(link)
        self.length.append(length)
        self.first.append(first)
        return len(self.length) - 1

    def _split(self, state: int, symbol: int, to: int) -> int:
        """The state of exactly the substrings that reach ``to`` by ``symbol`` from ``state``."""
        clone = self._state(self.length[state] + 1, self.next[to].copy(), self.link[to], self.first[to])
        self.link[to] = clone
        while state >= 0 and self.next[state].get(symbol) == to:
            self.next[state][symbol] = clone
            state = self.link[state]
        return clone

    def add(self, symbols: list[int], document: int) -> None:
        step, link, size, first = self.next, self.link, self.length, self.first
        last = 0
        for symbol in symbols:
            to = step[last].get(symbol)
            if to is not None:
                last = to if size[to] == size[last] + 1 else self._split(last, symbol, to)
                if document < first[last]:
                    first[last] = document
                continue
            made, state = len(size), last
            step.append({})
            link.append(0)
            size.append(size[last] + 1)
            first.append(document)
            while state >= 0:
                steps = step[state]
                to = steps.get(symbol)
                if to is not None:
                    link[made] = to if size[to] == size[state] + 1 else self._split(state, symbol, to)
                    break
                steps[symbol] = made
                state = link[state]
            last = made

    def finish(self) -> None:
        """Carry the smallest documents along the suffix links, longest substrings first."""
        first, link = self.first, self.link
        for state in np.argsort(-np.array(self.length), kind="stable").tolist()[:-1]:
            up = link[state]
            if first[state] < first[up]:
                first[up] = first[state]

    def matches(self, symbols: list[int], length: int) -> list[int]:
        """Matching statistics, cut off at ``length``: where the last ``length`` symbols occur in the
        reference, the smallest document they occur in."""
        step, link, size, first = self.next, self.link, self.length, self.first
        state, matched, out = 0, 0, []
        for symbol in symbols:
            to = step[state].get(symbol)
            while to is None and state:
                state = link[state]
                matched = size[state]
                to = step[state].get(symbol)
            if to is None:
                matched = 0
                continue
            state = to
            matched += 1
            if matched >= length:
                matched = length
                while size[link[state]] >= length:
                    state = link[state]
                out.append(first[state])
        return out


def automaton_index(length: int):
    """First documents of all windows of the segments of a shard (see ``passages.Index``)."""

    def index(data: bytes, sizes: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        numbers: dict[bytes, int] = {}
        ends = np.cumsum(sizes).tolist()
        symbols = [[numbers.setdefault(w, len(numbers)) for w in data[a:b].split()] for a, b in zip([0, *ends[:-1]], ends, strict=True)]
        automaton = SuffixAutomaton()
        for part, document in zip(symbols, firsts.tolist(), strict=True):
            automaton.add(part, document)
        automaton.finish()
        found = [automaton.matches(part, length) for part in symbols]
        return np.array([d for part in found for d in part], dtype=np.int64), np.array([len(part) for part in found], dtype=np.int64)

    return index


def remove_repeats(docs: DataFrame, length: int = LENGTH, grams: Sequence[int] = GRAMS, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """doc_id, n_words, n_removed, kept_text (binary, kept words joined by a space), one row per row.

    Removes each word covered by a window of ``length`` words that also starts in a document with a
    smaller doc_id.  Reads doc_id and text only.  NULL text has no words; shorter texts lose nothing.
    Rows with a NULL doc_id lose nothing and count as no reference.  Rows that repeat a doc_id are one
    document as a reference and each lose the words of that document's windows; their texts must agree.
    """
    levels = [Units(length, gram, True) for gram in (*grams, length)]
    spans = keep(repeated_windows(docs, levels, automaton_index(length), shard_bytes), "repeats")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, removed, kept = [], [], []
            for at, text in enumerate(texts_of(batch)):
                words = text.split()
                gone = covered(batch, at, length, len(words))
                total.append(len(words))
                removed.append(int(gone.sum()))
                kept.append(b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g] if removed[-1] else words))
            columns = [batch.column("doc_id"), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_removed", "kept_text"])

    spans = spans.withColumnRenamed("doc_id", "span_id")
    texts = docs.select("doc_id", F.col("text").cast("binary").alias("text")).join(spans, F.col("doc_id") == F.col("span_id"), "left")
    return texts.select("doc_id", "text", "spans").mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_text binary")
