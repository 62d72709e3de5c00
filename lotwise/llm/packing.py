"""Best-fit packing of tokenised documents into sequences, improved by a swap-based local search."""

from __future__ import annotations

import functools
import json
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import keep, lean, lean_group, text_or_empty

CAPACITY, END_ID = 1024, 2
#: Pieces that are packed together, on average: bounds the memory of a task.  What a group leaves underfull is
#: packed again with the rests of others.
GROUP_PIECES = 4096

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = PIECES + ", sequence_id long, offset long"
ROUND = PACKED + ", row long, room long"


@functools.cache
def _fast(vocabulary: str):
    """The vocabulary file in ``tiktoken``, which merges about four times faster than ``tokenizers`` and gives the
    same ids (a test holds them together)."""
    import tiktoken

    with open(vocabulary, encoding="utf-8") as file:
        spec = json.load(file)
    # Byte-level vocabularies write byte b as a printable character: itself where it is one, else 256 onwards.
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(sorted(set(range(256)) - set(plain)))}
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    ranks = {bytes(byte_of[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)


@functools.cache
def _general(vocabulary: str):
    """The same file in ``tokenizers``, for texts beyond Latin-1, where the two might class a rare character
    differently; loaded by workers that meet one."""
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary)


def token_ids(text: str, vocabulary: str) -> np.ndarray:
    """The ids of a whole text, without special tokens added."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return np.array(_general(vocabulary).encode(text, add_special_tokens=False).ids, dtype="<u4")
    return _fast(vocabulary).encode_to_numpy(text, allowed_special="all").astype("<u4", copy=False)


def cut(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: only a longer one is cut, its first piece may be shorter."""
    first = n % capacity or capacity
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))] if n > capacity else [(0, n)]


def pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY) -> DataFrame:
    """The pieces of each document, one pass over the texts in Arrow batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for at, text in enumerate(batch.column("text").to_pylist()):
                ids = np.append(token_ids(text, vocabulary), np.array([END_ID], "<u4"))
                for k, (start, length) in enumerate(cut(len(ids), capacity)):
                    rows.append((at, k, start, length, zlib.crc32(ids[start : start + length].tobytes())))
            of, *rest = np.array(rows, dtype=np.int64).reshape(-1, 5).T
            columns = [batch.column("doc_id").take(pa.array(of)), pa.array(rest[0].astype(np.int32)), *map(pa.array, rest[1:])]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(lean(run), PIECES)


def best_fit(sizes: np.ndarray, capacity: int) -> list[list[int]]:
    """Best fit in decreasing order; bins are found by their room through a bit mask of the rooms in use."""
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, bins = 0, []
    for item in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[item])
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
            bins[b].append(item)
        else:
            b, room = len(bins), capacity
            bins.append([item])
        by_room[room - size].append(b)
        rooms |= 1 << (room - size)
    return bins


def improve(bins: list[list[int]], sizes: np.ndarray, capacity: int, gather: bool = False) -> list[list[int]]:
    """Local search between underfull bins.

    The emptiest bin gives: a document moves to the fullest bin that takes it, or is exchanged for a
    smaller one, or any two are exchanged for one, whichever fills the other bin most.  Every step raises
    the sum of squared fills, so the search ends; a giver that can give no more is asked again after the
    others as long as any step was made, an emptied bin is gone.  It stops once the room left is below one
    bin, when no fewer bins are possible; with ``gather`` it goes on, so that the room is in few bins.
    """
    fill = np.array([int(sizes[b].sum()) for b in bins], dtype=np.int64)
    spare = len(bins) * capacity - int(fill.sum())
    if spare < capacity and not gather:
        return bins
    home = np.empty(len(sizes), dtype=np.int64)
    for k, b in enumerate(bins):
        home[b] = k
    items = np.flatnonzero(fill[home] < capacity)
    own = sizes[items].astype(np.int64)
    place = {int(item): at for at, item in enumerate(items)}
    where = home[items]
    done = fill >= capacity
    never = np.iinfo(np.int64).max
    stepped = False
    while gather or spare >= capacity:
        if done.all():
            done = (fill == 0) | (fill == capacity)
            if not stepped or done.all():
                break
            stepped = False
        giver = int(np.argmin(np.where(done, never, fill)))
        room = capacity - fill
        room[giver] = 0
        mine = sorted(bins[giver], key=lambda i: -sizes[i])
        step: tuple[int, tuple[int, ...], int, int] | None = None  # gain, items given, item taken (-1: none), bin
        for item in mine:
            size = int(sizes[item])
            fits = np.where((room >= size) & (fill > 0), room, never)
            to = int(np.argmin(fits))
            if fits[to] < never and fill[to] + size > fill[giver]:
                step = (size, (item,), -1, to)
                break
        if step is None:
            by_size = {int(sizes[i]): (i,) for i in reversed(mine)}
            twice = {int(sizes[i]): (i, j) for i, j in zip(mine, mine[1:], strict=False) if sizes[i] == sizes[j]}
            # Different sizes in a bin are few (their sum is bounded), so all sums of two are.
            offers = {2 * size: pair for size, pair in twice.items()}
            offers |= {a + b: (*by_size[a], *by_size[b]) for a in by_size for b in by_size if a > b}
            offers |= by_size
            best = np.zeros(capacity + 1, np.int64)  # the largest offer of at most a size
            best[[size for size in offers]] = [size for size in offers]
            best = np.maximum.accumulate(best)
            gain = best[own + room[where]] - own
            gain[(where == giver) | (gain <= fill[giver] - fill[where])] = 0
            at = int(np.argmax(gain)) if len(gain) else 0
            if len(gain) and gain[at] > 0:
                step = (int(gain[at]), offers[int(own[at] + gain[at])], int(items[at]), int(where[at]))
        if step is None:
            done[giver] = True
            continue
        stepped = True
        gain, given, taken, to = step
        for item in given:
            bins[giver].remove(item)
            bins[to].append(item)
            where[place[item]] = to
        if taken >= 0:
            bins[to].remove(taken)
            bins[giver].append(taken)
            where[place[taken]] = giver
        fill[giver] -= gain
        fill[to] += gain
        if fill[to] == capacity:
            done[to] = True
        if fill[giver] == 0:
            done[giver] = True
            spare -= capacity
    return [b for b in bins if b]


def _pack(group: pa.Table, capacity: int, first: int, last: bool) -> pa.Table:
    """A group's sequences, numbered from ``first`` groups on; those of an earlier round are a second start."""
    group = group.sort_by("row")
    sizes = group.column("length").to_numpy()
    bins = improve(best_fit(sizes, capacity), sizes, capacity, not last)
    if "sequence_id" in group.column_names:
        before: dict[int, list[int]] = {}
        for k, sequence_id in enumerate(group.column("sequence_id").to_pylist()):
            before.setdefault(sequence_id, []).append(k)
        bins = min(improve(list(before.values()), sizes, capacity, not last), bins, key=len)
    sequence, offset, room = (np.empty(len(sizes), np.int64) for _ in range(3))
    for k, b in enumerate(bins):
        sequence[b] = k
        offset[b] = np.cumsum(sizes[b]) - sizes[b]
        room[b] = capacity - sizes[b].sum()
    number = ((first + group.column("pack").to_numpy().astype(np.int64)) << 32) + sequence
    out = group.select(["doc_id", "piece", "start", "length", "ids_crc32"])
    out = out.append_column("sequence_id", pa.array(number)).append_column("offset", pa.array(offset))
    return out.append_column("row", group.column("row")).append_column("room", pa.array(room))


def _pack_in_rounds(part: DataFrame, capacity: int, group_pieces: int) -> DataFrame:
    """Groups are packed by themselves, then the underfull sequences of all groups in new groups, until one group
    has them all, they have less room than a sequence, or a round saves none."""
    left, least, first, packed = part.count(), None, 0, []
    dealt_by = "row"
    while True:
        groups = max(1, -(-left // group_pieces))
        dealt = part.withColumn("pack", F.pmod(F.xxhash64(dealt_by, F.lit(first)), F.lit(groups)))
        pack_group = lean_group(functools.partial(_pack, capacity=capacity, first=first, last=groups == 1))
        done = keep(dealt.groupBy("pack").applyInArrow(pack_group, ROUND), "pack-round")
        if groups == 1:
            return functools.reduce(DataFrame.unionByName, [*packed, done]).drop("row", "room")
        part = done.where("room > 0")
        room = part.where("offset = 0").agg(F.coalesce(F.sum("room"), F.lit(0))).first()[0]
        if room < capacity or (least is not None and room >= least):
            return functools.reduce(DataFrame.unionByName, [*packed, done]).drop("row", "room")
        packed.append(done.where("room = 0"))
        left, least, first, dealt_by = part.count(), room, first + groups, "sequence_id"


def pack(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: one row per piece of each row of ``docs``.

    Reads doc_id and text only; NULL text is empty and still has its end id.  Rows that repeat a doc_id
    are packed each.  Pieces of full length have a sequence of their own (negative numbers).  The others
    are dealt by a hash of their row in the written table of pieces, so groups are even whatever repeats;
    each group is packed by itself, and the underfull sequences of all groups again in further rounds.  An
    empty table gives an empty result.
    """
    table = keep(pieces(docs, vocabulary or public_tokenizers.path("byte_bpe_50k.json"), capacity), "pack-pieces")
    rows = table.withColumn("row", F.monotonically_increasing_id())
    whole = rows.where(F.col("length") == capacity).select(*table.columns, (-1 - F.col("row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return _pack_in_rounds(rows.where(F.col("length") < capacity), capacity, group_pieces).unionByName(whole)
