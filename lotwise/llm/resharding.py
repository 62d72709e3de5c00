"""Resharding by minimum-cost flow: from old shard sizes to new capacities with the fewest bytes moved.

Each old shard is cut into blocks by a hash of its rows.  The flow network has one node per old and
new shard, so its size does not depend on the data; its solution says how many bytes go from each old
to each new shard.  Blocks, a bounded number per old shard, then realise these amounts.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .base import new_path, text_or_empty

NEW_SHARDS = 24
#: Shards of the old layout, and blocks that each of them is cut into: 24,576 rows reach the driver at most.
OLD_SHARDS, BLOCKS = 24, 1024


class MinCostFlow:
    """Successive shortest paths with potentials over integer capacities and costs."""

    def __init__(self, nodes: int):
        self.out: list[list[int]] = [[] for _ in range(nodes)]
        self.head: list[int] = []
        self.room: list[int] = []
        self.cost: list[int] = []

    def arc(self, a: int, b: int, room: int, cost: int) -> int:
        for node, to, cap, price in ((a, b, room, cost), (b, a, 0, -cost)):
            self.out[node].append(len(self.head))
            self.head.append(to)
            self.room.append(cap)
            self.cost.append(price)
        return len(self.head) - 2

    def solve(self, source: int, sink: int) -> int:
        """Send as much as possible at least cost; returns the cost."""
        potential, total = [0] * len(self.out), 0
        while True:
            far: list[float] = [float("inf")] * len(self.out)
            by = [-1] * len(self.out)
            far[source], queue = 0, [(0, source)]
            while queue:
                d, node = heapq.heappop(queue)
                if d > far[node]:
                    continue
                for e in self.out[node]:
                    reduced = d + self.cost[e] + potential[node] - potential[self.head[e]]
                    if self.room[e] and reduced < far[self.head[e]]:
                        far[self.head[e]], by[self.head[e]] = reduced, e
                        heapq.heappush(queue, (reduced, self.head[e]))
            if by[sink] < 0:
                return total
            potential = [p + (int(d) if d < float("inf") else 0) for p, d in zip(potential, far, strict=True)]
            path, node = [], sink
            while node != source:
                path.append(by[node])
                node = self.head[by[node] ^ 1]
            sent = min(self.room[e] for e in path)
            for e in path:
                self.room[e] -= sent
                self.room[e ^ 1] += sent
            total += sent * sum(self.cost[e] for e in path)


def transfers(sizes: Sequence[int], capacities: Sequence[int]) -> dict[tuple[int, int], int]:
    """Bytes from each old shard to each new one; a byte that stays in the shard of its number costs
    nothing, any other costs one.  The capacities must hold all bytes."""
    if sum(capacities) < sum(sizes):
        raise ValueError("the capacities are below the sizes")
    old, new = len(sizes), len(capacities)
    net = MinCostFlow(old + new + 2)
    for i, size in enumerate(sizes):
        net.arc(old + new, i, size, 0)
    for j, capacity in enumerate(capacities):
        net.arc(old + j, old + new + 1, capacity, 0)
    arcs = {(i, j): net.arc(i, old + j, sizes[i], int(i != j)) for i in range(old) for j in range(new) if sizes[i]}
    net.solve(old + new, old + new + 1)
    return {pair: net.room[e ^ 1] for pair, e in arcs.items() if net.room[e ^ 1]}


@dataclass(frozen=True)
class Block:
    old: int
    block: int
    size: int
    rows: int


def place_blocks(blocks: Sequence[Block], capacities: Sequence[int]) -> list[int]:
    """The new shard of each block.

    Largest blocks first, each goes where the flow still has the most room for its old shard, its own
    number first; blocks that fit into no amount of the flow go, largest first, to the shard that is
    furthest below its capacity.
    """
    sizes = [0] * (max((b.old for b in blocks), default=0) + 1)
    for b in blocks:
        sizes[b.old] += b.size
    left = transfers(sizes, capacities)
    ways: dict[int, list[int]] = {}
    for i, j in sorted(left, key=lambda pair: (pair[0], pair[0] != pair[1], pair[1])):
        ways.setdefault(i, []).append(j)
    put, filled, rest = [-1] * len(blocks), [0] * len(capacities), []
    for k in sorted(range(len(blocks)), key=lambda k: (-blocks[k].size, blocks[k].old, blocks[k].block)):
        b = blocks[k]
        to = next((j for j in ways.get(b.old, ()) if left[b.old, j] >= b.size), None)
        if to is None:
            rest.append(k)
            continue
        left[b.old, to] -= b.size
        put[k] = to
        filled[to] += b.size
    below = [(filled[j] - capacities[j], j) for j in range(len(capacities))]
    heapq.heapify(below)
    for k in rest:
        level, j = heapq.heappop(below)
        put[k] = j
        heapq.heappush(below, (level + blocks[k].size, j))
    return put


def even(total: int, shards: int) -> list[int]:
    """Capacities that hold ``total`` bytes and differ by one at most."""
    return [total // shards + (j < total % shards) for j in range(shards)]


def old_shard_of_file(shards: int = OLD_SHARDS) -> Column:
    """The old layout of a table as it lies in files: the number that its file's name hashes to."""
    return F.pmod(F.crc32(F.element_at(F.split(F.input_file_name(), "/"), -1).cast("binary")), F.lit(shards)).cast("int")


def row_in_file() -> Column:
    """The place of a row in its Parquet file, which tells rows apart that are equal in all values."""
    return F.col("_metadata.row_index")


def _block(blocks: int, row: Column | None) -> tuple[Column, Column, Column]:
    """(size, text_crc32, block) of a document."""
    text = text_or_empty().cast("binary")
    size, crc = (F.octet_length(text) + F.lit(8)).cast("long"), F.crc32(text)
    parts = [F.col("doc_id"), crc, size] + ([] if row is None else [row])
    return size, crc, F.pmod(F.xxhash64(*parts), F.lit(blocks)).cast("int")


def _placed(rows: DataFrame, shards: int, capacities: Sequence[int] | None) -> list[tuple[int, int, int, int]]:
    """(old_shard, block, shard, rows before it in that shard) of every block, from rows of old_shard, block and size."""
    summed = rows.groupBy("old_shard", "block").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("rows"))
    found = sorted((Block(r["old_shard"], r["block"], r["size"], r["rows"]) for r in summed.collect()), key=lambda b: (b.old, b.block))
    put = place_blocks(found, capacities or even(sum(b.size for b in found), shards))
    taken = [0] * len(capacities or range(shards))
    placed = []
    for b, shard in zip(found, put, strict=True):
        placed.append((b.old, b.block, shard, taken[shard]))
        taken[shard] += b.rows
    return placed


def reshard(
    docs: DataFrame, old_shard: Column, shards: int = NEW_SHARDS, capacities: Sequence[int] | None = None, blocks: int = BLOCKS,
    row: Column | None = None,
) -> DataFrame:
    """doc_id, size, text_crc32, old_shard, block, shard and slot, one row per row of ``docs``.

    ``old_shard`` numbers the old layout from 0 and must have a bounded number of values.  Size: UTF-8
    bytes of the text (NULL: none) plus 8.  Without ``capacities`` the new shards get near equal
    bytes.  Slots of a shard go gapless from 0, by block, then doc_id; rows that tie on all values take
    neighbouring slots.  A block is a hash of doc_id, text and ``row``, so a NULL or repeated doc_id is
    spread over blocks; without ``row`` (:func:`row_in_file` for a table read from Parquet files) the
    rows of an old shard that are equal in doc_id and text share one.  An empty table gives an
    empty result.  Only one row per block, at most old shards times ``blocks``, reaches the driver, and
    the broadcast block table has that bound.
    """
    size, crc, block = _block(blocks, row)
    rows = docs.select("doc_id", size.alias("size"), crc.alias("text_crc32"), old_shard.alias("old_shard"), block.alias("block"))
    schema = "old_shard int, block int, shard int, before long"
    table = F.broadcast(docs.sparkSession.createDataFrame(_placed(rows, shards, capacities), schema))
    order = Window.partitionBy("old_shard", "block").orderBy("doc_id", "text_crc32", "size")
    return (
        rows.withColumn("place", F.row_number().over(order))
        .join(table, ["old_shard", "block"])
        .withColumn("slot", (F.col("before") + F.col("place") - 1).cast("long"))
        .drop("before", "place")
    )


def rewrite(
    docs: DataFrame, old_shard: Column, name: str = "resharded", shards: int = NEW_SHARDS, capacities: Sequence[int] | None = None,
    blocks: int = BLOCKS, row: Column | None = None,
) -> tuple[DataFrame, list[int]]:
    """Write the files of the affected shards anew, one folder per shard; returns (table, shards).

    A shard is affected if a block moved into or out of it.  The rows take the shards that
    :func:`reshard` gives their (old_shard, block) under the same arguments, and only those of affected
    shards enter the shuffle.  The number of writing tasks per shard follows its size, as the rows
    are rebalanced by shard.
    """
    size, _, block = _block(blocks, row)
    placed = _placed(docs.select(size.alias("size"), old_shard.alias("old_shard"), block.alias("block")), shards, capacities)
    affected = sorted({shard for old, _, to, _ in placed if old != to for shard in (old, to)})
    moves = [(old, b, to) for old, b, to, _ in placed if to in set(affected)]
    table = F.broadcast(docs.sparkSession.createDataFrame(moves, "_old_shard int, _block int, new_shard int"))
    path = new_path(docs.sparkSession, name)
    rows = docs.select("*", old_shard.alias("_old_shard"), block.alias("_block")).join(table, ["_old_shard", "_block"])
    rows = rows.drop("_old_shard", "_block")
    rows.hint("rebalance", F.col("new_shard")).write.partitionBy("new_shard").option("compression", "zstd").parquet(path)
    schema = T.StructType([*docs.schema.fields, T.StructField("new_shard", T.IntegerType())])
    return docs.sparkSession.read.schema(schema).parquet(path), affected
