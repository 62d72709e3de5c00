"""N-gram Jaccard join: a blocked sparse product of the document by n-gram incidence matrix.

Which rows can be similar at all follows from sizes alone.  The columns (n-grams) are cut into ranges by
hash, so many per document that two similar documents agree on a whole range: with at most d n-grams in
one set only, d + 1 ranges leave one without a difference.  Documents that agree on a range, directly or
through others, form a candidate group; a shared passage makes one only where it fills a range alone.  A group too
large for one tile is grouped anew by its sets' rarest n-grams, since such passages are found in more documents the
more there are.  Each group's rows of the matrix, in tiles of bounded size, are multiplied
with their transpose, columns a block at a time, and pairs below the bound for their sizes are dropped.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .base import forget, keep, lean, lean_group, lists_of, texts_of, with_unique_id, without
from .components import connected_components
from .hashing import U, chunks, mix, word_hashes

WORDS, SIMILARITY = 3, 90
#: A range that more documents offer is crowded.
CROWD = 32
#: A tile of the product: documents and n-grams on either side, in expectation.
TILE_DOCUMENTS, TILE_GRAMS = 1024, 1 << 19
#: Distances between the parts of a group whose tiles are made at a time: a row is shuffled twice for each at most.
DISTANCES = 4
#: Columns of a dense block; an n-gram in fewer documents of a tile is added up pair by pair.
DENSE_COLUMNS, DENSE_FROM = 2048, 24
#: Entry pairs that are added up at once.
PAIRS = 1 << 19

_FACTORS = mix(np.arange(1, 65, dtype=np.uint64)) | U(1)


def shingle_sets(texts: Sequence[bytes], words: int = WORDS) -> Iterator[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's shingles; a text with fewer words has its whole sequence."""
    for start, end in chunks(texts):
        hashes, first = word_hashes([t.lower() for t in texts[start:end]])
        grams = np.zeros(max(len(hashes) - words + 1, 0), dtype=np.uint64)
        for k in range(words):
            grams += hashes[k : len(hashes) - words + 1 + k] * _FACTORS[k] if len(grams) else U(0)
        grams = mix(grams)
        for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            if b - a >= words:
                yield np.unique(grams[a : b - words + 1])
            elif b > a:
                short = (hashes[a:b] * _FACTORS[words : words + b - a]).sum(keepdims=True) + U(b - a)
                yield mix(short)
            else:
                yield hashes[:0]


class SizeClasses:
    """Classes of set sizes such that similar sets lie in the same or in neighbouring classes.

    Meeting t joins class t - 1 and class t; ``ranges(t)`` is one more than the n-grams that two of its
    similar sets can differ in, |A| + |B| - 2 |A and B| <= (|A| + |B|) (1 - s) / (1 + s), plus ``spare(t)``.

    So similar sets agree on more than ``spare`` ranges, and a set may withhold its ``spare`` - 1 weakest:
    of a similar pair, the set that withholds up to the stronger range still offers two of those they agree
    on (one where ``spare`` is 0), and the other set, which withholds less, offers them too.  Weak are ranges of few n-grams (ties by
    their signature): those are what dissimilar sets agree on by chance or by a shared passage.
    """

    def __init__(self, percent: int, most: int = 1 << 40):
        self.percent, self.starts = percent, [1]
        while self.starts[-1] < most:
            self.starts.append(self.starts[-1] * 100 // percent + 1)

    def of(self, n: int) -> int:
        return int(np.searchsorted(self.starts, n, side="right")) - 1

    def differing(self, meeting: int) -> int:
        return 2 * (self.starts[meeting + 1] - 1) * (100 - self.percent) // (100 + self.percent)

    def spare(self, meeting: int) -> int:
        return (self.differing(meeting) + 1) // 2

    def ranges(self, meeting: int) -> int:
        return self.differing(meeting) + 1 + self.spare(meeting)


def range_signatures(grams: np.ndarray, classes: SizeClasses) -> np.ndarray:
    """One hash per offered column range and meeting: of the meeting, the range's number and its n-grams."""
    out = []
    own = classes.of(len(grams)) if len(grams) else 0
    sums = np.concatenate(([U(0)], np.cumsum(mix(grams ^ U(0x5851F42D4C957F2D)))))
    for meeting in (own, own + 1):
        n = classes.ranges(meeting)
        if len(grams) and n > 1:  # with one range only equal sets would meet, which are one class already
            limits = (np.arange(1, n, dtype=np.float64) * (2.0**64 / n)).astype(np.uint64)
            cuts = np.concatenate(([0], np.searchsorted(grams, limits), [len(grams)]))
            number = np.arange(n, dtype=np.uint64) + (U(meeting) << U(40))
            signatures = mix((sums[cuts[1:]] - sums[cuts[:-1]]) ^ mix(number))
            out.append(signatures[np.lexsort((signatures, np.diff(cuts)))[max(classes.spare(meeting) - 1, 0) :]])
    return np.concatenate(out) if out else grams[:0]


def set_marks(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, n_shingles and a fingerprint of the set (NULL for an empty one)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, marks = [], []
            for grams in shingle_sets(texts_of(batch), words):
                sizes.append(len(grams))
                marks.append(hashlib.blake2b(grams.tobytes(), digest_size=16).digest() if len(grams) else None)
            columns = [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(marks, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_shingles", "mark"])

    cut = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    return cut.mapInArrow(lean(run), "doc_id long, n_shingles long, mark binary")


def offered_ranges(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """range, id, leader: a row for each range signature that a document offers (see ``_meetings``).  They go straight
    into a shuffle; hashing the texts a second time costs less than keeping them on disk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = SizeClasses(percent)
        for batch in batches:
            texts = texts_of(batch)
            signatures, owners = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
            for a in range(0, len(texts), 512):
                parts = [range_signatures(grams, classes) for grams in shingle_sets(texts[a : a + 512], words)]
                of = np.repeat(np.arange(a, a + len(parts)), [len(p) for p in parts])
                for column, part in zip((signatures, owners), (np.concatenate(parts), of), strict=True):
                    column.append(part)
            yield _meetings(np.concatenate(signatures), batch.column("doc_id").to_numpy()[np.concatenate(owners)])

    cut = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    return cut.mapInArrow(lean(run), "range long, id long, leader long")


def _meetings(ranges: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
    """range, id, leader of what one batch offers.  In a range that more than CROWD of its documents offer, the
    one with the smallest id speaks for them (leader: itself) and the others follow it, under a number of their own
    in place of the range: a range of a third of all documents meets itself once per batch."""
    order = np.lexsort((ids, ranges))
    ranges, ids = ranges[order], ids[order]
    begin = np.flatnonzero(np.append(True, ranges[1:] != ranges[:-1])) if len(ranges) else np.empty(0, np.int64)
    sizes = np.diff(np.append(begin, len(ranges)))
    crowded = np.repeat(sizes > CROWD, sizes)
    leader = np.repeat(ids[begin], sizes)
    keys = np.where(crowded & (ids != leader), mix(ranges ^ mix(ids.astype(np.uint64))), ranges)
    columns = [pa.array(keys.view(np.int64)), pa.array(ids), pa.array(leader, mask=~crowded)]
    return pa.RecordBatch.from_arrays(columns, names=["range", "id", "leader"])


def with_texts(docs: DataFrame, members: DataFrame) -> DataFrame:
    """``members`` (id and other columns) with the texts of their documents."""
    texts = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    return texts.join(members, F.col("doc_id") == F.col("id")).select(*members.columns, "text")


def with_grams(texts: DataFrame, words: int) -> DataFrame:
    """``texts`` (text and int or long columns) with grams, the whole incidence rows, in place of the text."""
    carried = [c for c in texts.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams = lists_of([g.view(np.int64) for g in shingle_sets(texts_of(batch), words)])
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in carried), grams], names=[*carried, "grams"])

    fields = ", ".join(f"{c} {t}" for c, t in texts.drop("text").dtypes)
    return texts.mapInArrow(lean(run), f"{fields}, grams array<long>")


def overlap_counts(left: Sequence[np.ndarray], right: Sequence[np.ndarray]) -> np.ndarray:
    """Common n-grams of each left and each right row: the product of two sparse 0/1 matrices.

    Columns of few entries are added up entry pair by entry pair, the others in dense blocks, so neither
    many rare nor a few frequent n-grams blow the work up; memory is the result and one block.
    """
    out = np.zeros((len(left), len(right)), dtype=np.float32)
    sides = []
    for rows in (left, right):
        grams = np.concatenate(rows) if rows else np.empty(0, np.int64)
        owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        order = np.argsort(grams, kind="stable")
        sides.append((grams[order], owner[order]))
    (grams_a, rows_a), (grams_b, rows_b) = sides
    columns = np.intersect1d(grams_a, grams_b)
    begin_a, end_a = np.searchsorted(grams_a, columns), np.searchsorted(grams_a, columns, side="right")
    begin_b, end_b = np.searchsorted(grams_b, columns), np.searchsorted(grams_b, columns, side="right")
    size_a, size_b = end_a - begin_a, end_b - begin_b
    light = np.flatnonzero(size_a * size_b < DENSE_FROM * DENSE_FROM)
    for part in np.array_split(light, 1 + int((size_a * size_b)[light].sum()) // PAIRS):
        n = (size_a * size_b)[part]
        column = np.repeat(part, n)
        k = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        x = rows_a[begin_a[column] + k // size_b[column]]
        y = rows_b[begin_b[column] + k % size_b[column]]
        cells, counts = np.unique(x * len(right) + y, return_counts=True)
        out.reshape(-1)[cells] += counts.astype(np.float32)
    heavy = np.setdiff1d(np.arange(len(columns)), light)
    for part in (heavy[k : k + DENSE_COLUMNS] for k in range(0, len(heavy), DENSE_COLUMNS)):
        dense = []
        for rows, begin, size, height in ((rows_a, begin_a, size_a, len(left)), (rows_b, begin_b, size_b, len(right))):
            block = np.zeros((height, len(part)), dtype=np.float32)
            n = size[part]
            at = np.repeat(begin[part] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            block[rows[at], np.repeat(np.arange(len(part)), n)] = 1
            dense.append(block)
        out += dense[0] @ dense[1].T
    return out


def _tile_links(left: list, right: list, percent: int) -> Iterator[tuple[int, int]]:
    """(larger, smaller) ids that connect what the similar pairs of a tile connect; a forest, not all pairs."""
    (ids_a, rows_a), (ids_b, rows_b) = left, right
    sizes_a, sizes_b = (np.array([len(r) for r in rows], dtype=np.float64) for rows in (rows_a, rows_b))
    sums = sizes_a[:, None] + sizes_b[None, :]
    x, y = np.nonzero(overlap_counts(rows_a, rows_b).astype(np.float64) * (100 + percent) >= percent * sums)
    ids, at = np.unique(np.concatenate((ids_a, ids_b)), return_inverse=True)
    x, y = at[x], at[len(ids_a) + y]
    label = np.arange(len(ids))
    while True:  # each round takes the least label of the neighbours, then follows labels to their ends
        new = label.copy()
        np.minimum.at(new, x, label[y])
        np.minimum.at(new, y, label[x])
        while (new[new] != new).any():
            new = new[new]
        if (new == label).all():
            break
        label = new
    linked = np.flatnonzero(label != np.arange(len(ids)))
    return zip(ids[linked].tolist(), ids[label[linked]].tolist(), strict=True)


def _group_sizes(members: DataFrame) -> DataFrame:
    """group, n, size (n-grams) and the parts that it needs."""
    sizes = members.groupBy("group").agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("size"))
    parts = F.ceil(F.greatest(F.col("n") / TILE_DOCUMENTS, F.col("size") / TILE_GRAMS))
    return keep(sizes.withColumn("parts", parts.cast("int")), "group-sizes")


def _regrouped(docs: DataFrame, members: DataFrame, words: int, percent: int) -> DataFrame:
    """(id, group, n_shingles) of ``members`` that may be similar to others of their group, in the groups that these form.

    A set's n-grams are ordered by the number of sets here that have them, ties by hash.  Similar sets share s |A|
    n-grams of A at least, so the first that they share is among the first |A| - ceil(s |A|) + 1 of A, and likewise of B.
    Those that no other set has come first and meet nothing; of the rest a set offers what is left of these places.
    Sets that offer the same n-gram of a group meet the smallest id of them, so a frequent n-gram costs no squares.
    """
    texts = with_texts(docs, members.select("id", "group")).withColumn("row", F.monotonically_increasing_id())
    texts = keep(texts, "group-texts")  # rows that repeat an id are sets of their own

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams, n = np.unique(np.concatenate([np.empty(0, np.uint64), *shingle_sets(texts_of(batch), words)]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(grams.view(np.int64)), pa.array(n, pa.int64())], names=["gram", "n"])

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = list(shingle_sets(texts_of(batch), words))
            sizes = np.array([len(grams) for grams in sets], np.int32)
            grams = np.concatenate([np.empty(0, np.uint64), *sets]).view(np.int64)
            columns = [pa.array(c) for c in (grams, np.repeat(batch.column("row").to_numpy(), sizes), np.repeat(sizes, sizes))]
            yield pa.RecordBatch.from_arrays(columns, names=["gram", "row", "size"])

    several = texts.select("text").mapInArrow(lean(counts), "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).where("n > 1")
    several = keep(several, "shared-grams")
    held = texts.select("row", "text").mapInArrow(lean(entries), "gram long, row long, size int").join(several, "gram").groupBy("row")
    held = held.agg(F.first("size").alias("size"), F.sort_array(F.collect_list(F.struct("n", "gram"))).alias("held"))
    places = F.size("held") - F.ceil(F.col("size") * percent / 100).cast("int") + 1
    rarest = held.where(places > 0).withColumn("rarest", F.slice("held", F.lit(1), places)).join(texts.select("row", "id", "group"), "row")
    rarest = keep(rarest.select("id", "group", F.explode("rarest.gram").alias("gram")), "rarest-grams")
    forget(several, texts)
    leaders = rarest.groupBy("group", "gram").agg(F.min("id").alias("leader"), F.max("id").alias("last")).where("leader < last").drop("last")
    met = rarest.join(keep(leaders, "leaders"), ["group", "gram"]).select(F.col("id").alias("a"), F.col("leader").alias("b"))
    groups = connected_components(met).withColumnsRenamed({"node": "id", "component": "group"})
    return groups.join(members.select("id", "n_shingles"), "id")


def _product(docs: DataFrame, members: DataFrame, words: int, percent: int) -> DataFrame:
    """Links (a, b) from (id, group, n_shingles) rows: every similar pair of a group is connected by them.

    Small groups share a tile (numbered below 0), a large one is grouped anew and then dealt by hash into as many parts as it
    needs, and each pair of its parts is a tile.  So no task holds more than two parts, however large the
    group.  Tiles are known from the sizes before any text is read, and n-grams are shuffled once for each tile, the tiles of
    a few distances between parts (around a circle) at a time, so that what lies on disk grows with the rows.
    """
    sizes = _group_sizes(members)
    if sizes.where("parts > 1").head(1):
        known = members.join(sizes.select("group", "parts"), "group")
        anew = _regrouped(docs, known.where("parts > 1").select(*members.columns), words, percent)
        members = keep(known.where("parts = 1").select(*members.columns).unionByName(anew), "groups")
        sizes = _group_sizes(members)
    small = sizes.where("parts = 1").agg(F.sum("n").alias("n"), F.sum("size").alias("size")).first()
    cells = 1 + max((small["n"] or 0) // TILE_DOCUMENTS, (small["size"] or 0) // TILE_GRAMS) * 2
    dealt = members.join(sizes.select("group", "parts"), "group").select(
        "id",
        F.when(F.col("parts") > 1, F.col("group")).otherwise(-1 - F.pmod(F.xxhash64("group"), F.lit(cells))).alias("tile"),
        F.pmod(F.xxhash64("id"), F.col("parts")).cast("int").alias("part"),
        "parts",
    )
    texts = keep(with_texts(docs, keep(dealt, "dealt")), "dealt-texts")  # joined first: its shuffle goes before that of the n-grams

    def tiles(nearest: int) -> DataFrame:
        part, parts = F.col("part"), F.col("parts")
        apart = lambda other: F.least(F.pmod(part - other, parts), F.pmod(other - part, parts))
        others = F.filter(F.sequence(F.lit(0), parts - 1), lambda other: apart(other).between(nearest, nearest + DISTANCES - 1))
        rows = with_grams(texts.where(parts >= 2 * nearest), words).withColumn("other", F.explode(others))
        return rows.select("tile", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"), "part", "id", "grams")

    def run(tile: pa.Table) -> pa.Table:
        part, ids = tile.column("part").to_numpy(), tile.column("id").to_numpy()
        grams = tile.column("grams").combine_chunks()
        offsets, values = grams.offsets.to_numpy(), grams.values.to_numpy()
        sides = []
        for number in (tile.column("low")[0].as_py(), tile.column("high")[0].as_py()):
            own = np.flatnonzero(part == number)
            sides.append((ids[own], [values[offsets[k] : offsets[k + 1]] for k in own]))
        links = list(_tile_links(*sides, percent))
        return pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})

    most = sizes.agg(F.max("parts")).first()[0] or 1
    links = [tiles(d).groupBy("tile", "low", "high").applyInArrow(lean_group(run), "a long, b long") for d in range(0, most // 2 + 1, DISTANCES)]
    links = reduce(DataFrame.unionByName, [keep(of, "set-links") for of in links])
    forget(texts)
    return links


def _candidates(offered: DataFrame) -> DataFrame:
    """(a, b, n, leads): pairs that may be similar, and enough of them to connect all that are.

    A similar pair agrees on two ranges at least (``SizeClasses``).  In a range that up to CROWD documents
    offer, every pair counts one; in a larger one every document meets the smallest id, or one that meets it, alone
    (``leads``), which connects all pairs of it, so its size costs no squares.  What a pair has in common is then either
    a crowded range or n >= 2 others; a pair with one range in common by chance is no candidate.
    """
    range_of = Window.partitionBy("range")
    rows = (
        offered.withColumn("n", F.count(F.lit(1)).over(range_of) + F.max(F.when(F.col("leader").isNotNull(), F.lit(CROWD)).otherwise(F.lit(0))).over(range_of))
        .withColumn("leader", F.when(F.col("leader") != F.col("id"), F.col("leader")).otherwise(F.min("id").over(range_of)))
        .where("n > 1")
    )
    rows = keep(rows, "met")
    crowded = rows.where((F.col("n") > CROWD) & (F.col("leader") < F.col("id"))).select(F.col("id").alias("a"), F.col("leader").alias("b"))
    few = rows.where(F.col("n") <= CROWD).groupBy("range").agg(F.sort_array(F.collect_set("id")).alias("ids"))
    few = few.groupBy("ids").agg(F.count(F.lit(1)).alias("n"))  # copies agree on many ranges, whose pairs are the same
    pairs = few.select(F.posexplode("ids").alias("k", "a"), "ids", "n").select("a", F.explode(F.slice("ids", F.lit(1), F.col("k"))).alias("b"), "n")
    both = crowded.select("a", "b", F.lit(1).cast("long").alias("n"), F.lit(True).alias("leads"))
    both = both.unionByName(pairs.withColumn("leads", F.lit(False))).groupBy("a", "b")
    pairs = keep(both.agg(F.sum("n").alias("n"), F.max("leads").alias("leads")), "candidates")
    forget(rows)
    return pairs


def jaccard_links(docs: DataFrame, words: int = WORDS, percent: int = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """(documents, links).

    documents: doc_id, n_shingles, class_id (smallest doc_id with the same set; NULL for an empty set).
    links: (a, b) between class ids, which connect all that link; equal sets are one class before.
    """
    marks = keep(set_marks(docs, words), "set-marks")
    classes = keep(marks.where("mark is not null").groupBy("mark").agg(F.min("doc_id").alias("class_id")), "set-classes")
    known = keep(marks.join(classes, "mark", "left").drop("mark"), "set-members")
    copies = keep(known.where("doc_id is not null and doc_id != class_id").select("doc_id").distinct(), "set-copies")
    offered = offered_ranges(docs.where("doc_id is not null").join(copies, "doc_id", "left_anti"), words, percent)
    met = _candidates(offered).where("leads or n >= 2").select("a", "b")
    groups = connected_components(keep(met, "met")).withColumnsRenamed({"node": "id", "component": "group"})
    sizes = known.where("doc_id = class_id").groupBy(F.col("doc_id").alias("id")).agg(F.max("n_shingles").alias("n_shingles"))
    members = keep(groups.join(sizes, "id"), "groups")
    return known, _product(docs, members, words, percent)


def jaccard_components(docs: DataFrame, words: int = WORDS, percent: int = SIMILARITY) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable by links, itself included).

    Reads doc_id and text only.  A text is lower-cased in A-Z; NULL, empty or wordless texts have no
    shingles and are linked with nothing.  Rows that repeat a doc_id are one node. A row with
    a NULL doc_id gets the component of its set, or NULL.  Sets are sets of 64-bit hashes.
    """
    known, links = jaccard_links(docs, words, percent)
    comps = keep(connected_components(links), "components")
    return known.join(comps, F.col("class_id") == F.col("node"), "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "class_id", "doc_id").alias("component_id")
    )


def one_of_each_group(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """The rows of ``docs``, all columns, that have the smallest doc_id of their component.

    Every row is a document of its own: of rows that repeat a doc_id one has it and the others, like those without
    one, come after all doc_ids, so that an equal row goes, and one with another text is judged by that text.
    Any column name may occur beside doc_id and text.
    """
    rows, unique = with_unique_id(docs)
    found = jaccard_components(rows.select(F.col(unique).alias("doc_id"), "text"), words, percent)
    return without(rows, unique, found.where("doc_id != component_id").select("doc_id"), "near-copies")
