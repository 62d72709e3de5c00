"""Nulls, empty tables, very long texts, repeated rows, clashing columns, and the parts of each method."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lotwise.llm import exact_dedup, language_id, mixing, ngram_join, packing, quality_rules, resharding
from lotwise.llm import suffix_array, suffix_automaton, url_filter
from lotwise.llm.components import connected_components

OPERATORS = {
    "reshard": lambda d: resharding.reshard(d, F.lit(0), blocks=8),
    "automaton": suffix_automaton.remove_repeats,
    "array": suffix_array.remove_repeats,
    "rules": quality_rules.quality_rules,
    "jaccard": ngram_join.jaccard_components,
    "language": language_id.identify,
    "mixing": mixing.copies,
    "packing": packing.pack,
    "exact": exact_dedup.exact_dedup,
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_odd_rows(odd, none, name):
    rows = OPERATORS[name](odd).collect()
    found = {r["doc_id"] for r in rows}
    assert found == {None, *range(12)}
    assert len(rows) == odd.count() or name == "packing"
    assert OPERATORS[name](none).collect() == []


def test_null_and_repeated(odd):
    exact = {r["doc_id"]: r for r in exact_dedup.exact_dedup(odd).collect()}
    assert exact[7]["keep_id"] == 5 and exact[5]["group_size"] == 4 and exact[None]["keep_id"] == 5
    assert exact[1]["keep_id"] == 0 and not exact[1]["kept"] and exact[2]["keep_id"] == 2
    joined = {r["doc_id"]: r for r in ngram_join.jaccard_components(odd).collect()}
    assert [joined[k]["n_shingles"] for k in (0, 1, 2, 3, 4)] == [0, 0, 0, 1, 1]
    assert [joined[k]["component_id"] for k in (0, 1, 2, 6, 7, 10)] == [0, 1, 2, 5, 5, 9]
    automaton = {r["doc_id"]: r["n_removed"] for r in suffix_automaton.remove_repeats(odd).collect()}
    assert automaton[5] == 0 and automaton[7] == 16 and automaton[6] == 16 and automaton[None] == 0
    assert {r["doc_id"]: r["lang_pred"] for r in language_id.identify(odd).collect()}[2] == "und"


def test_collisions(spark):
    texts = ["a", "b", "a", "c c", "c  c", "b", "d"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: (r["keep_id"], r["group_size"]) for r in exact_dedup.exact_dedup(docs, lambda t: F.lit(b"same")).collect()}
    assert got == {0: (0, 2), 1: (1, 2), 2: (0, 2), 3: (3, 2), 4: (3, 2), 5: (1, 2), 6: (6, 1)}


def test_flow():
    assert resharding.transfers([10, 0, 2], [4, 4, 4]) == {(0, 0): 4, (0, 1): 4, (0, 2): 2, (2, 2): 2}
    rng = random.Random(1)
    for _ in range(50):
        old = [rng.randrange(50) for _ in range(rng.randrange(1, 6))]
        room = resharding.even(sum(old), rng.randrange(1, 6))
        moves = resharding.transfers(old, room)
        assert [sum(v for (i, _), v in moves.items() if i == k) for k in range(len(old))] == old
        assert all(sum(v for (_, j), v in moves.items() if j == k) <= room[k] for k in range(len(room)))
        stay = sum(min(a, b) for a, b in zip(old, room, strict=False))
        assert sum(v for (i, j), v in moves.items() if i != j) == sum(old) - stay
    with pytest.raises(ValueError):
        resharding.transfers([3], [2])


def test_rewrite(odd):
    table, shards = resharding.rewrite(odd.where("doc_id is not null").dropDuplicates(["doc_id"]), F.lit(0), shards=3, blocks=64)
    assert 0 in shards and table.count() == 12 and {r[0] for r in table.select("new_shard").distinct().collect()} <= set(shards)


def test_rewrite_of_null_and_repeated_ids(spark):
    """Rows of one doc_id lie in several old shards; shard 0 is not affected, the others even out."""
    ids = lambda i: (None, 7, i)[i // 4 % 3]
    rows = [(ids(i), f"text {i}", 0 if i % 4 == 0 else 1 if i % 4 < 3 else 2) for i in range(2400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, part int")
    sizes = [sum(len(t) + 8 for _, t, part in rows if part == k) for k in range(3)]
    rest = sum(sizes) - sizes[0]
    how = {"capacities": [sizes[0], rest // 2, rest - rest // 2], "blocks": 64}
    placed = resharding.reshard(docs, F.col("part"), **how)
    by_shard = {r["shard"]: r["size"] for r in placed.groupBy("shard").agg(F.sum("size").alias("size")).collect()}
    assert by_shard[0] == sizes[0] and abs(by_shard[1] - by_shard[2]) <= rest / 64
    table, shards = resharding.rewrite(docs, F.col("part"), **how)
    want = sorted((r["text_crc32"], r["shard"]) for r in placed.where("shard > 0").collect())
    assert shards == [1, 2] and sorted(map(tuple, table.select(F.crc32("text"), "new_shard").collect())) == want


def test_reshard_spreads_equal_rows(spark, tmp_path):
    """A third of the rows are equal in all values: by their place in the file they fall into many blocks."""
    rows = [(None, "same text") if i % 3 == 0 else (i, f"text {i:05}") for i in range(3000)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(2).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    placed = resharding.reshard(docs, resharding.old_shard_of_file(), 8, row=resharding.row_in_file())
    per_shard = [r["size"] for r in placed.groupBy("shard").agg(F.sum("size").alias("size")).collect()]
    assert placed.count() == 3000 and len(per_shard) == 8 and max(per_shard) - min(per_shard) <= 200


def test_rewrite_documents(spark, docs):
    how = {"row": resharding.row_in_file()}
    table, shards = resharding.rewrite(docs, resharding.old_shard_of_file(), **how)
    placed = resharding.reshard(docs, resharding.old_shard_of_file(), **how).where(F.col("shard").isin(shards))
    got = [sorted(map(tuple, d.collect())) for d in (placed.select("doc_id", "shard"), table.select("doc_id", "new_shard"))]
    assert got[0] == got[1] and len(got[0]) == docs.count()


def test_rules_hosts(spark):
    good, bad = " ".join(f"w{i}" for i in range(60)), "too short"
    rows = [(i, good, "a") for i in range(40)] + [(100 + i, bad if i < 39 else good, "b") for i in range(40)]
    got = {r["doc_id"]: r for r in quality_rules.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert all(got[i]["kept"] for i in range(40)) and not got[139]["base_failed"] and not got[139]["kept"]


def test_automaton_and_array():
    rng = random.Random(2)
    for length in (2, 3, 5):
        parts = [bytes(rng.choice(b"ab") for _ in range(rng.randrange(length, 40))) for _ in range(30)]
        firsts = [rng.randrange(9) for _ in parts]
        want = [[min(f for p, f in zip(parts, firsts) if s[k : k + length] in p) for k in range(len(s) - length + 1)] for s in parts]
        flat = [x for row in want for x in row]
        sizes = np.array([len(p) for p in parts])
        found, counts = suffix_array.array_index(length)(b"".join(parts), sizes, np.array(firsts))
        assert found.tolist() == flat and counts.tolist() == [len(row) for row in want]
        spaced = [b" ".join(bytes([c]) for c in p) + b" " for p in parts]
        found, counts = suffix_automaton.automaton_index(length)(b"".join(spaced), np.array([len(p) for p in spaced]), np.array(firsts))
        assert found.tolist() == flat and counts.tolist() == [len(row) for row in want]


@pytest.mark.parametrize("period", [3, 7, 31, 64])
def test_difference_cover(period):
    cover = suffix_array.difference_cover(period)
    assert {(a - b) % period for a in cover for b in cover} == set(range(period))


def test_suffix_order():
    rng = random.Random(3)
    text = bytes(rng.choice(b"aab") for _ in range(300)) * 3
    ordered = np.concatenate([o for o, _ in suffix_array.BlockSuffixes(text, 200).sort(np.arange(len(text) - 200))])
    assert [text[k : k + 200] for k in ordered] == sorted(text[k : k + 200] for k in range(len(text) - 200))


def test_overlaps_and_tiles(spark, docs, monkeypatch):
    rng = np.random.default_rng(4)
    rows = [np.unique(rng.integers(0, 80, rng.integers(0, 60))) for _ in range(70)]
    want = [[len(set(a.tolist()) & set(b.tolist())) for b in rows[:30]] for a in rows]
    assert ngram_join.overlap_counts(rows, rows[:30]).tolist() == want
    plain = sorted(map(tuple, ngram_join.jaccard_components(docs, 5, 50).collect()))
    monkeypatch.setattr(ngram_join, "TILE_DOCUMENTS", 1)
    assert sorted(map(tuple, ngram_join.jaccard_components(docs, 5, 50).collect())) == plain


def test_components(spark):
    links = [(i, i + 1) for i in range(1, 60)] + [(100, 7), (200, 201), (201, 200), (5, 5), (None, 3)] + [(1000 + i, 999) for i in range(300)]
    got = dict(map(tuple, connected_components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert got == {**{i: 1 for i in [*range(1, 61), 100]}, 200: 200, 201: 200, **{i: 999 for i in [999, *range(1000, 1300)]}}


def test_language_sums_all_segmentations():
    names = ["▁", "▁a", "a", "b", "ab", "▁ab"]
    table = np.array([[0.1], [0.2], [0.15], [0.25], [0.05], [0.25]])
    pieces = language_id.Pieces(names, table)
    # ▁|a|b, ▁a|b, ▁|ab, ▁ab
    total = 0.1 * 0.15 * 0.25 + 0.2 * 0.25 + 0.1 * 0.05 + 0.25
    assert np.allclose(np.exp(pieces.log_probability(["ab"])), total)
    expected = pieces.expected(["ab"], np.array([[1.0]]))[2:, 0] * total
    assert np.allclose(expected, [0.1 * 0.15 * 0.25 + 0.1 * 0.05, 0.05, 0.1 * 0.15 * 0.25, 0.1 * 0.15 * 0.25 + 0.05, 0.005, 0.25])


def test_known_language_rejects_what_was_not_learned(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang").where("lang != 'es'")
    rng = random.Random(7)
    foreign = [
        "Minä olen tänään kotona ja luen kirjaa suomalaisesta metsästä, jossa linnut laulavat ja lumi sulaa hitaasti keväällä.",
        "Сегодня хорошая погода, и мы идём гулять по берегу реки вместе с нашими друзьями.",
        "".join(rng.choice("abcdefghijklmnopqrstuvwxyz    ") for _ in range(400)),
    ]
    planted = spark.createDataFrame([(-1 - k, t, None) for k, t in enumerate(foreign)] + [(-9, "ok", None)], docs.schema)
    kept = {r["doc_id"] for r in language_id.known_language(docs.unionByName(planted)).collect()}
    assert kept == {r["doc_id"] for r in docs.where(r"text rlike '\\p{L}'").collect()} | {-9}


def test_known_language_without_labels(odd):
    docs = odd.withColumn("lang", F.lit(None).cast("string"))
    assert sorted(map(str, language_id.known_language(docs).collect())) == sorted(map(str, docs.collect()))


def test_targets(spark):
    sizes = spark.createDataFrame([("a", 100), ("b", 10), ("c", 100), (None, 100), ("z", 0)], "source string, size long")
    got = {r["source"]: r["target"] for r in mixing.source_targets(sizes).collect()}
    # Weights a 3, b 1, c 2, z 3, null 1; 465 words; b and z stop, then a.
    assert got["b"] == 20 and got["z"] == 0 and got["a"] == 200
    assert abs(got["c"] - 245 * 2 / 3) < 1e-9 and abs(got[None] - 245 / 3) < 1e-9


def test_token_libraries_agree():
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    fast, general = packing._fast(path), packing._general(path)
    rng = random.Random(5)
    for _ in range(300):
        text = "".join(chr(rng.randrange(256)) if rng.random() < 0.5 else rng.choice(" \n\t'sabZ09<|endoftext|>") for _ in range(rng.randrange(60)))
        assert fast.encode(text, allowed_special="all") == general.encode(text, add_special_tokens=False).ids


def test_local_search():
    rng = random.Random(6)
    sizes = np.array([rng.randrange(200, 900) for _ in range(400)])
    start = packing.best_fit(sizes, 1024)
    better = packing.improve([list(b) for b in start], sizes, 1024)
    assert sorted(i for b in better for i in b) == list(range(400)) and all(sizes[b].sum() <= 1024 for b in better)
    assert len(better) <= len(start)


def test_local_search_takes_any_pair():
    """The emptiest bin's ninth and tenth pieces together, for one of 10, are its only step."""
    sizes = np.array([491, 10] * 84 + [40] * 8 + [7, 5], dtype=np.int64)
    bins = packing.improve([[2 * k, 2 * k + 1] for k in range(84)] + [[*range(168, 178)]], sizes, 505)
    assert sorted(i for b in bins for i in b) == list(range(178)) and max(int(sizes[b].sum()) for b in bins) == 503


def test_groups_share_their_rests(spark, docs):
    """Small groups end with nearly as few sequences as one group."""
    counts = []
    for group_pieces in (24, 4096):
        rows = packing.pack(docs, group_pieces=group_pieces).collect()
        counts.append(len({r["sequence_id"] for r in rows}))
        fills = {}
        for r in rows:
            fills[r["sequence_id"]] = fills.get(r["sequence_id"], 0) + r["length"]
        assert max(fills.values()) <= 1024
    assert counts[1] <= counts[0] <= 1.05 * counts[1], counts


@pytest.mark.parametrize("pages", [[], [(1, None), (2, "no scheme")], [(1, "http://a.org/x"), (2, "http://b.net/y"), (None, "http://A.example.ORG/es/1?q")]])
def test_urls(spark, pages):
    got = url_filter.judge_urls(spark.createDataFrame([(*p, "h") for p in pages], "page_id long, url string, host string")).collect()
    assert len(got) == len(pages) and all(r["verdict"] in ("allow", "block") for r in got)
    assert {r["rule"] for r in got if r["page_id"] is None} <= {"example.org/es/"}


def test_a_crowd_in_a_batch(spark):
    """More near copies in one batch than meet pair by pair, and other documents among them."""
    rng = random.Random(8)
    word = lambda: "".join(rng.choices("abcdef", k=5))
    base = [word() for _ in range(150)]
    texts = [" ".join([*base[:k], word(), *base[k + 1 :]]) if i % 2 else " ".join(word() for _ in range(60)) for i, k in enumerate(rng.choices(range(1, 149), k=400))]
    docs = spark.createDataFrame([(1000 - i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    sets = {1000 - i: {tuple(w[j : j + 3]) for j in range(len(w) - 2)} for i, t in enumerate(texts) for w in [t.split()]}
    want, left = {}, set(sets)
    while left:
        todo = [min(left)]
        root = todo[0]
        left.discard(root)
        while todo:
            a = todo.pop()
            want[a] = root
            near = [b for b in left if 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b])]
            left.difference_update(near)
            todo += near
    for parts in (1, 7):
        got = {r["doc_id"]: r["component_id"] for r in ngram_join.jaccard_components(docs.repartition(parts), 3, 90).collect()}
        assert got == want


def test_meetings():
    ranges = np.array([5] * 40 + [6] * 3 + [7], dtype=np.uint64)
    ids = np.array([*range(100, 60, -1), 1, 2, 3, 9])
    rows = ngram_join._meetings(ranges, ids).to_pylist()
    assert sorted((r["range"], r["id"]) for r in rows if r["leader"] is None) == [(6, 1), (6, 2), (6, 3), (7, 9)]
    assert [(r["range"], r["id"]) for r in rows if r["leader"] == r["id"]] == [(5, 61)]
    silent = [r for r in rows if r["leader"] not in (None, r["id"])]
    assert len({r["range"] for r in silent}) == 39 and {r["leader"] for r in silent} == {61}


def test_large_candidate_groups_are_grouped_anew_and_met_in_rounds(spark, monkeypatch):
    """Texts that share a passage, half of each, form one candidate group; that no two are similar must not cost each row
    a copy for every part of the group.  Real copies in a group of many parts meet in several rounds, none is lost."""
    passage = " ".join(f"p{k}" for k in range(30))
    texts = {i: passage + " " + " ".join(f"u{i}x{k}" for k in range(10)) for i in range(60)}
    texts |= {100 + i: " ".join(f"c{(i // 20)}w{k}" if k != i * 2 else f"edit{i}" for k in range(80)) for i in range(40)}
    sets = {i: {tuple(w[k : k + 5]) for k in range(len(w) - 4)} for i, w in ((i, t.split()) for i, t in texts.items())}
    want = {i: i for i in texts}
    for _ in texts:
        for i in texts:
            near = [want[j] for j in texts if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
            want[i] = min(near)
    assert len(set(want.values())) == 62
    kept = {}
    plain = ngram_join.keep

    def spy(df, name):
        out = plain(df, name)
        kept.setdefault(name, []).append(out)
        return out

    monkeypatch.setattr(ngram_join, "keep", spy)
    monkeypatch.setattr(ngram_join, "TILE_DOCUMENTS", 4)
    monkeypatch.setattr(ngram_join, "DISTANCES", 1, raising=False)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").coalesce(1)
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.jaccard_components(docs, 5, 80).collect()}
    assert got == want
    assert kept["groups"][0].groupBy("group").count().agg({"count": "max"}).first()[0] >= 60  # they did form a group
    parts = {r["id"]: r["parts"] for r in kept["dealt"][-1].collect()}
    assert all(parts.get(i, 1) == 1 for i in range(60))
    assert max(parts[i] for i in range(100, 140)) > 2 and len(kept["set-links"]) > 1
