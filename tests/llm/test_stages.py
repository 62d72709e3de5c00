"""The pipeline's stages on rows with NULL and repeated ids, equal rows, and extra columns of any name."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lotwise.llm import exact_dedup, language_id

STAGES = dict(corpus_pipeline.STAGES)
LONG = "the quick brown fox jumps over the lazy dog and then it runs far away into the deep dark forest near the old mill"
#: Columns that operators work with, as columns of the documents.
EXTRA = [
    "row_key", "gone_id", "gone_key", "unique_id", "hash", "keep_id", "kept", "first_id", "norm", "other_id", "id", "component", "component_id",
    "size", "target", "source_size", "copies", "copy", "whole", "lang_pred", "score", "_letters", "_fit", "c0", "part", "place", "n",
]
ROWS = [
    (5, "a b c", "s1"), (3, "a  b c", "s1"), (5, "only here", "s2"), (5, "only here", "s2"), (None, "a b c", None), (None, "alone", None),
    (None, "alone", None), (7, None, "s1"), (8, "", None), (20, LONG, "s1"), (21, LONG + " today", "s1"), (20, "another text altogether", "s1"),
    (None, LONG + " yes", "s2"), (22, LONG.upper(), "s2"),
]


@pytest.fixture(scope="module")
def rows(spark, tmp_path_factory):
    schema = ", ".join(["doc_id long", "text string", "lang string", "source string", "n_chars long", *(f"`{c}` string" for c in EXTRA)])
    data = [(i, t, "en", s, k, *(f"{c}-{k}" for c in EXTRA)) for k, (i, t, s) in enumerate(ROWS)]
    path = str(tmp_path_factory.mktemp("rows") / "documents.parquet")
    spark.createDataFrame(data, schema).write.parquet(path)
    return spark.read.parquet(path)


def kept(df, rows):
    """Row numbers that a stage returns; every other column is as it was."""
    assert df.columns == rows.columns
    before = {r["n_chars"]: r for r in rows.collect()}
    after = df.collect()
    assert all(r == before[r["n_chars"]] for r in after)
    return Counter(r["n_chars"] for r in after)


def test_exact(spark, rows):
    found = kept(STAGES["exact dedup"](spark, rows, ""), rows)
    # Equal to (3, "a b c"): rows 0 and 4; rows 2 and 3 are one document; 5 and 6 have no id that is smaller.
    assert found == Counter([1, 2, 3, 5, 6, 7, 9, 10, 11, 12, 13])
    judged = exact_dedup.exact_dedup(rows, carry=["n_chars"]).where("kept")
    assert found == Counter(r["n_chars"] for r in judged.collect())
    assert kept(STAGES["exact dedup"](spark, rows.withColumn("_metadata", F.lit(1)), ""), rows.withColumn("_metadata", F.lit(1))) == found


def test_near(spark, rows):
    # 0 and 1 are one set of one shingle (id 3 is smaller); 3, 4 and 6 are equal rows without an id of their own.
    # 9, 10, 12 and 13 are near; 11 repeats the id of 9, with a text of its own.
    found = kept(STAGES["n-gram Jaccard join"](spark, rows, ""), rows)
    assert {k for k in found if k not in (2, 3, 5, 6, 9, 10)} == {1, 7, 8, 11}
    assert found[9] + found[10] == found[2] + found[3] == found[5] + found[6] == 1 and set(found.values()) == {1}


def test_mixing(spark, rows):
    found = kept(STAGES["mixing sources to target weights"](spark, rows, ""), rows)
    assert set(found.values()) <= {1, 2} and found[2] == found[3] and found[5] == found[6]
    words = {k: len((t or "").split()) for k, (_, t, _) in enumerate(ROWS)}
    assert sum(words[k] * n for k, n in found.items()) > sum(words.values())


def test_language(spark, rows):
    found = kept(STAGES["language ID"](spark, rows, ""), rows)
    assert set(found) == set(range(len(ROWS))) - {7, 8} and set(found.values()) == {1}
    assert kept(STAGES["language ID"](spark, rows.withColumn("lang", F.lit(None).cast("string")), ""), rows.withColumn("lang", F.lit(None).cast("string"))).total() == len(ROWS)


def test_packing(spark, rows):
    pieces = STAGES["best-fit packing"](spark, rows, "").collect()
    assert Counter(r["doc_id"] for r in pieces) == Counter(i for i, _, _ in ROWS)


def test_no_rows(spark, rows):
    for stage in STAGES.values():
        assert stage(spark, rows.where("false"), "").collect() == []


def test_too_many_languages(spark, monkeypatch):
    docs = spark.createDataFrame([(i, "some words", f"l{i}") for i in range(40)], "doc_id long, text string, lang string")
    monkeypatch.setattr(language_id, "MOST_BYTES", 1 << 20)
    with pytest.raises(ValueError, match="languages"):
        language_id.train(docs)
