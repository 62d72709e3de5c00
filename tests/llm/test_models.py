"""The models' numbers: URL features by hand, held-out URLs, and a text's posterior by enumerating segmentations."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lotwise.llm import language_id, url_filter


def test_url_grams(spark):
    row = spark.createDataFrame([("ab", "")], "host string, path string").select(url_filter._grams(F.col("host"), "h"), url_filter._grams(F.col("path"), "p")).first()
    assert Counter(row[0]) == Counter(["h^ab", "hab$", "h^ab$"]) and row[1] == []
    text = "www.a"
    ended = f"^{text}$"
    want = Counter("p" + ended[i : i + n] for n in (3, 4, 5) for i in range(len(ended) - n + 1))
    got = spark.createDataFrame([(text,)], "t string").select(url_filter._grams(F.col("t"), "p")).first()[0]
    assert Counter(got) == want


def test_url_features_are_hashed_sets(spark):
    rows = spark.createDataFrame([("aaaa.org", "/x"), ("aaaa.org", "/x"), ("", "")], "host string, path string")
    vectors = [r["features"] for r in url_filter._features(rows).collect()]
    grams = {m + e[i : i + n] for m, e in (("h", "^aaaa.org$"), ("p", "^/x$")) for n in (3, 4, 5) for i in range(max(len(e) - n + 1, 0))}
    assert vectors[0] == vectors[1] and vectors[0].size == url_filter.WIDTH and set(vectors[0].values) == {1.0}
    assert len(grams) - 3 <= len(vectors[0].indices) <= len(grams) and vectors[2].numNonzeros() == 0  # a bucket may hold two


def test_urls_held_out(spark):
    """Fitted on half of the URLs that a rule decides, the model alone finds the other half's verdicts."""
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").select("page_id", "url")
    host, path = url_filter.host_and_path(F.col("url"))
    verdict = url_filter.longest_rule(F.col("host"), F.col("path"))[1]
    known = pages.select("page_id", "url", host.alias("host"), path.alias("path")).withColumn("verdict", verdict).where("verdict is not null")
    half = F.pmod(F.xxhash64("host"), F.lit(2))
    labelled = known.where(half == 0).select("host", "path", "verdict").distinct()
    truth = known.where(half == 1).select("page_id", F.col("verdict").alias("truth"))
    judged = url_filter.judge_urls(known.where(half == 1).select("page_id", "url"), rules=(), labelled=labelled).join(truth, "page_id")
    counts = judged.agg(F.count(F.lit(1)), F.avg((F.col("verdict") == F.col("truth")).cast("double")), F.count_distinct("truth")).first()
    commonest = truth.groupBy("truth").count().agg(F.max("count")).first()[0] / counts[0]
    assert counts[2] == 2 and counts[1] >= 0.9 and counts[1] > commonest


def segmentations(word, pieces):
    if not word:
        yield 1.0
    for piece, p in pieces.items():
        if word.startswith(piece):
            for rest in segmentations(word[len(piece) :], pieces):
                yield p * rest


def test_posterior_by_enumeration(spark):
    names = ["▁", "▁a", "a", "b", "ab", "▁ab", "ba"]
    table = np.array([[0.1, 0.2], [0.2, 0.05], [0.15, 0.1], [0.25, 0.3], [0.05, 0.15], [0.15, 0.1], [0.1, 0.1]])
    texts = ["ab", "a b", "abab ba ab", "b b b", "aab, abba. Ab", None, "12"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in language_id.predict(docs, ["x", "y"], names, table).collect()}
    for k, text in enumerate(texts[:5]):
        words = [w.strip(".,").lower() for w in text.split()]
        logs = [sum(math.log(sum(segmentations("▁" + w, dict(zip(names, table[:, j]))))) for w in words) for j in (0, 1)]
        best = int(logs[1] > logs[0])
        assert got[k]["lang_pred"] == "xy"[best]
        assert got[k]["score"] == pytest.approx(1 / (1 + math.exp(logs[1 - best] - logs[best])), rel=1e-9)
    assert [(got[k]["lang_pred"], got[k]["score"]) for k in (5, 6)] == [("und", 0.0)] * 2
