"""Importance resampling against brute force; the radix sort against Python's sort."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest

from lotwise.llm import importance


def features(text, longest):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
    return len(words), [" ".join(words[i : i + k]) for k in range(1, longest + 1) for i in range(len(words) - k + 1)]


def brute(docs, target, longest=1, buckets=10_000, least_words=20, percent=10):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s = Counter(bucket(f) for _, text in docs for f in features(text, longest)[1])
    t = Counter(bucket(f) for text in target for f in features(text, longest)[1])
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (s.total() + buckets) / ((s[b] + 1) * (t.total() + buckets))))
    out, asked = [], []
    for doc_id, text in docs:
        n, found = features(text, longest)
        weight = sum(gain(bucket(f)) for f in found)
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))
        out.append([doc_id, len(found), weight, score, None])
        if n >= least_words:
            asked.append(out[-1])
    asked.sort(key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for k, r in enumerate(asked[: percent * len(asked) // 100]):
        r[4] = k + 1
    return sorted((tuple(r) for r in out), key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("longest", [1, 3])
def test_resample(spark, longest):
    rng = random.Random(2)
    words = ["Äpfel", "apple", "PEAR", "x_y", "a-1", "9", "你好"] + [f"w{i}" for i in range(60)]
    docs = [(i, " ".join(rng.choices(words, k=rng.choice([0, 5, 19, 20, 21, 60])))) for i in range(500)]
    docs += [(None, docs[3][1]), (None, " ".join(words)), (700, None), (-5, " ".join(words * 900))]
    target = [" ".join(rng.choices(words[:12], k=40)) for _ in range(30)] + [None]
    frame = spark.createDataFrame([(*d, 1, 2) for d in docs], "doc_id long, text string, weight int, place int").repartition(5)
    wanted = spark.createDataFrame([(t,) for t in target], "text string")
    found = importance.importance_resample(frame, wanted, longest, buckets=97, block_rows=64, digit_bits=5)
    assert got(found) == brute(docs, target, longest, 97)


def test_odd(spark, odd, none):
    docs = [(r["doc_id"], r["text"]) for r in odd.collect()]
    target = spark.createDataFrame([("one two w1",)], "text string")
    assert got(importance.importance_resample(odd, target, least_words=0, percent=50)) == brute(docs, ["one two w1"], least_words=0, percent=50)
    assert importance.importance_resample(none, target).collect() == []
    assert importance.importance_resample(odd, none).count() == len(docs)


@pytest.mark.parametrize("case", ["wide", "narrow", "equal"])
def test_radix_sort(spark, case):
    rng = random.Random(3)
    choose = {
        "wide": lambda: rng.choice([-(2**63), 2**63 - 1, 0, -1, None, rng.randint(-(2**62), 2**62)]),
        "narrow": lambda: rng.choice([-3, 0, 4, 4, 4, None]),
        "equal": lambda: 7,
    }[case]
    rows = [(choose(), rng.choice([1, 2, None]), i) for i in range(700)]
    frame = spark.createDataFrame(rows, "a long, b long, place long").repartition(3)
    frame = frame.selectExpr("a", "b", "place as was", "place")
    sorted_rows = importance.radix_sort(frame, ["a", "b"], block_rows=100, digit_bits=11).collect()
    assert sorted(r["place"] for r in sorted_rows) == list(range(700))
    order = [(r["a"], r["b"], r["was"]) for r in sorted(sorted_rows, key=lambda r: r["place"])]
    assert order == sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is None, r[1] or 0, r[2]))
