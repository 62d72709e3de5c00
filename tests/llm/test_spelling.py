"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lotwise.llm import spelling

WORDS = "word string, n long"


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute(counts, factor=2):
    out, forms = {}, {}
    for w, n in counts.items():
        near = [x for x in counts if one_edit(w, x)]
        best = min(near, key=lambda x: (-counts[x], x), default=None)
        forms[w] = best if best and counts[best] >= factor * n else None
        out[w] = (n, len(near), forms[w], counts[forms[w]] if forms[w] else None)
    for w in counts:
        root = w
        while forms[root]:
            root = forms[root]
        out[w] += (root,)
    return out


def result(df):
    return {r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in df.collect()}


def test_forms(spark):
    rng = random.Random(5)
    counts = {"".join(rng.choice("abé") for _ in range(rng.randint(1, 6))): rng.choice([1, 2, 2, 3, 5, 9, 40, 400]) for _ in range(400)}
    counts |= {"a" * k: 3**k for k in range(5, 16)}  # a chain of forms
    words = spark.createDataFrame(list(counts.items()), WORDS).repartition(7)
    assert result(spelling.spelling_forms(words)) == brute(counts)
    assert result(spelling.spelling_forms(words, factor=3)) == brute(counts, 3)
    with pytest.raises(ValueError, match="frequent"):
        spelling.spelling_forms(words, factor=1)


@settings(max_examples=200, deadline=None)
@given(st.sets(st.text(alphabet="abü", min_size=1, max_size=5), min_size=2, max_size=12))
def test_every_near_pair_once(words):
    groups = {}
    for w in words:
        for key, edit in spelling.rotations(w):
            groups.setdefault(key, []).append((edit, len(w)))
    found = Counter()
    for key, members in groups.items():
        assert len(members) == len({e for e, _ in members})
        for word, n_near, n, near in spelling.scan_group(key, members) if len(members) > 1 else []:
            assert one_edit(word, near) and n == len(near)
            found[word] += n_near
    assert found == Counter({w: n for w in words if (n := sum(one_edit(w, x) for x in words))})


def counted(rows, least_length=5, least_count=3):
    total = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            total[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 97 == 0 else run] += 1
    return {w: n for w, n in total.items() if len(w) >= least_length and n >= least_count}


def test_words(spark, odd, none, monkeypatch):
    rng = random.Random(1)
    texts = [" ".join(rng.choice(["ÀBCDE", "àbcde", "Straße", "ab-cdefgh", "naïve!", "o×y÷zab", "你naïve好", "word9word"]) for _ in range(50)) for _ in range(300)]
    rows = [*enumerate(texts), (None, "naïve naïve naïve"), (3, None), (4, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = counted(rows)
    assert {r["word"]: r["n"] for r in spelling.word_counts(docs).collect()} == want
    assert "straße" in want and any(len(w) == 4 for w in counted(rows, 4))
    assert result(spelling.spelling_variants(docs)) == brute(want)
    assert {r["word"]: r["n"] for r in spelling.word_counts(odd).collect()} == counted([(r["doc_id"], r["text"]) for r in odd.collect()])
    assert spelling.spelling_variants(none).collect() == [] == spelling.spelling_variants(docs.where("doc_id = 3")).where("n > 99999").collect()
