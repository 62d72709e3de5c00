"""Passages that documents share: crowded anchors against brute force, and what a document costs."""

import random
from collections import Counter

import numpy as np
import pytest

from lotwise.llm import base, passages, suffix_array, suffix_automaton

CASES = {"bytes": (suffix_array, "n_bytes", 50, bytes), "words": (suffix_automaton, "n_words", 13, bytes.split)}


def brute(rows, cut, length):
    seen, out = set(), {}
    for doc_id, text in sorted(rows):
        units = cut(text.encode())
        gone, own = np.zeros(len(units), bool), set()
        for k in range(len(units) - length + 1):
            window = tuple(units[k : k + length])
            if window in seen:
                gone[k : k + length] = True
            own.add(window)
        seen |= own
        out[doc_id] = (len(units), int(gone.sum()))
    return out


def around_a_passage(n, words=25, seed=1, whole=False):
    """Texts that differ but for one passage (and, if not ``whole``, parts of it and a periodic one)."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefgh", k=rng.randint(2, 7)))
    passage = [word() for _ in range(40)]
    rows = []
    for i in range(n):
        own = [word() for _ in range(words)]
        a, b = (0, 40) if whole or i % 3 else sorted(rng.sample(range(41), 2))
        rows.append((i, " ".join([*own[: words // 2], *passage[a:b], *own[words // 2 :], *(["ab"] * (0 if whole else i % 30))])))
    return rows


@pytest.mark.parametrize("case", sorted(CASES))
@pytest.mark.parametrize("crowd", [2, 5, 64])
def test_crowded_anchors(spark, monkeypatch, case, crowd):
    module, size, length, cut = CASES[case]
    monkeypatch.setattr(passages, "CROWD", crowd)
    rows = around_a_passage(150)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(9)
    got = {r["doc_id"]: (r[size], r["n_removed"]) for r in module.remove_repeats(docs).collect()}
    assert got == brute(rows, cut, length)


@pytest.mark.parametrize("case", sorted(CASES))
def test_crowded_or_not(docs, monkeypatch, case):
    module = CASES[case][0]
    plain = sorted(map(str, module.remove_repeats(docs).collect()))
    monkeypatch.setattr(passages, "CROWD", 2)
    assert sorted(map(str, module.remove_repeats(docs).collect())) == plain


@pytest.mark.parametrize("case", sorted(CASES))
def test_cost_of_a_document(spark, monkeypatch, case):
    """Twice the documents around a passage are twice the rows, at every stage."""
    counts = Counter()

    def keep(df, name):
        kept = base.keep(df, name)
        counts[name] += kept.count()
        return kept

    monkeypatch.setattr(passages, "keep", keep)
    monkeypatch.setattr(passages, "CROWD", 64)
    found = []
    for n in (500, 1000, 2000):
        counts.clear()
        docs = spark.createDataFrame(around_a_passage(n, whole=True), "doc_id long, text string").repartition(4)
        CASES[case][0].remove_repeats(docs).count()
        found.append({k: v / n for k, v in counts.items()})
    for name, per in found[0].items():
        if per > 0.2:
            assert found[1][name] == pytest.approx(per, rel=0.15) and found[2][name] == pytest.approx(found[1][name], rel=0.1), name


def test_grams_fit():
    with pytest.raises(ValueError, match="gram"):
        passages.Units(13, 14, True)
