import random

import numpy as np
import pytest
from hirelens.llm import substring_dedup


def by_hand(rows, window):
    first = {}
    for key, text in rows:
        words = (text or "").encode().split()
        if key is not None:
            for i in range(len(words) - window + 1):
                w = tuple(words[i : i + window])
                first[w] = min(key, first.get(w, key))
    out = []
    for key, text in rows:
        words = (text or "").encode().split()
        gone = set()
        if key is not None:
            for i in range(len(words) - window + 1):
                if first[tuple(words[i : i + window])] < key:
                    gone.update(range(i, i + window))
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone).decode()
        out.append((key, len(words), len(gone), kept))
    return sorted(out, key=repr)


def found(df, key="doc_id", window=50, seed=12):
    rows = substring_dedup.remove_repeats(df, key, "text", window, seed).collect()
    return sorted(((r[key], r["_n_words"], r["_n_removed"], r["_kept"]) for r in rows), key=repr)


@pytest.mark.parametrize("part", [2000, 2])
def test_odd_rows(docs, rows, part, monkeypatch):
    monkeypatch.setattr(substring_dedup, "PART", part)
    got = found(docs)
    assert got == by_hand([(i, t) for i, t, _ in rows], 50)
    assert any(n for _, _, n, _ in got)


@pytest.mark.parametrize("part", [2000, 1])
def test_few_words_many_repeats(spark, part, monkeypatch):
    """Texts over three words, with short windows: every way in which windows can overlap."""
    monkeypatch.setattr(substring_dedup, "PART", part)
    rng = random.Random(part)
    rows = [(rng.randrange(40), " ".join(rng.choice("abc") for _ in range(rng.randrange(30)))) for _ in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(df, window=7, seed=3) == by_hand(rows, 7)


def test_given_documents(some):
    assert found(some) == by_hand([(r["doc_id"], r["text"]) for r in some.collect()], 50)


def test_super_kmers_hold_every_window_once():
    rng = np.random.default_rng(2)
    for hashes in (rng.integers(0, 2**63, 500).astype(np.uint64), np.zeros(500, np.uint64)):
        low, first, n = substring_dedup.super_kmers(hashes, 50, 12)
        assert [i for f, k in zip(first, n) for i in range(f, f + k)] == list(range(451))
        assert n.max() <= 50


def test_smallest_in():
    values = np.random.default_rng(1).integers(0, 100, 60)
    for width in (1, 2, 3, 7, 39):
        want = [values[i : i + width].min() for i in range(60 - width + 1)]
        assert substring_dedup.smallest_in(values, width).tolist() == want


def test_empty(empty):
    assert substring_dedup.remove_repeats(empty, "doc_id", "text").count() == 0
