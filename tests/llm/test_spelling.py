import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hirelens.llm import spelling


def edits(a, b):
    """Whether two words are exactly one edit apart, by trying every edit of the longer one."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def by_hand(rows, slip=199, least=6, times=5, ratio=5):
    seen = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate({i: i + 32 for i in range(65, 91)})
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % slip == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            seen[run] += 1
    return of_counts({w: n for w, n in seen.items() if len(w) >= least and n >= times}, ratio)


def of_counts(words, ratio=5):
    near = {w: [v for v in words if edits(w, v)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= ratio * n else None
    out = []
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words.get(form[w])))
    return sorted(out, key=repr)


def rows_of(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted(map(tuple, df.collect()), key=repr)


def test_given_documents(some):
    words = spelling.word_counts(some, "doc_id", "text", slip=199)
    want = by_hand([(r["doc_id"], r["text"]) for r in some.collect()])
    assert rows_of(spelling.variants(words, cell=64, sample=500)) == want
    assert rows_of(spelling.variants(words)) == want and len(want) > 100


def test_odd_rows(spark, docs, rows, empty):
    got = spelling.variants(spelling.word_counts(docs, "doc_id", "text", min_count=1, slip=3))
    assert rows_of(got) == by_hand([(i, t) for i, t, _ in rows], slip=3, times=1)
    assert spelling.variants(spelling.word_counts(empty, "doc_id", "text")).count() == 0


def test_letters(spark):
    text = "ÀÉÎÕÜÿ x×y÷zzz Straße1Straße Ābcdefg ABCDEFGHIJ" + "q" * 70_000
    df = spark.createDataFrame([(1, text)] * 5, "id long, t string")
    got = {r["word"]: r["n"] for r in spelling.word_counts(df, "id", "t").collect()}
    assert got == {
        "ÀÉÎÕÜÿ": 5, "x×y÷zzz": 5, "straße": 10, "bcdefg": 5, "abcdefghij" + "q" * 70_000: 5
    }
    longer = [(text[-70_010:].lower() + "q", 5), *got.items()]
    words = spark.createDataFrame([(w, n) for w, n in longer], "word string, n long")
    assert {r["word"] for r in spelling.variants(words).filter("n_near = 1").collect()} == {w for w, _ in longer if len(w) > 9}


@pytest.mark.parametrize("cell, sample", [(4096, 10_000), (20, 10_000), (20, 40), (3, 5)])
def test_crowded_words(spark, cell, sample):
    """Anagrams cannot be parted by letter counts, so cells are split into blocks; chains have several steps."""
    rng = np.random.default_rng(3)
    words = {"abcabcabc": 5, "abcabcabd": 25, "abcabcad": 130, "abcabcade": 700, "zzzzzzzz": 9}
    while len(words) < 400:
        length = int(rng.integers(6, 10))
        words.setdefault("".join(rng.permutation(list("aabbcéaab"))[:length]), int(rng.integers(5, 200)))
    df = spark.createDataFrame(list(words.items()), "word string, n long").repartition(5)
    assert rows_of(spelling.variants(df, cell=cell, sample=sample)) == of_counts(words)


def test_tree_reaches_all_near_vectors():
    rng = np.random.default_rng(1)
    vectors = rng.integers(0, 4, (300, spelling.DIMENSIONS)).astype(np.int16)
    vectors[:, 4:] = 0
    tree = spelling.KdTree(vectors, 5)
    assert sorted(np.concatenate(tree.leaves)) == list(range(300))
    for up, down in ((1, 1), (1, 0), (0, 0)):
        met = {(int(q), int(m)) for leaf, rows in tree.reach(vectors, up, down) for q in rows for m in tree.leaves[leaf]}
        for q in range(300):
            apart = vectors - vectors[q]
            over, under = np.maximum(apart, 0).sum(1), np.maximum(-apart, 0).sum(1)
            assert {(q, int(m)) for m in np.flatnonzero((over <= up) & (under <= down))} <= met
    assert len(list(tree.reach(vectors, 0, 0))) == len(tree.leaves)
    assert sum(len(rows) for _, rows in tree.reach(vectors, 0, 0)) == 300
