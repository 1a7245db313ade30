import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hirelens.llm import packing
from hirelens.llm.token_ids import vocabulary
from tokenizers import Tokenizer

WORDS = vocabulary(public_tokenizers.path("word_bpe_49k.json"))


def best_fit_one_by_one(lengths, limit):
    """Best fit decreasing, a piece at a time: remaining capacities of the bins."""
    bins = []
    for length in sorted(lengths, reverse=True):
        fitting = [b for b in range(len(bins)) if bins[b] >= length]
        if fitting:
            bins[min(fitting, key=lambda b: bins[b])] -= length
        else:
            bins.append(limit - length)
    return sorted(bins)


@pytest.mark.parametrize("limit", [10, 64, 2048])
def test_runs_are_best_fit_decreasing(limit):
    rng = random.Random(limit)
    for n in (1, 5, 60, 400):
        lengths = [min(limit, 1 + int(rng.expovariate(3 / limit))) for _ in range(n)]
        used = Counter()
        counts = Counter(lengths)
        for run in packing.best_fit(dict(counts), limit):
            for i in range(run.items):
                assert run.offset + i % run.per_bin * run.length == used[run.bin + i // run.per_bin] or run.per_bin > 1
                used[run.bin + i // run.per_bin] += run.length
            counts[run.length] -= run.items
        assert not any(counts.values())
        assert sorted(limit - u for u in used.values()) == best_fit_one_by_one(lengths, limit)


def test_runs_do_not_grow_with_the_counts():
    rng = random.Random(1)
    few = {n: rng.randrange(1, 50) for n in range(1, 2049)}
    assert len(packing.best_fit({n: c * 10**6 for n, c in few.items()})) < 30_000


def whole(rows):
    library = Tokenizer.from_str(WORDS)
    return [(i, library.encode(t or "", add_special_tokens=False).ids + [0]) for i, t in rows]


def check(found, rows, limit):
    want = Counter()
    for i, ids in whole(rows):
        for p, at in enumerate(range(0, len(ids), limit)):
            cut = np.array(ids[at : at + limit], "<u4")
            want[i, p, at, len(cut), zlib.crc32(cut.tobytes())] += 1
    assert Counter((r[0], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in found) == want
    sequences = {}
    for r in found:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for placed in sequences.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= limit
    lengths = [r["length"] for r in found]
    assert len(sequences) == len(best_fit_one_by_one(lengths, limit))


def test_odd_rows(docs, rows):
    check(packing.pack(docs, "doc_id", "text", WORDS, 64).collect(), [(i, t) for i, t, _ in rows], 64)


def test_given_documents(some):
    rows = [(r["doc_id"], r["text"]) for r in some.collect()]
    check(packing.pack(some, "doc_id", "text", WORDS).collect(), rows, 2048)


def test_empty(empty):
    assert packing.pack(empty, "doc_id", "text", WORDS).count() == 0
