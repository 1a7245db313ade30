import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hirelens.llm import bpe
from hirelens.llm.token_ids import vocabulary

RANKS = vocabulary(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("x", pat_str=PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})


def strange(n):
    rng = random.Random(4)
    pick = lambda: chr(rng.choice([rng.randrange(128), rng.randrange(0xA0, 0x3000), rng.randrange(0x10000, 0x11000), 97, 32]))
    return ["".join(pick() for _ in range(rng.randrange(60))) for _ in range(n)]


def test_like_the_library(library, some):
    texts = [r["text"] for r in some.collect()] + strange(1500)
    texts += [None, "", "a" * 5000, "aaaaaaa aaaa", "  \n\n x", "I'll 's 12345 <|endoftext|>"]
    got = bpe.merges(RANKS).encode(texts, PATTERN)
    assert all(g.tolist() == library.encode_ordinary(t or "") for g, t in zip(got, texts))


def test_irregular_ranks():
    """Merges that make a pair of lower rank: still the leftmost pair of lowest rank first."""
    rng = random.Random(9)
    for _ in range(60):
        tokens = {bytes(rng.choice(b"abc") for _ in range(rng.randrange(2, 6))) for _ in range(25)}
        order = [bytes([b]) for b in range(256)] + rng.sample(sorted(tokens), len(tokens))
        table = bpe.Merges({t: i for i, t in enumerate(order)})
        words = list({bytes(rng.choice(b"abc") for _ in range(rng.randrange(1, 14))) for _ in range(80)})
        flat, sizes = table.replay(words)
        assert [x.tolist() for x in np.split(flat, np.cumsum(sizes)[:-1])] == [table.alone(w) for w in words]


def test_round_trip(docs, rows, library):
    got = {(r[0], r[1], r[2], r[3]) for r in bpe.round_trip(docs, "doc_id", "text", RANKS, PATTERN).collect()}
    want = set()
    for i, t, _ in rows:
        ids = library.encode_ordinary(t or "")
        sha = [hashlib.sha256(x).hexdigest() for x in (",".join(map(str, ids)).encode(), (t or "").encode())]
        want.add((i, len(ids), *sha))
    assert got == want


def test_encode_then_decode(docs, rows):
    decoded = bpe.decode(bpe.encode(docs, "doc_id", "text", RANKS, PATTERN), "doc_id", "ids", RANKS)
    key = lambda x: (x[0] or 0, x[1])
    assert sorted(((r[0], bytes(r[1])) for r in decoded.collect()), key=key) == sorted(
        ((i, (t or "").encode()) for i, t, _ in rows), key=key
    )


def test_small_table_changes_nothing(library, monkeypatch):
    table = bpe.Merges(bpe.read_ranks(RANKS))
    table.table.limit = 50
    for texts in (strange(100), strange(200)):
        assert [x.tolist() for x in table.encode(texts, PATTERN)] == [library.encode_ordinary(t) for t in texts]


def test_empty(empty):
    assert bpe.round_trip(empty, "doc_id", "text", RANKS, PATTERN).count() == 0
