"""Byte-level BPE: encoding by merge replay over the words of a corpus block, and decoding.

The words (matches of the splitting pattern) of a block of texts are laid out once as one row of byte
symbols, each word once however often it occurs. An inverted index goes from the rank of a token
pair to the places where the pair stands. Merges are applied in rank order, each at all its places
at once, and only the pairs with the two neighbours are looked up again and posted. A block is what
a task holds in memory; words it has met before are remembered up to a bound, so the corpus of a
worker is replayed once, not once per block. No word crosses the network.

Where a merge makes a pair that comes before it in rank order, which regular rank files never do,
the word is encoded alone, pair by pair, so that the result is always that of the plain definition:
merge the leftmost pair of lowest rank until there is none.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelens.llm.common import blocks
from hirelens.llm.word_table import WordTable

NONE = np.int32(2**31 - 1)  # rank of a pair that is no token
SHIFT = 21  # ranks are below 2^21
KNOWN = 600_000  # words a worker remembers
LETTER = r"[\p{L}\p{N}]"
_tables: dict[str, "Merges"] = {}


def merges(content: str) -> "Merges":
    """The merge table of this worker for a rank file (its text, as the driver read it)."""
    if content not in _tables:
        _tables.clear()
        _tables[content] = Merges(read_ranks(content))
    return _tables[content]


def read_ranks(content: str) -> dict[bytes, int]:
    """Token -> rank from lines of base64 and rank."""
    return {base64.b64decode(a): int(b) for a, b in map(str.split, content.splitlines())}


@cache
def later_letters() -> dict[int, str]:
    """Characters that ``regex`` knows as letters or numbers and ``tiktoken``, which follows an
    earlier Unicode version, does not; each with a symbol to stand for it while a text is split."""
    import tiktoken

    known = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    single = {bytes([b]): b for b in range(256)}
    probe = tiktoken.Encoding("probe", pat_str=LETTER, mergeable_ranks=single, special_tokens={})
    theirs = set(bytes(probe.encode_ordinary(known)).decode())
    return {ord(c): "\u2592" for c in regex.findall(LETTER, known) if c not in theirs}


def split_words(text: str | None, split: regex.Pattern) -> list[str]:
    """Matches of the pattern, as ``tiktoken`` would find them."""
    if not text:
        return []
    try:
        text.encode("latin-1")  # the common case, told fast: no later letter in it
    except UnicodeEncodeError:
        if not later_letters().keys().isdisjoint(map(ord, set(text))):
            alike = text.translate(later_letters())
            return [text[m.start() : m.end()] for m in split.finditer(alike)]
    return split.findall(text)


class Merges:
    """Ranks, and every pair of tokens that together are a token."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        if max(ranks.values(), default=0) >= 1 << SHIFT:
            raise ValueError("ranks are too large")
        self.bytes = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.bytes[rank] = token
        pairs = sorted(
            (ranks[token[:cut]] << SHIFT | ranks[token[cut:]], rank)
            for token, rank in ranks.items()
            for cut in range(1, len(token))
            if token[:cut] in ranks and token[cut:] in ranks
        )
        self.keys = np.array([k for k, _ in pairs] + [2**62], np.int64)
        self.values = np.array([v for _, v in pairs] + [NONE], np.int32)
        self.single = np.array([ranks.get(bytes([b]), -1) for b in range(256)], np.int32)
        if (self.single < 0).any():
            raise ValueError("a byte has no rank")
        self.table = WordTable(self.learn, KNOWN)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) << SHIFT | right
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.values[at], NONE)

    def alone(self, word: bytes) -> list[int]:
        """One word by the plain definition."""
        parts = [bytes([b]) for b in word]
        while len(parts) > 1:
            ranked = [self.ranks.get(a + b, NONE) for a, b in zip(parts, parts[1:])]
            best = min(ranked)
            if best == NONE:
                break
            at = ranked.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids))

    def replay(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct, non-empty words in a row, and how many each has."""
        lengths = np.array([len(w) for w in words])
        stops = np.cumsum(lengths)
        token = self.single[np.frombuffer(b"".join(words), np.uint8)]
        size = len(token)
        word = np.repeat(np.arange(len(words)), lengths)
        after = np.arange(1, size + 1)
        after[stops - 1] = size  # size stands for "no symbol"
        before = np.arange(-1, size)
        before[stops - lengths] = size
        before[size] = size
        rank = np.full(size + 1, NONE, np.int32)
        live = np.ones(size, bool)
        irregular: set[int] = set()
        index: dict[int, list[np.ndarray]] = {}
        queue: list[int] = []

        def post(places: np.ndarray, at_least: int) -> None:
            """Look up the pairs that begin at these places and post them in the index."""
            ranks = self.pair_ranks(token[places], token[after[places]])
            rank[places] = ranks
            real = ranks != NONE
            places, ranks = places[real], ranks[real]
            early = ranks < at_least
            if early.any():
                irregular.update(word[places[early]].tolist())
            order = np.argsort(ranks, kind="stable")
            places, ranks = places[order], ranks[order]
            cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
            for r, part in zip(ranks[np.append(0, cuts)].tolist() if len(ranks) else (), np.split(places, cuts)):
                if r in index:
                    index[r].append(part)
                else:
                    index[r] = [part]
                    heapq.heappush(queue, r)

        post(np.flatnonzero(after[:size] < size), 0)
        flag = np.zeros(size + 1, bool)
        while queue:
            r = heapq.heappop(queue)
            posted = index.pop(r)
            at = posted[0] if len(posted) == 1 else np.unique(np.concatenate(posted))
            at = at[(rank[at] == r) & live[at]]
            if not len(at):
                continue
            right = after[at]
            flag[at] = True
            if flag[right].any():  # like "aaa": of places in a chain every second one merges
                joined = np.append(False, right[:-1] == at[1:])
                heads = np.maximum.accumulate(np.where(joined, 0, np.arange(len(at))))
                flag[at] = False
                at = at[(np.arange(len(at)) - heads) % 2 == 0]
                flag[at] = True
                right = after[at]
            beyond = after[right]
            close = flag[beyond]  # merges right behind one another: the first may pair with what is still apart
            if close.any():
                alike = np.full(close.sum(), r, np.int32)
                early = self.pair_ranks(alike, token[beyond[close]]) < r
                irregular.update(word[at[close][early]].tolist())
            flag[at] = False
            token[at] = r
            live[right] = False
            rank[right] = NONE
            after[at] = beyond
            before[beyond] = at
            before[size] = size
            rank[at] = NONE
            left = before[at]
            touched = np.concatenate((at[beyond < size], left[left < size]))
            if len(touched):
                post(np.unique(touched), r)
        counts = np.bincount(word[live], minlength=len(words))
        ids = token[live]
        if irregular:
            found = np.split(ids, np.cumsum(counts)[:-1])
            for w in irregular:
                found[w] = np.array(self.alone(words[w]), np.int32)
            ids, counts = np.concatenate(found), np.array([len(f) for f in found])
        return ids, counts

    def learn(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct words: whole tokens as they are, the others by replay."""
        encoded = words.cast(pa.binary()).to_pylist()
        ranks = [self.ranks.get(w) for w in encoded]
        rest = [w for w, r in zip(encoded, ranks) if r is None]
        sizes = np.ones(len(words), np.int64)
        missing = np.array([r is None for r in ranks])
        if not rest:
            return np.array(ranks, np.uint32), sizes
        ids, counts = self.replay(rest)
        sizes[missing] = counts
        flat = np.empty(sizes.sum(), np.uint32)
        replayed = np.repeat(missing, sizes)
        flat[replayed] = ids
        flat[~replayed] = [r for r in ranks if r is not None]
        return flat, sizes

    def encode(self, texts: list[str | None], pattern: str) -> list[np.ndarray]:
        """Ids of each text; null is empty."""
        split = regex.compile(pattern)
        held, counts = [], []
        for text in texts:
            found = [w for w in split_words(text, split) if w]
            counts.append(len(found))
            held.append(pa.array(found, pa.string()))
        numbers = self.table.numbers(pa.concat_arrays(held))
        ends = np.cumsum(counts).tolist()
        found = [self.table.ids(numbers[end - n : end]) for n, end in zip(counts, ends)]
        self.table.shrink()
        return found


def packed(ids: np.ndarray) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    return ids.astype("<u4").tobytes()


def decimal_sha256(ids: list[int]) -> str:
    """SHA-256 of the ids in decimal, joined by commas."""
    return hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


def encode(df: DataFrame, key: str, text: str, content: str, pattern: str) -> DataFrame:
    """``key, ids`` of every row: ids as little-endian unsigned 32-bit integers, none for null or empty texts."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            found = merges(content).encode(block.column("text").to_pylist(), pattern)
            ids = pa.array(map(packed, found), pa.binary())
            yield from block.select(["key"]).append_column("ids", ids).to_batches()

    kind = df.schema[key].dataType.simpleString()
    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"key {kind}, ids binary").withColumnRenamed("key", key)


def decode(df: DataFrame, key: str, ids: str, content: str) -> DataFrame:
    """``key, decoded`` of encoded rows: the bytes that the ids stand for, none for null."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "ids"):
            found = [
                merges(content).decode(np.frombuffer(value or b"", "<u4").tolist())
                for value in block.column("ids").to_pylist()
            ]
            column = pa.array(found, pa.binary())
            yield from block.select(["key"]).append_column("decoded", column).to_batches()

    kind = df.schema[key].dataType.simpleString()
    rows = df.select(F.col(key).alias("key"), F.col(ids).alias("ids"))
    return rows.mapInArrow(run, f"key {kind}, decoded binary").withColumnRenamed("key", key)


def round_trip(df: DataFrame, key: str, text: str, content: str, pattern: str) -> DataFrame:
    """``key, n_tokens, ids_sha256, decoded_sha256``: encode, decode the ids, and digest both.

    Both steps in one worker: two Python stages in a row would keep two workers per core. A null
    text is an empty one; repeated rows and null keys come back as they are.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            table, counts, ids, decoded = merges(content), [], [], []
            for found in table.encode(block.column("text").to_pylist(), pattern):
                numbers = found.tolist()
                counts.append(len(numbers))
                ids.append(decimal_sha256(numbers))
                decoded.append(hashlib.sha256(table.decode(numbers)).hexdigest())
            out = block.select(["key"]).append_column("n_tokens", pa.array(counts, pa.int64()))
            out = out.append_column("ids_sha256", pa.array(ids, pa.string()))
            yield from out.append_column("decoded_sha256", pa.array(decoded, pa.string())).to_batches()

    kind = df.schema[key].dataType.simpleString()
    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    schema = f"key {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return rows.mapInArrow(run, schema).withColumnRenamed("key", key)
