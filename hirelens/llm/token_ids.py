"""Token ids of whole texts by a vocabulary file of the ``tokenizers`` library.

Its pieces never cross white space, so a text's ids are those of its chunks between white space, one
after the other, and a worker asks the library for chunks it has not met. A chunk of Latin letters,
digits and marks falls into pieces that the library treats alone; new pieces go to the library many
at a time, and its marks for the end of a word tell them apart again. Texts in which any of this
could differ (marks of special tokens, control characters on which the library does not split) go
to the library whole.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from hirelens.llm.word_table import WordTable

WHOLE = ("<|", "\x1c", "\x1d", "\x1e", "\x1f")
NOT_PLAIN = r"'|[^\x{00}-\x{ff}]"
PIECE = r"(\pL+|\pN|[^\s\pL\pN]+)"
END = "</w>"  # fixed value: how the vocabulary marks the last token of a word
CHUNKS, PIECES = 500_000, 300_000  # what a worker remembers
BLOCK_BYTES = 8_000_000
_encoders: dict[str, "Encoder"] = {}


def vocabulary(path: str) -> str:
    """The vocabulary file as text (a few MB); tasks get it with their code, not from their disk."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def encoder(content: str) -> "Encoder":
    """The encoder of this worker for a vocabulary."""
    if content not in _encoders:
        _encoders.clear()
        _encoders[content] = Encoder(content)
    return _encoders[content]


class Encoder:
    def __init__(self, content: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(content)
        size = self.library.get_vocab_size(with_added_tokens=True)
        self.ends = np.array([(self.library.id_to_token(i) or "").endswith(END) for i in range(size)])
        self.chunks = WordTable(self.learn_chunks, CHUNKS)
        self.pieces = WordTable(self.learn_pieces, PIECES)

    def ask(self, texts: list[str]) -> list[np.ndarray]:
        found = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, np.uint32) for e in found]

    def learn_pieces(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        flat, sizes = [np.empty(0, np.uint32)], [np.empty(0, np.int64)]
        for start in range(0, len(pieces), 2000):
            part = pieces[start : start + 2000].to_pylist()
            ids = self.ask([" ".join(part)])[0]
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) == len(part):
                sizes.append(np.diff(stops, prepend=0))
            else:  # not told apart: one by one
                found = self.ask(part)
                ids = np.concatenate(found)
                sizes.append(np.array([len(f) for f in found]))
            flat.append(ids)
        return np.concatenate(flat), np.concatenate(sizes)

    def learn_chunks(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        odd = pc.match_substring_regex(chunks, NOT_PLAIN).to_numpy(zero_copy_only=False)
        spaced = pc.replace_substring_regex(
            pc.utf8_lower(chunks.filter(pa.array(~odd))), PIECE, r"\1 "
        )
        split = pc.split_pattern(pc.utf8_rtrim(spaced, " "), " ")
        numbers = self.pieces.numbers(split.flatten())
        per_chunk = pc.list_value_length(split).to_numpy()
        plain_ids = self.pieces.ids(numbers)
        ends = np.append(0, np.cumsum(self.pieces.sizes[numbers]))
        plain_sizes = np.diff(ends[np.cumsum(per_chunk)], prepend=0)
        self.pieces.shrink()
        asked = self.ask(chunks.filter(pa.array(odd)).to_pylist())
        sizes = np.empty(len(chunks), np.int64)
        sizes[~odd], sizes[odd] = plain_sizes, [len(a) for a in asked]
        flat = np.empty(sizes.sum(), np.uint32)
        from_odd = np.repeat(odd, sizes)
        flat[~from_odd] = plain_ids
        if asked:
            flat[from_odd] = np.concatenate(asked)
        return flat, sizes

    def encode(self, texts: pa.ChunkedArray | list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers; null is empty."""
        if isinstance(texts, list):
            texts = pa.chunked_array([pa.array(texts, pa.string())])
        texts = pc.fill_null(texts, "").combine_chunks()
        whole = np.zeros(len(texts), bool)
        for mark in WHOLE:
            whole |= pc.match_substring(texts, mark).to_numpy(zero_copy_only=False)
        usual = texts.filter(pa.array(~whole)) if whole.any() else texts
        split = pc.utf8_split_whitespace(usual)
        counts = np.zeros(len(texts), np.int64)
        counts[~whole] = pc.list_value_length(split).to_numpy()
        numbers = self.chunks.numbers(split.flatten())
        ends = np.cumsum(counts)
        out = []
        for row, (start, end) in enumerate(zip((ends - counts).tolist(), ends.tolist())):
            if whole[row]:
                ids = self.ask([texts[row].as_py()])[0]
            else:
                ids = self.chunks.ids(numbers[start:end])
            out.append(ids.astype("<u4").tobytes())
        self.chunks.shrink()
        return out
