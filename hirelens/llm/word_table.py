"""Token ids of repeated words, worked out once: a bounded table that each worker keeps."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


class WordTable:
    """Ids of texts that are sequences of words, given the ids of distinct words.

    ``learn`` takes distinct words and returns the ids of all of them in a row, and how many each
    has. Words are looked up outside Python. The table changes nothing in the result, only how often
    a word is worked out; beyond ``limit`` words the more frequent half stays.
    """

    def __init__(self, learn: Callable[[pa.Array], tuple[np.ndarray, np.ndarray]], limit: int):
        self.learn, self.limit = learn, limit
        self.clear()

    def clear(self) -> None:
        self.words = pa.array([], pa.string())
        self.flat = np.empty(0, np.uint32)
        self.starts = np.empty(0, np.int64)
        self.sizes = np.empty(0, np.int64)
        self.uses = np.empty(0, np.int64)

    def add(self, words: pa.Array, flat: np.ndarray, sizes: np.ndarray) -> None:
        starts = len(self.flat) + np.cumsum(sizes) - sizes
        self.words = pa.concat_arrays([self.words, words])
        self.flat = np.concatenate([self.flat, flat.astype(np.uint32)])
        self.starts = np.concatenate([self.starts, starts])
        self.sizes = np.concatenate([self.sizes, sizes.astype(np.int64)])
        self.uses = np.concatenate([self.uses, np.zeros(len(sizes), np.int64)])

    def numbers(self, words: pa.Array) -> np.ndarray:
        """The number of each word; new ones are learned. Numbers hold until ``shrink``."""
        found = pc.index_in(words, value_set=self.words)
        numbers = pc.fill_null(found, -1).to_numpy()
        if found.null_count:
            unknown = words.filter(pc.is_null(found)).dictionary_encode()
            numbers = numbers.copy()
            numbers[numbers < 0] = len(self.words) + unknown.indices.to_numpy()
            self.add(unknown.dictionary, *self.learn(unknown.dictionary))
        self.uses += np.bincount(numbers, minlength=len(self.uses))
        return numbers

    def ids(self, numbers: np.ndarray) -> np.ndarray:
        """Ids of a row of known words."""
        sizes = self.sizes[numbers]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        return self.flat[np.repeat(self.starts[numbers] - ends + sizes, sizes) + np.arange(total)]

    def shrink(self) -> None:
        """Forget the rarer words once there are too many; to be called between blocks."""
        if len(self.words) <= self.limit:
            return
        kept = np.sort(np.argpartition(-self.uses, self.limit // 2)[: self.limit // 2])
        words, flat, sizes = self.words.take(pa.array(kept)), self.ids(kept), self.sizes[kept]
        uses = self.uses[kept] // 2
        self.clear()
        self.add(words, flat, sizes)
        self.uses = uses
