"""Token ids of words that are met again and again, kept as flat numpy arrays.

A memo, not a limit: once it holds ``most`` words it starts afresh.  Results
don't depend on it.  A worker outlives its task, so what a table holds is
missing in later stages until it is cleared.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import repeat

import numpy as np


class WordTable:
    """``encode`` gives (the ids of all words in a row, how many each word has)."""

    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], most: int = 800_000):
        self.encode, self.most = encode, most
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.flat = np.zeros(1 << 16, dtype=np.int32)
        self.start = np.zeros(1 << 12, dtype=np.int64)      # a word's ids end where the next one's start
        self.n = self.used = 0

    def _add(self, words: list[str]) -> None:
        ids, sizes = self.encode(words)
        n, used = self.n + len(words), self.used + len(ids)
        if used > len(self.flat):
            self.flat = np.concatenate((self.flat, np.zeros(max(used, len(self.flat)), dtype=np.int32)))
        if n >= len(self.start):
            self.start = np.concatenate((self.start, np.zeros(max(n + 1, len(self.start)), dtype=np.int64)))
        self.flat[self.used:used] = ids
        self.start[self.n + 1:n + 1] = self.used + np.cumsum(sizes)
        self.index.update(zip(words, range(self.n, n)))
        self.n, self.used = n, used

    def ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(the ids of all words in a row, how many each word has)."""
        at = np.fromiter(map(self.index.get, words, repeat(-1)), dtype=np.int64, count=len(words))
        missing = np.flatnonzero(at < 0)
        if len(missing):
            if self.n > self.most or self.used > 8 * self.most:
                self.clear()
                missing = np.arange(len(words))
            absent = [words[i] for i in missing.tolist()]
            self._add(list(dict.fromkeys(absent)))
            at[missing] = np.fromiter(map(self.index.__getitem__, absent), dtype=np.int64, count=len(absent))
        start = self.start[at]
        size = self.start[at + 1] - start
        lead = np.cumsum(size) - size
        return self.flat[np.repeat(start - lead, size) + np.arange(int(size.sum()))], size
