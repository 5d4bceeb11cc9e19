"""Bounded per-process tables of word values, filled on first use of a word."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np


class WordTable(dict):
    """Maps a word to a row of ``values``; a missing word is computed by ``describe``.

    ``describe(word)`` returns one float per column. ``trim`` empties the table
    once it holds ``bound`` words, so memory stays bounded (by ``bound`` words
    plus the distinct words of one document) whatever the vocabulary.
    """

    def __init__(self, describe: Callable[[str], tuple], columns: int, bound: int = 200_000):
        super().__init__()
        self.describe, self.bound = describe, bound
        self.values = np.zeros((1024, columns))

    def __missing__(self, word: str) -> int:
        row = len(self)
        if row == len(self.values):
            self.values = np.concatenate([self.values, np.zeros_like(self.values)])
        self.values[row] = self.describe(word)
        self[word] = row
        return row

    def trim(self) -> None:
        if len(self) > self.bound:
            self.clear()

    def rows(self, words) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))


class RecentValues(dict):
    """Maps a word to ``compute(word)``; keeps the words used lately.

    ``trim`` moves the words to the older generation once there are ``bound``;
    a word found there is taken back without computing it again. At most twice
    ``bound`` words (plus those of one document) are held.
    """

    def __init__(self, compute: Callable[[str], int], bound: int = 200_000):
        super().__init__()
        self.compute, self.bound, self.older = compute, bound, {}

    def __missing__(self, word: str) -> int:
        value = self.older.get(word)
        if value is None:
            value = self.compute(word)
        self[word] = value
        return value

    def trim(self) -> None:
        if len(self) > self.bound:
            self.older = dict(self)
            self.clear()
