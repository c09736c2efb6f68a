"""Ids of words that a task has met before, as one flat array."""

from __future__ import annotations

from collections.abc import Callable
from itertools import repeat

import numpy as np


class Remembered:
    """Up to ``most`` words and their ids; ``make`` gives the ids of new words and their counts."""

    def __init__(self, make: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], most: int) -> None:
        self.make, self.most = make, most
        self.forget()

    def forget(self) -> None:
        self.places: dict[str, int] = {}
        self.flat = np.zeros(0, np.uint32)
        self.starts = np.zeros(1, np.int64)

    def _learn(self, new: list[str]) -> None:
        ids, counts = self.make(new)
        self.places.update(zip(new, range(len(self.places), len(self.places) + len(new))))
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(counts)])
        self.flat = np.concatenate([self.flat, ids.astype(np.uint32)])

    def look_up(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words end to end, and the first id of each word (one more than words)."""
        at = np.fromiter(map(self.places.get, words, repeat(-1)), np.int64, len(words))
        missing = np.flatnonzero(at < 0).tolist()
        if missing:
            new = list(dict.fromkeys([words[i] for i in missing]))
            if len(self.places) + len(new) > self.most:
                self.forget()
                new, missing = list(dict.fromkeys(words)), list(range(len(words)))
            self._learn(new)
            at[missing] = list(map(self.places.__getitem__, [words[i] for i in missing]))
        starts = self.starts[at]
        counts = self.starts[at + 1] - starts
        firsts = np.append(0, np.cumsum(counts))
        return self.flat[np.arange(firsts[-1]) + np.repeat(starts - firsts[:-1], counts)], firsts
