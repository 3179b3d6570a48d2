"""Token ids of words met lately, in flat arrays: a batch looks up each distinct word once and gathers ids by offsets.

The store saves time only. It is bounded (once it holds ``limit`` words, those not
met again since they came go between batches), and every text is still encoded whole.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa


def strings(array: pa.Array) -> list[str]:
    """The array's values as Python strings (made in one go, not one scalar at a time)."""
    return array.to_numpy(zero_copy_only=False).tolist()


def gather(flat: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs ``flat[start:start + size]`` one behind the other, and where each one ends."""
    ends = np.cumsum(size, dtype=np.int64)
    total = int(ends[-1]) if len(ends) else 0
    kind = np.int32 if max(total, len(flat)) < 1 << 30 else np.int64
    return flat[np.repeat((start - ends + size).astype(kind), size) + np.arange(total, dtype=kind)], ends


class WordStore:
    """Word -> ids. ``learn`` is given new, distinct words and yields ``(words, their ids in turn, ids per word)``."""

    def __init__(self, learn: Callable[[list[str]], Iterable[tuple[list[str], np.ndarray, np.ndarray]]], kind: str,
                 limit: int = 400_000):
        self.learn, self.kind, self.limit = learn, kind, limit
        self._clear()

    def _clear(self) -> None:
        self.index: dict[str, int] = {}
        self.flat, self.used = np.empty(1 << 20, self.kind), 0
        self.size, self.start = np.empty(1 << 18, np.int32), np.empty(1 << 18, np.int64)
        self.again = np.zeros(1 << 18, bool)

    def turn(self) -> None:
        """Between batches: if the store is full, keep the words met again, at most half of ``limit`` of them."""
        n = len(self.index)
        if n <= self.limit:
            return
        kept = np.flatnonzero(self.again[:n])[-(self.limit // 2):] if self.limit > 1 else np.empty(0, np.int64)
        words = list(self.index)  # in the order of their numbers
        words = [words[k] for k in kept.tolist()]
        size, (ids, _) = self.size[kept], self.runs(kept)
        self._clear()
        self._add(words, ids, size)

    def _add(self, words: list[str], ids: np.ndarray, size: np.ndarray) -> None:
        n, new = len(self.index), len(words)
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.empty_like(self.flat)])
        while n + new > len(self.size):
            self.size, self.start, self.again = (np.concatenate([x, np.zeros_like(x)]) for x in (self.size, self.start, self.again))
        self.flat[self.used:self.used + len(ids)] = ids
        self.size[n:n + new], self.start[n:n + new] = size, self.used + np.cumsum(size) - size
        self.used += len(ids)
        self.index.update(zip(words, range(n, n + new)))

    def find(self, words: list[str]) -> np.ndarray:
        """Numbers of the words in the store; new ones are learned first."""
        get = self.index.get
        at = np.fromiter((get(w, -1) for w in words), np.int64, len(words))
        self.again[at[at >= 0]] = True
        missing = np.flatnonzero(at < 0).tolist()
        if missing:
            for group in self.learn(list(dict.fromkeys([words[k] for k in missing]))):
                self._add(*group)
            known = self.index
            at[missing] = [known[words[k]] for k in missing]
        return at

    def runs(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words with these numbers one behind the other, and where each word's ids end."""
        return gather(self.flat, self.start[numbers], self.size[numbers])
