"""An FM-index over integer symbols: backward search on wavelet-matrix ranks."""

from __future__ import annotations

import numpy as np


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Start positions in suffix order, by prefix doubling."""
    n = len(symbols)
    _, rank = np.unique(symbols, return_inverse=True)
    rank, step = rank.astype(np.int64) + 1, 1
    while True:
        key = rank * (n + 1)
        key[: n - step] += rank[step:]
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        fresh = np.ones(n, np.int64)
        fresh[1:] = ordered[1:] != ordered[:-1]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(fresh)
        step *= 2
        if rank[order[-1]] == n or step >= n:
            return order


class FMIndex:
    """Index of a sequence of symbols (1 and above; 0 is the end mark added here)."""

    def __init__(self, symbols: np.ndarray, sample: int = 8) -> None:
        text = np.append(symbols, 0).astype(np.int64)
        order = suffix_array(text)
        turned = text[order - 1]  # the symbol before each suffix
        self.levels = max(1, int(turned.max()).bit_length())
        counts = np.bincount(text, minlength=1 << self.levels)
        self.below = np.concatenate([[0], np.cumsum(counts)])  # symbols smaller than c
        self.size, self.ones, self.zeros = len(text), [], []
        for level in reversed(range(self.levels)):
            bits = (turned >> level) & 1
            ones = np.concatenate([[0], np.cumsum(bits)]).astype(np.int32)
            self.ones.append(ones)
            self.zeros.append(len(text) - int(ones[-1]))
            turned = np.concatenate([turned[bits == 0], turned[bits == 1]])
        marked = order % sample == 0
        self.marks = np.concatenate([[0], np.cumsum(marked)])
        self.samples = order[marked]

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often c stands before row i of the transformed text."""
        low = np.zeros_like(i)
        for at, level in enumerate(reversed(range(self.levels))):
            ones, one = self.ones[at], ((c >> level) & 1).astype(bool)
            low = np.where(one, self.zeros[at] + ones[low], low - ones[low])
            i = np.where(one, self.zeros[at] + ones[i], i - ones[i])
        return i - low

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row intervals [low, high) of phrases, one per line, ended by zeros."""
        lengths = (phrases > 0).sum(axis=1)
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.size, np.int64)
        for back in range(1, phrases.shape[1] + 1):
            live = np.flatnonzero((lengths >= back) & (low < high))
            c = phrases[live, lengths[live] - back]
            known = c < (1 << self.levels)
            low[live[~known]] = high[live[~known]]
            live, c = live[known], c[known]
            low[live] = self.below[c] + self.rank(c, low[live])
            high[live] = self.below[c] + self.rank(c, high[live])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows: steps back to the next sampled suffix."""
        out, todo, steps, rows = np.empty(len(rows), np.int64), np.arange(len(rows)), 0, rows.copy()
        while len(todo):
            at = rows[todo]
            hit = self.marks[at + 1] > self.marks[at]
            out[todo[hit]] = self.samples[self.marks[at[hit]]] + steps
            todo, at = todo[~hit], at[~hit]
            i, low, c = at, np.zeros_like(at), np.zeros_like(at)
            for k in range(self.levels):
                ones = self.ones[k]
                one = ones[i + 1] > ones[i]
                low = np.where(one, self.zeros[k] + ones[low], low - ones[low])
                i = np.where(one, self.zeros[k] + ones[i], i - ones[i])
                c = 2 * c + one
            rows[todo] = self.below[c] + i - low
            steps += 1
        return out
