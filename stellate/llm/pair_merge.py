"""Rank-synchronous pair merging over ragged symbol arrays.

Many short sequences lie side by side in one flat array.  In each round every
sequence applies its lowest-ordered pair at all of its places at once (left to
right where places overlap); a sequence without a pair is done.
"""

from __future__ import annotations

import numpy as np

NONE = np.int64(2**62)


class PairMerger:
    """Pairs ``left, right`` of symbols below ``n_symbols`` that merge into
    ``result``, lowest ``order`` first.  Of pairs that share an order but not a
    result only the leftmost place of a sequence merges in a round."""

    def __init__(self, left: np.ndarray, right: np.ndarray, order: np.ndarray, result: np.ndarray, n_symbols: int):
        key = left.astype(np.int64) * n_symbols + right
        by = np.argsort(key)
        self.n, self.keys = n_symbols, key[by]
        order, self.result = order[by].astype(np.int64), result[by].astype(np.int32)
        self.order = np.append(order, NONE)  # of pair -1
        _, first, level = np.unique(order, return_index=True, return_inverse=True)
        differs = self.result != self.result[first][level]
        self.tied = (np.bincount(level, differs) > 0)[level]

    def pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The pair at each place, -1 where the two don't merge (negative symbols never do)."""
        key = left.astype(np.int64) * self.n + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (left >= 0) & (right >= 0), at, -1)

    def survivors(self, symbol: np.ndarray, seq: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols left of each sequence, in order, and their sequences.  seq ascends."""
        symbol = symbol.copy()
        pair = np.full(len(symbol), -1, np.int64)
        if len(symbol) > 1:
            pair[:-1] = np.where(seq[1:] == seq[:-1], self.pairs(symbol[:-1], symbol[1:]), -1)
        done_symbols, done_seqs = [], []
        while len(symbol):
            first = np.flatnonzero(np.r_[True, seq[1:] != seq[:-1]])
            size = np.diff(np.r_[first, len(seq)])
            grade = self.order[pair]
            best = np.minimum.reduceat(grade, first)
            done = best == NONE
            if done.any():
                leave = np.repeat(done, size)
                done_symbols.append(symbol[leave])
                done_seqs.append(seq[leave])
                symbol, seq, pair, grade = symbol[~leave], seq[~leave], pair[~leave], grade[~leave]
                best, size = best[~done], size[~done]
                if not len(symbol):
                    break
            hit = np.flatnonzero(grade == np.repeat(best, size))
            again = np.r_[False, seq[hit[1:]] == seq[hit[:-1]]] & self.tied[pair[hit]]
            hit = hit[~again]
            # overlapping places a-a-a: take every other one of a run, from its left end
            start = np.r_[True, np.diff(hit) != 1]
            place = np.arange(len(hit))
            hit = hit[(place - place[start][np.cumsum(start) - 1]) % 2 == 0]
            symbol[hit] = self.result[pair[hit]]
            keep = np.ones(len(symbol), bool)
            keep[hit + 1] = False
            merged = hit - np.arange(len(hit))  # places of the merged symbols afterwards
            symbol, seq, pair = symbol[keep], seq[keep], pair[keep]
            for left in (merged, merged[merged > 0] - 1):
                inner = left[left < len(symbol) - 1]
                pair[inner] = np.where(seq[inner] == seq[inner + 1], self.pairs(symbol[inner], symbol[inner + 1]), -1)
                pair[left[left == len(symbol) - 1]] = -1
        if not done_symbols:
            return symbol, seq
        symbol, seq = np.concatenate(done_symbols), np.concatenate(done_seqs)
        by = np.argsort(seq, kind="stable")
        return symbol[by], seq[by]
