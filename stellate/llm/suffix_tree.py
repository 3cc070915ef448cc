"""Suffix trees with constant-time longest common extensions.

Ukkonen's online construction over integer symbols, then an Euler tour that
visits children in the order of their symbols.  Between two successive leaves
the tour's least string depth is that of their lowest common ancestor, so a
sparse table of minima over these answers any pair of suffixes at once.
"""

from __future__ import annotations

import numpy as np


def _ukkonen(s: list[int]) -> tuple[dict[int, int], list[int], list[int]]:
    """Children by ``node << 32 | first symbol``, and start and end of the edge
    into each node (0 is the root).  The last symbol of ``s`` is nowhere else."""
    n = len(s)
    child: dict[int, int] = {}
    start, end, link = [0], [0], [0]
    node, edge, length, left = 0, 0, 0, 0
    for i, c in enumerate(s):
        left += 1
        fresh = 0  # the inner node that still lacks its suffix link
        while left:
            if not length:
                edge = i
            key = node << 32 | s[edge]
            to = child.get(key)
            if to is None:
                child[key] = len(start)
                start.append(i)
                end.append(n)
                link.append(0)
                if fresh:
                    link[fresh] = node
                    fresh = 0
            else:
                a = start[to]
                size = min(end[to], i + 1) - a
                if length >= size:
                    node, edge, length = to, edge + size, length - size
                    continue
                if s[a + length] == c:
                    length += 1
                    if fresh:
                        link[fresh] = node
                    break
                inner = len(start)
                start += (a, i)
                end += (a + length, n)
                link += (0, 0)
                child[key] = inner
                child[inner << 32 | c] = inner + 1
                start[to] = a + length
                child[inner << 32 | s[a + length]] = to
                if fresh:
                    link[fresh] = inner
                fresh = inner
            left -= 1
            if node:
                node = link[node]
            elif length:
                length -= 1
                edge = i - left + 1
    return child, start, end


class SuffixTree:
    """Of a sequence of symbols from 0 to 2**31-1 whose last one is nowhere else.

    ``rank``: the place of each suffix in lexicographic order."""

    def __init__(self, s: np.ndarray):
        n = len(s)
        child, start, end = _ukkonen(s.tolist())
        # children side by side, by parent and symbol
        key = np.fromiter(child.keys(), np.int64, len(child))
        order = np.argsort(key)
        node = np.fromiter(child.values(), np.int64, len(child))[order]
        parent = key[order] >> 32
        del child
        first = np.searchsorted(parent, np.arange(len(start) + 1)).tolist()
        children, size = node.tolist(), (np.array(end) - np.array(start)).tolist()
        leaf, low = [], []        # suffixes in the tour's order, least depth of the tour before each
        todo, least = [(0, 0)], 0
        todo_pop, todo_push = todo.pop, todo.append
        while todo:
            v, depth = todo_pop()
            if v < 0:             # back at an inner node of this depth
                if depth < least:
                    least = depth
                continue
            depth += size[v]
            a, b = first[v], first[v + 1]
            if a == b:
                leaf.append(n - depth)
                low.append(least)
                least = depth
                continue
            for j in range(b - 1, a - 1, -1):
                todo_push((children[j], depth))
                if j > a:
                    todo_push((-1, depth))
        suffix = np.array(leaf, np.int64)
        self.rank = np.empty(n, np.int64)
        self.rank[suffix] = np.arange(n)
        table = [np.array(low, np.int32)]
        while 2 << len(table) - 1 <= n:
            half, last = 1 << len(table) - 1, table[-1]
            table.append(np.minimum(last[:-half], last[half:]))
        self.table, self.n = table, n

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Lengths of the longest common prefixes of suffixes ``i`` and ``j`` (i != j)."""
        a, b = self.rank[i], self.rank[j]
        a, b = np.minimum(a, b) + 1, np.maximum(a, b) + 1
        level = np.frexp((b - a).astype(np.float64))[1] - 1
        out = np.zeros(len(a), np.int64)
        for k in np.unique(level).tolist():
            at = np.flatnonzero(level == k)
            out[at] = np.minimum(self.table[k][a[at]], self.table[k][b[at] - (1 << k)])
        return out
