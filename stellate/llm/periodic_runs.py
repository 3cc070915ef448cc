"""Periodic runs of words by longest common extensions of suffix trees.

A maximal run of period q holds, at its root's least rotation, the longest
Lyndon word that starts there in the order of the words' numbers or in the
reverse order.  These are found from the next smaller and the next greater
suffix of every place; each is a candidate root, which is extended to the
right by the suffix tree of the document and to the left by that of its
reversal.

A run of at least four periods and six words repeats each of its sequences of
three words at least three times.  Words that no such sequence covers are in
no run; each stretch of them stands in the trees as one symbol of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stellate.llm.common import NOT_SPACE, distinct, joined_texts, text_groups, words
from stellate.llm.suffix_tree import SuffixTree

LEAST_WORDS = 6
LEAST_PERIODS = 4
RUNS = "runs array<struct<start: bigint, length: bigint, period: bigint>>"


def _next(rank: list[int], greater: bool) -> np.ndarray:
    """The next place of a smaller (greater) rank, the end if there is none."""
    n = len(rank)
    out, waiting = [n] * n, []
    if greater:
        rank = [-r for r in rank]
    for i, r in enumerate(rank):
        while waiting and rank[waiting[-1]] > r:
            out[waiting.pop()] = i
        waiting.append(i)
    return np.array(out, np.int64)


def maximal_runs(s: np.ndarray, least_words: int = LEAST_WORDS, least_periods: int = LEAST_PERIODS) -> np.ndarray:
    """Rows ``start, length, period`` of the maximal runs of a sequence whose
    first and last symbols are nowhere else in it, by start, then period.
    At least two periods, and at least ``least_periods`` and ``least_words``."""
    n = len(s)
    tree, reverse = SuffixTree(s), SuffixTree(s[::-1])
    rank = tree.rank.tolist()
    at = np.arange(n)
    i = np.concatenate([at, at])
    j = np.concatenate([_next(rank, False), _next(rank, True)])
    keep = j < n
    i, j = i[keep], j[keep]
    period = j - i
    right = tree.common(i, j)
    # a run's first root starts in its first period and has all but two periods to its right
    least_periods = max(2, least_periods)
    keep = right > (least_periods - 2) * period
    i, j, period, right = i[keep], j[keep], period[keep], right[keep]
    # the reversal's suffix at n - i reads backwards from the place before i
    begin, stop = i - reverse.common(n - i, n - j), j + right
    keep = (stop - begin >= least_words) & (stop - begin >= least_periods * period)
    found = np.unique(np.stack([begin[keep], stop[keep], period[keep]], axis=1), axis=0)
    # a root found as a multiple of itself has the same stretch: its smallest period counts
    first = np.r_[True, (np.diff(found[:, :2], axis=0) != 0).any(axis=1)] if len(found) else np.zeros(0, bool)
    found = found[first]
    found = found[np.lexsort((found[:, 2], found[:, 0]))]
    return np.stack([found[:, 0], found[:, 1] - found[:, 0], found[:, 2]], axis=1)


def _repeated(code: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Words that are covered by a sequence of three words which its document
    holds three times (by hash: a collision keeps words that could go)."""
    out = np.zeros(len(code), bool)
    if len(code) < 3:
        return out
    c = code.astype(np.uint64)
    h = (c[:-2] * np.uint64(0x9E3779B97F4A7C15)) ^ (c[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(0x165667B19E3779F9))
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (c[2:] * np.uint64(0x94D049BB133111EB))) * np.uint64(0x9E3779B97F4A7C15)
    h ^= (h >> np.uint64(32)) ^ (doc[2:].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    place = np.flatnonzero(doc[:-2] == doc[2:])
    order = place[np.argsort(h[place], kind="stable")]
    if not len(order):
        return out
    first = np.flatnonzero(np.r_[True, np.diff(h[order]) != 0])
    often = order[np.repeat(np.diff(np.r_[first, len(order)]) >= 3, np.diff(np.r_[first, len(order)]))]
    for k in range(3):
        out[often + k] = True
    return out


def document_runs(code: np.ndarray, kept: np.ndarray, least_words: int, least_periods: int) -> np.ndarray:
    """Runs of one document; words that are not ``kept`` are in none."""
    if not kept.any():
        return np.zeros((0, 3), np.int64)
    # the kept words, each stretch of others (and both ends) as one symbol of its own
    where = np.flatnonzero(kept)
    breaks = np.flatnonzero(np.diff(where) > 1) + 1  # a gap before these kept words
    at = np.arange(len(where)) + 1 + np.searchsorted(breaks, np.arange(len(where)), side="right")
    n = len(where) + len(breaks) + 2
    _, small = np.unique(code[where], return_inverse=True)
    s = np.full(n, -1, np.int64)
    s[at] = small
    own = np.flatnonzero(s < 0)
    s[own] = small.max() + 1 + np.arange(len(own))
    runs = maximal_runs(s, least_words, least_periods)
    back = np.zeros(n, np.int64)
    back[at] = where
    runs[:, 0] = back[runs[:, 0]]
    return runs


def _run_rows(parts, rewrite, least_words: int, least_periods: int) -> Iterator[pa.RecordBatch]:
    for b in parts:
        ids, texts = b.column("doc_id"), b.column("text")
        for first, last in text_groups(texts):
            data, docs = joined_texts(texts, b"", first, last)
            packed, starts, before = words(data, docs, NOT_SPACE)
            code, values = distinct(packed, starts)
            code = code.copy()
            group_ids = ids.slice(first, last - first).to_pylist()
            changed = set()
            if rewrite is not None:
                for d, doc_id in enumerate(group_ids):
                    own = slice(before[d], before[d + 1])
                    new = rewrite(code[own], doc_id)
                    if new is not None:
                        code[own] = new
                        changed.add(d)
            kept = _repeated(code, np.repeat(np.arange(len(group_ids)), np.diff(before)))
            # whole texts, a space after each word
            n = len(starts) - 1
            line = np.full(len(packed) + n, 0x20, np.uint8)
            line[np.arange(len(packed)) + np.repeat(np.arange(n), np.diff(starts))] = packed
            raw, ends = memoryview(line.tobytes()), (starts[before] + before).tolist()
            out_runs, texts_left = [], []
            for d in range(len(group_ids)):
                own = code[before[d]:before[d + 1]]
                runs = document_runs(own, kept[before[d]:before[d + 1]], least_words, least_periods)
                if len(runs) or d in changed:
                    edge = np.zeros(len(own) + 1, np.int64)
                    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
                    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
                    text = b" ".join([values[c] for c in own[np.cumsum(edge[:-1]) == 0].tolist()])
                else:
                    text = raw[ends[d]:max(ends[d], ends[d + 1] - 1)]
                texts_left.append(text)
                out_runs.append(runs)
            size = np.array([len(r) for r in out_runs])
            flat = np.concatenate(out_runs)
            lists = pa.ListArray.from_arrays(
                pa.array(np.r_[0, np.cumsum(size)].astype(np.int32)),
                pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(flat[:, k])) for k in range(3)], ["start", "length", "period"]))
            yield pa.RecordBatch.from_arrays(
                [ids.slice(first, last - first), pa.array(np.diff(before).astype(np.int64)), lists,
                 pa.array(texts_left, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "runs", "collapsed"])


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_words: int = LEAST_WORDS,
                  least_periods: int = LEAST_PERIODS, rewrite=None) -> DataFrame:
    """One row per document: ``doc_id, n_words, runs, collapsed``.

    Words are maximal runs without ASCII white space, numbered from 0.
    ``runs`` are the maximal stretches with a smallest period of words,
    ``start, length, period``, by start, then period, that have at least
    ``least_words`` (6 or more) words and ``least_periods`` (4 or more)
    periods.  ``collapsed`` holds the words that are in no run after its
    first period, joined by one space.  ``rewrite(codes, doc_id)`` may
    give other words of the same document (numbers, equal for equal words) in
    place of its words, or None to leave them.

    Null and empty texts have no words and no runs; repeated rows and null ids
    are returned as they are; an empty table gives no rows; other columns are
    ignored.
    """
    if least_words < 6 or least_periods < 4:
        raise ValueError("runs of fewer than 6 words or 4 periods are not looked for")
    src = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(lambda parts: _run_rows(parts, rewrite, least_words, least_periods),
                          f"doc_id bigint, n_words bigint, {RUNS}, collapsed string")
