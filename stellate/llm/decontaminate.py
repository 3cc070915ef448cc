"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Patterns are the windows of the benchmark items, as sequences of word
numbers; patterns of one length are searched together.  A shift table keyed by
a hash of two neighbouring words (a block) tells how far the search may jump:
a block that ends no closer than ``s`` words before the end of any pattern
allows a jump of ``s``.  Where the jump is zero, the block's bucket names the
patterns that end so, and these are compared word by word.

All texts of a batch are searched side by side: they are cut into stretches
of possible end places, each with a cursor of its own, and every round moves
all cursors.  Nothing is ever skipped but what the shift table excludes.

The benchmark is a stated set; its tables are built from blocks of items of
a bounded size, each broadcast by itself, so its size is never a limit.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stellate.llm.common import distinct, joined_texts, stage, text_groups, words

#: lower-cases A-Z
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32
#: digits, lower-case letters and every byte of a character outside ASCII
IN_WORD = np.zeros(256, bool)
IN_WORD[ord("0"):ord("9") + 1] = IN_WORD[ord("a"):ord("z") + 1] = IN_WORD[0x80:] = True
STRETCH = 512          # end places of one cursor
BLOCK_BYTES = 32 << 20  # text of benchmark items whose tables are broadcast at once


def split_words(texts: pa.Array, first: int = 0, last: int | None = None) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """Numbers of the words, their values, and words before each text."""
    data, docs = joined_texts(texts, b"", first, last)
    packed, starts, before = words(LOWER[data], docs, IN_WORD)
    codes, values = distinct(packed, starts)
    return codes, values, before


class WuManber:
    """Search tables for distinct patterns (rows of word numbers > 0) of one length."""

    def __init__(self, patterns: np.ndarray):
        self.patterns = patterns
        self.m = m = patterns.shape[1]
        self.block = min(2, m)
        self.bits = max(10, int(len(patterns) * m).bit_length() + 2)
        most = m - self.block + 1
        self.shift = np.full(1 << self.bits, most, np.int32)
        for end in range(self.block - 1, m):
            np.minimum.at(self.shift, self._key(patterns[:, end - self.block + 1], patterns[:, end]), m - 1 - end)
        suffix = self._key(patterns[:, m - self.block], patterns[:, m - 1])
        self.in_bucket = np.argsort(suffix, kind="stable")
        self.bucket = np.searchsorted(suffix[self.in_bucket], np.arange((1 << self.bits) + 1))

    def _key(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        x = a.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + b.astype(np.uint64)
        return ((x * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First places and pattern numbers of all occurrences.  Word number 0 is in no pattern."""
        m, none = self.m, np.zeros(0, np.int64)
        if len(text) < m:
            return none, none
        at = np.arange(m - 1, len(text), STRETCH)
        to = np.minimum(at + STRETCH, len(text))
        places, found = [], []
        while len(at):
            jump = self.shift[self._key(text[at - self.block + 1], text[at])]
            stop = at[jump == 0]
            if len(stop):
                key = self._key(text[stop - self.block + 1], text[stop])
                size = self.bucket[key + 1] - self.bucket[key]
                end = np.repeat(stop, size)
                nth = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
                pattern = self.in_bucket[np.repeat(self.bucket[key], size) + nth]
                for k in range(m):  # word by word, among those still equal
                    same = text[end - m + 1 + k] == self.patterns[pattern, k]
                    end, pattern = end[same], pattern[same]
                places.append(end - m + 1)
                found.append(pattern)
            at = at + np.maximum(jump, 1)
            live = at < to
            at, to = at[live], to[live]
        return (np.concatenate(places), np.concatenate(found)) if places else (none, none)


class Benchmark:
    """Search tables of a bounded block of benchmark items."""

    def __init__(self, items: list[tuple], window: int):
        codes, values, before = split_words(pa.array([t for _, t in items], pa.string()))
        self.numbers = {v: i + 1 for i, v in enumerate(values)}
        self.names = np.array([str(i) for i, _ in items], object)
        rows: dict[int, list] = {}
        for item in range(len(items)):
            ids = codes[before[item]:before[item + 1]].astype(np.int64) + 1
            m = min(window, len(ids))
            if m:
                sliding = np.lib.stride_tricks.sliding_window_view(ids, m)
                rows.setdefault(m, []).append((sliding, np.full(len(sliding), item)))
        self.tables = []
        for m, parts in sorted(rows.items()):
            patterns, of = np.unique(np.concatenate([p for p, _ in parts]), axis=0, return_inverse=True)
            owners = np.unique(np.stack([of.ravel(), np.concatenate([i for _, i in parts])], axis=1), axis=0)
            self.tables.append((WuManber(patterns), owners[:, 1], np.searchsorted(owners[:, 0], np.arange(len(patterns) + 1))))

    def search(self, texts: pa.Array, first: int, last: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Words of each text; the places (word numbers of the group) inside
        an occurrence with the words before each text; (text, item) pairs."""
        codes, values, before = split_words(texts, first, last)
        known = np.fromiter((self.numbers.get(v, 0) for v in values), np.int64, len(values))
        size = np.diff(before)
        # a stop word between texts, so no window spans two
        text = np.zeros(len(codes) + len(size), np.int64)
        doc = np.repeat(np.arange(len(size)), size)
        text[np.arange(len(codes)) + doc] = known[codes] if len(values) else 0
        edge = np.zeros(len(text) + 1, np.int64)
        pairs = [np.zeros((0, 2), np.int64)]
        doc_of = np.repeat(np.arange(len(size)), size + 1)
        for table, owners, begin in self.tables:
            place, pattern = table.find(text)
            np.add.at(edge, place, 1)
            np.add.at(edge, place + table.m, -1)
            hits = np.unique(np.stack([doc_of[place], pattern], axis=1), axis=0)
            n = begin[hits[:, 1] + 1] - begin[hits[:, 1]]
            nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            pairs.append(np.stack([np.repeat(hits[:, 0], n), owners[np.repeat(begin[hits[:, 1]], n) + nth]], axis=1))
        hit = np.flatnonzero((np.cumsum(edge[:-1]) > 0)[np.arange(len(codes)) + doc])
        return size, hit, before, np.unique(np.concatenate(pairs), axis=0)


def _found(parts, benchmark: Benchmark, keys: list[str]) -> Iterator[pa.RecordBatch]:
    """Per text its keys, words, the places that are hit, and the items."""
    for b in parts:
        texts = b.column("text")
        for first, last in text_groups(texts):
            size, hit, before, pairs = benchmark.search(texts, first, last)
            n = last - first
            upto = np.searchsorted(hit, before)
            places = pa.ListArray.from_arrays(pa.array(upto.astype(np.int32)),
                                              pa.array((hit - np.repeat(before[:-1], np.diff(upto))).astype(np.int32)))
            items = pa.ListArray.from_arrays(
                pa.array(np.searchsorted(pairs[:, 0], np.arange(n + 1)).astype(np.int32)),
                pa.array(benchmark.names[pairs[:, 1]].tolist(), pa.string()))
            yield pa.RecordBatch.from_arrays(
                [*(b.column(k).slice(first, n) for k in keys), pa.array(size.astype(np.int64)), places, items],
                [*keys, "n_words", "places", "items"])


def _blocks(items: DataFrame, block_bytes: int) -> int:
    """Blocks of about ``block_bytes`` of text."""
    total = items.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint") + 16)).first()[0] or 0
    return max(1, -(-total // block_bytes))


def find_contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       item_col: str = "item_id", item_text_col: str = "text", window: int = 10,
                       block_bytes: int = BLOCK_BYTES, key_col: str | None = None) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_hit, n_items, items_sha256,
    contaminated``, and the found ``items`` (sorted as strings), and ``key`` if
    there is a ``key_col`` (binary, returned as it is).

    A-Z is lower-cased; words are runs of digits, letters a-z and characters
    outside ASCII.  A benchmark item's windows are its runs of ``window``
    words, or all its words if it has fewer; an item without words has none.
    A document word inside any occurrence is hit.  Null and empty texts have
    no words; rows of one id and text are one finding, returned once per row;
    a null item id counts as the text ``null``; empty tables give no rows or
    no hits; other columns are ignored.
    """
    src = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                      *([F.col(key_col).alias("key")] if key_col else []))
    extra = ["key"] if key_col else []
    items = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("null")).alias("item"),
                             F.col(item_text_col).cast("string").alias("text"))
    sc = docs.sparkSession.sparkContext
    n = _blocks(items, block_bytes)

    def search(block: int, source: DataFrame, keys: dict) -> DataFrame:
        chosen = items if n == 1 else items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == block)
        tables, names = sc.broadcast(Benchmark([tuple(r) for r in chosen.collect()], window)), list(keys)
        return source.mapInArrow(lambda parts: _found(parts, tables.value, names),
                                 ", ".join(f"{k} {t}" for k, t in keys.items())
                                 + ", n_words bigint, places array<int>, items array<string>")

    if n == 1:
        merged = search(0, src, {"doc_id": "bigint"} | dict.fromkeys(extra, "binary"))
    else:
        # the blocks' findings of a text meet by its id and digest; the first block keeps every text
        keyed = src.withColumn("text_key", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256))
        found = [search(i, keyed, {"doc_id": "bigint", "text_key": "string"}).filter((F.size("places") > 0) | F.lit(i == 0))
                 for i in range(n)]
        joined = reduce(DataFrame.unionByName, [stage(f, "contamination") for f in found]).groupBy("doc_id", "text_key").agg(
            F.max("n_words").alias("n_words"), F.array_distinct(F.flatten(F.collect_list("places"))).alias("places"),
            F.flatten(F.collect_list("items")).alias("items"))
        left, right = keyed.select("doc_id", "text_key", *extra).alias("l"), joined.alias("r")
        merged = left.join(right, F.expr("l.doc_id <=> r.doc_id AND l.text_key = r.text_key")).select(
            "l.doc_id", "r.n_words", "r.places", "r.items", *[f"l.{c}" for c in extra])
    named = merged.withColumn("items", F.array_sort(F.array_distinct("items")))
    return named.select("doc_id", "n_words", F.size("places").cast("bigint").alias("n_hit"),
                        F.size("items").cast("bigint").alias("n_items"),
                        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
                        (F.size("places") > 0).alias("contaminated"), "items", *extra)


def _clean_rows(parts, benchmark: Benchmark) -> Iterator[pa.RecordBatch]:
    for b in parts:
        texts = b.column("text")
        for first, last in text_groups(texts):
            _, hit, before, _ = benchmark.search(texts, first, last)
            clean = np.diff(np.searchsorted(hit, before)) == 0
            yield pa.RecordBatch.from_arrays([b.column("row").slice(first, last - first).filter(pa.array(clean))], ["row"])


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                      item_text_col: str = "text", window: int = 10, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs``, with all their columns, that ``find_contamination``
    doesn't call contaminated.  Each block of items reads the rows that the
    one before left; a row is judged where it is read, nothing is exchanged."""
    items = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("null")).alias("item"),
                             F.col(item_text_col).cast("string").alias("text"))
    n, names = _blocks(items, block_bytes), docs.columns
    for block in range(n):
        chosen = items if n == 1 else items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == block)
        tables = docs.sparkSession.sparkContext.broadcast(Benchmark([tuple(r) for r in chosen.collect()], window))
        packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col(text_col).cast("string").alias("text"))
        docs = packed.mapInArrow(lambda parts, t=tables: _clean_rows(parts, t.value),
                                 f"row {packed.schema['row'].dataType.simpleString()}").select("row.*")
    return docs
