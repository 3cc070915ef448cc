"""Ranked lexical search over hashed max-sketches.

Every document becomes a row of an index: the number of its terms, a sketch,
and its occurrences of the items' terms.  The sketch hashes all terms of the
document to a fixed number of coordinates; each keeps the greatest occurrence
count there, and since an impact grows with the count, that is the greatest
impact as well.

A batch of documents is looked up for all items at once: a matrix of sketch
impacts times a matrix of the items' weights by coordinate gives a bound that
no exact score exceeds.  Each item's documents are then scored exactly in the
order of falling bounds, until the next bound is below its threshold.

Two passes read the index.  The first finds a few high scores of every task;
the k-th highest of an item over all tasks is its threshold from the start of
the second, so that a task hands on only what can still be among the k best.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stellate.llm.common import Memo, distinct, joined_texts, ragged_starts, stage, text_groups, words

WIDTH = 4096              # coordinates of a sketch
SCALE = 1_000_000_000
SEEDS = 8                 # scores per item that each task of the first pass hands on
BLOCK_TERMS = 1 << 20     # (item, term) pairs of the items searched at once
BOUNDS_AT_ONCE = 1 << 21  # bounds held at once: documents x items
PAIRS_AT_ONCE = 1 << 21   # term lookups of one rescoring step
MEMO_KEYS = 400_000
SLACK = 1.001             # covers the rounding of single precision: WIDTH sums of relative error 2**-23

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
IN_TERM = np.ones(256, bool)
IN_TERM[[*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = False
FOLD = np.arange(256, dtype=np.uint8)
FOLD[ord("A"):ord("Z") + 1] += 32

INDEX = "doc_id bigint, n bigint, coords array<int>, most array<int>, terms array<int>, counts array<int>"


# ---------------------------------------------------------------- index

def _lists(owner: np.ndarray, n: int, *columns: np.ndarray) -> list[pa.Array]:
    """Columns of values of ascending owners, as one list per owner."""
    offsets = pa.array(np.searchsorted(owner, np.arange(n + 1)).astype(np.int32))
    return [pa.ListArray.from_arrays(offsets, pa.array(c.astype(np.int32))) for c in columns]


def _index_rows(parts, vocabulary: dict[bytes, int], width: int) -> Iterator[pa.RecordBatch]:
    """A term's code is its number among the items' terms (0: none of them) times ``width`` plus its coordinate."""
    def codes_of(terms: list[bytes]) -> list[int]:
        return [vocabulary.get(t, 0) * width + xxhash.xxh64_intdigest(t) % width for t in terms]

    memo = Memo(codes_of, MEMO_KEYS)
    for b in parts:
        texts = b.column("text")
        for first, last in text_groups(texts):
            data, docs = joined_texts(texts, b"", first, last)
            packed, starts, before = words(FOLD[data], docs, IN_TERM)
            number, values = distinct(packed, starts)
            n, n_values = np.diff(before), max(1, len(values))
            # the number and the distinct term make one key; equal keys are one term of one document
            key, count = np.unique(np.repeat(np.arange(len(n)), n) * n_values + number, return_counts=True)
            doc, code = key // n_values, np.array(memo.values(values), np.int64)[key % n_values]
            coord, term = code % width, code // width
            place = doc * width + coord
            order = np.argsort(place, kind="stable")
            at = np.flatnonzero(np.r_[True, np.diff(place[order]) != 0]) if len(place) else np.zeros(0, np.int64)
            most = np.maximum.reduceat(count[order], at) if len(at) else count
            folded = place[order][at]
            known = np.flatnonzero(term)
            known = known[np.lexsort((term[known], doc[known]))]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").slice(first, last - first), pa.array(n.astype(np.int64)),
                 *_lists(folded // width, len(n), folded % width, most),
                 *_lists(doc[known], len(n), term[known] - 1, count[known])],
                ["doc_id", "n", "coords", "most", "terms", "counts"])


# ---------------------------------------------------------------- items

class Items:
    """The terms of some items and their weights."""

    def __init__(self, ids: list, item: np.ndarray, term: np.ndarray, n_terms: int, coord: np.ndarray):
        order = np.lexsort((term, item))
        self.ids, self.item, self.term, self.coord = ids, item[order], term[order], coord
        self.starts = np.searchsorted(self.item, np.arange(len(ids) + 1))
        self.n_terms = n_terms
        self.weight = np.zeros(n_terms, np.int64)

    def weigh(self, n_docs: int, df: np.ndarray) -> None:
        self.weight = np.floor(1000 * np.log((2 * n_docs + 2) / (2 * df + 1))).astype(np.int64)

    def by_coordinate(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """The coordinates that some item uses, and the sum of each item's weights there."""
        used, at = np.unique(self.coord[self.term], return_inverse=True)
        table = np.zeros((len(used), len(self.ids)), np.float32)
        np.add.at(table, (at, self.item), self.weight[self.term].astype(np.float32))
        row = np.full(width, -1, np.int64)
        row[used] = np.arange(len(used))
        return row, table


def impacts(count: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (SCALE * count) // (1000 * count + 20 * m)


# ---------------------------------------------------------------- search

class Best:
    """The k best (score, smaller id, null id last) of every item, and the least score that still counts."""

    def __init__(self, floors: np.ndarray, k: int):
        self.k, self.floors = k, floors.copy()
        self.item, self.score, self.doc = (np.zeros(0, np.int64) for _ in range(3))
        self.null = np.zeros(0, bool)

    def add(self, item, score, doc, null) -> None:
        keep = score >= self.floors[item]
        if not keep.any():
            return
        columns = [np.concatenate(pair) for pair in ((self.item, item[keep]), (self.score, score[keep]),
                                                     (self.doc, doc[keep]), (self.null, null[keep]))]
        order = np.lexsort((columns[2], columns[3], -columns[1], columns[0]))
        own = columns[0][order]
        place = np.arange(len(own)) - np.searchsorted(own, own)
        self.item, self.score, self.doc, self.null = (c[order[place < self.k]] for c in columns)
        last = order[place == self.k - 1]
        self.floors[columns[0][last]] = np.maximum(self.floors[columns[0][last]], columns[1][last])


class _Batch:
    """Some documents of the index."""

    def __init__(self, b: pa.RecordBatch, first: int, last: int, n_docs: int, n_all: int):
        ids = b.column("doc_id").slice(first, last - first)
        self.null = ids.is_null().to_numpy(zero_copy_only=False)
        self.ids = ids.fill_null(0).to_numpy(zero_copy_only=False)
        n = b.column("n").slice(first, last - first).to_numpy()
        # no document has a term if n_all is 0
        self.m = 50 + 50 * n * n_docs // max(1, n_all)
        self.coord_doc, self.coord, most = self._lists(b, "coords", "most", first, last)
        self.sketch = impacts(most, self.m[self.coord_doc])
        self.term_doc, self.term, count = self._lists(b, "terms", "counts", first, last)
        self.impact = impacts(count, self.m[self.term_doc])

    @staticmethod
    def _lists(b, name: str, value: str, first: int, last: int):
        column = b.column(name).slice(first, last - first)
        size = np.diff(column.offsets.to_numpy())
        values = [b.column(c).slice(first, last - first).flatten().to_numpy().astype(np.int64) for c in (name, value)]
        return np.repeat(np.arange(last - first), size), *values

    def bounds(self, row: np.ndarray, table: np.ndarray) -> np.ndarray:
        """Bounds of all documents and items."""
        at = row[self.coord]
        used = at >= 0
        dense = np.zeros((len(self.ids), len(table)), np.float32)
        dense[self.coord_doc[used], at[used]] = self.sketch[used]
        return dense @ table * np.float32(SLACK)

    def scores(self, items: Items, doc: np.ndarray, item: np.ndarray) -> np.ndarray:
        """Exact scores of pairs."""
        keys = self.term_doc * items.n_terms + self.term
        out = np.zeros(len(doc), np.int64)
        if not len(keys):
            return out
        size = np.diff(items.starts)[item]
        step = max(1, PAIRS_AT_ONCE // max(1, int(size.max(initial=1))))
        for a in range(0, len(doc), step):
            own, n = item[a:a + step], size[a:a + step]
            pair = np.repeat(np.arange(len(own)), n)
            at = np.arange(len(pair)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(items.starts[own], n)
            key = doc[a:a + step][pair] * items.n_terms + items.term[at]
            near = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            hit = keys[near] == key
            np.add.at(out, a + pair[hit], items.weight[items.term[at[hit]]] * self.impact[near[hit]])
        return out


def rescore(batch: _Batch, items: Items, bounds: np.ndarray, best: Best, at_once: int = 64) -> int:
    """Scores each item's documents by falling bounds until the next bound is
    below the item's threshold.  The number of pairs that were scored."""
    scored, n_docs = 0, len(batch.ids)
    doc, item = np.nonzero(bounds >= np.maximum(best.floors, 1)[None, :])
    bound = bounds[doc, item]
    order = np.lexsort((-bound, item))
    doc, item, bound = doc[order], item[order], bound[order]
    place = np.arange(len(item)) - np.searchsorted(item, item)
    for a in range(0, n_docs, at_once):
        now = (place >= a) & (place < a + at_once) & (bound >= best.floors[item])
        if not now.any():
            break  # bounds fall, so no later place reaches a threshold either
        scores = batch.scores(items, doc[now], item[now])
        best.add(item[now], scores, batch.ids[doc[now]], batch.null[doc[now]])
        scored += int(now.sum())
    return scored


def _search_rows(parts, items: Items, floors: np.ndarray, k: int, n_docs: int, n_all: int, width: int) -> Iterator[pa.RecordBatch]:
    row, table = items.by_coordinate(width)
    best = Best(np.maximum(floors, 1), k)
    step = max(1, BOUNDS_AT_ONCE // max(1, len(items.ids), len(table)))
    for b in parts:
        for first in range(0, b.num_rows, step):
            batch = _Batch(b, first, min(first + step, b.num_rows), n_docs, n_all)
            rescore(batch, items, batch.bounds(row, table), best)
    yield pa.RecordBatch.from_arrays(
        [pa.array(best.item.astype(np.int32)), pa.array(best.doc, mask=best.null), pa.array(best.score)], ["item", "doc_id", "score"])


def _search_block(texts: DataFrame, pairs: list, k: int, width: int) -> DataFrame:
    spark = texts.sparkSession
    ids = sorted({r["item_id"] for r in pairs}, key=lambda i: (i is None, i or 0))
    terms = sorted({r["term"] for r in pairs})
    of_item, of_term = {x: i for i, x in enumerate(ids)}, {x: i for i, x in enumerate(terms)}
    encoded = [t.encode() for t in terms]
    items = Items(ids, np.array([of_item[r["item_id"]] for r in pairs], np.int64),
                  np.array([of_term[r["term"]] for r in pairs], np.int64), len(terms),
                  np.array([xxhash.xxh64_intdigest(t) % width for t in encoded], np.int64))
    held = spark.sparkContext.broadcast({t: i + 1 for i, t in enumerate(encoded)})
    index = stage(texts.mapInArrow(lambda parts: _index_rows(parts, held.value, width), INDEX), "sketch-index")

    n_docs, n_all = index.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(len(terms), np.int64)
    for r in index.select(F.explode("terms").alias("term")).groupBy("term").count().collect():  # one row per term of the block
        df[r["term"]] = r["count"]
    items.weigh(n_docs, df)
    shared = spark.sparkContext.broadcast(items)

    def search(floors: np.ndarray, most: int) -> DataFrame:
        return index.mapInArrow(lambda parts: _search_rows(parts, shared.value, floors, most, n_docs, n_all, width),
                                "item int, doc_id bigint, score bigint")

    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    floors = np.zeros(len(ids), np.int64)
    seeds = search(floors, min(k, SEEDS)).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") == k)
    for r in seeds.collect():  # one row per item at most
        floors[r["item"]] = r["score"]
    found = search(floors, k).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    names = spark.createDataFrame([(i, x) for i, x in enumerate(ids)], "item int, item_id bigint")
    return found.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")


def ranked_search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", k: int = 50, width: int = WIDTH,
                  block_terms: int = BLOCK_TERMS) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` highest-scoring documents
    of each item with a score above 0 (all, if fewer), equal scores by
    ascending id.

    The score is that of the module's query contract: weights of rare terms
    times impacts that grow with a term's count and shrink with the
    document's length.  A null or empty text has no term: it matches nothing,
    and such an item has no rows.  Rows of one document id are documents of
    their own; a null document id comes after all others of its score.  Rows
    of one item id (nulls alike) are one item with the terms of all.  No
    documents or no items give no rows; other columns are ignored.

    Items are searched in blocks of about ``block_terms`` distinct terms, by
    hash of the id; a block's terms are broadcast, and one item's are never
    parted.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    folded = F.translate(F.col(item_text_col).cast("string"), UPPER, LOWER)
    pairs = stage(items.select(F.col(item_col).cast("bigint").alias("item_id"),
                               F.explode(F.regexp_extract_all(folded, F.lit(TERM), F.lit(0))).alias("term")).distinct(), "item-terms")
    n_blocks = max(1, -(-pairs.count() // block_terms))
    found = None
    for i in range(n_blocks):
        block = pairs.filter(F.pmod(F.xxhash64("item_id"), F.lit(n_blocks)) == i).collect()
        if block:
            part = _search_block(texts, block, k, width)
            part = stage(part, "ranked") if n_blocks > 1 else part
            found = part if found is None else found.unionByName(part)
    return spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint") if found is None else found
