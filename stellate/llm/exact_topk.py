"""Exact top-k inner products by exhaustive term-at-a-time accumulation.

Vectors become integer weights.  A block of query rows is held sparse; a
batch of candidate rows is turned into postings (per dimension the rows with
a weight there, and the weights).  Dimension by dimension, every query that
has it scatters its weight times the postings into its row of a dense score
array.  No candidate is skipped.  Each partition keeps its best k of every
query, and the partitions' lists are merged.

The queries are a stated set, taken in groups of a bounded size; each group is
broadcast by itself and meets all rows once, in blocks of a bounded number, so
that a batch of rows becomes postings once for all blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stellate.llm.common import stage

QUERY_BLOCK = 1024  # queries of one dense score array
BROADCAST_BYTES = 64 << 20  # of the query components that are broadcast at once
ROWS_AT_ONCE = 256  # candidate rows of one dense score array


def weights(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x), x as double, as exact integers."""
    scaled = np.floor(values.astype(np.float64) * scale)
    if len(scaled) and np.abs(scaled).max() >= 2.0**63:
        raise OverflowError("a scaled component doesn't fit 64 bits")
    return scaled.astype(np.int64)


class Postings:
    """Non-zero weights of some rows by term."""

    def __init__(self, row: np.ndarray, term: np.ndarray, weight: np.ndarray):
        keep = weight != 0
        row, term, weight = row[keep], term[keep], weight[keep]
        order = np.lexsort((row, term))
        self.row, self.weight = row[order], weight[order]
        self.terms, begin = np.unique(term[order], return_index=True)
        self.begin = np.append(begin, len(order))
        self.largest = int(np.abs(weight).max()) if len(weight) else 0

    def of(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        part = slice(self.begin[i], self.begin[i + 1])
        return self.row[part], self.weight[part]


def accumulate(queries: Postings, n_queries: int, rows: Postings, n_rows: int) -> np.ndarray:
    """Dense scores, queries by rows."""
    terms, in_queries, in_rows = np.intersect1d(queries.terms, rows.terms, assume_unique=True, return_indices=True)
    bound = queries.largest * rows.largest * max(1, len(terms))
    kind = np.int32 if bound < 2**31 else np.int64 if bound < 2**63 else object
    scores = np.zeros((n_queries, n_rows), kind)
    product = np.empty((n_queries, n_rows), kind)
    for i, j in zip(in_queries, in_rows):
        q, query_weight = queries.of(i)
        r, row_weight = rows.of(j)
        query_weight, row_weight = query_weight.astype(kind), row_weight.astype(kind)
        if len(r) == n_rows and len(q) == n_queries:  # no gaps: scatter is a plain sum
            np.multiply(query_weight[:, None], row_weight[None, :], out=product)
            scores += product
        elif len(r) == n_rows:
            scores[q] += query_weight[:, None] * row_weight[None, :]
        else:
            scores[np.ix_(q, r)] += query_weight[:, None] * row_weight[None, :]
    if kind is object and scores.size and max(abs(scores.max()), abs(scores.min())) >= 2**63:
        raise OverflowError("a score doesn't fit 64 bits")
    return scores.astype(np.int64) if kind is object else scores


class Best:
    """The k best candidates of every query so far."""

    def __init__(self, ids: np.ndarray, k: int):
        self.ids, self.k = ids, k
        self.query, self.row, self.score = (np.zeros(0, np.int64) for _ in range(3))

    def add(self, rows: np.ndarray, scores: np.ndarray) -> None:
        """Partition selection: what reaches the k-th best score of the block, cut to k of each query."""
        n = len(rows)
        if not n:
            return
        least = np.iinfo(scores.dtype).min
        own = self.ids[:, None] == rows[None, :]
        scores = np.where(own, least, scores)
        kth = np.partition(scores, n - self.k, axis=1)[:, n - self.k] if n > self.k else np.full(len(scores), least)
        q, r = np.nonzero((scores >= kth[:, None]) & ~own)
        self.query = np.concatenate([self.query, q])
        self.row = np.concatenate([self.row, rows[r]])
        self.score = np.concatenate([self.score, scores[q, r].astype(np.int64)])
        order = np.lexsort((self.row, -self.score, self.query))
        q = self.query[order]
        place = np.arange(len(q)) - np.searchsorted(q, q)
        keep = order[place < self.k]
        self.query, self.row, self.score = self.query[keep], self.row[keep], self.score[keep]


def _ragged(ids: np.ndarray, offsets: np.ndarray, values: np.ndarray, scale: int, first: int, last: int) -> Postings:
    size = np.diff(offsets[first:last + 1])
    row = np.repeat(np.arange(last - first), size)
    term = np.arange(offsets[first], offsets[last]) - np.repeat(offsets[first:last], size)
    return Postings(row, term, weights(values[offsets[first]:offsets[last]], scale))


def _vectors(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    column = batch.column("vector")
    offsets = column.offsets.to_numpy()
    return (batch.column("id").to_numpy(), (offsets - offsets[0]).astype(np.int64),
            column.flatten().to_numpy(zero_copy_only=False))


def _group_best(parts, blocks: list[tuple[np.ndarray, Postings]], k: int, scale: int) -> Iterator[pa.RecordBatch]:
    bests = [Best(ids, k) for ids, _ in blocks]
    for b in parts:
        rows, offsets, values = _vectors(b)
        for first in range(0, len(rows), ROWS_AT_ONCE):
            last = min(first + ROWS_AT_ONCE, len(rows))
            postings = _ragged(rows, offsets, values, scale, first, last)
            for (ids, queries), best in zip(blocks, bests):
                best.add(rows[first:last], accumulate(queries, len(ids), postings, last - first))
    for (ids, _), best in zip(blocks, bests):
        yield pa.RecordBatch.from_arrays([pa.array(ids[best.query]), pa.array(best.row), pa.array(best.score)],
                                         ["query_id", "vec_id", "score"])


def exact_top_k(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", query_modulus: int = 50,
                k: int = 5, scale: int = 256, query_block: int = QUERY_BLOCK,
                broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row whose id is divisible by
    ``query_modulus`` the ``k`` highest inner products (all, if fewer) over
    every row with another id, ties to the smaller id.

    A component x counts as floor(scale * x).  Rows with a null id, and
    vectors that are null or hold null or non-finite components, take no part;
    a missing trailing component counts as 0, so an empty vector scores 0.  A
    candidate row that is repeated counts each time; of several rows with one
    query id the least vector is the query.  Components or scores beyond 64
    bits raise OverflowError.  An empty table, or one without a query or a
    second row, gives no rows; other columns are ignored.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("bigint").alias("id"),
                          F.col(vector_col).cast("array<double>").alias("vector")).filter(
        F.col("id").isNotNull() & F.col("vector").isNotNull()
        & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    queries = rows.filter(F.col("id") % query_modulus == 0).groupBy("id").agg(F.min("vector").alias("vector"))
    # a component takes two numbers as a posting, a query its id and offset
    size = queries.agg(F.coalesce(F.sum(F.size("vector").cast("bigint") * 16 + 16), F.lit(0))).first()[0]
    n_groups = max(1, -(-size // broadcast_bytes))

    def group(i: int) -> DataFrame:
        chosen = queries.filter(F.pmod(F.xxhash64("id"), F.lit(n_groups)) == i).orderBy("id").toArrow().combine_chunks()
        blocks = []
        for first in range(0, chosen.num_rows, query_block):
            rows_of = chosen.slice(first, query_block).combine_chunks()
            ids, vectors = rows_of.column("id").to_numpy(), pa.concat_arrays(rows_of.column("vector").chunks)
            lengths = pc.list_value_length(vectors).to_numpy(zero_copy_only=False).astype(np.int64)
            blocks.append((ids, _ragged(ids, np.r_[0, np.cumsum(lengths)], vectors.flatten().to_numpy(zero_copy_only=False), scale, 0, len(ids))))
        held = spark.sparkContext.broadcast(blocks)
        return rows.mapInArrow(lambda parts: _group_best(parts, held.value, k, scale), "query_id bigint, vec_id bigint, score bigint")

    found = group(0) if n_groups == 1 else reduce(DataFrame.unionByName, [stage(group(i), "topk") for i in range(n_groups)])
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
