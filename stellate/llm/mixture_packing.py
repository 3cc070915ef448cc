"""Mixture-controlled packing by deficit round-robin over source queues.

The documents of a source, in the order in which they are read, form one
queue of tokens.  In every round each queue is credited with its share of a
window; it hands out as many whole slots of tokens as its credit pays for
and carries the rest, its deficit, to the next round.  What the rounds hand
out is laid end to end and cut into windows, so every window holds the target
proportions to within a slot a queue, and the deficits keep any stretch of
windows to them.  A queue that is empty hands out nothing, and the others
fill its place.

The credit of a queue after r rounds is r times its share.  So the round and
the place of any token follow from its place in its queue alone, and every
partition carries on with the deficits that those before it left, without a
pass over them.  Documents stay where they were tokenised; only the token
counts of (task, source) are exchanged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stellate.llm.byte_bpe import byte_encoder
from stellate.llm.common import join_grouped, stage, text_groups

CAPACITY = 1024
END_ID = 0
SLOT = 64                    # tokens that a queue hands out at once
MOST_QUEUES = 256            # the sources with the most tokens; all others share one more queue
BROADCAST_ROWS = 1 << 17     # (task, source) counts that are broadcast; more are joined by an exchange
CREDIT_BITS = 20             # a credit is counted in 2**-20 slots
CELLS_AT_ONCE = 1 << 20      # places computed at once: stretches x queues

TOKENS = "doc_id bigint, source string, task int, before bigint, n bigint, ids binary"
PIECES = ("doc_id bigint, source string, start bigint, length bigint, ids binary, doc_tokens bigint, "
          "sequence_id bigint, offset bigint")


def stored(path: str) -> np.dtype:
    """How a vocabulary's ids are staged: two bytes each, if they fit."""
    return np.dtype("<u2" if byte_encoder(path).n_ids <= 1 << 16 else "<u4")


def _token_rows(parts, path: str, end_id: int) -> Iterator[pa.RecordBatch]:
    """``before``: tokens of the source that this task has read before the document."""
    encode, kind = byte_encoder(path).encode, stored(path)
    task, read = TaskContext.get().partitionId(), {}
    for b in parts:
        texts = b.column("text")
        for first, last in text_groups(texts):
            ids, offsets = encode(texts, first, last, end_id)
            n = np.diff(offsets)
            before = np.empty(len(n), np.int64)
            source = b.column("source").slice(first, last - first)
            for i, (s, k) in enumerate(zip(source.to_pylist(), n.tolist())):
                before[i] = read.get(s, 0)
                read[s] = before[i] + k
            raw = pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), len(n), [None, pa.py_buffer(offsets * kind.itemsize),
                                            pa.py_buffer(ids.astype(kind))])
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").slice(first, last - first), source, pa.array(np.full(len(n), task, np.int32)),
                 pa.array(before), pa.array(n.astype(np.int64)), raw.cast(pa.binary())],
                ["doc_id", "source", "task", "before", "n", "ids"])


class RoundRobin:
    """Where the tokens of queues with ``totals`` tokens go, for target ``weights``."""

    def __init__(self, totals: list[int], weights: list[float], capacity: int = CAPACITY, slot: int = SLOT):
        self.totals, self.capacity, self.slot = np.array(totals, np.int64), capacity, slot
        share = np.array(weights, np.float64) / sum(weights) * (capacity / slot)
        #: slots a round, in 2**-20; every queue is served in the end
        self.credit = np.maximum(1, np.rint(share * (1 << CREDIT_BITS))).astype(np.int64)
        total = int(self.totals.sum())
        self.full = total // capacity
        # what fills no window is cut at powers of two, which need no padding
        rest, edges = total - self.full * capacity, [self.full * capacity]
        for bit in range(capacity.bit_length(), -1, -1):
            if rest >> bit & 1:
                edges.append(edges[-1] + (1 << bit))
        self.edges = np.array(edges, np.int64)

    def round_of(self, slot_no: np.ndarray, queue: np.ndarray) -> np.ndarray:
        """The round (from 1) that hands out a queue's slot."""
        credit = self.credit[queue]
        return -(-((slot_no + 1) << CREDIT_BITS) // credit)

    def handed_out(self, rounds: np.ndarray, queues: slice) -> np.ndarray:
        """Tokens that queues have handed out after some rounds (rounds x queues)."""
        slots = (rounds[:, None] * self.credit[queues][None, :]) >> CREDIT_BITS
        return np.minimum(slots * self.slot, self.totals[queues][None, :])

    def place(self, place: np.ndarray, queue: np.ndarray, rounds: np.ndarray) -> np.ndarray:
        """The place in the whole output of a queue's token that its ``rounds`` hand out."""
        out = place.copy()
        step = max(1, CELLS_AT_ONCE // len(self.totals))
        for a in range(0, len(place), step):
            part = slice(a, a + step)
            own = queue[part]
            now, last = self.handed_out(rounds[part], slice(None)), self.handed_out(rounds[part] - 1, slice(None))
            no = np.arange(len(self.totals))[None, :]
            out[part] += np.where(no < own[:, None], now, np.where(no > own[:, None], last, 0)).sum(axis=1)
        return out

    def sequence(self, place: np.ndarray) -> np.ndarray:
        return np.where(place < self.edges[0], place // self.capacity,
                        self.full - 1 + np.searchsorted(self.edges, place, side="right"))

    def begin(self, sequence: np.ndarray) -> np.ndarray:
        return np.where(sequence <= self.full, sequence * self.capacity,
                        self.edges[np.clip(sequence - self.full, 0, len(self.edges) - 1)])

    def pieces(self, place: np.ndarray, queue: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
        """Documents at ``place`` of their queues, with ``n`` tokens: per piece
        the document, start, length, sequence and offset there."""
        first = place // self.slot
        n_slots = (place + n - 1) // self.slot - first + 1
        doc = np.repeat(np.arange(len(n)), n_slots)
        slot_no = np.arange(len(doc)) - np.repeat(np.cumsum(n_slots) - n_slots, n_slots) + first[doc]
        rounds = self.round_of(slot_no, queue[doc])
        # slots of one round follow each other
        new = np.r_[True, (np.diff(doc) != 0) | (np.diff(rounds) != 0)] if len(doc) else np.zeros(0, bool)
        doc, rounds = doc[new], rounds[new]
        at = np.maximum(slot_no[new] * self.slot, place[doc])
        after = np.r_[doc[1:] != doc[:-1], True] if len(doc) else np.zeros(0, bool)
        stop = np.where(after, (place + n)[doc], np.r_[at[1:], 0])
        whole = self.place(at, queue[doc], rounds)
        # cut where sequences end
        low, high = self.sequence(whole), self.sequence(whole + stop - at - 1)
        parts = high - low + 1
        of = np.repeat(np.arange(len(doc)), parts)
        sequence = low[of] + np.arange(len(of)) - np.repeat(np.cumsum(parts) - parts, parts)
        begin = np.maximum(whole[of], self.begin(sequence))
        end = np.minimum((whole + stop - at)[of], self.begin(sequence + 1))
        # the last sequence has no next
        end = np.where(sequence == high[of], (whole + stop - at)[of], end)
        start = (at - place[doc])[of] + begin - whole[of]
        return doc[of], start, end - begin, sequence, begin - self.begin(sequence)


def _piece_rows(parts, robin: RoundRobin, kind: np.dtype) -> Iterator[pa.RecordBatch]:
    for b in parts:
        for first, last in text_groups(b.column("ids"), 1 << 23):
            rows = b.slice(first, last - first)
            place, queue, n = (rows.column(c).to_numpy() for c in ("place", "queue", "n"))
            doc, start, length, sequence, offset = robin.pieces(place, queue.astype(np.int64), n)
            # the pieces of a document in the order of their tokens are its ids side by side
            raw = np.frombuffer(b"".join(rows.column("ids").to_pylist()), kind).astype("<u4")
            ids = pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), len(doc), [None, pa.py_buffer(np.r_[0, np.cumsum(length * 4)].astype(np.int64)), pa.py_buffer(raw)])
            of = pa.array(doc)
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id").take(of), rows.column("source").take(of), pa.array(start), pa.array(length),
                 ids.cast(pa.binary()), rows.column("n").take(of), pa.array(sequence), pa.array(offset)],
                ["doc_id", "source", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])


def mix_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                  source_col: str = "source", targets: dict | None = None, capacity: int = CAPACITY,
                  end_id: int = END_ID, slot: int = SLOT, most_queues: int = MOST_QUEUES) -> DataFrame:
    """One row per piece: ``doc_id, source, start, length, ids, doc_tokens,
    sequence_id, offset``; ``ids`` are little-endian unsigned 32-bit numbers.

    ``tokenizer_path`` must exist on the driver and every executor.  ``targets`` gives each
    source's weight in a window; without it every window has the proportions
    of the whole table.  A source that ``targets`` lacks has weight 0: it
    follows when the others are done.  The ``most_queues`` sources with the
    most tokens (ties: by name) have queues of their own, all others share one
    whose documents follow each other by task, then source.

    Sequences hold ``capacity`` tokens; what is left at the end is cut into
    sequences of powers of two, so nothing is padded.  A document is the ids
    of its whole text and ``end_id``; null and empty texts are the end id
    alone.  A null source is a source.  Rows of one id, and null ids, are
    packed like any other row; an empty table gives no rows; other columns are
    ignored.
    """
    if capacity % slot or slot < 1:
        raise ValueError("a window must hold a whole number of slots")
    if not 0 <= end_id < byte_encoder(tokenizer_path).n_ids:
        raise ValueError("the end id must be one of the vocabulary")
    spark, kind = docs.sparkSession, stored(tokenizer_path)
    src = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                      F.col(source_col).cast("string").alias("source"))
    tokens = stage(src.mapInArrow(lambda parts: _token_rows(parts, tokenizer_path, end_id), TOKENS), "mixture-tokens")
    counts = stage(tokens.groupBy("task", "source").agg(F.sum("n").alias("n")), "mixture-counts")
    sources = counts.groupBy("source").agg(F.sum("n").alias("n"))
    total = sources.agg(F.sum("n")).first()[0]
    if total is None:
        return spark.createDataFrame([], PIECES)
    largest = sources.orderBy(F.desc("n"), "source").limit(most_queues).collect()  # a bounded number of rows
    names, totals = [r["source"] for r in largest], [r["n"] for r in largest]
    weights = [float(n) for n in totals] if targets is None else [float(targets.get(s, 0)) for s in names]
    if total > sum(totals):
        totals.append(total - sum(totals))
        weights.append(float(totals[-1]) if targets is None else sum(w for s, w in targets.items() if s not in names))
    if min(weights) < 0 or not sum(weights):
        raise ValueError("weights must not be negative, and one of a source must be positive")
    queues = spark.createDataFrame([(s, i) for i, s in enumerate(names)], "name string, no int")
    named = counts.join(F.broadcast(queues), F.col("source").eqNullSafe(F.col("name")), "left").select(
        "task", "source", "n", F.coalesce("no", F.lit(len(names))).alias("queue"))
    order = Window.partitionBy("queue").orderBy("task", "source").rowsBetween(Window.unboundedPreceding, -1)
    bases = named.withColumn("base", F.coalesce(F.sum("n").over(order), F.lit(0))).select(
        "task", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("")).alias("source_key"), "queue", "base")
    keyed = tokens.withColumn("source_key", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("")))
    rows, size = counts.agg(F.count("*"), F.sum(F.octet_length("source"))).first()
    placed = (keyed.join(F.broadcast(bases), ["task", "source_key"]) if rows <= BROADCAST_ROWS and (size or 0) <= BROADCAST_ROWS * 64
              else join_grouped(keyed, bases, ["source_key", "task"]))
    held = spark.sparkContext.broadcast(RoundRobin(totals, weights, capacity, slot))
    return placed.select("doc_id", "source", "n", "ids", "queue", (F.col("base") + F.col("before")).alias("place")).mapInArrow(
        lambda parts: _piece_rows(parts, held.value, kind), PIECES)
