"""Packing of tokenised documents by bounded-space online best-fit.

A document's token ids, closed by an end id, form one piece; longer ones are
cut at the capacity.  Pieces go to shards by hash, and every shard packs its
stream in one pass: a fixed number of sequences is open at a time, a bitset
keyed by free space finds the open sequence that a piece fills best, and
when another one must be opened, the fullest is closed.

A shard's sequences that are still open at its end with much space left are
taken apart and handed to the next round, where fewer shards pack what all
shards have left; so the loss per shard doesn't add up.  A round that hands
over nearly all it got is the last: its pieces don't fit beside each other.
Only the piece table (a few numbers a document) is ever exchanged.
"""

from __future__ import annotations

import json
import os
import string
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stellate.llm.common import NOT_SPACE, Memo, distinct, joined_texts, ragged_starts, stage, text_groups, words
from stellate.llm.pair_merge import PairMerger

CAPACITY = 4096
END_ID = 1
OPEN_SEQUENCES = 1024
SHARD_TOKENS = 1 << 20
MEMO_KEYS = 300_000
LEAST_CLOSED = 0.1   # share of a round's tokens that must be in closed sequences for another round
MOST_ROUNDS = 127    # a sequence's number has 7 bits for its round

def _cuts() -> np.ndarray:
    """Neighbouring ASCII bytes between which no token of the vocabulary
    reaches: digits are split one by one, and letters from punctuation, but
    for the apostrophe (contractions) and the signs around special tokens."""
    letter = np.array([chr(c).isalpha() and c < 128 for c in range(256)])
    digit = np.array([chr(c).isdigit() and c < 128 for c in range(256)])
    sign = np.array([chr(c) in string.punctuation and chr(c) not in "'<|>" for c in range(256)])
    plain = letter | digit | sign
    cut = (letter[:, None] & sign[None, :]) | (sign[:, None] & letter[None, :])
    return (cut | (digit[:, None] & plain[None, :]) | (plain[:, None] & digit[None, :])).ravel()


CUT = _cuts()

#: fixed values: the normaliser, pre-tokeniser and added tokens that the cut places hold for
SETTINGS = ([{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}],
            [{"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
              "behavior": "Removed", "invert": True},
             {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}],
            {"<|startoftext|>", "<|endoftext|>"})


def _settings(spec: dict) -> tuple:
    return ((spec["normalizer"] or {}).get("normalizers"), (spec["pre_tokenizer"] or {}).get("pretokenizers"),
            {t["content"] for t in spec["added_tokens"]})

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32

_ENCODERS: dict[str, "ChunkEncoder"] = {}


#: bytes of lower-case letters that no normalisation changes: a-z and those of Latin-1
PLAIN = bytes([*range(ord("a"), ord("z") + 1), 0xC3, *(c for c in range(0x9F, 0xC0) if c != 0xB7)])
PLAIN_LONGEST = 64


class WordMerger:
    """Ids of chunks of plain lower-case letters, merged side by side (see pair_merge)."""

    def __init__(self, spec: dict):
        model = spec["model"]
        vocab, suffix = model["vocab"], model["end_of_word_suffix"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        rows = np.array([(vocab[a], vocab[b], i, vocab[a + b]) for i, (a, b) in enumerate(pairs)], np.int64)
        self.merger = PairMerger(*rows.T, len(vocab))
        # the byte-level alphabet: printable bytes stand for themselves, the others follow from 256 on
        own = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in own]
        char = {**{b: chr(b) for b in own}, **{b: chr(256 + i) for i, b in enumerate(rest)}}
        self.inner = np.array([vocab[char[b]] for b in range(256)], np.int32)
        self.last = np.array([vocab[char[b] + suffix] for b in range(256)], np.int32)

    def encode(self, chunks: list[bytes]) -> list[bytes]:
        size = np.fromiter(map(len, chunks), np.int64, len(chunks))
        data = np.frombuffer(b"".join(chunks), np.uint8)
        symbol, ends = self.inner[data], np.cumsum(size) - 1
        symbol[ends] = self.last[data[ends]]
        ids, seq = self.merger.survivors(symbol, np.repeat(np.arange(len(chunks)), size))
        raw, at = ids.astype("<u4").tobytes(), (4 * np.searchsorted(seq, np.arange(len(chunks) + 1))).tolist()
        return [raw[a:e] for a, e in zip(at, at[1:])]


class ChunkEncoder:
    """Token ids of texts by a vocabulary file that ignores case and whose
    tokens never reach across ASCII white space or the places of ``CUT``: each
    distinct chunk between such places is encoded once, by the library, or, if
    it is plain letters, by merging many side by side."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.memo = Memo(self._encode, MEMO_KEYS)
        with open(path) as f:
            spec = json.load(f)
        model = spec["model"]
        if _settings(spec) != SETTINGS:
            raise ValueError("chunks are cut for a vocabulary with another normaliser or pre-tokeniser")
        plain = model["type"] == "BPE" and model["end_of_word_suffix"] and not (
            model["continuing_subword_prefix"] or model["dropout"] or model["ignore_merges"])
        self.merger = WordMerger(spec) if plain else None

    def _encode(self, chunks: list[bytes]) -> list[bytes]:
        out: list = [None] * len(chunks)
        plain = [i for i, c in enumerate(chunks) if len(c) <= PLAIN_LONGEST and not c.translate(None, PLAIN)] if self.merger else []
        for i in range(0, len(plain), 50_000):
            part = plain[i:i + 50_000]
            for j, ids in zip(part, self.merger.encode([chunks[j] for j in part])):
                out[j] = ids
        other = [i for i, x in enumerate(out) if x is None]
        for i in range(0, len(other), 20_000):
            part = other[i:i + 20_000]
            texts = [chunks[j].decode() for j in part]
            for j, e in zip(part, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
                out[j] = np.array(e.ids, "<u4").tobytes()
        return out

    def encode(self, texts: pa.Array, first: int, last: int, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts ``first`` to ``last`` side by side, each closed by ``end_id``, and their offsets."""
        data, docs = joined_texts(texts, b"", first, last)
        packed, starts, before = words(data, docs, NOT_SPACE, CUT)
        if len(starts) > 1:  # chunks of ASCII alone, without a special token, in lower case
            as_is = np.logical_or.reduceat((packed >= 0x80) | (packed == ord("<")), starts[:-1])
            packed = np.where(np.repeat(as_is, np.diff(starts)), packed, LOWER[packed])
        codes, chunks = distinct(packed, starts)
        encoded = self.memo.values(chunks)
        size = np.fromiter((len(e) // 4 for e in encoded), np.int64, len(encoded))
        begin = ragged_starts(size)
        table = np.frombuffer(b"".join(encoded), "<u4")
        size = size[codes]
        upto = ragged_starts(size)
        ids = table[np.arange(upto[-1]) + np.repeat(begin[codes] - upto[:-1], size)]
        offsets = upto[before]
        return np.insert(ids, offsets[1:], end_id), offsets + np.arange(len(offsets))


def encoder(path: str) -> ChunkEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = ChunkEncoder(path)
    return _ENCODERS[path]


def _piece_rows(parts, path: str, capacity: int, end_id: int) -> Iterator[pa.RecordBatch]:
    encode, salt = encoder(path).encode, TaskContext.get().partitionId() << 40
    for b in parts:
        texts = b.column("text")
        for first, last in text_groups(texts):
            ids, offsets = encode(texts, first, last, end_id)
            n = -(-np.diff(offsets) // capacity)
            doc = np.repeat(np.arange(last - first), n)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
            start = piece * capacity
            length = np.minimum(np.diff(offsets)[doc] - start, capacity)
            raw, at = memoryview(ids.tobytes()), (offsets[doc] + start) * 4
            crc = [zlib.crc32(raw[a:e]) for a, e in zip(at.tolist(), (at + length * 4).tolist())]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").slice(first, last - first).take(pa.array(doc)), pa.array(piece.astype(np.int32)),
                 pa.array(start), pa.array(length), pa.array(crc, pa.int64()), pa.array(salt + np.arange(len(doc)))],
                ["doc_id", "piece", "start", "length", "ids_crc32", "salt"])
            salt += len(doc)


class BestFit:
    """Online best-fit with a bounded number of open bins."""

    def __init__(self, capacity: int, most_open: int):
        self.capacity, self.most_open = capacity, most_open
        self.by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.bits = 0       # bit f is set if an open bin has f free
        self.n_open = self.n_bins = 0

    def _take(self, free: int) -> int:
        bins = self.by_free[free]
        found = bins.pop()
        if not bins:
            self.bits ^= 1 << free
        return found

    def place(self, length: int) -> tuple[int, int]:
        """The bin and the place in it for an item."""
        fits = self.bits >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            chosen = self._take(free)
        else:
            if self.n_open == self.most_open:  # the fullest closes
                self._take((self.bits & -self.bits).bit_length() - 1)
                self.n_open -= 1
            chosen, free = self.n_bins, self.capacity
            self.n_bins += 1
            self.n_open += 1
        left = free - length
        if left:
            if not self.by_free[left]:
                self.bits |= 1 << left
            self.by_free[left].append(chosen)
        else:
            self.n_open -= 1
        return chosen, self.capacity - free

    def open_bins(self, least_free: int) -> set[int]:
        return {b for free in range(least_free, self.capacity + 1) for b in self.by_free[free]}


def _packed_rows(parts, capacity: int, most_open: int, least_free: int) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by shard.  Adds bin, offset and whether the bin is left open for the next round."""
    shard, bins, of_shard = None, None, []

    def finish():
        open_now = bins.open_bins(least_free)
        for rows, chosen, offset in of_shard:
            carried = np.isin(chosen, np.fromiter(open_now, np.int64, len(open_now)))
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(chosen), pa.array(offset), pa.array(carried)],
                                             [*rows.schema.names, "bin", "offset", "carried"])

    for b in parts:
        shards = b.column("shard").to_numpy()
        edges = np.r_[0, np.flatnonzero(np.diff(shards)) + 1, len(shards)]
        for first, last in zip(edges, edges[1:]):
            if first == last:
                continue
            if shards[first] != shard:
                if of_shard:
                    yield from finish()
                shard, bins, of_shard = shards[first], BestFit(capacity, most_open), []
            rows = b.slice(first, last - first)
            placed = np.array([bins.place(n) for n in rows.column("length").to_pylist()], np.int64)
            of_shard.append((rows, placed[:, 0], placed[:, 1]))
    if of_shard:
        yield from finish()


PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY, most_open: int = OPEN_SEQUENCES,
                shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to a table of pieces (see PIECES).

    There is another round only if this one closed a share of ``LEAST_CLOSED``;
    the last round keeps all of its sequences, so every piece is in one.
    ``salt`` is a number of each piece's own, so that equal pieces are spread
    over all shards as well; without such a column the pieces are numbered first."""
    if "salt" not in pieces.columns:
        pieces = stage(pieces.withColumn("salt", F.monotonically_increasing_id()), "pieces")
    done, round_no, rest = [], 0, pieces
    total = rest.agg(F.sum("length")).first()[0] or 0
    while True:
        n = max(1, -(-total // shard_tokens))
        key = F.xxhash64("salt", F.lit(round_no))
        dealt = rest.withColumn("shard", F.pmod(key, F.lit(n))).repartition("shard").sortWithinPartitions(
            "shard", F.desc("length"), "doc_id", "piece", "salt")
        # what fits in one shard is the last round
        least_free = capacity // 8 if n > 1 else capacity + 1
        packed = stage(dealt.mapInArrow(lambda parts, f=least_free: _packed_rows(parts, capacity, most_open, f),
                                        PIECES + ", salt bigint, shard bigint, bin bigint, offset bigint, carried boolean"), "packed")
        number = F.lit(round_no << 56) + F.shiftleft("shard", 24) + F.col("bin")
        carried = packed.filter("carried")
        left = 0 if n == 1 else carried.agg(F.sum("length")).first()[0] or 0
        last = not left or left > (1 - LEAST_CLOSED) * total or round_no + 1 == MOST_ROUNDS
        done.append((packed if last else packed.filter("not carried")).select(
            "doc_id", "piece", "start", "length", "ids_crc32", number.cast("bigint").alias("sequence_id"), "offset"))
        if last:
            break
        rest, round_no, total = carried.select("doc_id", "piece", "start", "length", "ids_crc32", "salt"), round_no + 1, left
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def pack_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                   capacity: int = CAPACITY, end_id: int = END_ID, most_open: int = OPEN_SEQUENCES,
                   shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32,
    sequence_id, offset``.

    ``tokenizer_path`` must exist on every executor.  A document is the ids of
    its whole text and ``end_id``; null and empty texts, and white space, are
    the end id alone.  Rows of one id, and null ids, are packed like any other
    row; an empty table gives no rows; other columns are ignored.
    """
    src = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    pieces = stage(src.mapInArrow(lambda parts: _piece_rows(parts, tokenizer_path, capacity, end_id), PIECES + ", salt bigint"), "pieces")
    return pack_pieces(pieces, capacity, most_open, shard_tokens)
