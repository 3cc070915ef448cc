"""Token counts by rank-synchronous merging of ragged arrays.

A byte-pair vocabulary with piece scores is turned into a table of pairs:
for two pieces whose concatenation is a piece too, the rank of that piece
(rank 0: the best score).  Pre-tokens are held side by side in one flat
array of symbols; in each round every sequence applies its lowest-ranked
pair at all of its places at once (left to right where places overlap), and
a sequence without a pair is done: its surviving symbols are counted.

Pre-tokens are cut only where no piece of the vocabulary reaches across, so
the counts equal those of the library on the whole text.  Each distinct
pre-token is merged once per worker and then looked up.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stellate.llm.common import Memo, batches, distinct, joined_texts, ragged_starts, text_groups
from stellate.llm.pair_merge import PairMerger

SPACE = "\u2581"             # how the vocabulary writes a space
SPACE_BYTES = SPACE.encode()
LONG_SPACES = b" " * 64
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6  # piece types of the file format
LONG_PRETOKEN = 64           # longer ones are cut again between characters that no piece joins
SYMBOLS_AT_ONCE = 1_000_000  # symbols merged side by side
MEMO_KEYS = 400_000          # distinct pre-tokens kept per worker

_COUNTERS: dict[str, "PieceCounter"] = {}


class PieceCounter:
    """Counts tokens of a byte-fallback BPE vocabulary file."""

    run = 0  # spaces in the longest piece of spaces

    def __init__(self, model_path: str):
        from sentencepiece import sentencepiece_model_pb2 as pb

        model = pb.ModelProto()
        with open(model_path, "rb") as f:
            model.ParseFromString(f.read())
        norm, trainer = model.normalizer_spec, model.trainer_spec
        if trainer.model_type != trainer.BPE or not trainer.byte_fallback:
            raise ValueError("only BPE vocabularies with byte fallback are supported")
        if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.escape_whitespaces:
            raise ValueError("only the identity normaliser is supported")
        if trainer.treat_whitespace_as_suffix or any(p.type in (USER_DEFINED, UNUSED) for p in model.pieces):
            raise ValueError("suffix spaces, user-defined and unused pieces are not supported")
        self.lead = b" " if norm.add_dummy_prefix else b""
        pieces = {p.piece: p.score for p in model.pieces if p.type == NORMAL}
        # symbols are named by their place among the pieces, best score first
        rank = {p: i for i, p in enumerate(sorted(pieces, key=lambda p: -pieces[p]))}
        self.n = len(rank)
        single = sorted((ord(p), r) for p, r in rank.items() if len(p) == 1)
        self.chars = np.array([c for c, _ in single], np.int64)
        self.char_ids = np.array([r for _, r in single], np.int32)
        # pieces of one score share an order
        scores = sorted(pieces.values(), reverse=True)
        level = {x: i for i, x in reversed(list(enumerate(scores)))}
        pairs = np.array([(rank[p[:i]], rank[p[i:]], level[pieces[p]], r) for p, r in rank.items()
                          for i in range(1, len(p)) if p[:i] in rank and p[i:] in rank], np.int64)
        self.merger = PairMerger(*pairs.T, self.n)
        inside = {(ord(p[i]) << 21) | ord(p[i + 1]) for p in rank for i in range(len(p) - 1)}
        self.joined = np.array(sorted(inside), np.int64)
        # two neighbouring bytes are cut apart if no piece has them side by side, between characters only
        cut = np.ones((256, 256), bool)
        cut[:, 0x80:0xC0] = False
        for p in rank:
            b = np.frombuffer(p.replace(SPACE, " ").encode(), np.uint8)
            cut[b[:-1], b[1:]] = False
        self.cut = cut.ravel()
        self.run = max([len(p) for p in rank if set(p) == {SPACE}], default=0)
        self.memo = Memo(self.count_pretokens, MEMO_KEYS)
        # a long run of spaces falls into longest pieces from its left end
        alone = self._count_group([b" " * n for n in range(1, 3 * self.run + 1)])
        if any(alone[n - 1] != 1 + alone[n - self.run - 1] for n in range(self.run + 1, 3 * self.run + 1)):
            self.run = 0

    # ------------------------------------------------------------ texts

    def count_texts(self, texts: pa.Array) -> np.ndarray:
        """Tokens of each text; null and empty texts have none."""
        out = [np.zeros(0, np.int64)]
        for first, last in text_groups(texts):
            data, docs = joined_texts(texts, self.lead, first, last)
            if SPACE_BYTES in data.tobytes():  # a written-out space sign is the same symbol
                data, docs = self._plain_spaces(data, docs)
            begin = np.zeros(len(data) + 1, bool)
            begin[docs] = True
            begin[1:-1] |= self.cut[data[:-1].astype(np.int32) * 256 + data[1:]]
            starts = np.flatnonzero(begin)
            codes, pretokens = distinct(data, starts)
            upto = ragged_starts(np.array(self.memo.values(pretokens), np.int64)[codes])
            out.append(np.diff(upto[np.searchsorted(starts, docs)]))
        return np.concatenate(out)

    @staticmethod
    def _plain_spaces(data: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        texts = [data[a:b].tobytes().replace(SPACE_BYTES, b" ") for a, b in zip(docs, docs[1:])]
        return np.frombuffer(b"".join(texts), np.uint8), ragged_starts(np.array([len(t) for t in texts]))

    # ------------------------------------------------------------ merging

    def count_pretokens(self, pretokens: list[bytes]) -> list[int]:
        out: list[int] = []
        for group in batches(pretokens, len, SYMBOLS_AT_ONCE):
            out += self._count_group(group)
        return out

    def _short_runs(self, pretoken: bytes) -> tuple[bytes, int]:
        """A long run of leading spaces cut down, and the pieces cut off."""
        spaces = len(pretoken) - len(pretoken.lstrip(b" "))
        n = max(0, spaces - 2) // self.run if self.run else 0
        return pretoken[n * self.run:], n

    def _count_group(self, pretokens: list[bytes]) -> list[int]:
        cut_off = {}
        for i, p in enumerate(pretokens):
            if p.startswith(LONG_SPACES):
                pretokens[i], cut_off[i] = self._short_runs(p)
        texts = [p.decode() for p in pretokens]
        lengths = np.array([len(p) for p in texts], np.int64)
        code = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).astype(np.int64)
        code[code == ord(" ")] = ord(SPACE)
        owner = np.repeat(np.arange(len(pretokens)), lengths)
        at = np.minimum(np.searchsorted(self.chars, code), len(self.chars) - 1)
        known = self.chars[at] == code
        symbol = np.where(known, self.char_ids[at], np.int32(-1))
        # an unknown character never joins and costs one token per UTF-8 byte
        extra = np.where(known, 0, (code > 0x7F).astype(np.int64) + (code > 0x7FF) + (code > 0xFFFF))
        total = np.bincount(owner, weights=extra, minlength=len(pretokens)).astype(np.int64)
        new = np.empty(len(code), bool)
        new[:1] = True
        new[1:] = owner[1:] != owner[:-1]
        if (lengths > LONG_PRETOKEN).any():
            inner = np.flatnonzero(~new & (lengths[owner] > LONG_PRETOKEN))
            pair = (code[inner - 1] << 21) | code[inner]
            near = np.minimum(np.searchsorted(self.joined, pair), len(self.joined) - 1)
            new[inner[self.joined[near] != pair]] = True
        seq = np.cumsum(new) - 1              # sequence of each symbol
        seq_owner = owner[new]                # pre-token of each sequence
        left = np.bincount(self.merger.survivors(symbol, seq)[1], minlength=len(seq_owner))
        np.add.at(total, seq_owner, left)
        for i, n in cut_off.items():
            total[i] += n
        return total.tolist()


def counter(model_path: str) -> PieceCounter:
    """The worker's counter for a vocabulary file (built once per process)."""
    if model_path not in _COUNTERS:
        _COUNTERS[model_path] = PieceCounter(model_path)
    return _COUNTERS[model_path]


def token_counts(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 4096) -> DataFrame:
    """One row per document: ``doc_id, n_bytes, n_tokens, over_limit``.

    ``model_path`` must exist on every executor.  Whole texts are counted,
    without begin, end or special tokens.  Null and empty texts have 0 bytes
    and 0 tokens; repeated rows and null ids are returned as they are; an
    empty table gives no rows; other columns are ignored.
    """
    src = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(model_path)
        for b in parts:
            tokens = count.count_texts(b.column("text"))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("n_bytes"), pa.array(tokens, pa.int64())],
                ["doc_id", "n_bytes", "n_tokens"])

    sized = src.withColumn("n_bytes", F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint"))
    return (sized.mapInArrow(run, "doc_id bigint, n_bytes bigint, n_tokens bigint")
            .withColumn("over_limit", F.col("n_tokens") > F.lit(limit)))
