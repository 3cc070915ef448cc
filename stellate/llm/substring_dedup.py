"""Removal of word sequences that an earlier document already has, by
difference-cover anchors.

A difference cover of a period holds, for every difference modulo the period,
two members that far apart.  So if two documents share ``window`` words, then
among any ``period`` neighbouring places of the shared stretch there is one
that lies on the cover in both documents at once, and the ``window - period +
1`` words from there on (an anchor) are hashed in both.  Only anchors at cover
places are hashed and exchanged; those that two documents have mark the places
from which the match is extended to whole windows, which are compared by a
96-bit hash.

Flow: (1) exact copies of a smaller document are settled by their digest;
(2) anchors are counted, shared ones go back to their documents; (3) those
documents hash the windows around shared anchors, and windows with a smaller
document go back to theirs; (4) every document drops the words they cover.
The texts are exchanged once, by document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stellate.llm.common import NOT_SPACE, distinct, join_grouped, joined_texts, text_groups, words

# fixed values: a perfect difference set (every non-zero difference occurs once)
PERIOD = 31
ROW_BITS = 20  # of a text's digest, beside its id
COVER = (1, 5, 11, 24, 25, 27)
#: odd multipliers of the two rolling hashes
BASES = (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03)
MASK = (1 << 64) - 1


def check_cover(cover: tuple, period: int) -> None:
    if {(a - b) % period for a in cover for b in cover} != set(range(period)):
        raise ValueError("not a difference cover of the period")


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n + 1, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Words:
    """The words of a group of texts, with rolling hashes over them."""

    def __init__(self, texts: pa.Array, first: int, last: int):
        data, docs = joined_texts(texts, b"", first, last)
        self.packed, self.starts, self.before = words(data, docs, NOT_SPACE)
        self.size = np.diff(self.before)
        self.n = len(self.starts) - 1

    def hashed(self) -> "_Words":
        codes, values = distinct(self.packed, self.starts)
        halves = np.frombuffer(b"".join(xxhash.xxh128_digest(v) for v in values), "<u8").reshape(-1, 2)
        self.sums, self.inverse = [], []
        for k, base in enumerate(BASES):
            h = halves[codes, k] if len(values) else np.zeros(0, np.uint64)
            sums = np.zeros(self.n + 1, np.uint64)
            np.cumsum(h * _powers(base, self.n)[:self.n], out=sums[1:])
            self.sums.append(sums)
            self.inverse.append(_powers(pow(base, -1, 1 << 64), self.n))
        self.doc = np.repeat(np.arange(len(self.size)), self.size)
        self.at = np.arange(self.n) - self.before[:-1][self.doc]  # place in its document
        return self

    def window(self, first: np.ndarray, length: int, k: int) -> np.ndarray:
        """Hash ``k`` of the ``length`` words from each of ``first``."""
        s = self.sums[k]
        return _mixed((s[first + length] - s[first]) * self.inverse[k][first])

    def anchors(self, window: int, period: int, cover: tuple) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of anchors, their documents' numbers and hashes."""
        length = window - period + 1
        on = np.zeros(period, bool)
        on[list(cover)] = True
        size = self.size[self.doc]
        place = np.flatnonzero(on[self.at % period] & (size >= window) & (self.at + length <= size))
        return place, self.doc[place], self.window(place, length, 0)


def _pairs(doc: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs."""
    order = np.lexsort((value, doc))
    doc, value = doc[order], value[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
    return doc[new], value[new]


def _lists(column: pa.Array, first: int, last: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers and row numbers of a list column's rows ``first`` to ``last`` (null: none)."""
    part = column.slice(first, last - first)
    flat = part.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
    lengths = pc.fill_null(pc.list_value_length(part), 0).to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(last - first), lengths), flat


def _listed(doc: np.ndarray, value: np.ndarray, list_doc: np.ndarray, list_value: np.ndarray) -> np.ndarray:
    """Whether each (doc, value) is in the lists."""
    if not len(list_value) or not len(value):
        return np.zeros(len(value), bool)
    values, inverse = np.unique(list_value, return_inverse=True)
    at = np.minimum(np.searchsorted(values, value), len(values) - 1)
    known = values[at] == value
    n = np.int64(len(values))
    return known & np.isin(doc * n + at, list_doc * n + inverse)


def _anchor_rows(parts, window, period, cover) -> Iterator[pa.RecordBatch]:
    for b in parts:
        rows, texts = b.column("row"), b.column("text")
        for first, last in text_groups(texts):
            _, doc, value = _Words(texts, first, last).hashed().anchors(window, period, cover)
            doc, value = _pairs(doc, value)
            yield pa.RecordBatch.from_arrays([pa.array(value.view(np.int64)), rows.take(pa.array(doc + first))],
                                             ["anchor", "row"])


def _window_rows(parts, window, period, cover) -> Iterator[pa.RecordBatch]:
    """The windows that hold a shared anchor."""
    length = window - period + 1
    for b in parts:
        rows, texts, lists = b.column("row"), b.column("text"), b.column("anchors")
        for first, last in text_groups(texts):
            w = _Words(texts, first, last).hashed()
            place, doc, value = w.anchors(window, period, cover)
            place = place[_listed(doc, value, *_lists(lists, first, last))]
            # a window holds an anchor at its places 0 .. window - length
            edge = np.zeros(w.n + 1, np.int64)
            np.add.at(edge, np.maximum(place - (window - length), w.before[:-1][w.doc[place]] if len(place) else 0), 1)
            np.add.at(edge, place + 1, -1)
            start = np.flatnonzero((np.cumsum(edge[:-1]) > 0) & (w.at + window <= w.size[w.doc]))
            h1, h2, of = w.window(start, window, 0), w.window(start, window, 1) >> np.uint64(32), w.doc[start]
            order = np.lexsort((h2, h1, of))
            new = np.ones(len(order), bool)
            new[1:] = ((np.diff(of[order]) != 0) | (h1[order][1:] != h1[order][:-1]) | (h2[order][1:] != h2[order][:-1]))
            keep = order[new]
            yield pa.RecordBatch.from_arrays(
                [pa.array(h1[keep].view(np.int64)), pa.array(h2[keep].astype(np.uint32).view(np.int32)),
                 rows.take(pa.array(of[keep] + first))], ["h1", "h2", "row"])


def _kept_rows(parts, window) -> Iterator[pa.RecordBatch]:
    for b in parts:
        rows, texts, lists = b.column("row"), b.column("text"), b.column("windows")
        copies = b.column("is_copy").to_numpy(zero_copy_only=False)
        for first, last in text_groups(texts):
            w = _Words(texts, first, last)
            copy = copies[first:last].astype(bool) & (w.size >= window)
            gone = np.zeros(w.n, bool)
            list_doc, list_value = _lists(lists, first, last)
            if len(list_value):
                w.hashed()
                place = np.flatnonzero(w.at + window <= w.size[w.doc])
                hit = place[_listed(w.doc[place], w.window(place, window, 0), list_doc, list_value)]
                edge = np.zeros(w.n + 1, np.int64)
                np.add.at(edge, hit, 1)
                np.add.at(edge, hit + window, -1)
                gone = np.cumsum(edge[:-1]) > 0
            gone |= np.repeat(copy, w.size)
            gone_upto = np.r_[0, np.cumsum(gone)]
            removed = np.diff(gone_upto[w.before])
            # kept words side by side, a space after each
            width = np.diff(w.starts)
            stay = ~gone
            out = np.full(int((width[stay] + 1).sum()), 0x20, np.uint8)
            byte_stays = np.repeat(stay, width)
            kept_no = np.cumsum(stay) - 1
            out[np.arange(int(byte_stays.sum())) + np.repeat(kept_no[stay], width[stay])] = w.packed[byte_stays]
            ends = np.r_[0, np.cumsum(np.where(stay, width + 1, 0))][w.before].tolist()
            raw = memoryview(out.tobytes())
            sha = [hashlib.sha256(raw[a:max(a, e - 1)]).hexdigest() for a, e in zip(ends, ends[1:])]
            yield pa.RecordBatch.from_arrays(
                [rows.slice(first, last - first), pa.array(w.size.astype(np.int64)), pa.array(removed.astype(np.int64)),
                 pa.array(sha, pa.string())], ["row", "n_words", "n_removed", "kept_sha256"])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 50,
                   period: int = PERIOD, cover: tuple = COVER) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_removed, kept_sha256``.

    Words are maximal runs without ASCII white space.  A word goes if it is
    covered by ``window`` consecutive words whose sequence also starts in a
    document with a smaller id; windows are judged on the input.
    ``kept_sha256`` is over the words that stay, joined by one space.  Null
    and empty texts have no words; texts shorter than the window lose none;
    rows with equal ids don't affect each other; a null id is larger than any
    other (its rows don't affect each other either); an empty table gives no
    rows; other columns are ignored.
    """
    check_cover(cover, period)
    if window - period + 1 < 1:
        raise ValueError("the window must be at least as long as the period")
    src = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text")).withColumn(
        "digest", F.unhex(F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)))
    # a row is its id and some bits of its text's digest, ordered by id: lists are gathered by row, so that one id on
    # many rows, or a null id, makes no large group
    least, most = src.agg(F.min("doc_id"), F.max("doc_id")).first()
    bits = F.xxhash64("digest").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    no_id = (1 << 63 - ROW_BITS) - 1  # larger than any id
    if least is None or (least >= 0 and most < no_id):
        row = F.shiftleft(F.coalesce("doc_id", F.lit(no_id)), ROW_BITS).bitwiseOR(bits)

        def doc_of(r):
            return F.shiftright(r, ROW_BITS)
    else:
        row = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", bits.alias("bits"))

        def doc_of(r):
            return F.struct(r["unnamed"], r["doc_id"])
    src = src.select(row.alias("row"), "text", "digest")
    kind = src.schema["row"].dataType.simpleString()
    ids = src.select("row", "digest")
    originals = ids.groupBy("digest").agg(F.min("row").alias("original"), F.count("*").alias("n")).filter("n > 1")
    copies = (join_grouped(ids, originals, ["digest"]).filter(doc_of(F.col("row")) > doc_of(F.col("original")))
              .select("row").distinct().withColumn("is_copy", F.lit(True)))
    texts = src.join(copies, "row", "left").select("row", "text", F.coalesce("is_copy", F.lit(False)).alias("is_copy"))
    own = texts.filter("not is_copy")

    # an anchor counts once per row, so rows of one id may mark too much, never too little
    anchors = own.select("row", "text").mapInArrow(
        lambda parts: _anchor_rows(parts, window, period, cover), f"anchor bigint, row {kind}")
    shared = anchors.groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1").select("anchor")
    marked = join_grouped(anchors, shared, ["anchor"]).groupBy("row").agg(F.collect_set("anchor").alias("anchors"))

    windows = own.join(marked, "row").select("row", "text", "anchors").mapInArrow(
        lambda parts: _window_rows(parts, window, period, cover), f"h1 bigint, h2 int, row {kind}")
    earliest = (windows.groupBy("h1", "h2").agg(F.min("row").alias("first"), F.count("*").alias("n"))
                .filter("n > 1").select("h1", "h2", "first"))
    repeated = (join_grouped(windows, earliest, ["h1", "h2"]).filter(doc_of(F.col("row")) > doc_of(F.col("first")))
                .groupBy("row").agg(F.collect_set("h1").alias("windows")))

    out = texts.join(repeated, "row", "left").select("row", "text", "is_copy", "windows").mapInArrow(
        lambda parts: _kept_rows(parts, window), f"row {kind}, n_words bigint, n_removed bigint, kept_sha256 string")
    doc = F.col("row.doc_id") if kind.startswith("struct") else F.when(doc_of(F.col("row")) != no_id, doc_of(F.col("row")))
    return out.select(doc.alias("doc_id"), "n_words", "n_removed", "kept_sha256")
