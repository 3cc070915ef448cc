"""Shared helpers of the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stellate.session import shared_dir


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def crc_mod(id_col: str, n: int) -> Column:
    """crc32 of the id as text, modulo ``n`` (null id: null)."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % n


def row_key(id_col: str, text_col: str) -> Column:
    """A digest of a row's id and text, never null (a null text is like an empty one)."""
    return F.unhex(F.sha2(F.concat(F.coalesce(F.col(id_col).cast("bigint").cast("string"), F.lit("null")), F.lit(" "),
                                   F.coalesce(F.col(text_col).cast("string"), F.lit(""))).cast("binary"), 256))


def stage_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the cluster's shared checkpoint dir."""
    return f"{shared_dir(spark, 'stage')}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write to the shared folder and read back, so a lost
    executor costs no recomputation of what came before."""
    spark = df.sparkSession
    path = stage_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def join_grouped(left: DataFrame, grouped: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """``left`` with the one row that ``grouped`` has for its keys.

    The first key is compared in another form than ``grouped`` was grouped by.
    The join then has an exchange of its own on both sides, and adaptive
    execution can split a hot key's partition; it can't where the partitions
    of the aggregate are used again."""
    key, kind = keys[0], left.schema[keys[0]].dataType.typeName()
    there, back = {"binary": (F.hex, F.unhex), "string": (F.reverse, F.reverse)}.get(kind, (F.bitwise_not, F.bitwise_not))
    joined = left.withColumn(key, there(key)).join(grouped.withColumn(key, there(key)), keys, how)
    return joined.withColumn(key, back(key))


def joined_texts(column: pa.Array, lead: bytes = b"", first: int = 0, last: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of texts ``first`` to ``last`` side by side, ``lead``
    before each that is neither null nor empty, and the n+1 offsets."""
    texts = column.slice(first, None if last is None else last - first).cast(pa.binary()).to_pylist()
    texts = [lead + t if t else b"" for t in texts] if lead else [t or b"" for t in texts]
    return np.frombuffer(b"".join(texts), np.uint8), ragged_starts(np.fromiter(map(len, texts), np.int64, len(texts)))


def text_groups(column: pa.Array, limit: int = 1 << 22) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose texts together have about ``limit`` bytes (a longer text stands alone)."""
    size = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    first, total = 0, 0
    for i, n in enumerate(size.tolist()):
        if total and total + n > limit:
            yield first, i
            first, total = i, 0
        total += n
    if first < len(size):
        yield first, len(size)


def distinct(packed: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """Byte strings that lie side by side in ``packed``: the number of each
    one's value, and the distinct values."""
    if len(starts) < 2:
        return np.zeros(0, np.int32), []
    rows = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(starts) - 1,
        [None, pa.py_buffer(np.ascontiguousarray(starts, np.int64)), pa.py_buffer(np.ascontiguousarray(packed))])
    coded = rows.dictionary_encode()
    return coded.indices.to_numpy(), coded.dictionary.to_pylist()


def words(data: np.ndarray, doc_starts: np.ndarray, in_word: np.ndarray,
          cut: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of bytes with ``in_word[byte]`` inside each text: the
    words' bytes side by side, their offsets there, and the number of words
    before each text (n+1 offsets).  ``cut`` (65,536 flags) parts a run
    between byte a and byte b where ``cut[256 * a + b]``."""
    word = in_word[data]
    first = word.copy()
    first[1:] &= ~word[:-1]
    if cut is not None:
        first[1:] |= word[1:] & cut[data[:-1].astype(np.int32) * 256 + data[1:]]
    begins = doc_starts[:-1][doc_starts[:-1] < doc_starts[1:]]
    first[begins] = word[begins]
    packed = data[word]
    starts = np.append(np.flatnonzero(first[word]), len(packed))
    before = np.searchsorted(np.flatnonzero(first), doc_starts)
    return packed, starts, before


#: bytes other than 0x20 and 0x09-0x0D
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False


def batches(items: Iterable, weight, limit: int) -> Iterator[list]:
    """Consecutive groups of ``items`` whose weights sum to about ``limit``."""
    group, size = [], 0
    for x in items:
        group.append(x)
        size += weight(x)
        if size >= limit:
            yield group
            group, size = [], 0
    if group:
        yield group


class Memo:
    """One computed value per distinct key, forgotten as a whole when it
    would hold more than ``most`` keys.  ``fill(keys)`` computes many values."""

    def __init__(self, fill, most: int):
        self.fill, self.most, self.known = fill, most, {}

    def values(self, keys: list) -> list:
        """The values of distinct ``keys``."""
        if len(self.known) + len(keys) > self.most:
            self.known = {}
        missing = [k for k in keys if k not in self.known]
        if missing:
            self.known.update(zip(missing, self.fill(missing), strict=True))
        return list(map(self.known.__getitem__, keys))


def ragged_starts(lengths: np.ndarray) -> np.ndarray:
    """Offsets [0, l0, l0+l1, ...] of a ragged array."""
    out = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=out[1:])
    return out
