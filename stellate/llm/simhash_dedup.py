"""SimHash near-duplicates by deletion-variant signatures.

The fingerprint's 64 bits are cut into ``max_distance // 2 + 1`` segments:
of two fingerprints within the distance, one segment differs by one bit at
most.  Every segment is indexed once for each of its bits with that bit left
out (a one-wildcard variant); equal variants are joined and the whole
fingerprints compared.

A variant that many different fingerprints share (a large family of near
copies) is not joined with itself.  Its fingerprints are linked through the
points between them instead: two fingerprints within the distance both lie
within half of it of some common 64-bit value, and all that do so for one
value are within the distance of each other, so each is linked to the least
of them.  That is linear in the family and exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stellate.llm.common import NOT_SPACE, join_grouped, joined_texts, row_key, stage, text_groups, words
from stellate.llm.components import star_components

SEED = 42
BITS = 64
SHINGLES_AT_ONCE = 1 << 15  # whose bits are spread out at once
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32


def fingerprints(texts: pa.Array, shingle: int = 3) -> np.ndarray:
    """SimHash of each text (uint64) over its word shingles, repeats included."""
    out = [np.zeros(0, np.uint64)]
    for first, last in text_groups(texts):
        data, docs = joined_texts(texts, b"", first, last)
        packed, starts, before = words(LOWER[data], docs, NOT_SPACE)
        out.append(_simhash(packed, starts, before, shingle))
    return np.concatenate(out)


def _simhash(packed: np.ndarray, starts: np.ndarray, before: np.ndarray, shingle: int) -> np.ndarray:
    n = len(starts) - 1
    size = np.diff(before)
    # all words, a space after each
    place = starts[:-1] + np.arange(n)
    text = np.full(len(packed) + n, 0x20, np.uint8)
    text[np.arange(len(packed)) + np.repeat(np.arange(n), np.diff(starts))] = packed
    ends = place + np.diff(starts)
    # the first word of each shingle; a text with fewer words is one shingle
    per_doc = np.where(size >= shingle, size - shingle + 1, np.minimum(size, 1))
    offset = np.cumsum(per_doc) - per_doc
    first = np.arange(per_doc.sum()) - np.repeat(offset, per_doc) + np.repeat(before[:-1], per_doc)
    last = first + np.repeat(np.minimum(size, shingle), per_doc) - 1
    raw, digest = text.tobytes(), xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(raw[a:b], SEED) for a, b in zip(place[first].tolist(), ends[last].tolist())),
                         np.uint64, len(first))
    ones = np.zeros((len(size), BITS), np.int64)
    doc = np.repeat(np.arange(len(size)), per_doc)
    for a in range(0, len(hashes), SHINGLES_AT_ONCE):
        block, owner = hashes[a:a + SHINGLES_AT_ONCE], doc[a:a + SHINGLES_AT_ONCE]
        bits = np.unpackbits(block.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        first_of = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        ones[owner[first_of]] += np.add.reduceat(bits, first_of, axis=0, dtype=np.int64)
    over = (2 * ones > per_doc[:, None]).astype(np.uint8)
    return np.packbits(over, axis=1, bitorder="little").view("<u8").ravel()


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _one_bit() -> Column:
    """1 << bit as bigint."""
    return F.expr("shiftleft(1L, bit)")


def _variants(fps: DataFrame, max_distance: int) -> DataFrame:
    """``bit, part, fp``: the segment of ``fp`` that holds ``bit``, without that bit."""
    segments = max_distance // 2 + 1
    edges = [BITS * s // segments for s in range(segments + 1)]
    masks = [_signed((1 << b) - (1 << a)) for a, b in zip(edges, edges[1:]) for _ in range(a, b)]
    lowest = [a for a, b in zip(edges, edges[1:]) for _ in range(a, b)]
    table = F.array(*[F.struct(F.lit(i).alias("bit"), F.lit(m).cast("bigint").alias("mask"), F.lit(f).alias("low"))
                      for i, (m, f) in enumerate(zip(masks, lowest))])
    return (fps.select("fp", F.explode(table).alias("x")).select("fp", "x.*")
            .withColumn("part", F.col("fp").bitwiseAND(F.col("mask")).bitwiseAND(F.bitwise_not(_one_bit()))))


def _links(fps: DataFrame, max_distance: int, most: int) -> DataFrame:
    """Links ``u, v`` that connect exactly what pairs within the distance connect."""
    variants = _variants(fps, max_distance)
    shared = variants.groupBy("bit", "part").agg(F.count("*").alias("n")).filter("n > 1")
    members = stage(join_grouped(variants, shared, ["part", "bit"]).select("bit", "part", "mask", "low", "fp", "n"), "simhash-members")
    few = members.filter(F.col("n") <= most)
    a = few.select("bit", "part", "mask", "low", F.col("fp").alias("u"))
    b = few.select("bit", "part", F.col("fp").alias("v"))
    differ = F.col("u").bitwiseXOR(F.col("v"))
    # of the variants that bring a pair together, the one of its own differing bit
    # counts, or the segment's lowest if the segment is equal
    own = F.when(differ.bitwiseAND(F.col("mask")) == 0, F.col("bit") == F.col("low")).otherwise(
        differ.bitwiseAND(F.col("mask")) == _one_bit())
    near = (a.join(b, ["bit", "part"]).filter(F.col("u") < F.col("v"))
            .filter(own & (F.bit_count(differ) <= max_distance)).select("u", "v"))
    crowd = members.filter(F.col("n") > most).select("fp").distinct()
    flips = F.array(*[F.lit(_signed(1 << i)).cast("bigint") for i in range(BITS)])
    # radius max_distance // 2 around a point; with an odd distance one more bit is left out
    if max_distance >= 2:
        around = crowd.select("fp", F.explode(F.concat(F.array(F.lit(0).cast("bigint")), flips)).alias("flip")).select(
            "fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("point"))
    else:
        around = crowd.select("fp", F.col("fp").alias("point"))
    if max_distance % 2:
        around = around.select("fp", "point", F.posexplode(flips).alias("bit", "flip")).select(
            "fp", "bit", F.col("point").bitwiseAND(F.bitwise_not(F.col("flip"))).alias("point"))
    else:
        around = around.withColumn("bit", F.lit(-1))
    around = around.distinct()
    least = around.groupBy("bit", "point").agg(F.min("fp").alias("m"), F.count("*").alias("c")).filter("c > 1")
    through = join_grouped(around, least, ["point", "bit"]).filter("fp <> m").select(F.col("m").alias("u"), F.col("fp").alias("v"))
    return near.union(through).distinct()


def _fingerprinted(src: DataFrame, keys: dict[str, str], shingle: int) -> DataFrame:
    """``src`` (keys and ``text``) with ``fp`` in place of the text."""
    names = list(keys)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts:
            fp = fingerprints(b.column("text"), shingle).view(np.int64)
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in names), pa.array(fp)], [*names, "fp"])

    return stage(src.select(*names, "text").mapInArrow(run, ", ".join(f"{k} {t}" for k, t in keys.items()) + ", fp bigint"),
                 "simhash-fp")


def _rooted(fps: DataFrame, max_distance: int, most: int) -> DataFrame:
    """``fps`` (one row per ``fp``) with the ``root`` of its group."""
    # a fingerprint becomes 64 variants: small as the table is, it is dealt to as many tasks as a shuffle has (by
    # another form of the key: a repartition by the key that it was grouped by would be left out as redundant)
    dealt = fps.select("fp").repartition(int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions")), F.bitwise_not("fp"))
    stars = star_components(_links(dealt, max_distance, most), "simhash")
    return (fps.join(stars, fps["fp"] == stars["node"], "left")
            .select(*fps.columns, F.coalesce("root", "fp").alias("root")))


def group_firsts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                 max_distance: int = 2, most_in_variant: int = 32) -> DataFrame:
    """One row per ``key`` (see ``row_key``): ``n_rows`` that have it, and
    ``is_first``, true for one key of each group of ``simhash_groups``: that of
    its row with the least id, and of those the least key.  A null id comes
    after all others."""
    if not 0 <= max_distance <= 3:
        raise ValueError("max_distance must be 0 to 3")
    src = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                      row_key(id_col, text_col).alias("key"))
    rows = _fingerprinted(src, {"doc_id": "bigint", "key": "binary"}, shingle)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "key")).alias("first")
    rooted = _rooted(rows.groupBy("fp").agg(first), max_distance, most_in_variant)
    firsts = rooted.groupBy("root").agg(F.min("first").alias("first")).select("first.key", F.lit(True).alias("is_first"))
    counted = rows.groupBy("key").agg(F.count("*").alias("n_rows"))
    return counted.join(firsts, "key", "left").select("key", "n_rows", F.coalesce("is_first", F.lit(False)).alias("is_first"))


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                   max_distance: int = 2, most_in_variant: int = 32) -> DataFrame:
    """One row per document: ``doc_id, fingerprint, component_id``.

    ``fingerprint`` is 16 lowercase hex digits; documents whose fingerprints
    differ in ``max_distance`` (0 to 3) bits or fewer are linked, and
    ``component_id`` is the least doc_id reachable over links.  Null and empty
    texts, and texts of white space, have fingerprint zero and are linked like
    any other; a null id takes part but is never a component's name unless all
    ids of the component are null (then null); repeated rows stay; an empty
    table gives no rows; other columns are ignored.  ``most_in_variant`` only
    chooses how a variant's fingerprints are linked, never whether.
    """
    if not 0 <= max_distance <= 3:
        raise ValueError("max_distance must be 0 to 3")
    src = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = _fingerprinted(src, {"doc_id": "bigint"}, shingle)
    rooted = _rooted(rows.groupBy("fp").agg(F.min("doc_id").alias("doc")), max_distance, most_in_variant)
    named = rooted.groupBy("root").agg(F.min("doc").alias("component_id"))
    of_fp = rooted.join(named, "root").select("fp", "component_id")
    return rows.join(of_fp, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
