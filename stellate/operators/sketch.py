"""Sketches of key columns, so that an audit reads old folders only where it must.

A sketch is a bitmap of hashed keys (a Bloom filter with two bits a key and
about sixteen bits of room for each): a key whose bits aren't both set is
certainly absent.  It is a small table of bitmap pieces, built and probed by
built-in functions: a probe meets its piece by an equality join.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stellate.operators.audit import duplicate_keys, orphans
from stellate.operators.merge import _as_list, choose_strategy

PIECE_BITS = 32768   # of a bitmap row, as bitmap_construct_agg makes it
ROOM = 16            # bits for each key
SEEDS = (0, 1)
FOLDER = "_folder"


def sketch_bits(rows: int) -> int:
    """Bits of a sketch for ``rows`` keys: a power of two, one piece at least."""
    return 1 << max(PIECE_BITS.bit_length() - 1, (max(1, rows) * ROOM - 1).bit_length())


def _place(keys: list, bits: int, seed: int) -> Column:
    return F.pmod(F.xxhash64(*keys, F.lit(seed)), F.lit(bits)) + 1  # pieces count from 1


def _not_null(keys: list) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def key_sketch(df: DataFrame, keys, bits: int) -> DataFrame:
    """``bits, piece, bitmap`` of the keys that hold no NULL."""
    keys = _as_list(keys)
    places = F.explode(F.array(*[_place(keys, bits, s) for s in SEEDS]))
    return (df.filter(_not_null(keys)).select(places.alias("place"))
            .groupBy(F.bitmap_bucket_number("place").alias("piece"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bitmap"))
            .select(F.lit(bits).cast("bigint").alias("bits"), "piece", "bitmap"))


def maybe_in(keys_df: DataFrame, keys, sketch: DataFrame) -> DataFrame:
    """The distinct keys that a sketch doesn't rule out, with the folder of
    each sketch that doesn't (``_folder``); sketches may differ in size."""
    keys = _as_list(keys)
    sizes = [r["bits"] for r in sketch.select("bits").distinct().collect()]  # a few powers of two
    if not sizes:
        return keys_df.select(*keys, F.lit("").alias(FOLDER)).limit(0)
    key = F.struct(*keys).alias("_key")  # a key may be named like a sketch's column
    sought = keys_df.filter(_not_null(keys)).select(*keys).distinct()
    probes = F.explode(F.array(*[F.struct(F.lit(b).cast("bigint").alias("bits"), _place(keys, b, s).alias("place"), F.lit(s).alias("seed"))
                                 for b in sizes for s in SEEDS]))
    at = sought.select(key, probes.alias("p")).select("_key", "p.bits", "p.seed", F.bitmap_bucket_number("p.place").alias("piece"),
                                                      F.bitmap_bit_position("p.place").alias("bit"))
    byte = F.conv(F.hex(F.expr("substring(bitmap, cast(bit div 8 as int) + 1, 1)")), 16, 10).cast("int")
    hit = F.expr("shiftleft(1, cast(bit % 8 as int))").bitwiseAND(byte) != 0
    return (at.join(sketch, ["bits", "piece"]).filter(hit).groupBy("_key", "folder").agg(F.count_distinct("seed").alias("n"))
            .filter(F.col("n") == len(SEEDS)).select("_key.*", F.col("folder").alias(FOLDER)))


def maybe_present(keys_df: DataFrame, keys, sketch: DataFrame) -> DataFrame:
    """The distinct keys that the sketch doesn't rule out.  ``sketch`` may hold
    sketches of several folders, each with its own ``folder`` and size."""
    keys = _as_list(keys)
    if "folder" not in sketch.columns:
        sketch = sketch.withColumn("folder", F.lit(""))
    return maybe_in(keys_df, keys, sketch).select(*keys).distinct()


def small(df: DataFrame) -> DataFrame:
    """``df``, to be broadcast if its measured size is under the bound."""
    return F.broadcast(df) if choose_strategy(df) == "broadcast" else df


def new_duplicates(new: DataFrame, keys, old_sketch: DataFrame, old) -> DataFrame:
    """Keys of ``new`` that are there twice, hold a NULL, or are in the old rows
    already.  ``old`` is a function that gives the old rows' keys; it is called
    only if the sketch leaves candidates, and only those are compared."""
    keys = _as_list(keys)
    own = duplicate_keys(new, keys).select(*keys)
    candidates = maybe_present(new, keys, old_sketch)
    if not candidates.limit(1).count():
        return own
    again = old().select(*keys).join(small(candidates), keys, "left_semi").distinct()
    return own.unionByName(again).distinct()


def new_orphans(new: DataFrame, fk_cols, parent: DataFrame, pk_cols, gone: DataFrame, old_sketch: DataFrame, old) -> DataFrame:
    """Child rows that have no parent and had one, or weren't there, before the
    load: new rows are checked against the parent, old ones only for the keys
    ``gone`` from it, and only where the old references' sketch has them."""
    fk_cols, pk_cols = _as_list(fk_cols), _as_list(pk_cols)
    fresh = orphans(new, fk_cols, parent, pk_cols)
    # a hash depends on the type, so the parent's keys are sought as the child holds them
    sought = gone.select(*[F.col(p).try_cast(new.schema[f].dataType).alias(f) for p, f in zip(pk_cols, fk_cols)])
    lost = maybe_present(sought, fk_cols, old_sketch)
    if not lost.limit(1).count():
        return fresh
    return fresh.unionByName(old().join(small(lost), fk_cols, "left_semi").select(*new.columns))
