"""Change predicates for dimension merges.

Three NULL semantics are supported (see README):

* ``sentinel``  -- ``coalesce(t, empty) <> coalesce(s, empty)`` where
  *empty* is the column type's empty value ('' / 0 / 1900-01-01 / false /
  empty bytes).  NULL therefore equals the empty value.
* ``sql``       -- plain ``t <> s``; a NULL on either side is never a change.
* ``null_safe`` -- ``NOT (t <=> s)``; NULL differs from every value.
"""

from __future__ import annotations

import datetime as _dt
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

NULL_MODES = ("sentinel", "sql", "null_safe")


def typed_empty(dtype: T.DataType) -> Column:
    """The value an empty literal takes when implicitly converted to ``dtype``."""
    if isinstance(dtype, (T.StringType, T.VarcharType, T.CharType)):
        return F.lit("")
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType,
                          T.FloatType, T.DoubleType, T.DecimalType)):
        return F.lit(0).cast(dtype)
    if isinstance(dtype, T.BooleanType):
        return F.lit(False)
    if isinstance(dtype, T.DateType):
        return F.lit(_dt.date(1900, 1, 1))
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        # from text, so the value does not depend on the driver's time zone
        return F.lit("1900-01-01 00:00:00").cast(dtype)
    if isinstance(dtype, T.BinaryType):
        return F.lit(bytearray())
    raise TypeError(f"no empty value for {dtype}")


def col_changed(t: Column, s: Column, dtype: T.DataType, mode: str = "null_safe") -> Column:
    """One column's change test under ``mode``; may be NULL in ``sql`` mode."""
    if mode == "sentinel":
        e = typed_empty(dtype)
        return F.coalesce(t, e) != F.coalesce(s, e)
    if mode == "sql":
        return t != s
    if mode == "null_safe":
        return ~t.eqNullSafe(s)
    raise ValueError(f"null_mode must be one of {NULL_MODES}, got {mode!r}")


def changed(pairs, mode: str = "null_safe") -> Column:
    """OR of per-column change tests, never NULL.

    ``pairs`` is an iterable of ``(target_col, source_col, dtype)``.
    In ``sql`` mode the OR follows three-valued logic and a NULL result
    counts as "no change", as in a WHERE clause.
    """
    tests = [col_changed(t, s, d, mode) for t, s, d in pairs]
    if not tests:
        return F.lit(False)
    return F.coalesce(reduce(lambda a, b: a | b, tests), F.lit(False))


def binary_changed(t: Column, s: Column, mode: str = "digest", prefix_bytes: int = 30) -> Column:
    """Change test for a blob column.

    ``digest``: SHA-256 of the whole value, NULL-safe.
    ``prefix``: legacy behaviour that compares only the first ``prefix_bytes``
    bytes (a conversion to a default-length text), NULL treated as empty.
    """
    if mode == "digest":
        return ~F.sha2(t, 256).eqNullSafe(F.sha2(s, 256))
    if mode == "prefix":
        tp = F.coalesce(F.hex(F.substring(t, 1, prefix_bytes)), F.lit(""))
        sp = F.coalesce(F.hex(F.substring(s, 1, prefix_bytes)), F.lit(""))
        return tp != sp
    raise ValueError(f"binary mode must be 'digest' or 'prefix', got {mode!r}")
