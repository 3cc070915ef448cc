"""Measured sizes, the checks behind broadcasts and single-task paths."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# bytes of a value of fixed width
FIXED_WIDTHS = {T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.DateType: 4,
                T.FloatType: 4, T.LongType: 8, T.DoubleType: 8, T.TimestampType: 8, T.TimestampNTZType: 8,
                T.DecimalType: 16}


def row_bytes(schema: T.StructType) -> Column:
    """Bytes of a row: every variable-width value's bytes plus a fixed width per fixed-width value."""
    widths = []
    for f in schema.fields:
        c = F.col(f"`{f.name}`")
        w = next((v for k, v in FIXED_WIDTHS.items() if isinstance(f.dataType, k)), None)
        if w is not None:
            widths.append(F.lit(w))
        elif isinstance(f.dataType, (T.StringType, T.BinaryType)):
            widths.append(F.coalesce(F.octet_length(c), F.lit(0)) + 8)
        else:
            widths.append(F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0)) + 8)
    return reduce(lambda a, b: a + b, widths).cast("bigint")


def measured(df: DataFrame) -> tuple[int, int]:
    """Rows and bytes of ``df``, in one aggregate pass."""
    r = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(row_bytes(df.schema)), F.lit(0))).first()
    return int(r[0]), int(r[1])


def measured_bytes(df: DataFrame) -> int:
    return measured(df)[1]


def parse_bytes(value) -> int:
    """'67108864', '64m', '1g', '512k' -> bytes."""
    text = str(value).strip().lower().rstrip("b")
    scale = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40}.get(text[-1:], 1)
    return int(float(text[:-1] if scale > 1 else text) * scale)
