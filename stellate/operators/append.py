"""Idempotent fact append.

The reference appends the whole join result on every run, so a rerun
doubles the fact.  ``new_rows`` keeps only batch rows whose key is not yet in
the fact.  With ``range_col`` (the fact's date / partition column, which must
be part of the key) the existing fact is first cut to the batch's
[min, max] of that column, and batch rows outside the existing fact's
[min, max] are new as they are, so the anti join reads and shuffles only the
overlapping slices instead of the whole history and the whole batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stellate.operators.merge import choose_strategy


def new_rows(batch: DataFrame, existing: DataFrame, key_cols, range_col: str | None = None,
             strategy: str = "auto") -> DataFrame:
    """Batch rows whose key is not in ``existing``.  Keys are compared
    NULL-safely: a row with a NULL in its key meets its own copy.

    With a batch whose measured size is under the broadcast bound, the
    existing fact is probed with ``LEFT SEMI JOIN broadcast(batch keys)``
    (a scan, no shuffle of the fact); the keys found -- at most the batch's
    -- are then removed from the batch.  Otherwise one anti sort-merge join.
    """
    key_cols = [key_cols] if isinstance(key_cols, str) else list(key_cols)
    if range_col is not None:
        if range_col not in key_cols:
            raise ValueError("range_col must be part of the key")
        c = F.col(range_col)  # rows without a date meet a batch's rows without one

        def within(df: DataFrame) -> Column:
            lo, hi = df.agg(F.min(range_col)).scalar(), df.agg(F.max(range_col)).scalar()
            return F.coalesce((c >= lo) & (c <= hi), c.isNull())
        met = within(existing)
        existing, outside, batch = existing.filter(within(batch)), batch.filter(~met), batch.filter(met)
        return outside.unionByName(new_rows(batch, existing, key_cols, strategy=strategy))
    same = F.expr(" AND ".join(f"a.`{k}` <=> b.`{k}`" for k in key_cols))
    keys = batch.select(*key_cols)
    if choose_strategy(keys, strategy) == "broadcast":
        seen = existing.select(*key_cols).alias("a").join(F.broadcast(keys).alias("b"), same, "left_semi").distinct()
        return batch.alias("a").join(F.broadcast(seen).alias("b"), same, "left_anti")
    return batch.alias("a").join(existing.select(*key_cols).alias("b"), same, "left_anti")


def append_idempotent(batch: DataFrame, existing: DataFrame, key_cols, range_col: str | None = None,
                      batch_col: str | None = None, strategy: str = "auto") -> DataFrame:
    """The fact after the load: existing rows plus the batch's new rows
    (optionally tagged in ``batch_col`` as 'existing' / 'appended')."""
    add = new_rows(batch, existing, key_cols, range_col, strategy)
    if batch_col:
        return (existing.withColumn(batch_col, F.lit("existing"))
                .unionByName(add.withColumn(batch_col, F.lit("appended"))))
    return existing.unionByName(add)
