"""foreachBatch driver for dimension loads.

Each micro-batch of landed rows is reduced to one row per key, merged into
the table's current snapshot with the chosen SCD operator, audited, and
published as a new snapshot.  The merges are idempotent (re-applying the
same batch changes nothing), so a micro-batch that is replayed after a
failure leaves the same result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stellate.operators import audit
from stellate.operators.merge import scd1
from stellate.operators.scd import scd2, scd3
from stellate.sources.publish import current_snapshot, publish, read_snapshot, warehouse_root


def dedupe_latest(df: DataFrame, keys, order_col: str) -> DataFrame:
    """Latest row per key by ``order_col``; ties are broken by the remaining
    columns, so the pick is deterministic (retry-safe).  ``max`` of a struct
    is partially aggregated, so a key that holds a third of the batch is
    reduced inside each task before the shuffle, not in one task."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    others = [c for c in df.columns if c not in keys and c != order_col]
    latest = F.max(F.struct(F.col(order_col), *[F.col(c) for c in others])).alias("_latest")
    return df.groupBy(*keys).agg(latest).select(*keys, *[F.col(f"_latest.{c}") for c in df.columns if c not in keys])


def merge_loader(table: str, keys, tracked, kind: str = "scd1", as_of=None, order_col: str | None = None,
                 root: str | None = None, initial: Callable[[DataFrame], DataFrame] | None = None,
                 current_col: str = "is_current", **kwargs) -> Callable[[DataFrame, int], None]:
    """Build a ``foreachBatch`` function that merges each batch into ``table``.

    ``kind`` is ``scd1`` / ``scd2`` / ``scd3``; ``initial`` turns the first
    batch into the table's first image when nothing is published yet.

    A micro-batch is never the whole source, so a key that it lacks is kept
    (``delete_missing=True`` is refused).  ``as_of`` is the load's date, or a
    function of (batch, epoch) that gives each batch's; ``scd2`` and ``scd3``
    need it.  A second change under one date replaces the first (see
    ``scd2``).  Every batch is published on top of the snapshot that it was
    merged into: a concurrent load of the same table makes it fail, and the
    stream replays it.

    ``scd2`` writes only current and newly closed versions; versions that
    were closed before stay in the folders where they are.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    if kind not in ("scd1", "scd2", "scd3"):
        raise ValueError(f"unknown kind {kind!r}")
    if kwargs.get("delete_missing"):
        raise ValueError("a micro-batch is not the whole source: delete_missing would empty the dimension")
    if kind == "scd1":
        kwargs["delete_missing"] = False
    elif as_of is None:
        raise ValueError(f"{kind} needs as_of, the date of the load or a function of the batch")

    def load(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        where = root or warehouse_root(spark)
        src = dedupe_latest(batch, keys, order_col).drop(order_col) if order_col else batch
        date = as_of(batch, epoch_id) if callable(as_of) else as_of
        base = current_snapshot(spark, table, where)
        if base is None:
            out = initial(src) if initial else src
        elif kind == "scd1":
            out = scd1(read_snapshot(spark, table, base, where), src, keys, tracked, **kwargs)
        elif kind == "scd2":
            out = scd2(read_snapshot(spark, table, base, where), src, keys, tracked, date, current_col=current_col,
                       with_closed=False, **kwargs)
        else:
            out = scd3(read_snapshot(spark, table, base, where), src, keys, tracked, as_of=date, **kwargs)
        checks = {"source_key": lambda _w: audit.duplicate_keys(src, keys)}
        if kind == "scd2":
            checks["one_current_version"] = lambda w: audit.unique_among(w, keys, current_col)
            publish(out, table, checks, where, base=base, keep=base, flag=current_col)
        else:
            checks["primary_key"] = lambda w: audit.duplicate_keys(w, keys)
            publish(out, table, checks, where, base=base)

    return load


def run_incremental(stream: DataFrame, load: Callable[[DataFrame, int], None], checkpoint_location: str,
                    available_now: bool = True):
    """Start the streaming query; ``available_now`` processes what has landed
    and stops (a scheduled batch), otherwise it keeps running."""
    w = stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint_location)
    w = w.trigger(availableNow=True) if available_now else w
    return w.start()
