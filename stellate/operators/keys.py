"""Surrogate keys and key lookups.

``assign_surrogate_keys`` numbers rows by a total order *without* funnelling
them through one partition (a global ``row_number()`` does): the rows are
range-partitioned on the order, each partition is sorted, the per-partition
row counts (one row per partition -- a proven size bound) become offsets,
and the in-partition position comes from ``monotonically_increasing_id``,
which is (partition index << 33) + position.  One shuffle, no driver collect.

The counting and the numbering must see the *same* partitions.  Two
evaluations of a range exchange are not guaranteed to agree (the sampled
bounds are seeded per evaluation) and exchange reuse is only an
optimisation, so the sorted, range-partitioned rows become one checkpointed
Dataset: a single RDD with a single partitioner (bounds sampled once), which
both branches read.  The checkpoint files go to the cluster's shared
checkpoint dir, so a lost executor re-reads them instead of recomputing.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stellate.functions.sizes import measured, parse_bytes
from stellate.session import shared_dir

_PID, _MID, _OFF = "_sk_pid", "_sk_mid", "_sk_off"


def _default_partitions(df: DataFrame) -> int:
    try:
        return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    except (TypeError, ValueError):
        return 200


# Inputs with at most this many rows and bytes (measured first, in one pass)
# are numbered by one ordered window in a single task; override with
# stellate.keys.singleTaskRows and stellate.keys.singleTaskBytes.
DEFAULT_SINGLE_TASK_ROWS = 1_000_000
DEFAULT_SINGLE_TASK_BYTES = 64 * 1024 * 1024


def _single_task_rows(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("stellate.keys.singleTaskRows", str(DEFAULT_SINGLE_TASK_ROWS)))


def _fits_one_task(df: DataFrame) -> bool:
    """Whether ``df``'s measured rows and bytes are within the bounds of one task."""
    rows, size = measured(df)
    most = parse_bytes(df.sparkSession.conf.get("stellate.keys.singleTaskBytes", str(DEFAULT_SINGLE_TASK_BYTES)))
    return rows <= _single_task_rows(df) and size <= most


def _base_column(base) -> Column:
    if isinstance(base, DataFrame):
        return base.select(F.coalesce(F.col(base.columns[0]).cast("bigint"), F.lit(0))).scalar()
    return F.lit(int(base or 0)).cast("bigint")


def assign_surrogate_keys(df: DataFrame, order_cols, sk_col: str = "sk",
                          base: DataFrame | int | None = 0,
                          num_partitions: int | None = None, strategy: str = "auto") -> DataFrame:
    """Add ``sk_col`` = base + 1, base + 2, ... following ``order_cols``.

    ``order_cols`` must be a total order over ``df`` (e.g. the natural key)
    so the numbering is deterministic and survives task retries.
    ``base`` is an int, or a one-row DataFrame whose single column holds the
    offset (e.g. ``max(sk)`` of the existing dimension).

    ``strategy``: ``range`` (distributed, below), ``single`` (one ordered
    window -- only for inputs known to be small), or ``auto``: measure the
    input and use ``single`` when its rows and bytes are within the bounds of
    one task (``stellate.keys.singleTaskRows``, ``...Bytes``), else ``range``.
    """
    order_cols = [order_cols] if isinstance(order_cols, (str, Column)) else list(order_cols)
    if strategy == "auto":
        strategy = "single" if _fits_one_task(df) else "range"
    if strategy == "single":
        w = Window.orderBy(*order_cols)
        return df.withColumn(sk_col, (_base_column(base) + F.row_number().over(w)).cast("bigint"))
    # A fixed partition count (AQE never coalesces a REPARTITION_BY_NUM
    # shuffle) and one checkpointed Dataset: the counting branch and the
    # numbering branch read the same partitions in the same order.
    ranged = (df.repartitionByRange(num_partitions or _default_partitions(df), *order_cols)
              .sortWithinPartitions(*order_cols))
    shared_dir(df.sparkSession)  # make sure a checkpoint dir exists (tests / local runs)
    ranged = ranged.checkpoint(eager=False)
    numbered = (ranged
                .withColumn(_PID, F.spark_partition_id())
                .withColumn(_MID, F.monotonically_increasing_id()))
    counts = numbered.groupBy(_PID).agg(F.count(F.lit(1)).alias("_n"))
    # the offsets table has one row per partition: a single-partition window
    # over it is bounded by the partition count, not by the data.
    w = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(_PID, F.coalesce(F.sum("_n").over(w), F.lit(0)).alias(_OFF))
    # the base is one value, evaluated once (a scalar subquery for a frame)
    offsets = offsets.withColumn(_OFF, F.col(_OFF) + _base_column(base))
    pos = F.col(_MID) - F.shiftleft(F.col(_PID).cast("bigint"), 33)
    return (numbered.join(F.broadcast(offsets), _PID)
            .withColumn(sk_col, (F.col(_OFF) + pos + 1).cast("bigint"))
            .drop(_PID, _MID, _OFF))


def key_map(df: DataFrame, keys, sk_col: str = "sk", base: DataFrame | int | None = 0,
            num_partitions: int | None = None) -> DataFrame:
    """Natural key -> surrogate key map, numbered on the key columns alone:
    only the keys are shuffled and checkpointed, however wide ``df`` is."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return assign_surrogate_keys(df.select(*keys), keys, sk_col, base, num_partitions)


def with_surrogate_keys(df: DataFrame, keys, sk_col: str = "sk", base: DataFrame | int | None = 0) -> DataFrame:
    """``df`` plus its surrogate key, via ``key_map`` joined back on the key."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.join(key_map(df, keys, sk_col, base), keys)


def max_key(df: DataFrame, sk_col: str) -> DataFrame:
    """One-row DataFrame with max(sk) (0 when empty), for ``base=``."""
    return df.agg(F.coalesce(F.max(sk_col), F.lit(0)).cast("bigint").alias("max_sk"))


def extend_surrogate_keys(existing: DataFrame, incoming: DataFrame, keys,
                          sk_col: str = "sk") -> DataFrame:
    """Key map (natural keys + sk) for ``existing`` plus new keys of
    ``incoming``, numbered above the existing maximum in key order."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    old = existing.select(*keys, sk_col)
    new = incoming.select(*keys).distinct().join(old.select(*keys), keys, "left_anti")
    return old.unionByName(assign_surrogate_keys(new, keys, sk_col, base=max_key(existing, sk_col)))


def fill_surrogate_keys(df: DataFrame, order_cols, sk_col: str = "sk",
                        base: DataFrame | int | None = None, strategy: str = "auto") -> DataFrame:
    """Give rows whose ``sk_col`` is NULL (new rows / new versions of a merge)
    keys above ``base`` (default: the largest key already in ``df``),
    numbered in ``order_cols`` order; rows with a key keep it.

    Only the keyless rows are range-partitioned and checkpointed; ``df`` is
    read twice (keyed / keyless), so pass a checkpointed or published frame
    when it is expensive to recompute."""
    order_cols = [order_cols] if isinstance(order_cols, str) else list(order_cols)
    have = df.filter(F.col(sk_col).isNotNull())
    need = df.filter(F.col(sk_col).isNull()).drop(sk_col)
    if base is None:
        base = max_key(have, sk_col)
    numbered = assign_surrogate_keys(need, order_cols, sk_col, base=base, strategy=strategy)
    return have.unionByName(numbered.select(*df.columns))


def single_task_bound(rows_upper_bound: DataFrame) -> str:
    """``single`` when ``rows_upper_bound`` -- a frame at least as large as
    the rows to number, e.g. a merge's source for its new versions -- is
    within the bounds of one task, else ``range``."""
    return "single" if _fits_one_task(rows_upper_bound) else "range"


def lookup_key(fact: DataFrame, dim: DataFrame, fact_cols, dim_cols, sk_col: str,
               out_col: str | None = None, how: str = "inner") -> DataFrame:
    """Replace natural key ``fact_cols`` by the dimension's surrogate key.

    ``how='inner'`` drops unmatched facts (the reference behaviour); use
    ``unmatched`` to report them.  Join strategy is left to the planner:
    AQE turns it into a broadcast join when the key map is small at run
    time and splits skewed partitions otherwise.
    """
    fact_cols = [fact_cols] if isinstance(fact_cols, str) else list(fact_cols)
    dim_cols = [dim_cols] if isinstance(dim_cols, str) else list(dim_cols)
    out_col = out_col or sk_col
    m = dim.select(*[F.col(d).alias(f) for d, f in zip(dim_cols, fact_cols)], F.col(sk_col).alias(out_col))
    return fact.join(m, fact_cols, how)


def unmatched(fact: DataFrame, dim: DataFrame, fact_cols, dim_cols) -> DataFrame:
    """Fact rows whose natural key is NULL or has no dimension row."""
    fact_cols = [fact_cols] if isinstance(fact_cols, str) else list(fact_cols)
    dim_cols = [dim_cols] if isinstance(dim_cols, str) else list(dim_cols)
    m = dim.select(*[F.col(d).alias(f) for d, f in zip(dim_cols, fact_cols)])
    # NULL keys never match; they bypass the join instead of all hashing into
    # one shuffle partition.
    any_null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in fact_cols])
    return fact.filter(any_null).unionByName(fact.filter(~any_null).join(m, fact_cols, "left_anti"))
