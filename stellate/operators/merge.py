"""MERGE as a DataFrame operator.

Parquet tables have no row-level MERGE, so the merge is a full outer join on
the business key that classifies every key pair (``merge_action``) and keeps
both images as structs ``t`` (target) and ``s`` (source).  Everything else --
SCD1 overwrite/delete, SCD2 versioning, SCD3 previous values, SCD4 history
and the change feed -- is a projection of that one join.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stellate.functions.predicates import binary_changed, changed
from stellate.functions.sizes import measured_bytes, parse_bytes
from stellate.sources.publish import checkpoint_table

ACTION = "merge_action"
INSERT, UPDATE, DELETE, KEEP = "INSERT", "UPDATE", "DELETE", "KEEP"
_IN_T, _IN_S = "_in_t", "_in_s"


def _as_list(x):
    return [x] if isinstance(x, str) else list(x)


def change_condition(dtypes: dict, tracked, null_mode: str = "null_safe",
                     binary_mode: str = "digest") -> Column:
    """OR of change tests between ``t.<c>`` and ``s.<c>`` for tracked columns."""
    pairs, blobs = [], []
    for c in tracked:
        if isinstance(dtypes[c], T.BinaryType):
            blobs.append(binary_changed(F.col(f"t.{c}"), F.col(f"s.{c}"), binary_mode))
        else:
            pairs.append((F.col(f"t.{c}"), F.col(f"s.{c}"), dtypes[c]))
    cond = changed(pairs, null_mode)
    for b in blobs:
        cond = cond | F.coalesce(b, F.lit(False))
    return cond


# A source at most this large (measured, see ``measured_bytes``) is
# broadcast by the "auto" merge strategy; override per session with
# ``stellate.merge.broadcastBytes``.  Every read of an unstaged merge collects
# its broadcasts at the driver again (a load with its feed: up to nine), so
# the bound is a small part of what the driver takes.
DEFAULT_BROADCAST_BYTES = 8 * 1024 * 1024


def choose_strategy(source: DataFrame, strategy: str = "auto", max_bytes: int | None = None) -> str:
    """``broadcast`` when the measured source fits under the bound, else ``shuffle``."""
    if strategy != "auto":
        return strategy
    if max_bytes is None:
        max_bytes = parse_bytes(source.sparkSession.conf.get("stellate.merge.broadcastBytes",
                                                             str(DEFAULT_BROADCAST_BYTES)))
    return "broadcast" if measured_bytes(source) <= max_bytes else "shuffle"


def _unique_source(s: DataFrame, keys: list) -> DataFrame:
    """``s`` (keys, struct ``s``, marker) with the error of MERGE built into
    the plan: a key that occurs twice fails the query that reads it.  The
    grouping shares its partitions with the merge join."""
    names = ", ".join(keys)
    grouped = s.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.any_value("s").alias("s"))
    one = F.when(F.col("_n") > 1, F.raise_error(F.concat(
        F.lit(f"source key ({names}) occurs more than once: "), F.to_json(F.struct(*keys))))).otherwise(F.lit(True))
    return grouped.select(*keys, "s", one.cast("boolean").alias(_IN_S))


def merge_actions(target: DataFrame, source: DataFrame, keys, tracked=None,
                  null_mode: str = "null_safe", binary_mode: str = "digest",
                  update_when: str | None = None, strategy: str = "auto",
                  broadcast_bytes: int | None = None) -> DataFrame:
    """Classify every (target row, source row) pair of a full outer join on ``keys``.

    Output columns: ``keys``, ``merge_action``, ``t`` (struct of the target's
    other columns, NULL when the key is new), ``s`` (struct of the source's
    other columns, NULL when the key left the source).

    * INSERT -- key only in the source
    * DELETE -- key only in the target (the caller decides whether to drop it)
    * UPDATE -- both present, ``update_when`` (a boolean target column, e.g.
      the current-version flag) holds, and a tracked column changed
    * KEEP   -- anything else

    A target with several rows per key (versions) is allowed: each target row
    gets its own action.  The source must be unique per key: one that occurs
    twice fails the query, under either strategy.

    Strategy (same result either way):

    * ``shuffle`` -- one full outer sort-merge join; both sides shuffle on
      the key.  Used when the source is large.
    * ``broadcast`` -- for a source whose measured size is under
      ``broadcast_bytes``: ``target LEFT OUTER JOIN broadcast(source)``
      classifies every target row, and the inserts are the source keys
      absent from ``target LEFT SEMI JOIN broadcast(source keys)``.  The
      target is scanned (its key column twice) and never shuffled -- the
      shape of a small daily batch against a large dimension.
    * ``auto`` (default) -- measure the source (one aggregate pass) and pick.
    """
    keys = _as_list(keys)
    t_cols = [c for c in target.columns if c not in keys]
    s_cols = [c for c in source.columns if c not in keys]
    tracked = list(tracked) if tracked is not None else [c for c in s_cols if c in t_cols]
    dtypes = {f.name: f.dataType for f in source.schema.fields}
    t = target.select(*keys, F.struct(*t_cols).alias("t"), F.lit(True).alias(_IN_T))
    s = source.select(*keys, F.struct(*s_cols).alias("s"), F.lit(True).alias(_IN_S))
    # Rows with a NULL key match nothing: they bypass the join (a NULL key
    # would otherwise hash every such row into one partition).
    null_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    tk, sk = t.filter(~null_key), _unique_source(s.filter(~null_key), keys)
    if choose_strategy(source, strategy, broadcast_bytes) == "broadcast":
        s_keys = F.broadcast(sk.select(*keys))
        # distinct matched keys are at most the source's keys: a proven bound
        matched = tk.select(*keys).join(s_keys, keys, "left_semi").distinct()
        inserts = sk.join(F.broadcast(matched), keys, "left_anti")
        joined = tk.join(F.broadcast(sk), keys, "left_outer").unionByName(inserts, allowMissingColumns=True)
    else:
        joined = tk.join(sk, keys, "full_outer")
    j = (joined.unionByName(t.filter(null_key), allowMissingColumns=True)
         .unionByName(s.filter(null_key), allowMissingColumns=True))
    chg = change_condition(dtypes, tracked, null_mode, binary_mode)
    if update_when is not None:
        chg = F.coalesce(F.col(f"t.{update_when}"), F.lit(False)) & chg
    action = (F.when(F.col(_IN_T).isNull(), F.lit(INSERT))
              .when(F.col(_IN_S).isNull(), F.lit(DELETE))
              .when(chg, F.lit(UPDATE))
              .otherwise(F.lit(KEEP)))
    return j.select(*keys, action.alias(ACTION), "t", "s")


def split_new(actions: DataFrame, strategy: str) -> tuple[DataFrame, DataFrame]:
    """Inserts and updates, staged in the shared folder, and all other actions.

    What reads both runs the merge once: after a ``shuffle`` merge all actions
    are staged; after a ``broadcast`` merge, which shuffles nothing of the
    target, the new rows alone (at most one per source row and matched target
    row), and the others come from a second scan of the target."""
    new = F.col(ACTION).isin(INSERT, UPDATE)
    if strategy == "shuffle":
        staged = checkpoint_table(actions, "merge-actions")
        return staged.filter(new), staged.filter(~new)
    return checkpoint_table(actions.filter(new), "merge-new"), actions.filter(~new)


def with_new_keys(new: DataFrame, target: DataFrame, order_cols: list, sk_col: str) -> DataFrame:
    """Staged new rows with surrogate keys above the target's largest for those that lack one."""
    from stellate.operators.keys import fill_surrogate_keys, max_key
    return fill_surrogate_keys(new, order_cols, sk_col, base=max_key(target, sk_col))


def scd1(target: DataFrame, source: DataFrame, keys, tracked=None,
         null_mode: str = "sentinel", delete_missing: bool = True,
         actions: DataFrame | None = None, sk_col: str | None = None) -> DataFrame:
    """Type-1 dimension: overwrite changed rows, insert new keys, and (mirror
    mode, ``delete_missing``) drop keys that left the source.  Target-only
    columns are kept for matched rows and NULL for inserts; with ``sk_col``
    inserted keys get surrogate keys above the target's maximum (deleted
    keys' numbers are never reused)."""
    return scd1_load(target, source, keys, tracked, null_mode, delete_missing, actions, sk_col, with_feed=False)[0]


def scd1_load(target: DataFrame, source: DataFrame, keys, tracked=None, null_mode: str = "sentinel",
              delete_missing: bool = True, actions: DataFrame | None = None, sk_col: str | None = None,
              with_feed: bool = True) -> tuple[DataFrame, DataFrame | None]:
    """The dimension that ``scd1`` gives, and the load's feed with both images
    (see ``operators.feed``)."""
    keys = _as_list(keys)
    strategy = choose_strategy(source) if actions is None else "shuffle"
    a = actions if actions is not None else merge_actions(target, source, keys, tracked, null_mode, strategy=strategy)
    take_s = F.col(ACTION).isin(INSERT, UPDATE)
    s_cols = set(source.columns)
    out = []
    for c in target.columns:
        if c in keys:
            out.append(F.col(c))
        elif c in s_cols:
            out.append(F.when(take_s, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c))
        else:
            out.append(F.col(f"t.{c}").alias(c))
    return finish_load(a, out, target, keys, strategy, sk_col, with_feed, delete_missing)


def finish_load(a: DataFrame, out: list, target: DataFrame, keys: list, strategy: str, sk_col: str | None,
                with_feed: bool, delete_missing: bool, split: tuple | None = None) -> tuple[DataFrame, DataFrame | None]:
    """Rows of a one-row-per-key dimension from its actions (``out``: the new
    columns), new rows numbered, and the feed; the merge runs once."""
    if sk_col is None and not with_feed:
        return (a.filter(F.col(ACTION) != DELETE) if delete_missing else a).select(*out), None
    from stellate.operators.feed import image_feed
    new, rest = split or split_new(a, strategy)
    new = new.select(*out, ACTION, "t")
    if sk_col is not None:
        new = with_new_keys(new, target, keys, sk_col)
        if with_feed:  # numbered once, for the rows and for the feed
            new = checkpoint_table(new, "merge-numbered")
    rows = new.select(*target.columns).unionByName(
        (rest.filter(F.col(ACTION) != DELETE) if delete_missing else rest).select(*out))
    if not with_feed:
        return rows, None
    feed = image_feed(new, keys, target.columns)
    if delete_missing:
        feed = feed.unionByName(image_feed(rest.filter(F.col(ACTION) == DELETE).select(*out, ACTION, "t"), keys, target.columns))
    return rows, feed


def change_feed(actions: DataFrame, keys, source_cols, include=(INSERT, UPDATE, DELETE)) -> DataFrame:
    """Row-level change feed: source image + action name (the OUTPUT clause)."""
    keys = _as_list(keys)
    return (actions.filter(F.col(ACTION).isin(*include))
            .select(*keys, *[F.col(f"s.{c}").alias(c) for c in source_cols], ACTION))
