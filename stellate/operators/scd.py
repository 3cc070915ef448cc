"""Slowly changing dimensions of type 2, 3 and 4 on top of ``merge_actions``."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stellate.functions.dates import date_key_str
from stellate.functions.predicates import col_changed
from stellate.operators.merge import (
    ACTION, DELETE, INSERT, UPDATE, _as_list, choose_strategy, finish_load, merge_actions, split_new, with_new_keys,
)
from stellate.sources.publish import checkpoint_table


def _date_lit(d) -> F.Column:
    if d is None:
        raise ValueError("the load needs its date (as_of)")
    if isinstance(d, str):
        d = _dt.date.fromisoformat(d)
    return F.lit(d)


_MARKER = "_closed_key"


def scd2_actions(target: DataFrame, source: DataFrame, keys, tracked=None,
                 null_mode: str = "sentinel", binary_mode: str = "digest",
                 current_col: str = "is_current", strategy: str = "auto") -> DataFrame:
    """``merge_actions`` for a versioned target without shuffling its history.

    Only current versions take part in the join with their full rows.  For
    closed versions just the distinct keys enter, as marker rows (partially
    aggregated before the shuffle, so a key with many versions costs one row
    per task): a source key that meets only a marker is "matched" and
    therefore neither inserted nor updated -- a key whose versions are all
    closed is never re-opened.  Closed versions have no action: the markers
    are taken out again, so the actions are the same under either strategy.
    """
    keys = _as_list(keys)
    strategy = choose_strategy(source, strategy)
    is_cur = F.coalesce(F.col(current_col), F.lit(False))
    current = target.filter(is_cur).withColumn(_MARKER, F.lit(False))
    closed_keys = target.filter(~is_cur).select(*keys)
    if strategy == "broadcast":  # only closed keys the batch touches matter
        closed_keys = closed_keys.join(F.broadcast(source.select(*keys)), keys, "left_semi")
    markers = closed_keys.distinct().withColumn(_MARKER, F.lit(True))
    tprime = current.unionByName(markers, allowMissingColumns=True)
    a = merge_actions(tprime, source, keys, tracked, null_mode, binary_mode, update_when=current_col,
                      strategy=strategy)
    return a.filter(~F.coalesce(F.col(f"t.{_MARKER}"), F.lit(False)))


def _in_place(target: DataFrame, current_col: str, eff_col: str, as_of: F.Column) -> F.Column:
    """An UPDATE of a version that isn't older than the load: it replaces that
    version, since closing it would give it an end before its start."""
    if eff_col not in target.columns:
        return F.lit(False)
    return (F.col(ACTION) == UPDATE) & F.coalesce(F.col(f"t.{eff_col}") >= as_of.cast(target.schema[eff_col].dataType), F.lit(False))


def scd2(target: DataFrame, source: DataFrame, keys, tracked=None, as_of="2002-01-01",
         null_mode: str = "sentinel", binary_mode: str = "digest",
         current_col: str = "is_current", eff_col: str = "effective_date",
         ineff_col: str = "ineffective_date", close_missing: bool = False,
         actions: DataFrame | None = None, sk_col: str | None = None, with_closed: bool = True) -> DataFrame:
    """Type-2 dimension after one load.

    With ``sk_col`` (a per-version surrogate key column of the target), new
    versions get keys above the target's maximum, in (key, effective date)
    order; existing versions keep theirs.

    * a current version whose tracked columns changed is expired
      (``current=false``, ``ineffective = as_of - 1 day``) and a new current
      version is emitted from the source image (``effective = as_of``);
    * a key with no version at all is inserted as a current version;
    * closed versions, unchanged versions, and keys that left the source stay
      as they are (``close_missing=True`` expires the latter instead);
    * a key with only closed versions is neither updated nor re-inserted;
    * a change of a version whose effective date isn't before ``as_of`` (two
      changes under one date, or a late one) replaces that version in place,
      with its dates and surrogate key.

    ``with_closed=False`` leaves out versions that were closed before, for a
    caller that keeps them where they are.  Closed versions bypass the join (see ``scd2_actions``); when the table is
    partitioned by ``current_col`` their scan is a separate partition.  Both
    output rows of a joined row come out of one ``explode`` -- the join runs
    once, with no cache.
    """
    return scd2_load(target, source, keys, tracked, as_of, null_mode, binary_mode, current_col, eff_col, ineff_col,
                     close_missing, actions, sk_col, with_closed, with_feed=False)[0]


def scd2_load(target: DataFrame, source: DataFrame, keys, tracked=None, as_of="2002-01-01",
              null_mode: str = "sentinel", binary_mode: str = "digest",
              current_col: str = "is_current", eff_col: str = "effective_date",
              ineff_col: str = "ineffective_date", close_missing: bool = False,
              actions: DataFrame | None = None, sk_col: str | None = None, with_closed: bool = True,
              with_feed: bool = True) -> tuple[DataFrame, DataFrame | None]:
    """The dimension that ``scd2`` gives, and the load's feed (see
    ``operators.feed``): per key its current version before and after."""
    keys = _as_list(keys)
    strategy = choose_strategy(source) if actions is None else "shuffle"
    a = actions if actions is not None else scd2_actions(
        target, source, keys, tracked, null_mode, binary_mode, current_col, strategy)
    as_of_c = _date_lit(as_of)
    yesterday = F.date_sub(as_of_c, 1)
    s_cols = set(source.columns)
    in_place = _in_place(target, current_col, eff_col, as_of_c)
    expire = (F.col(ACTION) == UPDATE) & ~in_place
    if close_missing:
        expire = expire | ((F.col(ACTION) == DELETE) & F.coalesce(F.col(f"t.{current_col}"), F.lit(False)))
    old_img, new_img = [], []
    for f in target.schema.fields:
        c = f.name
        if c in keys:
            old_img.append(F.col(c).alias(c))
            new_img.append(F.col(c).alias(c))
        elif c == current_col:
            old_img.append(F.when(expire, F.lit(False)).otherwise(F.col(f"t.{c}")).alias(c))
            new_img.append(F.lit(True).alias(c))
        elif c == ineff_col:
            old_img.append(F.when(expire, yesterday).otherwise(F.col(f"t.{c}")).cast(f.dataType).alias(c))
            new_img.append(F.lit(None).cast(f.dataType).alias(c))
        elif c == eff_col:
            old_img.append(F.col(f"t.{c}").alias(c))
            new_img.append(F.when(in_place, F.col(f"t.{c}")).otherwise(as_of_c).cast(f.dataType).alias(c))
        else:
            old_img.append(F.col(f"t.{c}").alias(c))
            new_img.append((F.col(f"s.{c}") if c in s_cols else F.when(in_place, F.col(f"t.{c}"))).cast(f.dataType).alias(c))
    emit_old = (F.col(ACTION) != INSERT) & ~in_place
    emit_new = F.col(ACTION).isin(INSERT, UPDATE)
    rows = F.array_compact(F.array(F.when(emit_old, F.struct(*old_img)),
                                   F.when(emit_new, F.struct(*new_img))))
    def versions(some: DataFrame) -> DataFrame:
        return some.select(F.explode(rows).alias("_v")).select("_v.*")

    feed = None
    if sk_col is None and not with_feed:
        merged = versions(a)
    else:
        new, rest = split_new(a, strategy)
        opened = new.select(*new_img, ACTION, "t")
        if sk_col is not None:
            opened = with_new_keys(opened, target, keys + [eff_col], sk_col)
            if with_feed:
                opened = checkpoint_table(opened, "merge-numbered")
        merged = (new.filter(emit_old).select(*old_img).unionByName(opened.select(*target.columns)).unionByName(versions(rest)))
        if with_feed:
            from stellate.operators.feed import image_feed
            feed = image_feed(opened, keys, target.columns)
            if close_missing:
                gone = rest.filter(expire)
                feed = feed.unionByName(image_feed(gone.select(*old_img, ACTION, "t"), keys, target.columns))
    if _has_marker(a) and with_closed:  # closed versions bypassed the join
        closed = target.filter(~F.coalesce(F.col(current_col), F.lit(False)))
        merged = closed.unionByName(merged)
    return merged, feed


def _has_marker(actions: DataFrame) -> bool:
    t = actions.schema["t"].dataType
    return _MARKER in t.fieldNames()


def scd2_expired(actions: DataFrame, target: DataFrame, keys, as_of, current_col="is_current",
                 ineff_col="ineffective_date", eff_col="effective_date") -> DataFrame:
    """The versions an SCD2 load closes (old image, flag and end date set)."""
    keys = _as_list(keys)
    yesterday = F.date_sub(_date_lit(as_of), 1)
    cols = []
    for f in target.schema.fields:
        c = f.name
        if c in keys:
            cols.append(F.col(c))
        elif c == current_col:
            cols.append(F.lit(False).alias(c))
        elif c == ineff_col:
            cols.append(yesterday.cast(f.dataType).alias(c))
        else:
            cols.append(F.col(f"t.{c}").alias(c))
    in_place = _in_place(target, current_col, eff_col, _date_lit(as_of))
    return actions.filter((F.col(ACTION) == UPDATE) & ~in_place).select(*cols)


def scd2_new_versions(actions: DataFrame, target: DataFrame, source: DataFrame, keys, as_of,
                      current_col="is_current", eff_col="effective_date",
                      ineff_col="ineffective_date", include_inserts: bool = False) -> DataFrame:
    """Current versions opened by an SCD2 load: one per updated key (and per
    new key with ``include_inserts``), from the change feed's source image."""
    keys = _as_list(keys)
    s_cols = set(source.columns)
    in_place = _in_place(target, current_col, eff_col, _date_lit(as_of))
    cols = []
    for f in target.schema.fields:
        c = f.name
        if c in keys:
            cols.append(F.col(c))
        elif c == current_col:
            cols.append(F.lit(True).alias(c))
        elif c == ineff_col:
            cols.append(F.lit(None).cast(f.dataType).alias(c))
        elif c == eff_col:
            cols.append(F.when(in_place, F.col(f"t.{c}")).otherwise(_date_lit(as_of)).cast(f.dataType).alias(c))
        else:
            cols.append((F.col(f"s.{c}") if c in s_cols else F.when(in_place, F.col(f"t.{c}"))).cast(f.dataType).alias(c))
    wanted = [UPDATE, INSERT] if include_inserts else [UPDATE]
    return actions.filter(F.col(ACTION).isin(*wanted)).select(*cols)


def scd3(target: DataFrame, source: DataFrame, keys, tracked=None, previous=None,
         as_of="2002-01-01", null_mode: str = "sql", delete_missing: bool = False,
         actions: DataFrame | None = None, sk_col: str | None = None) -> DataFrame:
    """Type-3 dimension: overwrite changed rows and keep the prior value of
    selected columns.

    ``previous`` maps a tracked column to ``(prev_col, prev_validto_col)``.
    On an UPDATE, when that column itself differs (same NULL semantics as the
    change test, evaluated on the pre-update row) the old value moves to
    ``prev_col`` and ``prev_validto_col`` becomes ``as_of - 1 day`` as
    ``yyyyMMdd`` text; otherwise both keep their values.  With ``sk_col``
    inserted keys get surrogate keys above the target's maximum, in key order.
    """
    return scd3_load(target, source, keys, tracked, previous, as_of, null_mode, delete_missing, actions, sk_col, with_feed=False)[0]


def scd3_load(target: DataFrame, source: DataFrame, keys, tracked=None, previous=None, as_of="2002-01-01",
              null_mode: str = "sql", delete_missing: bool = False, actions: DataFrame | None = None,
              sk_col: str | None = None, with_feed: bool = True) -> tuple[DataFrame, DataFrame | None]:
    """The dimension that ``scd3`` gives, and the load's feed with both images."""
    keys = _as_list(keys)
    previous = previous or {}
    strategy = choose_strategy(source) if actions is None else "shuffle"
    a = actions if actions is not None else merge_actions(target, source, keys, tracked, null_mode, strategy=strategy)
    dtypes = {f.name: f.dataType for f in source.schema.fields}
    upd = F.col(ACTION) == UPDATE
    ins = F.col(ACTION) == INSERT
    take_s = F.col(ACTION).isin(INSERT, UPDATE)
    validto = date_key_str(F.date_sub(_date_lit(as_of), 1))
    prev_of = {}
    for c, (pc, vc) in previous.items():
        moved = upd & F.coalesce(col_changed(F.col(f"t.{c}"), F.col(f"s.{c}"), dtypes[c], null_mode), F.lit(False))
        prev_of[pc] = F.when(ins, F.lit(None)).when(moved, F.col(f"t.{c}")).otherwise(F.col(f"t.{pc}"))
        prev_of[vc] = F.when(ins, F.lit(None)).when(moved, validto).otherwise(F.col(f"t.{vc}"))
    s_cols = set(source.columns)
    out = []
    for f in target.schema.fields:
        c = f.name
        if c in keys:
            out.append(F.col(c))
        elif c in prev_of:
            out.append(prev_of[c].cast(f.dataType).alias(c))
        elif c in s_cols:
            out.append(F.when(take_s, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c))
        else:
            out.append(F.col(f"t.{c}").alias(c))
    return finish_load(a, out, target, keys, strategy, sk_col, with_feed, delete_missing)


def scd4(current: DataFrame, source: DataFrame, keys, tracked=None, as_of="2002-01-01",
         null_mode: str = "null_safe", valid_from_col: str = "valid_from",
         valid_to_col: str = "valid_to", actions: DataFrame | None = None, sk_col: str | None = None):
    """Type-4 dimension: the current table is overwritten (SCD1 without
    delete) and the replaced images go to an append-only history table.

    Returns ``(new_current, history_rows)``; history rows carry the old
    image, its ``valid_from`` and ``valid_to = as_of - 1 day``.  With
    ``sk_col`` inserted keys get surrogate keys above the table's maximum.
    """
    rows, _, history = scd4_load(current, source, keys, tracked, as_of, null_mode, valid_from_col, valid_to_col, actions,
                                 sk_col, with_feed=False)
    return rows, history


def scd4_load(current: DataFrame, source: DataFrame, keys, tracked=None, as_of="2002-01-01",
              null_mode: str = "null_safe", valid_from_col: str = "valid_from", valid_to_col: str = "valid_to",
              actions: DataFrame | None = None, sk_col: str | None = None, with_feed: bool = True):
    """``(new_current, feed, history_rows)`` of an ``scd4`` load."""
    keys = _as_list(keys)
    strategy = choose_strategy(source) if actions is None else "shuffle"
    a = actions if actions is not None else merge_actions(current, source, keys, tracked, null_mode, strategy=strategy)
    as_of_c = _date_lit(as_of)
    take_s = F.col(ACTION).isin(INSERT, UPDATE)
    s_cols = set(source.columns)
    cur_cols, hist_cols = [], []
    for f in current.schema.fields:
        c = f.name
        if c in keys:
            cur_cols.append(F.col(c))
            hist_cols.append(F.col(c))
        elif c == valid_from_col:
            cur_cols.append(F.when(take_s, as_of_c).otherwise(F.col(f"t.{c}")).cast(f.dataType).alias(c))
            hist_cols.append(F.col(f"t.{c}").alias(c))
        elif c in s_cols:
            cur_cols.append(F.when(take_s, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c))
            hist_cols.append(F.col(f"t.{c}").alias(c))
        else:
            cur_cols.append(F.col(f"t.{c}").alias(c))
            hist_cols.append(F.col(f"t.{c}").alias(c))
    hist_cols.append(F.date_sub(as_of_c, 1).alias(valid_to_col))
    if sk_col is None and not with_feed:
        return a.select(*cur_cols), None, a.filter(F.col(ACTION) == UPDATE).select(*hist_cols)
    new, rest = split_new(a, strategy)  # staged: the history reads it too
    rows, feed = finish_load(a, cur_cols, current, keys, strategy, sk_col, with_feed, False, (new, rest))
    return rows, feed, new.filter(F.col(ACTION) == UPDATE).select(*hist_cols)
