"""Appends that are audited against the old rows without reading them.

Beside each folder of a published table lies a sketch of its keys (see
``operators.sketch``), written when the folder is appended.  A load's keys are
looked up in the sketches; only the folders that may hold one are read, and
there the keys are compared.  A snapshot also notes what it was checked for:
its key, and each reference with the parent's version at that time.  So a
load checks new rows against the parent, and old rows only for the keys that
the parent has lost since.  What isn't noted -- a plain ``publish`` came
between, or another key -- is audited in full, and noted then.

Keys are compared as the table holds them.  Floating-point keys are refused:
equal ones may differ in their bits.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stellate.operators.audit import duplicate_keys, orphans
from stellate.operators.merge import ACTION, DELETE, _as_list
from stellate.operators.sketch import FOLDER, key_sketch, maybe_in, sketch_bits, small
from stellate.sources.feeds import changes
from stellate.sources.publish import Snapshot, _scan, current_snapshot, prepare, read_snapshot, snapshot_at, switch, warehouse_root

SKETCH = "folder string, keys string, bits bigint, piece bigint, bitmap binary"


def _name(keys) -> str:
    return json.dumps(_as_list(keys))


def _reference(ref: tuple) -> str:
    cols, parent, parent_cols = ref
    return f"{_name(cols)} in {parent} {_name(parent_cols)}"


def folder_rows(spark: SparkSession, table: str, snap: Snapshot, folders, root: str) -> DataFrame:
    """The rows of some of a snapshot's folders."""
    return reduce(DataFrame.unionByName, _scan(spark, root, table, snap, folders, T.StructType.fromJson(json.loads(snap.schema))))


def with_sketches(spark: SparkSession, table: str, snap: Snapshot, key_sets, root: str) -> Snapshot:
    """``snap`` with sketches of ``key_sets`` for every folder that lacks one
    (a new folder, or one that a compaction has made); others are kept."""
    wanted, have, added = [_name(k) for k in key_sets], {}, []
    for folder, _, sets in snap.sketches:
        have.setdefault(folder, set()).update(sets)
    for folder in snap.folders:
        missing = [k for k in dict.fromkeys(wanted) if k not in have.get(folder, ())]
        if not missing:
            continue
        rows = folder_rows(spark, table, snap, [folder], root)
        known = next((n for f, n, _, _ in snap.sizes if f == folder), None)
        bits = sketch_bits(rows.count() if known is None else known)
        made = [key_sketch(rows, json.loads(k), bits).select(F.lit(folder).alias("folder"), F.lit(k).alias("keys"), "bits", "piece", "bitmap")
                for k in missing]
        place = f"sketch={uuid.uuid4().hex}"
        reduce(DataFrame.unionByName, made).write.mode("errorifexists").parquet(f"{root}/{table}/{place}")
        added.append((folder, place, tuple(missing)))
    return replace(snap, sketches=tuple(x for x in snap.sketches if x[0] in snap.folders) + tuple(added))


def stored_sketches(spark: SparkSession, table: str, snap: Snapshot, keys, root: str) -> DataFrame:
    """``folder, bits, piece, bitmap`` of the keys, of every folder of the snapshot."""
    name = _name(keys)
    places = {folder: place for folder, place, sets in snap.sketches if name in sets}
    lacking = [f for f in snap.folders if f not in places]
    if lacking:
        raise ValueError(f"{len(lacking)} folders of {table} have no sketch of {name}")
    paths = [f"{root}/{table}/{places[f]}" for f in snap.folders]
    return spark.read.schema(SKETCH).parquet(*paths).filter(F.col("keys") == name).drop("keys")


def rows_with(spark: SparkSession, table: str, snap: Snapshot, sought: DataFrame, keys, root: str) -> DataFrame | None:
    """The snapshot's rows whose key is among ``sought``; None if the sketches
    rule out every key.  Folders without a candidate aren't read."""
    keys = _as_list(keys)
    found = maybe_in(sought, keys, stored_sketches(spark, table, snap, keys, root))
    folders = {r[FOLDER] for r in found.select(FOLDER).distinct().collect()}  # names that the entry lists
    if not folders:
        return None
    old = folder_rows(spark, table, snap, [f for f in snap.folders if f in folders], root)
    return old.join(small(found.select(*keys).distinct()), keys, "left_semi").select(*old.columns)


def gone_keys(spark: SparkSession, table: str, keys, first: int, last: int, root: str) -> DataFrame | None:
    """Keys of version ``first`` that version ``last`` hasn't: from the stored
    feeds if all versions between have one by these keys, else from the key
    columns of both.  None if the feeds hold no change."""
    keys = _as_list(keys)
    between = [snapshot_at(spark, table, v, root) for v in range(first + 1, last + 1)]
    if all(not s.flag and (s.feed == "" or s.feed and list(s.feed_keys) == keys) for s in between):
        net = changes(spark, table, first, last, root)
        return None if net is None else net.filter(F.col(ACTION) == DELETE).select(*keys)
    then, now = (read_snapshot(spark, table, snapshot_at(spark, table, v, root), root).select(*keys) for v in (first, last))
    return then.distinct().join(now, keys, "left_anti")


@dataclass(frozen=True)
class Append:
    """A batch that is written and audited, not current.  ``violations`` holds
    by audit name the rows (of a key audit: the keys) that break it."""

    table: str
    root: str
    snap: Snapshot
    base: Snapshot | None
    violations: dict


def prepare_append(new: DataFrame, table: str, keys=None, references=(), root: str | None = None, **how) -> Append:
    """Write ``new`` on top of the table's current snapshot and audit what the
    table would be: ``keys`` (no NULL, no key twice) and ``references``
    (columns, parent table, its columns; the parent's current snapshot).
    ``how`` are further arguments of ``publish.prepare``."""
    spark = new.sparkSession
    root = root or warehouse_root(spark)
    references = [(_as_list(c), p, _as_list(pc)) for c, p, pc in references]
    key_sets = ([_as_list(keys)] if keys else []) + [c for c, _, _ in references]
    base = current_snapshot(spark, table, root)
    types = {f.name: f.dataType for f in new.schema}
    if base is not None:
        if base.flag or base.catalog:
            raise ValueError(f"{table} is not a plain published table")
        held = {f.name: f.dataType for f in T.StructType.fromJson(json.loads(base.schema))}
        if held != types:
            raise ValueError(f"the batch's columns or types aren't those of {table}")
    if any(isinstance(types[c], (T.FloatType, T.DoubleType)) for k in key_sets for c in k):
        raise ValueError("a floating-point column can't be a key here")
    snap = prepare(new, table, root=root, keep=base, **how)
    written = folder_rows(spark, table, snap, [snap.head], root)
    snap = with_sketches(spark, table, snap, key_sets, root)
    # the sketches of old folders that lacked one were made with the new folder's
    old = replace(base, sketches=tuple(x for x in snap.sketches if x[0] != snap.head)) if base else None
    noted, checked, violations = dict(base.checked) if base else {}, [], {}
    if keys:
        keys = _as_list(keys)
        checked.append((f"unique {_name(keys)}", 0))
        if old is not None and checked[-1][0] not in noted:
            found = duplicate_keys(read_snapshot(spark, table, snap, root), keys).select(*keys)
        else:
            found = duplicate_keys(written, keys).select(*keys)
            again = rows_with(spark, table, old, written.select(*keys), keys, root) if old else None
            if again is not None:
                found = found.unionByName(again.select(*keys)).distinct()
        violations["duplicate_" + "_".join(keys)] = found
    for cols, parent, parent_cols in references:
        now = current_snapshot(spark, parent, root)
        if now is None:
            raise FileNotFoundError(f"{parent}, which {table} refers to, has no published snapshot")
        there = read_snapshot(spark, parent, now, root)
        checked.append((_reference((cols, parent, parent_cols)), now.version))
        found, since = orphans(written, cols, there, parent_cols), noted.get(checked[-1][0])
        if old is not None and since is None:
            found = found.unionByName(orphans(read_snapshot(spark, table, old, root), cols, there, parent_cols))
        elif old is not None and since != now.version:
            gone = gone_keys(spark, parent, parent_cols, since, now.version, root)
            if gone is not None:
                # a hash depends on the type: the parent's keys as the table holds them
                sought = gone.select(*[F.col(p).try_cast(types[c]).alias(c) for p, c in zip(parent_cols, cols)])
                lost = rows_with(spark, table, old, sought, cols, root)
                found = found if lost is None else found.unionByName(lost)
        violations["orphan_" + "_".join(cols)] = found
    return Append(table, root, replace(snap, checked=tuple(checked)), base, violations)


def append_checked(new: DataFrame, table: str, keys=None, references=(), root: str | None = None, **how) -> int:
    """``prepare_append``, then the switch; any violation raises and the
    snapshot before stays current.  Returns the new version."""
    spark = new.sparkSession
    made = prepare_append(new, table, keys, references, root, **how)
    probes = [found.limit(1).select(F.lit(name).alias("audit")) for name, found in made.violations.items()]
    failed = sorted(r["audit"] for r in reduce(DataFrame.unionByName, probes).collect()) if probes else []
    if failed:
        raise ValueError(f"append to {table} aborted: audit {', '.join(failed)} failed")
    return switch(spark, table, made.root, made.snap, made.base)
