"""Copy-on-write merges: only the files that hold a batch's keys are written again.

A dimension in key-ranged files (``key_ranged``) has each key in one file, and
a file's footer tells its range of keys, so a scan for a small batch's keys
skips most files without reading them.  The files that are found are merged
with the batch and written to a new folder; the snapshot keeps all others
where they are.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stellate.operators.keys import fill_surrogate_keys, max_key
from stellate.operators.merge import _as_list, choose_strategy, scd1_load
from stellate.sources.publish import (
    Snapshot, checkpoint_table, current_snapshot, data_files, prepare, read_snapshot, switch, warehouse_root,
)

LISTED_KEYS = 1000  # batch keys that are pushed to the scan one by one; more are pushed as their range


def key_ranged(df: DataFrame, keys, files: int) -> DataFrame:
    """``df`` so that it is written as ``files`` files, each with a range of keys."""
    keys = _as_list(keys)
    return df.repartitionByRange(files, *keys).sortWithinPartitions(*keys)


def _near(rows: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """``rows`` cut to what a scan can tell from the files' footers: the batch's
    keys if they are few, else the range that they span."""
    few = [r[0] for r in batch.select(key).distinct().limit(LISTED_KEYS + 1).collect()]
    if len(few) <= LISTED_KEYS:
        return rows.filter(F.col(key).isin(few))
    least, most = batch.agg(F.min(key), F.max(key)).first()
    return rows.filter((F.col(key) >= least) & (F.col(key) <= most))


def files_with(spark: SparkSession, table: str, snap: Snapshot, batch: DataFrame, keys, root: str) -> list[str]:
    """Files of the snapshot, below the table's folder, that hold a key of the batch."""
    keys = _as_list(keys)
    rows = read_snapshot(spark, table, snap, root).select(*keys, F.col("_metadata.file_path").alias("_file"))
    sought = batch.select(*keys).distinct()
    if choose_strategy(sought) == "broadcast":
        sought = F.broadcast(sought)
    found = _near(rows, batch, keys[0]).join(sought, keys, "left_semi").select("_file").distinct().collect()  # one row per file
    # a file's path is an address; below the table's folder it is the snapshot's folder and the file's name there
    paths = [unquote(r["_file"]) for r in found]
    return sorted(p[p.rindex(f"/{table}/") + len(table) + 2:] for p in paths)


def merge_touched(spark: SparkSession, table: str, batch: DataFrame, keys, tracked=None, null_mode: str = "sentinel",
                  sk_col: str | None = None, root: str | None = None,
                  audits: dict[str, Callable[[DataFrame], DataFrame]] | None = None) -> tuple[int, list[str]]:
    """Merge a batch of changed and new rows (type 1; keys that it lacks stay)
    into a published dimension.  Returns the new version and the files whose
    rows were written again.  ``audits`` see the rows that were written.

    A batch that holds a key twice fails.  NULL keys are refused, since no
    file's range tells where they are."""
    keys, root = _as_list(keys), root or warehouse_root(spark)
    base = current_snapshot(spark, table, root)
    if base is None or base.flag or base.catalog:
        raise ValueError(f"{table} is not a plain published table")
    if batch.filter(" OR ".join(f"`{k}` IS NULL" for k in keys)).limit(1).count():
        raise ValueError("a key of the batch is NULL")
    touched = files_with(spark, table, base, batch, keys, root)
    whole = read_snapshot(spark, table, base, root)
    target = (spark.read.schema(whole.schema).options(basePath=f"{root}/{table}")
              .parquet(*[f"{root}/{table}/{f}" for f in touched]).select(*whole.columns) if touched else whole.limit(0))
    rows, feed = scd1_load(target, batch, keys, tracked, null_mode, delete_missing=False)
    if sk_col is not None:
        rows = fill_surrogate_keys(checkpoint_table(rows, "touched"), keys, sk_col, base=max_key(whole, sk_col))
        feed = None  # its images would lack the new keys
    layout = next((cols for _, _, _, cols in base.sizes if cols), "")
    written = prepare(key_ranged(rows, keys, max(1, len(touched))), table, audits, root,
                      partition_by=layout.split(",") if layout else None, keep=base, feed=feed, feed_keys=keys if feed is not None else ())
    sizes = {f"{d}/{f}": n for d in base.folders for f, n in data_files(spark, f"{root}/{table}/{d}").items()}
    skip = {*base.skip, *touched}
    held = {d: any(f.startswith(f"{d}/") and f not in skip for f in sizes) for d in base.folders}
    folders = [written.head, *[d for d in base.folders if held[d]]]
    snap = replace(written, tail=tuple(folders[1:]), sizes=tuple(x for x in written.sizes if x[0] in folders),
                   skip=tuple(sorted(f for f in skip if f.split("/", 1)[0] in folders)),
                   sketches=tuple(x for x in written.sketches if x[0] in folders),
                   rows=written.rows - target.count(), bytes=written.bytes - sum(sizes[f] for f in touched))
    return switch(spark, table, root, snap, base), touched
