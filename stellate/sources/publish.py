"""Snapshot publishing: all-or-nothing replacement of a table.

Spark refuses to overwrite a table it is reading from, and a failed
overwrite would leave a half-written table.  Instead every load writes new
folders, the audits run against what was written, and only then a new entry
is put into the table's pointer folder.  An entry is one small file named by
its version (``_current/<version>``); it lists the folders that make up the
snapshot, their schema, rows and bytes.  The current snapshot is the greatest
version.  Nothing is overwritten, so a reader always finds a complete
snapshot; ``removable`` lists what no kept version needs any more.

An entry is written aside and then put in place under exactly the version
after the one that the load read, by a step that fails if that name exists: of
two loads from one snapshot the second fails (``ConcurrentPublish``) instead
of undoing the first.  The step is a hard link on a local disk and a rename
that doesn't overwrite elsewhere, which is atomic on HDFS; an object store
needs a connector whose rename is a conditional put.  An entry that another
program left empty blocks its version until ``repair``.  Only a missing
pointer folder counts as "no table yet"; anything that can't be read raises.

A snapshot may keep folders of the one before (``keep``): an append adds a
folder, and a versioned dimension keeps its closed history untouched while
only the current versions are written again.  A chain of folders is read as
one scan, and ``compact`` folds small ones together.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass, replace
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stellate.session import is_local, shared_dir

POINTER = "_current"
CODEC = "zstd"  # of the files: fewer bytes to write than the default
UNCHECKED = object()  # publish whatever was current before


class ConcurrentPublish(RuntimeError):
    """Another load published since this one read the table."""


@dataclass(frozen=True)
class Snapshot:
    """A published state of a table: ``head`` is read whole; of the folders in
    ``tail`` the rows whose ``flag`` column isn't true (all rows without a flag).

    ``sizes`` has ``(folder, rows, bytes, partition columns)`` of each folder.
    ``feed`` is the folder of the changes against the version before.
    Files in ``skip`` don't count any more."""

    version: int
    head: str
    tail: tuple
    flag: str | None
    schema: str
    rows: int
    bytes: int
    catalog: str | None = None
    sizes: tuple = ()
    feed: str | None = None
    feed_schema: str | None = None
    feed_keys: tuple = ()
    #: files of the folders whose rows a later merge has written again
    skip: tuple = ()
    #: ``(folder, its sketch's folder, keys)`` and ``(audit, parent's version)``, see ``sources.sketches``
    sketches: tuple = ()
    checked: tuple = ()

    @property
    def folders(self) -> tuple:
        return (self.head, *self.tail)

    @property
    def needs(self) -> set:
        """All folders that the snapshot refers to."""
        return {*self.folders, *([self.feed] if self.feed else []), *[x[1] for x in self.sketches]}

    def entry(self) -> dict:
        return {k: v for k, v in asdict(self).items() if k != "version"}

    @staticmethod
    def of(version: int, e: dict) -> "Snapshot":
        return Snapshot(version, e["head"], tuple(e["tail"]), e["flag"], e["schema"], e["rows"], e["bytes"], e["catalog"],
                        tuple(tuple(x) for x in e.get("sizes", ())), e.get("feed"), e.get("feed_schema"), tuple(e.get("feed_keys", ())),
                        tuple(e.get("skip", ())), tuple((f, p, tuple(k)) for f, p, k in e.get("sketches", ())),
                        tuple(tuple(x) for x in e.get("checked", ())))


def warehouse_root(spark: SparkSession) -> str:
    """``stellate.warehouse.dir``, else a folder in the session's configured
    warehouse.  Durable tables never go below a checkpoint dir; only a local
    session without either uses scratch space."""
    root = spark.conf.get("stellate.warehouse.dir", None)
    if root:
        return root.rstrip("/")
    root = spark.sparkContext.getConf().get("spark.sql.warehouse.dir", None)
    if root:
        return f"{root.rstrip('/')}/stellate"
    if not is_local(spark):
        raise ValueError("stellate.warehouse.dir or spark.sql.warehouse.dir must name a shared folder")
    return shared_dir(spark, "warehouse")


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _versions(spark: SparkSession, table: str, root: str) -> dict[int, int]:
    """Published versions and the sizes of their entries (0: abandoned)."""
    fs, p = _fs(spark, f"{root}/{table}/{POINTER}")
    if not fs.exists(p):
        return {}
    found = {}
    for f in fs.listStatus(p):
        name = f.getPath().getName()
        if name.startswith((".", "_")):
            continue
        if not name.isdigit():
            raise ValueError(f"unexpected file {name} among the versions of {table}")
        found[int(name)] = f.getLen()
    return found


def put_new(spark: SparkSession, path: str, text: str) -> bool:
    """Create ``path`` with ``text``, whole or not at all; False if it exists."""
    fs, p = _fs(spark, path)
    _, aside = _fs(spark, f"{path.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}")
    out = fs.create(aside, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    try:
        return (_link_new if fs.getUri().getScheme() == "file" else _rename_new)(spark, fs, aside, p)
    finally:
        fs.delete(aside, False)


def _link_new(spark: SparkSession, fs, aside, p) -> bool:
    """A hard link fails if its name exists, in one step."""
    try:
        os.link(aside.toUri().getPath(), p.toUri().getPath())
    except FileExistsError:
        return False
    return True


def _rename_new(spark: SparkSession, fs, aside, p) -> bool:
    """A rename that doesn't overwrite: one step on HDFS."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    none = spark._sc._gateway.new_array(hadoop.Options.Rename, 1)
    none[0] = hadoop.Options.Rename.NONE
    try:
        hadoop.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration()).rename(aside, p, none)
    except Py4JJavaError as e:
        if "FileAlreadyExists" not in str(e.java_exception):
            raise
        return False
    return True


def _entry(spark: SparkSession, table: str, root: str, version: int) -> Snapshot:
    text = spark.read.text(f"{root}/{table}/{POINTER}/{version:020d}", wholetext=True).first()[0]
    return Snapshot.of(version, json.loads(text))


def snapshot_at(spark: SparkSession, table: str, version: int, root: str | None = None) -> Snapshot:
    """A published version of a table."""
    return _entry(spark, table, root or warehouse_root(spark), version)


def repair(spark: SparkSession, table: str, root: str | None = None) -> list[int]:
    """Remove entries that were created and never written; their versions.
    Run it only when no load of the table is under way."""
    root = root or warehouse_root(spark)
    empty = sorted(v for v, size in _versions(spark, table, root).items() if not size)
    for v in empty:
        fs, p = _fs(spark, f"{root}/{table}/{POINTER}/{v:020d}")
        fs.delete(p, False)
    return empty


def current_snapshot(spark: SparkSession, table: str, root: str | None = None) -> Snapshot | None:
    """The newest snapshot; None if the table was never published."""
    root = root or warehouse_root(spark)
    done = [v for v, size in _versions(spark, table, root).items() if size]  # 0 bytes: never written
    return _entry(spark, table, root, max(done)) if done else None


def _part(spark: SparkSession, root: str, table: str, folder: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(f"{root}/{table}/{folder}").select(*schema.names)


def _scan(spark: SparkSession, root: str, table: str, snap: Snapshot, folders, schema: T.StructType) -> list[DataFrame]:
    """One scan of ``folders``, or one for each way that they are partitioned."""
    layout, skip = {f: cols for f, _, _, cols in snap.sizes}, set(snap.skip)
    partly = {f.split("/", 1)[0] for f in skip}
    groups: dict = {}
    for f in folders:
        paths = [f"{f}/{x}" for x in data_files(spark, f"{root}/{table}/{f}")] if f in partly else [f]
        groups.setdefault(layout.get(f), []).extend(f"{root}/{table}/{p}" for p in paths if p not in skip)
    groups = {cols: paths for cols, paths in groups.items() if paths}
    if not groups:
        return [spark.createDataFrame([], schema)]
    # partitioned folders are partitions (snap=...) of the table's folder
    return [spark.read.schema(schema).options(**({"basePath": f"{root}/{table}"} if cols else {})).parquet(*paths).select(*schema.names)
            for cols, paths in groups.items()]


def data_files(spark: SparkSession, path: str) -> dict[str, int]:
    """Names below ``path`` and sizes of its data files."""
    fs, p = _fs(spark, path)
    top = fs.getFileStatus(p).getPath().toUri().getPath()
    found, files = {}, fs.listFiles(p, True)
    while files.hasNext():
        f = files.next()
        name = f.getPath().toUri().getPath()[len(top) + 1:]
        if not any(part.startswith(("_", ".")) for part in name.split("/")):
            found[name] = f.getLen()
    return found


def read_snapshot(spark: SparkSession, table: str, snap: Snapshot, root: str | None = None,
                  open_only: bool = False) -> DataFrame:
    """A snapshot's rows; ``open_only`` reads the flagged rows alone (one
    partition of the newest folder, no closed history)."""
    root = root or warehouse_root(spark)
    if snap.catalog and spark.catalog.tableExists(snap.catalog):
        return spark.table(snap.catalog)
    schema = T.StructType.fromJson(json.loads(snap.schema))
    if not snap.flag:
        return reduce(DataFrame.unionByName, _scan(spark, root, table, snap, snap.folders, schema))
    head = _part(spark, root, table, snap.head, schema)
    if open_only:
        return head.filter(F.col(snap.flag))
    tail = [t.filter(~F.col(snap.flag)) for t in _scan(spark, root, table, snap, snap.tail, schema)]
    return reduce(DataFrame.unionByName, [head, *tail])


def read_table(spark: SparkSession, table: str, root: str | None = None, snapshot: int | Snapshot | None = None) -> DataFrame:
    """The table's current snapshot, or the given one (as ``publish`` returned it).

    A snapshot published with ``bucket_by`` is read through the catalog, so
    joins on its bucket key keep the bucketed layout (no shuffle of it);
    without the catalog entry it is read as plain parquet."""
    root = root or warehouse_root(spark)
    if isinstance(snapshot, int):
        snapshot = _entry(spark, table, root, snapshot)
    snap = snapshot or current_snapshot(spark, table, root)
    if snap is None:
        raise FileNotFoundError(f"table {table} has no published snapshot under {root}")
    return read_snapshot(spark, table, snap, root)


def prepare(df: DataFrame, table: str, audits: dict[str, Callable[[DataFrame], DataFrame]] | None = None,
            root: str | None = None, partition_by=None, bucket_by: tuple | None = None,
            keep: Snapshot | None = None, flag: str | None = None, feed: DataFrame | None = None, feed_keys=()) -> Snapshot:
    """Write and audit a new snapshot (see ``publish``) without making it current."""
    spark = df.sparkSession
    root = root or warehouse_root(spark)
    folder = f"snap={uuid.uuid4().hex}"
    path = f"{root}/{table}/{folder}"
    partition_by = [flag] if flag else [partition_by] if isinstance(partition_by, str) else list(partition_by or [])
    w = df.write.mode("errorifexists").option("compression", CODEC)
    catalog = None
    if partition_by:
        w = w.partitionBy(*partition_by)
    if bucket_by:
        n, cols = bucket_by
        cols = [cols] if isinstance(cols, str) else list(cols)
        catalog = f"{table}__{folder.split('=', 1)[-1]}"
        w.bucketBy(n, *cols).sortBy(*cols).option("path", path).saveAsTable(catalog)
        written = spark.table(catalog)
    else:
        w.parquet(path)
        written = _part(spark, root, table, folder, df.schema)
    if audits:
        # all audits in one job; at most one row per failed audit reaches the driver
        probes = [audit(written).limit(1).select(F.lit(name).alias("audit")) for name, audit in audits.items()]
        failed = sorted(r["audit"] for r in reduce(DataFrame.unionByName, probes).collect())
        if failed:
            raise ValueError(f"publish of {table} aborted: audit {', '.join(failed)} failed")
    changes = None
    if feed is not None:
        changes = f"feed={uuid.uuid4().hex}"
        feed.write.mode("errorifexists").option("compression", CODEC).parquet(f"{root}/{table}/{changes}")
    rows, size = written.count(), _folder_bytes(spark, path)
    kept = (keep.rows, keep.bytes) if keep and not flag else (0, 0)
    return Snapshot(0, folder, keep.folders if keep else (), flag, df.schema.json(), rows + kept[0], size + kept[1], catalog,
                    ((folder, rows, size, ",".join(partition_by)), *(keep.sizes if keep else ())),
                    changes, feed.schema.json() if feed is not None else None,
                    tuple([feed_keys] if isinstance(feed_keys, str) else feed_keys), keep.skip if keep else (),
                    keep.sketches if keep else ())


def _folder_bytes(spark: SparkSession, path: str) -> int:
    fs, p = _fs(spark, path)
    return fs.getContentSummary(p).getLength()


def publish(df: DataFrame, table: str, audits: dict[str, Callable[[DataFrame], DataFrame]] | None = None,
            root: str | None = None, partition_by=None, bucket_by: tuple | None = None, base=UNCHECKED,
            keep: Snapshot | None = None, flag: str | None = None, feed: DataFrame | None = None, feed_keys=()) -> int:
    """Write ``df`` as a new snapshot, audit it, then make it current.

    ``audits`` maps a name to a function returning violating rows of the
    written data; any violation aborts before the switch, leaving the
    previous snapshot current.  ``base`` is the snapshot that ``df`` was
    computed from (None: there was none); if another one is current by then,
    ``ConcurrentPublish`` is raised.  ``keep`` adds that snapshot's folders to
    the new one; with ``flag`` (a boolean column that the folders are
    partitioned by) only their rows that aren't flagged count.  ``feed`` (see
    ``operators.feed``) is stored with the snapshot: the changes against
    ``base`` by ``feed_keys``.

    ``bucket_by=(n, [cols])`` writes the snapshot bucketed and sorted by
    ``cols`` into ``n`` buckets, registered in the catalog (data stays under
    ``root``): two tables bucketed the same way on the merge key then merge
    with no shuffle.  Returns the new version.
    """
    root = root or warehouse_root(df.sparkSession)
    snap = prepare(df, table, audits, root, partition_by, bucket_by, keep, flag, feed, feed_keys)
    return switch(df.sparkSession, table, root, snap, base)


def switch(spark: SparkSession, table: str, root: str, snap: Snapshot, base=UNCHECKED) -> int:
    """Make a prepared snapshot current, as the version after ``base``."""
    seen = _versions(spark, table, root)
    current = max((v for v, size in seen.items() if size), default=None)
    if base is not UNCHECKED and current != (base.version if base else None):
        raise ConcurrentPublish(f"{table} is at version {current}, this load read {base.version if base else None}")
    version = (current or 0) + 1
    if not put_new(spark, f"{root}/{table}/{POINTER}/{version:020d}", json.dumps(snap.entry())):
        raise ConcurrentPublish(f"version {version} of {table} exists; if no load is writing it, run repair")
    return version


# ---------------------------------------------------------------- compaction, retention

TIER = 4  # folders of like size (within this factor) that are folded into one


def _folds(sizes: list, least: int) -> list[list]:
    """Groups of folders to fold, by size tiers: whenever ``least`` groups are
    of one tier they become one of the next.  So a row is rewritten a
    logarithmic number of times, and a chain keeps a logarithmic number of folders."""
    groups = [([name], max(1, size)) for name, size in sizes]
    while True:
        tiers: dict = {}
        for g in groups:
            tiers.setdefault((g[1].bit_length() - 1) // (TIER.bit_length() - 1), []).append(g)
        full = next((t for _, t in sorted(tiers.items()) if len(t) >= least), None)
        if full is None:
            return [names for names, _ in groups if len(names) > 1]
        groups = [g for g in groups if g not in full] + [([n for names, _ in full for n in names], sum(size for _, size in full))]


def compact(spark: SparkSession, table: str, root: str | None = None, least: int = TIER) -> int | None:
    """Fold the current snapshot's small folders together and publish the same
    rows; the new version, None if there is nothing to fold.  Of a flagged
    snapshot the folders of closed rows are folded, and their flagged rows,
    which no longer count, dropped.  A load that publishes meanwhile makes
    it fail, and nothing is changed."""
    root = root or warehouse_root(spark)
    snap = current_snapshot(spark, table, root)
    if snap is None or snap.catalog:
        return None
    known = {f: (rows, size, cols) for f, rows, size, cols in snap.sizes}
    parts: dict = {}
    for f in snap.tail if snap.flag else snap.folders:
        if f in known:
            parts.setdefault(known[f][2], []).append((f, known[f][1]))
    schema = T.StructType.fromJson(json.loads(snap.schema))
    folders, sizes = list(snap.folders), list(snap.sizes)
    for cols, members in parts.items():
        for group in _folds(members, least):
            [rows] = _scan(spark, root, table, snap, group, schema)
            folder = f"snap={uuid.uuid4().hex}"
            w = (rows.filter(~F.col(snap.flag)) if snap.flag else rows).write.mode("errorifexists")
            (w.partitionBy(*cols.split(",")) if cols else w).parquet(f"{root}/{table}/{folder}")
            n, size = _part(spark, root, table, folder, schema).count(), _folder_bytes(spark, f"{root}/{table}/{folder}")
            folders[folders.index(group[0])] = folder
            folders = [f for f in folders if f not in group]
            sizes = [x for x in sizes if x[0] not in group] + [(folder, n, size, cols)]
    if tuple(folders) == snap.folders:
        return None
    total = snap.bytes if snap.flag else sum(x[2] for x in sizes if x[0] in folders)
    empty = T.StructType([]).json()  # nothing changed
    new = replace(snap, head=folders[0], tail=tuple(folders[1:]), sizes=tuple(sizes), bytes=total, feed="", feed_schema=empty,
                  skip=tuple(f for f in snap.skip if f.split("/", 1)[0] in folders),
                  sketches=tuple(x for x in snap.sketches if x[0] in folders))
    return switch(spark, table, root, new, snap)


def removable(spark: SparkSession, table: str, root: str | None = None, keep_versions: int = 1, pinned=()) -> list[str]:
    """Folders of superseded versions that neither the newest ``keep_versions``
    versions nor the ``pinned`` ones (numbers, or snapshots) refer to.  Folders
    that no version names (a load may be writing them) are never listed;
    nothing is removed."""
    root = root or warehouse_root(spark)
    versions = sorted(v for v, size in _versions(spark, table, root).items() if size)
    kept = set(versions[-keep_versions:] if keep_versions else []) | {p for p in pinned if isinstance(p, int)}
    needed, all_of = set(), set()
    for snap in [_entry(spark, table, root, v) for v in versions] + [p for p in pinned if isinstance(p, Snapshot)]:
        own = snap.needs
        all_of |= own
        if snap.version in kept or any(p is snap for p in pinned):
            needed |= own
    return sorted(all_of - needed)


def checkpoint_table(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage by writing ``df`` to the shared folder and reading it back
    (survives executor loss, unlike a local checkpoint)."""
    spark = df.sparkSession
    path = f"{shared_dir(spark, 'stage')}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", CODEC).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
