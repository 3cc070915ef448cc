"""One switch for many tables.

A ``Commit`` prepares new snapshots of several tables -- written and audited,
across tables too, but not current -- and then makes all of them current at
once by one manifest, a small file that names the snapshot of every table
(``_manifests/<name>/<version>``).  It is put in place like a table's entry:
whole, under exactly the version after the one that the commit read, or not
at all.  A commit that fails, at whatever step, leaves every table as it was.

Readers pin a manifest: ``Pinned.table`` reads the snapshots that it names,
whatever is committed meanwhile.
"""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession

from stellate.sources.publish import ConcurrentPublish, Snapshot, _fs, prepare, put_new, read_snapshot, warehouse_root

MANIFESTS = "_manifests"


class Pinned:
    """The tables of one manifest (version 0: none yet)."""

    def __init__(self, spark: SparkSession, root: str, name: str, version: int, tables: dict[str, Snapshot]):
        self.spark, self.root, self.name, self.version, self.tables = spark, root, name, version, tables

    def table(self, table: str, open_only: bool = False) -> DataFrame:
        if table not in self.tables:
            raise FileNotFoundError(f"manifest {self.version} of {self.name} has no table {table}")
        return read_snapshot(self.spark, table, self.tables[table], self.root, open_only)


def _folder(root: str, name: str) -> str:
    return f"{root}/{MANIFESTS}/{name}"


def manifest_versions(spark: SparkSession, name: str, root: str | None = None) -> list[int]:
    fs, p = _fs(spark, _folder(root or warehouse_root(spark), name))
    if not fs.exists(p):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(p)]
    names = [n for n in names if not n.startswith((".", "_"))]
    if any(not n.isdigit() for n in names):
        raise ValueError(f"unexpected files among the manifests of {name}")
    return sorted(map(int, names))


def pin(spark: SparkSession, name: str, root: str | None = None, version: int | None = None) -> Pinned:
    """The newest manifest, or the given one."""
    root = root or warehouse_root(spark)
    if version is None:
        version = max(manifest_versions(spark, name, root), default=0)
    if not version:
        return Pinned(spark, root, name, 0, {})
    text = spark.read.text(f"{_folder(root, name)}/{version:020d}", wholetext=True).first()[0]
    entries = json.loads(text)
    return Pinned(spark, root, name, version, {t: Snapshot.of(e.pop("version"), e) for t, e in entries.items()})


class Commit:
    """New snapshots of some tables, on top of the manifest that was current at the start."""

    def __init__(self, spark: SparkSession, name: str, root: str | None = None):
        self.spark, self.name, self.root = spark, name, root or warehouse_root(spark)
        self.base = pin(spark, name, self.root)
        self.prepared: dict[str, Snapshot] = {}
        self._lock = threading.Lock()  # independent tables are prepared by several threads

    def before(self, table: str) -> Snapshot | None:
        """The table's snapshot at the start; None if there was none."""
        return self.base.tables.get(table)

    def table(self, table: str, open_only: bool = False) -> DataFrame:
        """The table as this commit will leave it."""
        snap = self.prepared.get(table) or self.before(table)
        if snap is None:
            raise FileNotFoundError(f"{self.name} has no table {table}")
        return read_snapshot(self.spark, table, snap, self.root, open_only)

    def prepare(self, df: DataFrame, table: str, audits: dict | None = None, **how) -> Snapshot:
        """Write and audit a table's new snapshot (arguments as for ``publish``)."""
        before = self.before(table)
        snap = prepare(df, table, audits, self.root, **how)
        snap = Snapshot.of((before.version if before else 0) + 1, snap.entry())
        with self._lock:
            if table in self.prepared:
                raise ValueError(f"{table} was prepared twice")
            self.prepared[table] = snap
        return snap

    def audit(self, checks: dict) -> None:
        """Fail on any row of ``checks`` (name -> DataFrame of violations over the tables to be)."""
        for name, found in checks.items():
            if found.limit(1).count():
                raise ValueError(f"commit of {self.name} aborted: audit {name} failed")

    def commit(self) -> Pinned:
        """Make all prepared snapshots current; nothing else becomes visible."""
        tables = {**self.base.tables, **self.prepared}
        version = self.base.version + 1
        text = json.dumps({t: {**s.entry(), "version": s.version} for t, s in tables.items()})
        if not put_new(self.spark, f"{_folder(self.root, self.name)}/{version:020d}", text):
            raise ConcurrentPublish(f"{self.name} has a manifest {version} since this commit began")
        return Pinned(self.spark, self.root, self.name, version, tables)


def pinned_snapshots(spark: SparkSession, table: str, name: str, root: str | None = None, keep_manifests: int = 1) -> list[Snapshot]:
    """A table's snapshots in the newest manifests, for ``publish.removable(pinned=...)``."""
    root = root or warehouse_root(spark)
    kept = manifest_versions(spark, name, root)[-keep_manifests:] if keep_manifests else []
    found = [pin(spark, name, root, v).tables.get(table) for v in kept]
    return [s for s in found if s is not None]


def removable_folders(spark: SparkSession, name: str, root: str | None = None, keep_manifests: int = 1, pinned=()) -> dict[str, list[str]]:
    """Per table the folders that superseded manifests name and that neither the
    newest ``keep_manifests`` nor the ``pinned`` versions do.  Nothing is removed."""
    root = root or warehouse_root(spark)
    versions = manifest_versions(spark, name, root)
    kept = {*(versions[-keep_manifests:] if keep_manifests else []), *pinned}
    needed, named = set(), set()
    for v in versions:
        for t, s in pin(spark, name, root, v).tables.items():
            own = {(t, f) for f in s.needs}
            named |= own
            if v in kept:
                needed |= own
    out: dict[str, list[str]] = {}
    for t, f in sorted(named - needed):
        out.setdefault(t, []).append(f)
    return out
