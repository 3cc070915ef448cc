"""What changed in a published table between two versions."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stellate.operators.feed import VERSION, net_changes
from stellate.sources.commit import pin
from stellate.sources.publish import Snapshot, snapshot_at, warehouse_root


def _read(spark: SparkSession, table: str, root: str, snaps: list[tuple[int, Snapshot]]) -> tuple[DataFrame | None, tuple]:
    parts, keys = [], ()
    for v, snap in snaps:
        if snap.feed is None:
            raise ValueError(f"version {v} of {table} was published without a change feed")
        if snap.feed:
            schema = T.StructType.fromJson(json.loads(snap.feed_schema))
            if parts and (snap.feed_keys != keys):
                raise ValueError(f"version {v} of {table} has a feed by other keys")
            keys = snap.feed_keys
            parts.append(spark.read.schema(schema).parquet(f"{root}/{table}/{snap.feed}").withColumn(VERSION, F.lit(v)))
    return (reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts) if parts else None), keys


def stored_feeds(spark: SparkSession, table: str, first: int, last: int, root: str | None = None) -> tuple[DataFrame | None, tuple]:
    """The feeds of versions ``first`` + 1 to ``last`` with their version in
    ``feed_version``, and their keys.  A compaction changes no row; any other
    version without a feed can't be told and raises."""
    root = root or warehouse_root(spark)
    if first > last:
        raise ValueError(f"version {first} comes after {last}")
    return _read(spark, table, root, [(v, snapshot_at(spark, table, v, root)) for v in range(first + 1, last + 1)])


def changes(spark: SparkSession, table: str, first: int, last: int, root: str | None = None) -> DataFrame | None:
    """The net change of every key from version ``first`` to ``last`` (see
    ``net_changes``); None if no version in between holds a feed."""
    feed, keys = stored_feeds(spark, table, first, last, root)
    return None if feed is None else net_changes(feed, list(keys))


def committed_changes(spark: SparkSession, name: str, table: str, first: int, last: int, root: str | None = None) -> DataFrame | None:
    """``changes`` of a table of commits between two manifests; a manifest that
    names the snapshot of the one before adds nothing."""
    root = root or warehouse_root(spark)
    if not 1 <= first <= last:
        raise ValueError(f"there are no changes from manifest {first} to {last}")
    tables = [pin(spark, name, root, v).tables.get(table) for v in range(first, last + 1)]
    snaps = [(first + i, s) for i, s in enumerate(tables) if i and s is not None and (tables[i - 1] is None or s.head != tables[i - 1].head)]
    feed, keys = _read(spark, table, root, snaps)
    return None if feed is None else net_changes(feed, list(keys))
