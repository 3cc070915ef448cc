"""Row-level change feeds with both images, and their net effect.

A feed has the keys, ``merge_action`` and the images ``before`` and ``after``
as structs of the other columns (NULL where there is none).  Feeds of
consecutive loads compose to one: the image before the first change and the
image after the last one decide what became of a key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stellate.operators.merge import ACTION, DELETE, INSERT, UPDATE, _as_list

VERSION = "feed_version"


def image_feed(rows: DataFrame, keys, columns, before: str = "t") -> DataFrame:
    """Rows with their new values in ``columns``, the old image in the struct
    ``before`` and an action, as a feed."""
    keys = _as_list(keys)
    rest = [c for c in columns if c not in keys]
    image = F.struct(*[F.col(c) for c in rest])
    old = F.struct(*[F.col(f"{before}.{c}") for c in rest])
    return rows.select(*keys, ACTION, F.when(F.col(ACTION) != INSERT, old).alias("before"),
                       F.when(F.col(ACTION) != DELETE, image).alias("after"))


def net_changes(feed: DataFrame, keys, version_col: str = VERSION) -> DataFrame:
    """One row per key whose first and last images differ: ``keys``,
    ``merge_action``, ``before``, ``after``.

    A key that came and went, or changed and changed back, has no row.  Each
    key may have one row per version.  Grouping is partial before the
    exchange; only the feeds are read, never the table."""
    keys = _as_list(keys)
    v = F.col(version_col)
    net = feed.groupBy(*keys).agg(F.min(F.struct(v.alias("v"), F.col("before").alias("image"))).alias("first"),
                                  F.max(F.struct(v.alias("v"), F.col("after").alias("image"))).alias("last"))
    before, after = F.col("first.image"), F.col("last.image")
    action = F.when(before.isNull(), F.lit(INSERT)).when(after.isNull(), F.lit(DELETE)).otherwise(F.lit(UPDATE))
    return net.filter(~before.eqNullSafe(after)).select(*keys, action.alias(ACTION), before.alias("before"), after.alias("after"))
