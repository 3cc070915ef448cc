"""Connected components of a link table, by joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stellate.llm.common import join_grouped, stage


def _large_star(links: DataFrame) -> DataFrame:
    """Every node hands its least neighbour to its larger neighbours."""
    both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (join_grouped(both.filter("v > u"), least, ["u"]).select(F.col("v").alias("u"), F.col("m").alias("v"))
            .filter("u <> v").distinct())


def _small_star(links: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours link to the least of them."""
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    return (join_grouped(down, least, ["u"]).select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct())


def _state(links: DataFrame) -> tuple:
    """Changes whenever the links change."""
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def star_components(links: DataFrame, name: str) -> DataFrame:
    """``node, root`` for every node that has a link ``u, v``: the least node
    that it reaches.  Alternates large-star and small-star until the links are
    stars around their least nodes; each round is written to the shared folder.
    A hub is only ever a grouped minimum and one side of an equality join, so
    no list of neighbours is gathered.  No links: no rows."""
    links = stage(links.filter("u <> v").select("u", "v"), f"{name}-links")
    before = None
    while (now := _state(links)) != before:
        before = now
        links = stage(_small_star(_large_star(links)), f"{name}-links")
    return links.select(F.col("u").alias("node"), F.col("v").alias("root"))
