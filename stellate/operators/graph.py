"""Closures over references: ancestors in a hierarchy, and what a delete takes along.

Both follow pointers by doubling: after i rounds a row points to its ancestor
2**i steps up, so a chain of a thousand takes ten rounds, not a thousand.
Every round is written to the shared folder, so a lost executor repeats one
round, and plans stay short.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stellate.sources.publish import checkpoint_table


def _any(df: DataFrame) -> bool:
    return df.limit(1).count() > 0


def _edges(df: DataFrame, key: str, parent: str) -> DataFrame:
    """Distinct ``d`` -> ``a`` of rows whose parent is a row too."""
    kind = df.schema[key].dataType
    e = df.select(F.col(key).alias("d"), F.col(parent).cast(kind).alias("a")).filter("d IS NOT NULL AND a IS NOT NULL").distinct()
    return e.join(df.select(F.col(key).alias("a")).distinct(), "a", "left_semi").select("d", "a")


def _twice(jump: DataFrame) -> DataFrame:
    """Pointers twice as far."""
    return jump.join(jump.select(F.col("d").alias("a"), F.col("a").alias("b")), "a").select("d", F.col("b").alias("a")).distinct()


def cycle_members(df: DataFrame, key: str, parent: str) -> DataFrame:
    """``key`` of the rows that are their own ancestors."""
    return _cycle(checkpoint_table(_edges(df, key, parent), "edges")).select(F.col("d").alias(key))


def _cycle(edges: DataFrame) -> DataFrame:
    # whoever still points somewhere after as many steps as there are edges leads into a cycle, and points at one
    n, steps, jump = edges.count(), 1, edges
    while steps <= n and _any(jump):
        jump, steps = checkpoint_table(_twice(jump), "jump"), steps * 2
    return jump.select(F.col("a").alias("d")).distinct()


def ancestors(df: DataFrame, key: str, parent: str, ancestor_col: str = "ancestor",
              distance_col: str = "distance") -> tuple[DataFrame, DataFrame]:
    """All pairs of a row and a row above it -- ``key``, ``ancestor``,
    ``distance`` in steps -- and the members of cycles (``key``).

    A NULL parent, or one that is no row, is none.  In a cycle everyone is above
    everyone, at any distance: a member's own parent is left out of the pairs
    and the member reported, so rows below a cycle have the member that they
    hang on, and what hangs below that, as ancestors.  A row with several
    parents has the ancestors of all, each at its least distance."""
    edges = checkpoint_table(_edges(df, key, parent), "edges")
    cycle = checkpoint_table(_cycle(edges), "cycle")
    jump = checkpoint_table(edges.join(cycle, "d", "left_anti").select("d", "a"), "jump")
    parts, steps = [jump.withColumn("n", F.lit(1).cast("bigint"))], 1
    while _any(jump):
        # the first half of the way is a pointer, the second any pair so far
        above = reduce(DataFrame.unionByName, parts).select(F.col("d").alias("a"), F.col("a").alias("b"), "n")
        further = jump.join(above, "a").select("d", F.col("b").alias("a"), (F.col("n") + steps).alias("n"))
        parts.append(checkpoint_table(further, "ancestors"))
        jump, steps = checkpoint_table(_twice(jump), "jump"), steps * 2
    pairs = reduce(DataFrame.unionByName, parts).groupBy("d", "a").agg(F.min("n").alias("n"))
    return (pairs.select(F.col("d").alias(key), F.col("a").alias(ancestor_col), F.col("n").alias(distance_col)),
            cycle.select(F.col("d").alias(key)))


def marked_below(edges: DataFrame, marked: DataFrame) -> DataFrame:
    """``d`` of ``marked`` and of all rows with one of them above, cycles included.  edges: ``d``, ``a``."""
    n, steps, jump = edges.count(), 1, edges
    marked = marked.select("d").distinct()
    while steps <= 2 * n and _any(jump):
        hit = jump.join(marked.select(F.col("d").alias("a")), "a", "left_semi").select("d")
        marked = checkpoint_table(marked.unionByName(hit).distinct(), "marked")
        jump, steps = checkpoint_table(_twice(jump), "jump"), steps * 2
    return marked


# ---------------------------------------------------------------- cascades

CASCADE, SET_NULL, RESTRICT = "cascade", "set null", "restrict"


def _key(cols, kinds) -> F.Column:
    """Key columns as one value, in the types of the key that they refer to."""
    return F.struct(*[F.col(c).cast(t).alias(f"k{i}") for i, (c, t) in enumerate(zip(cols, kinds, strict=True))])


def _present(cols) -> F.Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])


def cascade_closure(tables: dict[str, DataFrame], entities: list, deletes: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The tables after deleting rows and all that their references take along.

    ``entities`` declare keys, references and what a delete does
    (``catalog.Entity.on_delete``: cascade, set null; a reference without a
    declaration, or ``restrict``, fails if a row that stays still refers to a
    deleted one).  ``deletes`` has the key columns of the rows to delete.  The
    deleted keys grow along all references until nothing is added; references
    of a table to itself are followed by doubling.  Cycles, through several
    tables too, end when no new key comes."""
    entities = [e for e in entities if e.name in tables]
    by_name = {e.name: e for e in entities}
    kinds = {e.name: [tables[e.name].schema[c].dataType for c in e.key] for e in entities}
    gone: dict[str, DataFrame] = {}
    new = {name: checkpoint_table(df.select(_key(by_name[name].key, kinds[name]).alias("d")).distinct(), "gone")
           for name, df in deletes.items()}
    self_edges = {}
    for e in entities:
        for cols, parent, _ in e.foreign_keys:
            if parent == e.name and e.on_delete.get(tuple(cols)) == CASCADE:
                rows = tables[e.name].filter(_present(cols)).select(_key(e.key, kinds[e.name]).alias("d"), _key(cols, kinds[e.name]).alias("a"))
                self_edges.setdefault(e.name, []).append(rows)
    self_edges = {name: checkpoint_table(reduce(DataFrame.unionByName, parts).distinct(), "self-edges")
                  for name, parts in self_edges.items()}

    def fresh(name: str, found: DataFrame) -> DataFrame:
        if name in self_edges:
            found = marked_below(self_edges[name], found)
        return checkpoint_table(found.distinct().join(gone[name], "d", "left_anti") if name in gone else found.distinct(), "gone")

    new = {name: fresh(name, found) for name, found in new.items()}
    while new:
        for name, found in new.items():
            gone[name] = gone[name].unionByName(found) if name in gone else found
        hits: dict[str, list] = {}
        for e in entities:
            for cols, parent, _ in e.foreign_keys:
                if parent in new and parent != e.name and e.on_delete.get(tuple(cols)) == CASCADE:
                    ref = new[parent].select(F.col("d").alias("ref"))
                    rows = tables[e.name].filter(_present(cols)).select(
                        _key(e.key, kinds[e.name]).alias("d"), _key(cols, kinds[parent]).alias("ref"))
                    hits.setdefault(e.name, []).append(rows.join(ref, "ref", "left_semi").select("d"))
        found = {name: fresh(name, reduce(DataFrame.unionByName, parts)) for name, parts in hits.items()}
        new = {name: keys for name, keys in found.items() if _any(keys)}

    out = {}
    for e in entities:
        left = tables[e.name]
        if e.name in gone:
            left = (left.withColumn("_k", _key(e.key, kinds[e.name])).join(gone[e.name].select(F.col("d").alias("_k")), "_k", "left_anti")
                    .drop("_k"))
        for cols, parent, _ in e.foreign_keys:
            if parent not in gone:
                continue
            action = e.on_delete.get(tuple(cols), RESTRICT)
            if action == CASCADE:
                continue
            lost = gone[parent].select(F.col("d").alias("_r"), F.lit(True).alias("_lost"))
            if action == SET_NULL:
                keyed = left.withColumn("_r", F.when(_present(cols), _key(cols, kinds[parent]))).join(lost, "_r", "left")
                left = keyed.select(*[F.when(F.col("_lost"), F.lit(None)).otherwise(F.col(c)).alias(c) if c in cols else F.col(c)
                                      for c in left.columns])
            else:
                held = left.filter(_present(cols)).withColumn("_r", _key(cols, kinds[parent])).join(lost, "_r", "left_semi")
                if _any(held):
                    raise ValueError(f"rows of {e.name} still refer to deleted rows of {parent}")
        out[e.name] = left
    return out
