"""Constraint audits.  Parquet tables enforce no PRIMARY KEY, FOREIGN KEY,
UNIQUE or NOT NULL, so each constraint is a job that returns the violating
rows (empty = pass), plus the two ON DELETE/UPDATE CASCADE rewrites."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _as_list(x):
    return [x] if isinstance(x, str) else list(x)


def duplicate_keys(df: DataFrame, keys, count_col: str = "n_rows") -> DataFrame:
    """Primary-key / UNIQUE audit: keys that occur more than once or hold a
    NULL.  The count is partially aggregated before the shuffle, so a hot
    key costs one row per task, not one row per occurrence."""
    keys = _as_list(keys)
    any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col))
            .filter((F.col(count_col) > 1) | any_null)
            .withColumn(count_col, F.col(count_col).cast("bigint")))


def unique_among(df: DataFrame, keys, flag_col: str, count_col: str = "n_rows") -> DataFrame:
    """UNIQUE restricted to rows where ``flag_col`` holds (e.g. current versions)."""
    return duplicate_keys(df.filter(F.col(flag_col)), keys, count_col)


def orphans(child: DataFrame, fk_cols, parent: DataFrame, pk_cols) -> DataFrame:
    """Foreign-key audit: child rows with a non-NULL key absent from the parent.
    A NULL foreign key is allowed (SQL semantics)."""
    fk_cols, pk_cols = _as_list(fk_cols), _as_list(pk_cols)
    not_null = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in fk_cols])
    parent_keys = parent.select(*[F.col(p).alias(f) for p, f in zip(pk_cols, fk_cols)])
    return child.filter(not_null).join(parent_keys, fk_cols, "left_anti")


def null_violations(df: DataFrame, key_cols, cols, name_col: str = "column_name") -> DataFrame:
    """NOT NULL audit over many columns in one pass: one output row per
    (row, column) that holds a NULL."""
    key_cols = _as_list(key_cols)
    names = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in cols]))
    return df.select(*key_cols, F.explode(names).alias(name_col))


def length_violations(df: DataFrame, key_cols, limits: dict, name_col: str = "column_name") -> DataFrame:
    """Narrowing audit: values longer than the target column allows, one pass."""
    key_cols = _as_list(key_cols)
    items = [F.when(F.length(F.col(c)) > n,
                    F.struct(F.lit(c).alias(name_col),
                             F.length(F.col(c)).cast("bigint").alias("length"),
                             F.lit(n).cast("bigint").alias("max_length")))
             for c, n in limits.items()]
    return (df.select(*key_cols, F.explode(F.array_compact(F.array(*items))).alias("_v"))
            .select(*key_cols, "_v.*"))


def declared(entity, parents: dict) -> dict:
    """The audits that a registry entity declares, by name: each a function
    from the written table to its violations.  References whose parent isn't
    in ``parents`` (name -> DataFrame) are left out."""
    checks = {}
    if entity.key:
        checks["primary_key"] = lambda w: duplicate_keys(w, entity.key)
    if entity.unique_current:
        checks["unique_current"] = lambda w: unique_among(w, entity.unique_current, "is_current")
    for cols, parent, parent_cols in entity.foreign_keys:
        if parent in parents:
            checks[f"fk_{'_'.join(cols)}"] = lambda w, c=cols, p=parents[parent], pc=parent_cols: orphans(w, c, p, pc)
    key = entity.key or entity.not_null[:1]
    if entity.not_null:
        checks["not_null"] = lambda w: null_violations(w, key, entity.not_null)
    if entity.lengths:
        checks["lengths"] = lambda w: length_violations(w, key, entity.lengths)
    return checks


def cascade_delete(child: DataFrame, fk_cols, deleted_parent_keys: DataFrame, pk_cols) -> DataFrame:
    """ON DELETE CASCADE: the child without rows that reference deleted keys."""
    fk_cols, pk_cols = _as_list(fk_cols), _as_list(pk_cols)
    gone = deleted_parent_keys.select(*[F.col(p).alias(f) for p, f in zip(pk_cols, fk_cols)])
    return child.join(gone, fk_cols, "left_anti")


def cascade_update(child: DataFrame, fk_col: str, key_map: DataFrame,
                   old_col: str = "old_key", new_col: str = "new_key") -> DataFrame:
    """ON UPDATE CASCADE: rewrite ``fk_col`` through an (old -> new) key map."""
    m = key_map.select(F.col(old_col).alias(fk_col), F.col(new_col).alias("_new"))
    cols = [F.coalesce(F.col("_new"), F.col(fk_col)).cast(child.schema[fk_col].dataType).alias(fk_col)
            if c == fk_col else F.col(c) for c in child.columns]
    return child.join(m, fk_col, "left").select(*cols)


def assert_clean(violations: DataFrame, what: str) -> None:
    """Raise if an audit found anything (reads at most one row)."""
    if violations.limit(1).count():
        raise ValueError(f"audit failed: {what}")
