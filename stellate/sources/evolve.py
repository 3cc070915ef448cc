"""Tables whose schema changes while their folders stay as they were written.

A table has a log of schemas (``_schema/<version>``), each put exclusively.
A column has an id that never changes; files hold columns by id, so a renamed
column is still the same, and a dropped name can come back as another one.
Folders are kept by the schema that they were written under; a read takes one
scan of each schema's folders, finds every present column by its id, casts it
to its present type and fills a column that the folder doesn't know with its
default.  A type can only be widened to one that holds every old value.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stellate.sources.publish import ConcurrentPublish, _fs, put_new, warehouse_root

LOG = "_schema"
#: integer types and the decimal digits that hold each
_INTEGERS = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 19}
_WIDER = {("float", "double"), ("date", "timestamp_ntz"), *((i, f) for i in ("tinyint", "smallint", "int") for f in ("double",)),
          ("tinyint", "float"), ("smallint", "float")}


def widens(old: str, new: str) -> bool:
    """Whether every value of type ``old`` is one of type ``new``."""
    a, b = T._parse_datatype_string(old), T._parse_datatype_string(new)
    old, new = a.simpleString(), b.simpleString()
    if old == new or (old, new) in _WIDER:
        return True
    if old in _INTEGERS and new in _INTEGERS:
        return _INTEGERS[old] <= _INTEGERS[new]
    if isinstance(b, T.DecimalType):
        whole, places = (_INTEGERS[old], 0) if old in _INTEGERS else (
            (a.precision - a.scale, a.scale) if isinstance(a, T.DecimalType) else (99, 99))
        return whole <= b.precision - b.scale and places <= b.scale
    return False


@dataclass(frozen=True)
class Column:
    id: int
    name: str
    type: str
    default: str | None = None  # as text, cast to the column's type


@dataclass(frozen=True)
class Evolving:
    """One version of a table's schema."""

    table: str
    root: str
    version: int
    next_id: int
    columns: tuple

    def column(self, name: str) -> Column:
        for c in self.columns:
            if c.name == name:
                return c
        raise ValueError(f"{self.table} has no column {name}")

    def physical(self) -> T.StructType:
        return T.StructType([T.StructField(f"c{c.id}", T._parse_datatype_string(c.type)) for c in self.columns])


def _path(root: str, table: str, version: int) -> str:
    return f"{root}/{table}/{LOG}/{version:020d}"


def _put(spark: SparkSession, s: Evolving) -> Evolving:
    names = [c.name for c in s.columns]
    if len(set(names)) < len(names):
        raise ValueError(f"{s.table} has a column twice")
    text = json.dumps({"next_id": s.next_id, "columns": [asdict(c) for c in s.columns]})
    if not put_new(spark, _path(s.root, s.table, s.version), text):
        raise ConcurrentPublish(f"schema {s.version} of {s.table} exists")
    return s


def create(spark: SparkSession, table: str, columns: dict[str, str], root: str | None = None) -> Evolving:
    """Schema 1 of a new table: column names and types."""
    made = tuple(Column(i, n, t) for i, (n, t) in enumerate(columns.items(), 1))
    return _put(spark, Evolving(table, root or warehouse_root(spark), 1, len(made) + 1, made))


def schema_at(spark: SparkSession, table: str, version: int | None = None, root: str | None = None) -> Evolving:
    """A version of the table's schema, the newest without a number."""
    root = root or warehouse_root(spark)
    if version is None:
        fs, p = _fs(spark, f"{root}/{table}/{LOG}")
        if not fs.exists(p):
            raise FileNotFoundError(f"table {table} has no schema under {root}")
        version = max(int(f.getPath().getName()) for f in fs.listStatus(p) if not f.getPath().getName().startswith((".", "_")))
    e = json.loads(spark.read.text(_path(root, table, version), wholetext=True).first()[0])
    return Evolving(table, root, version, e["next_id"], tuple(Column(**c) for c in e["columns"]))


def alter(spark: SparkSession, schema: Evolving, add: dict | None = None, rename: dict | None = None,
          widen: dict | None = None, drop=()) -> Evolving:
    """The schema after ``drop`` (names), ``rename`` (old name -> new), ``widen``
    (name -> type) and ``add`` (name -> type, or (type, default as text)), in
    this order; fails if another change was made since ``schema`` was read."""
    columns = list(schema.columns)
    for name in drop:
        columns.remove(schema.column(name))
    for old, new in (rename or {}).items():
        c = schema.column(old)
        columns[columns.index(c)] = replace(c, name=new)
    for name, kind in (widen or {}).items():
        at = next((i for i, c in enumerate(columns) if c.name == name), None)
        if at is None:
            raise ValueError(f"{schema.table} has no column {name}")
        if not widens(columns[at].type, kind):
            raise ValueError(f"{schema.table}.{name}: {columns[at].type} doesn't widen to {kind}")
        columns[at] = replace(columns[at], type=kind)
    next_id = schema.next_id
    for name, kind in (add or {}).items():
        kind, default = (kind, None) if isinstance(kind, str) else kind
        columns.append(Column(next_id, name, kind, default))
        next_id += 1
    return _put(spark, Evolving(schema.table, schema.root, schema.version + 1, next_id, tuple(columns)))


def append(df: DataFrame, schema: Evolving) -> None:
    """Add rows under ``schema``: ``df`` has exactly its columns, in types that widen to theirs."""
    if set(df.columns) != {c.name for c in schema.columns}:
        raise ValueError(f"columns {sorted(df.columns)} do not match {schema.table}, schema {schema.version}")
    for c in schema.columns:
        if not widens(df.schema[c.name].dataType.simpleString(), c.type):
            raise ValueError(f"{schema.table}.{c.name}: {df.schema[c.name].dataType.simpleString()} doesn't widen to {c.type}")
    rows = df.select(*[F.col(c.name).cast(c.type).alias(f"c{c.id}") for c in schema.columns])
    rows.write.mode("errorifexists").parquet(f"{schema.root}/{schema.table}/schema={schema.version}/part={uuid.uuid4().hex}")


def read(spark: SparkSession, table: str, root: str | None = None, version: int | None = None) -> DataFrame:
    """All rows as the newest schema has them, or as ``version`` has them.

    Rows that were written under a later schema than ``version`` are read too:
    a column that was widened since must still fit (a cast that fails raises)."""
    now = schema_at(spark, table, version, root)
    fs, p = _fs(spark, f"{now.root}/{table}")
    parts = []
    for f in sorted(f.getPath().getName() for f in fs.listStatus(p)):
        if not f.startswith("schema="):
            continue
        then = schema_at(spark, table, int(f.split("=")[1]), now.root)
        known = {c.id for c in then.columns}
        rows = spark.read.schema(then.physical()).parquet(f"{now.root}/{table}/{f}/*")
        parts.append(rows.select(*[
            (F.col(f"c{c.id}") if c.id in known else F.lit(c.default)).cast(c.type).alias(c.name) for c in now.columns]))
    if not parts:
        return spark.createDataFrame([], T.StructType([T.StructField(c.name, T._parse_datatype_string(c.type)) for c in now.columns]))
    return reduce(DataFrame.unionByName, parts)
