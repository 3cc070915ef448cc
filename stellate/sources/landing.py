"""Typed landing loads.

The reference reads workbook sheets into pandas, renders every value as SQL
text (missing values become 'nan'/'NaT'), and inserts one row per round
trip.  Here a landed entity is read in parallel with its *declared* schema,
or -- when it arrives as text -- normalised column by column: null tokens
first, then ``try_cast`` to the declared type; values that fail the cast are
reported by ``rejects`` instead of failing the load.
"""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stellate.sources.testdata import NULL_TOKENS


def _clean(c: str, tokens) -> F.Column:
    return F.when(F.col(c).isin(*tokens), F.lit(None)).otherwise(F.col(c))


def _is_text(dtype) -> bool:
    return (dtype if isinstance(dtype, str) else dtype.simpleString()).lower() == "string"


def normalize(raw: DataFrame, types: dict, null_tokens=NULL_TOKENS) -> DataFrame:
    """Turn null tokens into NULL and cast each column to its declared type.

    Tokens are replaced *before* the cast: ``try_cast('nan' as double)`` is
    NaN, not NULL.  In a column declared as text a token is ordinary text.
    Columns not named in ``types`` pass through.
    """
    cols = []
    for c in raw.columns:
        if c in types and _is_text(types[c]):
            cols.append(F.col(c).cast("string").alias(c))
        elif c in types:
            cols.append(_clean(c, null_tokens).try_cast(types[c]).alias(c))
        else:
            cols.append(F.col(c))
    return raw.select(*cols)


def rejects(raw: DataFrame, key_cols, types: dict, null_tokens=NULL_TOKENS,
            name_col: str = "column_name", value_col: str = "raw_value") -> DataFrame:
    """One row per (row, column) whose text is present, is not a null token,
    and does not convert to the declared type -- one pass over the data.
    ``types`` should name the key columns too: a key that doesn't convert
    becomes NULL in ``normalize`` and is reported here by its text."""
    key_cols = [key_cols] if isinstance(key_cols, str) else list(key_cols)
    items = []
    for c, t in types.items():
        if _is_text(t):
            continue
        present = F.col(c).isNotNull() & ~F.col(c).isin(*null_tokens)
        bad = present & F.col(c).try_cast(t).isNull()
        items.append(F.when(bad, F.struct(F.lit(c).alias(name_col), F.col(c).cast("string").alias(value_col))))
    return (raw.select(*key_cols, F.explode(F.array_compact(F.array(*items))).alias("_r"))
            .select(*key_cols, "_r.*"))


def load_entity(spark: SparkSession, path: str, schema: T.StructType | None = None,
                fmt: str = "parquet", **options) -> DataFrame:
    """Read one landed entity.  CSV/JSON get the declared schema (never
    inferred); a CSV with ``header=True`` is bound by the header's names, one
    without by position; parquet carries its own schema and is projected onto
    the declared columns when a schema is given."""
    reader = spark.read.options(**options)
    if fmt == "jdbc":  # ``path`` is the table name; url/user/... come in options
        df = reader.format("jdbc").option("dbtable", path).load()
        return df.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields]) if schema else df
    if fmt == "parquet":
        df = reader.parquet(path)
        if schema is not None:
            df = df.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])
        return df
    if schema is not None and fmt == "csv" and str(options.get("header", "")).lower() == "true":
        return normalize(_by_header(spark, path, schema, options), _types(schema))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.format(fmt).load(path)


def _types(schema: T.StructType) -> dict:
    return {f.name: f.dataType.simpleString() for f in schema.fields}


def _by_header(spark: SparkSession, path: str, schema: T.StructType, options: dict) -> DataFrame:
    """The declared columns of a CSV as text, found by their names in the
    header (Spark binds a given schema by position)."""
    raw = spark.read.options(**{**options, "inferSchema": "false"}).csv(path)
    missing = [f.name for f in schema.fields if f.name not in raw.columns]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    return raw.select(*schema.names)


def load_with_rejects(spark: SparkSession, path: str, schema: T.StructType, key_cols, **options) -> tuple[DataFrame, DataFrame]:
    """Rows of a headed CSV in their declared types, and its rejects: one row
    per value, keys included, that doesn't convert."""
    raw = _by_header(spark, path, schema, {**options, "header": "true"})
    return normalize(raw, _types(schema)), rejects(raw, key_cols, _types(schema))


MALFORMED = "_malformed"


def load_delimited(spark: SparkSession, path: str, schema: T.StructType, max_bad_share: float = 1.0,
                   null_tokens=NULL_TOKENS, **options) -> tuple[DataFrame, DataFrame]:
    """Rows of a CSV without a header in their declared types, and the lines
    that aren't rows: with too many or too few fields, kept whole as ``line``
    with ``file_path``, ``block_start`` (where the part of the file begins that
    a task read) and ``line_in_block`` (from 0).  Empty lines are neither.

    A value that doesn't convert doesn't make a line malformed: it becomes NULL
    and is reported by ``rejects``.  If more than ``max_bad_share`` of the lines
    are malformed nothing is loaded (ValueError).  A field can't hold a line break."""
    text = T.StructType([T.StructField(n, T.StringType()) for n in [*schema.names, MALFORMED]])
    how = {**options, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": MALFORMED}
    raw = spark.read.text(path).select(
        F.col("value").alias("line"), F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block_start"), F.monotonically_increasing_id().alias("_nth"),
        F.from_csv("value", F.lit(text.toDDL()), how).alias("_row"))
    bad, filled = F.col(f"_row.{MALFORMED}").isNotNull(), F.trim("line") != ""
    if max_bad_share < 1:
        n, n_bad = raw.filter(filled).agg(F.count("*"), F.count_if(bad)).first()
        if n_bad > max_bad_share * n:
            raise ValueError(f"{n_bad} of {n} lines of {path} are malformed")
    good = raw.filter(filled & ~bad).select(*[F.col(f"_row.`{n}`") for n in schema.names])
    first = raw.groupBy("file_path", "block_start").agg(F.min("_nth").alias("_first"))  # one row per part that was read
    lines = raw.filter(filled & bad).join(first, ["file_path", "block_start"]).select(
        "line", "file_path", "block_start", (F.col("_nth") - F.col("_first")).alias("line_in_block"))
    return normalize(good, _types(schema), null_tokens), lines


def load_entities(spark: SparkSession, root: str, names, schemas: dict | None = None,
                  fmt: str = "parquet", **options) -> dict:
    """Read every named entity from one landing folder (``root/<name>.<fmt>``);
    for ``fmt="jdbc"`` the entity name is the table (``root`` is then a
    schema prefix, may be empty) and the connection comes in ``options``."""
    schemas = schemas or {}
    if fmt == "jdbc":
        prefix = f"{root}." if root else ""
        return {n: load_entity(spark, f"{prefix}{n}", schemas.get(n), fmt, **options) for n in names}
    return {n: load_entity(spark, f"{root.rstrip('/')}/{n}.{fmt}", schemas.get(n), fmt, **options)
            for n in names}


def append(df: DataFrame, path: str, partition_by=None) -> None:
    """Append by column name: ``df`` is aligned to the existing table's
    column order (so every file has one layout); a column set that differs
    from the table's is an error, as an INSERT with unknown columns is."""
    spark = df.sparkSession
    try:
        existing = spark.read.parquet(path).columns
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        existing = None  # no table yet
    if existing is not None:
        if set(existing) != set(df.columns):
            raise ValueError(f"columns {sorted(df.columns)} do not match table {sorted(existing)}")
        df = df.select(*existing)
    w = df.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def entity_counts(entities: dict, entity_col: str = "entity", count_col: str = "n_rows") -> DataFrame:
    """Row count per loaded entity (global aggregates, partial per task)."""
    parts = [df.agg(F.count(F.lit(1)).cast("bigint").alias(count_col))
             .select(F.lit(name).alias(entity_col), count_col)
             for name, df in entities.items()]
    return reduce(DataFrame.unionByName, parts)


def preview_rows(df: DataFrame, keys, n: int = 15) -> DataFrame:
    """The first ``n`` whole rows of an entity by key (a bounded top-k)."""
    return df.orderBy(*([keys] if isinstance(keys, str) else keys)).limit(n)


def row_text(schema: T.StructType) -> F.Column:
    """A row's columns as text, ``|`` between them: floating point numbers as
    whole ten-thousandths, instants to the microsecond, lists in brackets, NULL as ``~``."""
    def text(c, kind):
        if isinstance(kind, T.ArrayType):
            items = F.transform(c, lambda x: F.coalesce(text(x, kind.elementType), F.lit("~")))
            return F.concat(F.lit("["), F.array_join(items, ","), F.lit("]"))
        if isinstance(kind, (T.FloatType, T.DoubleType)):
            return F.floor(c.cast("double") * 10000).cast("bigint").cast("string")
        if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        return c.cast("string")
    return F.concat_ws("|", *[F.coalesce(text(F.col(f"`{f.name}`"), f.dataType), F.lit("~")) for f in schema.fields])


def preview(entities: dict, keys: dict, n: int = 15, entity_col: str = "entity") -> DataFrame:
    """The first ``n`` rows of each entity by key (a bounded top-k per entity),
    reduced to their key columns and unioned."""
    width = max(len(v) for v in keys.values())
    parts = []
    for name, df in entities.items():
        ks = keys[name]
        top = df.orderBy(*ks).limit(n).select(*ks)
        cols = [F.lit(name).alias(entity_col)]
        cols += [F.col(k).cast("bigint").alias(f"key_{i + 1}") for i, k in enumerate(ks)]
        cols += [F.lit(None).cast("bigint").alias(f"key_{i + 1}") for i in range(len(ks), width)]
        parts.append(top.select(*cols))
    return reduce(DataFrame.unionByName, parts)
