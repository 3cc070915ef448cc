"""Small tables that every operator of the subpackage must take."""

import random

from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])

#: names that operators use inside; here they are just other columns
CLASHES = ["fp", "digest", "anchor", "anchors", "h1", "windows", "is_copy", "node", "root", "n", "n_bytes", "score",
           "kind", "start", "spans", "shard", "length", "piece", "key", "value", "line", "word", "blob", "rank"]


def docs(spark, rows, clashes=False):
    """``rows``: (doc_id, text) or (doc_id, text, lang)."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else None, "src", None if r[1] is None else len(r[1])) for r in rows]
    df = spark.createDataFrame(full, DOCS)
    if clashes:
        from pyspark.sql import functions as F
        df = df.select("*", *[F.lit("x").alias(c) for c in CLASHES])
    return df


def prose(rng: random.Random, n: int, vocabulary: int = 400) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))
