"""A corpus pipeline: documents in, packed training sequences out.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet in the shared folder and read again as the next one's
``docs``.  All stages but the last return the columns of ``documents``; each
works on all rows that the one before kept.

The language and benchmark stages judge a row where it is read, with all its
columns.  The verdicts of the other two belong to a row's id and text and are
joined back by a digest of both, so rows of one id, and rows with a null id,
are each kept or dropped by their own text.  Only the keys that go are
joined: broadcast up to a counted bound, beyond it by an exchange.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stellate.llm.bestfit_packing import pack_documents
from stellate.llm.common import read, row_key, stage, stage_path
from stellate.llm.decontaminate import drop_contaminated
from stellate.llm.language_gru import UNKNOWN, fit_languages, label_languages
from stellate.llm.secret_ledger import find_secrets
from stellate.llm.simhash_dedup import group_firsts

KEY = "pipeline_row_key"
BROADCAST_KEYS = 1 << 20  # keys of 32 bytes that are broadcast


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.withColumn(KEY, row_key("doc_id", "text"))


def _small(keys: DataFrame) -> DataFrame:
    """Staged keys, broadcast if they are few."""
    return F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose ``key`` is not in ``gone``."""
    keys = stage(gone.select(F.col("key").alias(KEY)).distinct(), "pipeline-gone")
    return _keyed(docs).join(_small(keys), KEY, "left_anti").select(*docs.columns)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter go; where ``lang`` is null it becomes the
    predicted language.  A language that wasn't learned isn't told from those
    that were: it stays.  If no language can be learned (no row has one), all
    documents stay as they are.  No bound on the score: short texts, and words
    that many languages share, pool to a low one in the right language as well."""
    net = fit_languages(docs)
    if net is None:
        return docs
    found = label_languages(docs, net).filter(F.col("lang_pred") != UNKNOWN)
    return found.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies one row stays: that with the least id (a
    null id comes last, so it stays if the group has no other), then by a
    digest of id and text, then by the other columns."""
    verdicts = stage(group_firsts(docs, shingle=3, max_distance=2), "pipeline-groups")
    # only an id and text that several rows have needs its rows compared
    once = _without(docs, verdicts.filter("not is_first or n_rows > 1"))
    several = verdicts.filter("is_first and n_rows > 1").select(F.col("key").alias(KEY))
    again = (_keyed(docs).join(_small(several), KEY, "left_semi")
             .groupBy(KEY).agg(F.min(F.struct(*docs.columns)).alias("row")))
    return once.unionByName(again.select("row.*"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    return drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a secret go."""
    found = find_secrets(_keyed(docs), stage_path(spark, "secret-ledger"), key_col=KEY)
    return _without(docs, found.filter(F.col("spans") != ""))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents that are left, as pieces of packed sequences."""
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("packing", packing),
]

#: The language stage is a trained network, which SQL can't express; the
#: stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
