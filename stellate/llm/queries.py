"""Registered queries of the training-data operators, each over its whole table."""

from __future__ import annotations

import zlib
from dataclasses import replace

import corpus_pipeline
import numpy as np
import public_tokenizers
from pyspark.sql import functions as F

from stellate.llm.bestfit_packing import pack_documents
from stellate.llm.common import read, stage_path
from stellate.llm.decontaminate import find_contamination
from stellate.llm.exact_topk import exact_top_k
from stellate.llm.language_gru import identify_languages
from stellate.llm.license_scan import known_licenses, scan_licenses
from stellate.llm.max_sketch_search import ranked_search
from stellate.llm.mixture_packing import mix_documents
from stellate.llm.oracle import LLM_ORACLE_SQL  # noqa: F401
from stellate.llm.periodic_runs import periodic_runs
from stellate.llm.quality_pu import score_quality
from stellate.llm.secret_ledger import RULES, find_secrets, scan_blobs
from stellate.llm.simhash_dedup import simhash_groups
from stellate.llm.substring_dedup import remove_repeats
from stellate.llm.token_counts import token_counts


def op1_token_counts(spark, d):
    return token_counts(read(spark, d, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op2_quality_classifier(spark, d):
    return score_quality(read(spark, d, "documents"), read(spark, d, "labels"))


def op3_substring_dedup(spark, d):
    return remove_repeats(read(spark, d, "documents"))


def op4_decontamination(spark, d):
    return find_contamination(read(spark, d, "documents"), read(spark, d, "benchmark")).drop("items")


def op5_license_scan(spark, d):
    return scan_licenses(read(spark, d, "documents"), known_licenses(spark))


def op6_secret_scan(spark, d):
    """All documents, over a ledger that an earlier scan has filled: that saw
    about half of them, and an older version of one rule.  So the scan itself
    runs all rules on blobs that are new, and the changed rule on the others."""
    docs, ledger = read(spark, d, "documents"), stage_path(spark, "secret-ledger")
    earlier = docs.filter(F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0).select(F.col("doc_id").alias("path"), "text")
    scan_blobs(earlier, ledger, (replace(RULES[0], version=0), *RULES[1:]))
    return find_secrets(docs, ledger)


def op7_bestfit_packing(spark, d):
    return pack_documents(read(spark, d, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op8_exact_topk(spark, d):
    return exact_top_k(read(spark, d, "embeddings"))


def op9_simhash_dedup(spark, d):
    return simhash_groups(read(spark, d, "documents"), shingle=3, max_distance=2)


def op10_language_id(spark, d):
    return identify_languages(read(spark, d, "documents"))


def op11_ranked_search(spark, d):
    return ranked_search(read(spark, d, "documents"), read(spark, d, "benchmark"))


def periodic_tail(code: np.ndarray, doc_id) -> np.ndarray | None:
    """The words of one document in ten, by a checksum of its id, with a tail that repeats (no id: unchanged)."""
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    n = len(code)
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return np.concatenate([code[:a], code[a + np.arange(n - a) % p]])


def op12_periodic_runs(spark, d):
    found = periodic_runs(read(spark, d, "documents"), rewrite=periodic_tail)
    # the longest run, ties: least start, then period
    longest = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("rest"), r["start"].alias("start"),
                                                                 r["period"].alias("period"))))
    line = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","),
                                                  r["period"].cast("string"), F.lit("\n")))
    return found.withColumn("longest", longest).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), F.col("longest.start").alias("start"),
        (-F.col("longest.rest")).alias("length"), F.col("longest.period").alias("period"),
        F.expr("(-1000 * longest.rest) div longest.period").alias("exponent_milli"),
        F.sha2(F.array_join(line, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


def op13_mixture_packing(spark, d):
    pieces = mix_documents(read(spark, d, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "source")


LLM_QUERIES = {
    "op1_token_counts": op1_token_counts,
    "op2_quality_classifier": op2_quality_classifier,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_decontamination": op4_decontamination,
    "op5_license_scan": op5_license_scan,
    "op6_secret_scan": op6_secret_scan,
    "op7_bestfit_packing": op7_bestfit_packing,
    "op8_exact_topk": op8_exact_topk,
    "op9_simhash_dedup": op9_simhash_dedup,
    "op10_language_id": op10_language_id,
    "op11_ranked_search": op11_ranked_search,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_mixture_packing": op13_mixture_packing,
    "pipeline": corpus_pipeline.run,
}
