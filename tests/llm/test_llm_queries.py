"""Registered queries against DuckDB, and the columns that their contracts fix."""

import os
import sys

import __spark_entry__ as E
import pytest

from stellate.llm.queries import LLM_ORACLE_SQL, LLM_QUERIES

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(E.__file__)), "tools"))
from oracle_check import digest  # noqa: E402

SF_SMALL = E.SMOKE_DIR

CONTRACT = {
    "op1_token_counts": "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean",
    "op2_quality_classifier": "doc_id bigint, held_out boolean, score double, predicted int",
    "op3_substring_dedup": "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string",
    "op4_decontamination": "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean",
    "op5_license_scan": "doc_id bigint, text_digest string, license string, n_notices bigint, notices string",
    "op6_secret_scan": "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string",
    "op7_bestfit_packing": "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint",
    "op8_exact_topk": "query_id bigint, rank int, vec_id bigint, score bigint",
    "op9_simhash_dedup": "doc_id bigint, fingerprint string, component_id bigint",
    "op10_language_id": "doc_id bigint, held_out boolean, lang_pred string, score double",
    "op11_ranked_search": "item_id bigint, rank int, doc_id bigint, score bigint",
    "op12_periodic_runs": ("doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, "
                           "runs_sha256 string, collapsed_sha256 string"),
    "op13_mixture_packing": ("doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, "
                             "offset bigint, source string"),
}


def test_one_query_of_each_operator():
    assert set(CONTRACT) | {"pipeline"} == set(LLM_QUERIES)
    assert set(LLM_QUERIES) <= set(E.queries()) and set(LLM_ORACLE_SQL) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(CONTRACT))
def test_query(spark, duck, name):
    df = LLM_QUERIES[name](spark, SF_SMALL)
    assert [f"{c} {t}" for c, t in df.dtypes] == CONTRACT[name].split(", ")
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) >= duck.execute("SELECT count(*) FROM " + {
        "op8_exact_topk": "embeddings WHERE vec_id % 50 = 0", "op11_ranked_search": "benchmark"}.get(name, "documents")).fetchone()[0]
    if name in LLM_ORACLE_SQL:
        cur = duck.execute(LLM_ORACLE_SQL[name])
        cols = [c[0] for c in cur.description]
        assert sorted(cols) == sorted(df.columns)
        assert digest(df.columns, rows) == digest(cols, cur.fetchall())
