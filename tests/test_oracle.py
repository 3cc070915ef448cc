"""Every registered query equals its DuckDB oracle on the sf0.001 tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from conftest import SF_SMALL  # noqa: E402
from oracle_check import digest  # noqa: E402

from stellate.plans.queries import QUERIES  # noqa: E402

NAMES = sorted(QUERIES)


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(E.oracle_sql())
    assert set(NAMES) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[:2] == ["order_id", "line_number"]


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    cur = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert digest(df.columns, srows) == digest(dcols, drows)


SCALE_PATHS = ["fact_order_lines", "fact_key_lookup", "surrogate_keys", "scd2_version_keys", "dim_products",
               "bridge_employee_territory", "merge_actions", "scd1_merge", "scd2_merge", "scd2_change_feed",
               "scd3_customer", "scd4_current", "fact_append_idempotent"]


@pytest.mark.parametrize("name", SCALE_PATHS)
def test_distributed_paths_match_oracle(spark, duck, name):
    """The paths taken at scale (range-partitioned numbering, shuffle merge,
    anti-join append) give the oracle's answer too."""
    spark.conf.set("stellate.keys.singleTaskRows", "0")
    spark.conf.set("stellate.merge.broadcastBytes", "0")
    try:
        df = E.queries()[name](spark, SF_SMALL)
        srows = [tuple(r) for r in df.collect()]
    finally:
        spark.conf.unset("stellate.keys.singleTaskRows")
        spark.conf.unset("stellate.merge.broadcastBytes")
    cur = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    assert digest(df.columns, srows) == digest(dcols, cur.fetchall())
