"""Golden counts of FIXTURES.md section 4 at sf0.001."""

from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_SMALL

Q = E.queries()


def _count(spark, name, cond=None):
    df = Q[name](spark, SF_SMALL)
    return (df.filter(cond) if cond is not None else df).count()


def test_scd1_action_counts(spark):
    a = Q["merge_actions"](spark, SF_SMALL)
    got = {r["merge_action"]: r["count"] for r in a.groupBy("merge_action").count().collect()}
    assert got == {"INSERT": 15, "UPDATE": 37, "DELETE": 12, "KEEP": 98}


def test_plain_inequality_updates(spark):
    assert _count(spark, "change_sql", F.col("changed")) == 17


def test_scd2_counts(spark):
    assert _count(spark, "scd2_merge") == 231
    feed = Q["scd2_change_feed"](spark, SF_SMALL)
    got = {r["merge_action"]: r["count"] for r in feed.groupBy("merge_action").count().collect()}
    assert got == {"INSERT": 15, "UPDATE": 37}


def test_scd3_moves(spark):
    df = Q["scd3_customer"](spark, SF_SMALL)
    assert df.filter(F.col("addr_prev_validto") == "20011231").count() == 17


def test_bridge_and_fact(spark):
    assert _count(spark, "bridge_employee_territory") == 50
    assert _count(spark, "fact_order_lines") == 6000
    assert _count(spark, "fact_territory_fanout") == 30000


def test_unmatched_and_rejects(spark):
    u = Q["fact_unmatched"](spark, SF_SMALL)
    got = {r["reason"]: r["count"] for r in u.groupBy("reason").count().collect()}
    assert got == {"NULL_KEY": 79, "ORPHAN": 62}
    assert _count(spark, "land_rejects") == 96  # 47 customers and 49 keys
    n = Q["land_normalize"](spark, SF_SMALL)
    assert n.filter(F.col("fin")).count() == 493
    assert n.filter(F.col("od").isNull()).count() == 116


def test_day_number_sums(spark):
    r = Q["scalar_day_number"](spark, SF_SMALL).agg(F.sum("day_number"), F.sum("day_diff")).first()
    assert (r[0], r[1]) == (45304509, 45304005)
