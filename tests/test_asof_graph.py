"""Point-in-time lookups, hierarchies and cascades."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stellate.operators.asof import lookup_asof, overlapping_versions
from stellate.operators.graph import ancestors, cascade_closure, cycle_members, marked_below
from stellate.sources.catalog import Entity

DAY = dt.date(2000, 1, 1)


def day(n):
    return None if n is None else DAY + dt.timedelta(n)


def test_order_lines_are_looked_up_per_order(spark, monkeypatch):
    from conftest import SF_SMALL
    from stellate.plans import queries
    facts = []
    monkeypatch.setattr(queries, "lookup_asof", lambda fact, *a, **kw: facts.append(fact) or lookup_asof(fact, *a, **kw))
    found = queries.q_fact_asof_lookup(spark, SF_SMALL)
    assert "l_linenumber" not in facts[0].columns
    lines, orders = (queries.td.table(spark, SF_SMALL, t) for t in ("lineitem", "orders"))
    assert found.count() == lines.join(orders, F.expr("l_orderkey = o_orderkey")).count() > facts[0].count()


def versions_and_lines(seed, n_keys=20, n_lines=300):
    rng = random.Random(seed)
    versions, sk = [], 0
    for k in range(n_keys):
        at = rng.randrange(-50, 100)
        for _ in range(rng.randrange(0, 7)):
            last = at + rng.choice([0, 1, 3, 40, 400])
            sk += 1
            versions.append((k, day(at), day(None if rng.random() < 0.1 else last), sk))
            if versions[-1][2] is None:
                break
            at = last + rng.choice([1, 1, 10])
    versions += [(None, day(0), None, 900), (3, None, day(5), 901)]
    lines = [(i, rng.choice([None, 99, *range(n_keys)]), day(rng.choice([None, *range(-80, 500)]))) for i in range(n_lines)]
    return versions, lines


def tables(spark, versions, lines):
    return (spark.createDataFrame(versions, "k long, since date, until date, sk long"),
            spark.createDataFrame(lines, "line long, key long, at date"))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_asof_equals_brute_force(spark, seed):
    versions, lines = versions_and_lines(seed)
    v, f = tables(spark, versions, lines)
    assert overlapping_versions(v.filter("k IS NOT NULL"), "k", "since", "until").count() == 0

    def valid(key, at):
        return [sk for k, a, b, sk in versions if k is not None and k == key and a and at and a <= at and (b is None or at <= b)]
    want = sorted((i, sk) for i, k, at in lines for sk in (valid(k, at) or [None]) )
    got = lookup_asof(f, v, "key", "at", "k", {"sk": "version"}, "since", "until", how="left")
    assert sorted(((r.line, r.version) for r in got.collect()), key=str) == sorted(want, key=str)
    inner = lookup_asof(f, v, "key", "at", "k", {"sk": "version"}, "since", "until")
    assert sorted((r.line, r.version) for r in inner.collect()) == sorted(w for w in want if w[1] is not None)
    assert inner.columns == ["line", "key", "at", "version"]


def test_asof_takes_empty_sides_and_finds_overlaps(spark):
    v, f = tables(spark, [(1, day(0), day(9), 1), (1, day(9), None, 2)], [(1, 1, day(3))])
    assert [r.sk for r in overlapping_versions(v, "k", "since", "until").collect()] == [2]
    assert lookup_asof(f.limit(0), v, "key", "at", "k", {"sk": "s"}, "since", "until", "left").count() == 0
    assert [r.s for r in lookup_asof(f, v.limit(0), "key", "at", "k", {"sk": "s"}, "since", "until", "left").collect()] == [None]


def test_asof_of_a_hot_key_is_split(spark):
    """A key with a third of all lines: no range join, and adaptive execution splits what one bucket still holds."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, val in conf.items():
        spark.conf.set(k, val)
    try:
        f = spark.range(30_000).select(F.col("id").alias("line"), F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 900).alias("key"),
                                       F.date_add(F.lit(DAY), (F.col("id") % 10).cast("int")).alias("at")).repartition(8)
        v = spark.range(900).select(F.col("id").alias("k"), F.lit(DAY).alias("since"), F.lit(None).cast("date").alias("until"),
                                    (F.col("id") + 1000).alias("sk"))
        out = lookup_asof(f, v, "key", "at", "k", {"sk": "version"}, "since", "until")
        assert out.count() == 30_000 and out.filter("version <> key + 1000").count() == 0
        out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan and "NestedLoop" not in plan and "Cartesian" not in plan
    finally:
        for k, val in old.items():
            spark.conf.unset(k) if val is None else spark.conf.set(k, val)


# ---------------------------------------------------------------- hierarchies

def test_chain_of_a_thousand_takes_ten_rounds(spark, monkeypatch):
    from stellate.operators import graph
    rounds, real = [], graph.checkpoint_table
    monkeypatch.setattr(graph, "checkpoint_table", lambda df, name: rounds.append(name) or real(df, name))
    df = spark.range(1000).select("id", F.when(F.col("id") > 0, F.col("id") - 1).alias("up"))
    pairs, cycle = ancestors(df, "id", "up")
    assert pairs.count() == 1000 * 999 // 2 and cycle.count() == 0
    assert pairs.filter("distance <> id - ancestor").count() == 0
    assert rounds.count("ancestors") <= 11


def brute_ancestors(edges, cycle):
    up = {}
    for d, a in edges:
        up.setdefault(d, set()).add(a)
    out = {}
    for d in up:
        at, n = {d}, 0
        while at:
            at, n = {a for x in at if x not in cycle for a in up.get(x, ())}, n + 1
            for a in at:
                out.setdefault((d, a), n)
    return out


def test_cycles_dangling_parents_and_several_parents(spark):
    rows = [(1, 2), (2, 3), (3, 1), (4, 3), (5, 4), (6, None), (7, 6), (8, 999), (9, 9), (10, 9), (None, 1), (11, 5), (11, 7), (7, 6)]
    df = spark.createDataFrame(rows, "id long, up long")
    pairs, cycle = ancestors(df, "id", "up")
    members = {r.id for r in cycle.collect()}
    assert members == {1, 2, 3, 9} == {r.id for r in cycle_members(df, "id", "up").collect()}
    ids = {i for i, _ in rows}
    edges = {(d, a) for d, a in rows if d is not None and a in ids and a is not None}
    assert {(r.id, r.ancestor): r.distance for r in pairs.collect()} == brute_ancestors(edges, members)


def test_marked_below_reaches_everything_also_through_cycles(spark):
    rng = random.Random(3)
    for _ in range(3):
        up = {i: rng.randrange(60) for i in range(60) if rng.random() < 0.85}
        edges = spark.createDataFrame(list(up.items()), "d long, a long")
        marked = {i for i in range(60) if rng.random() < 0.05} or {0}
        want = set(marked)
        for i in range(60):
            at, seen = i, set()
            while at in up and at not in seen:
                seen.add(at)
                at = up[at]
                if at in marked:
                    want.add(i)
        got = {r.d for r in marked_below(edges, spark.createDataFrame([(i,) for i in marked], "d long")).collect()}
        assert got == want


# ---------------------------------------------------------------- cascades

def entity(name, cols, key, refs=(), on_delete=None):
    return Entity(name, T.StructType([T.StructField(c, T.LongType()) for c in cols]), key, list(refs), on_delete=on_delete or {})


def test_cascades_follow_cycles_of_tables(spark):
    a = spark.createDataFrame([(i, i - 1 if i % 5 else None) for i in range(40)], "id long, b long")
    b = spark.createDataFrame([(i, i) for i in range(40)], "id long, a long")
    es = [entity("a", ["id", "b"], ["id"], [(["b"], "b", ["id"])], {("b",): "cascade"}),
          entity("b", ["id", "a"], ["id"], [(["a"], "a", ["id"])], {("a",): "cascade"})]
    left = cascade_closure({"a": a, "b": b}, es, {"a": a.filter("id = 11").select("id")})
    gone = set(range(11, 15))  # 11 takes b 11, which takes a 12, ... up to the next without a reference
    assert {r.id for r in left["a"].collect()} == set(range(40)) - gone == {r.id for r in left["b"].collect()}


def test_restrict_set_null_and_composite_keys(spark):
    p = spark.createDataFrame([(1, 1), (1, 2), (2, 1)], "x int, y int")
    c = spark.createDataFrame([(1, 1, 1), (2, 1, 2), (3, None, 1), (4, 2, 1)], "id long, x long, y long")
    refs = [(["x", "y"], "p", ["x", "y"])]
    gone = p.filter("x = 1 AND y = 2")
    cut = cascade_closure({"p": p, "c": c}, [entity("p", ["x", "y"], ["x", "y"]), entity("c", ["id", "x", "y"], ["id"], refs, {("x", "y"): "set null"})],
                          {"p": gone})
    assert sorted(map(tuple, cut["c"].collect()), key=str) == [(1, 1, 1), (2, None, None), (3, None, 1), (4, 2, 1)]
    assert cut["p"].count() == 2
    for declared in ({}, {("x", "y"): "restrict"}):
        es = [entity("p", ["x", "y"], ["x", "y"]), entity("c", ["id", "x", "y"], ["id"], refs, declared)]
        with pytest.raises(ValueError, match="still refer"):
            cascade_closure({"p": p, "c": c}, es, {"p": gone})
        # a row that goes itself holds nothing back
        left = cascade_closure({"p": p, "c": c}, es, {"p": gone, "c": c.filter("id = 2").select("id")})
        assert left["c"].count() == 3
    es = [entity("p", ["x", "y"], ["x", "y"]), entity("c", ["id", "x", "y"], ["id"], refs, {("x", "y"): "cascade"})]
    assert cascade_closure({"p": p, "c": c}, es, {"p": gone})["c"].count() == 3


def test_self_reference_cascades_down_a_long_chain(spark):
    t = spark.range(600).select("id", F.when(F.col("id") > 0, F.col("id") - 1).alias("up"))
    es = [entity("t", ["id", "up"], ["id"], [(["up"], "t", ["id"])], {("up",): "cascade"})]
    left = cascade_closure({"t": t}, es, {"t": t.filter("id = 100").select("id")})["t"]
    assert {r.id for r in left.collect()} == set(range(100))
