"""Star-wide commits, stored feeds, compaction and retention."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from stellate.operators.feed import net_changes
from stellate.operators.merge import scd1_load
from stellate.operators.scd import scd2_load, scd3_load
from stellate.plans import pipeline
from stellate.sources import testdata as td
from stellate.sources.commit import Commit, manifest_versions, pin, pinned_snapshots, removable_folders
from stellate.sources.feeds import changes, committed_changes, stored_feeds
from stellate.sources.publish import (
    ConcurrentPublish, _folds, compact, current_snapshot, publish, read_snapshot, read_table, removable, snapshot_at,
)


def kv(spark, rows, schema="k long, v string"):
    return spark.createDataFrame(rows, schema)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


# ---------------------------------------------------------------- commits

def test_all_tables_switch_at_once(spark, tmp_path):
    root = str(tmp_path / "wh")
    one = Commit(spark, "s", root)
    one.prepare(kv(spark, [(1, "a")]), "x")
    one.prepare(kv(spark, [(1, "b")]), "y")
    assert manifest_versions(spark, "s", root) == []  # prepared, not current
    with pytest.raises(FileNotFoundError):
        pin(spark, "s", root).table("x")
    first = one.commit()
    two = Commit(spark, "s", root)
    two.prepare(kv(spark, [(2, "c")]), "x", keep=two.before("x"))
    assert rows_of(two.table("x")) == [(1, "a"), (2, "c")] and rows_of(two.table("y")) == [(1, "b")]
    assert rows_of(pin(spark, "s", root).table("x")) == [(1, "a")]
    second = two.commit()
    assert rows_of(second.table("x")) == [(1, "a"), (2, "c")] and rows_of(second.table("y")) == [(1, "b")]
    assert rows_of(first.table("x")) == [(1, "a")] == rows_of(pin(spark, "s", root, 1).table("x"))  # pinned readers stay
    assert (second.tables["x"].version, second.tables["y"].version, second.version) == (2, 1, 2)


def test_a_failing_audit_or_another_commit_changes_nothing(spark, tmp_path):
    root = str(tmp_path / "wh")
    base = Commit(spark, "s", root)
    base.prepare(kv(spark, [(1, "a")]), "x")
    base.commit()
    bad, late = Commit(spark, "s", root), Commit(spark, "s", root)
    bad.prepare(kv(spark, [(9, "z")]), "x")
    with pytest.raises(ValueError, match="cross"):
        bad.audit({"cross": bad.table("x").filter("k = 9")})
    with pytest.raises(ValueError):
        bad.prepare(kv(spark, [(1, "a"), (1, "b")]), "y", {"pk": lambda w: w.groupBy("k").count().filter("count > 1")})
    late.prepare(kv(spark, [(2, "b")]), "x")
    good = Commit(spark, "s", root)
    good.prepare(kv(spark, [(3, "c")]), "x")
    good.commit()
    with pytest.raises(ConcurrentPublish):
        late.commit()
    assert rows_of(pin(spark, "s", root).table("x")) == [(3, "c")] and manifest_versions(spark, "s", root) == [1, 2]


def test_manifest_retention_keeps_pinned_folders(spark, tmp_path):
    root = str(tmp_path / "wh")
    for i in range(4):
        c = Commit(spark, "s", root)
        c.prepare(kv(spark, [(i, "a")]), "x")
        if i % 2 == 0:
            c.prepare(kv(spark, [(i, "b")]), "y", keep=c.before("y"))
        c.commit()
    snaps = [pin(spark, "s", root, v).tables for v in (1, 2, 3, 4)]
    assert removable_folders(spark, "s", root) == {"x": sorted(s["x"].head for s in snaps[:3])}  # y is a chain
    assert removable_folders(spark, "s", root, pinned=(2,)) == {"x": sorted([snaps[0]["x"].head, snaps[2]["x"].head])}
    assert [s.head for s in pinned_snapshots(spark, "x", "s", root, 2)] == [s["x"].head for s in snaps[2:]]


def test_a_failed_star_load_leaves_the_star(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "wh")
    lines = td.table(spark, SF_SMALL, "lineitem").filter("l_orderkey % 20 = 0")
    pipeline.run_star(spark, SF_SMALL, root, day=1, as_of=td.CURRENT_SINCE, lines=lines)
    before = rows_of(pipeline.content(spark, root))

    def broken(*_):
        raise RuntimeError("executor lost for good")
    monkeypatch.setattr(pipeline.star, "bridge_employee_territory", broken)
    with pytest.raises(RuntimeError):
        pipeline.run_star(spark, SF_SMALL, root, day=2, as_of=td.AS_OF, lines=lines)
    assert rows_of(pipeline.content(spark, root)) == before


def test_changes_of_a_star_table_between_loads(spark, tmp_path):
    root = str(tmp_path / "wh")
    none = td.table(spark, SF_SMALL, "lineitem").limit(0)
    for day, date in ((1, td.CURRENT_SINCE), (2, td.AS_OF), (2, td.AS_OF)):
        pipeline.run_star(spark, SF_SMALL, root, day=day, as_of=date, lines=none)
    for table, key in (("dim_shippers", "shipper_id"), ("dim_customers", "c_custkey"), ("dim_products", "product_id")):
        before, after = ({r[key]: r for r in pipeline.read_star(spark, root, v).table(table).collect()} for v in (1, 2))
        want = {k: "INSERT" if k not in before else "DELETE" if k not in after else "UPDATE"
                for k in before.keys() | after.keys() if before.get(k) != after.get(k)}
        for last in (2, 3):  # the third load changes nothing
            got = {r[key]: r.merge_action for r in committed_changes(spark, pipeline.STAR, table, 1, last, root).collect()}
            assert got == want and want, table
        assert committed_changes(spark, pipeline.STAR, table, 2, 3, root).count() == 0
    got = {r.region_id: (r.merge_action, r.before and r.before.region_key, r.after.region_key)
           for r in committed_changes(spark, pipeline.STAR, "dim_regions", 1, 2, root).collect()}
    old, new = ({r.region_id: r.region_key for r in pipeline.read_star(spark, root, v).table("dim_regions").filter("is_current").collect()} for v in (1, 2))
    assert got == {k: ("INSERT" if k not in old else "UPDATE", old.get(k), new[k]) for k in new if old.get(k) != new[k]}
    with pytest.raises(ValueError):
        committed_changes(spark, pipeline.STAR, "dim_date", 1, 2, root)


def test_waiting_lines_are_tried_once_per_change(spark, tmp_path):
    root = str(tmp_path / "wh")
    lines = td.table(spark, SF_SMALL, "lineitem").filter("l_orderkey % 10 = 0")
    none = lines.limit(0)
    tried = []
    real = pipeline.star.fact_order_lines

    def counted(spark, d, dims, batch, **kw):
        tried.append(batch.count())
        return real(spark, d, dims, batch, **kw)
    pipeline.star.fact_order_lines = counted
    try:
        pipeline.run_star(spark, SF_SMALL, root, day=1, as_of=td.CURRENT_SINCE, lines=lines)
        star1 = pipeline.read_star(spark, root)
        waiting = star1.table("fact_rejects").count()
        loaded = star1.table("fact_order_lines").count()
        assert waiting > 0 and waiting + loaded == lines.count()
        # nothing new is known: the dimensions of this commit are those that were tried
        commit = Commit(spark, pipeline.STAR, root)
        for name in pipeline.DIMENSIONS:
            commit.prepared[name] = commit.before(name)
        pipeline.load_fact(spark, SF_SMALL, none, commit)
        assert tried[-1] == 0 and commit.table("fact_rejects").count() == waiting
        pipeline.run_star(spark, SF_SMALL, root, day=2, as_of=td.AS_OF, lines=none)
    finally:
        pipeline.star.fact_order_lines = real
    star2 = pipeline.read_star(spark, root)
    assert tried[-1] == waiting
    fact, left = star2.table("fact_order_lines"), star2.table("fact_rejects")
    assert fact.count() > loaded and fact.count() + left.count() == lines.count()
    # delivering a waiting line again doesn't double it
    pipeline.run_star(spark, SF_SMALL, root, day=2, as_of=td.AS_OF, lines=lines)
    star3 = pipeline.read_star(spark, root)
    assert star3.table("fact_order_lines").count() == fact.count() and star3.table("fact_rejects").count() == left.count()


# ---------------------------------------------------------------- feeds

def test_a_batch_is_looked_up_once(spark, tmp_path):
    root = str(tmp_path / "wh")
    lines = td.table(spark, SF_SMALL, "lineitem").filter("l_orderkey % 10 = 0")
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b
    early = lines.filter("l_shipdate < timestamp_ntz'1997-01-01'")
    pipeline.run_star(spark, SF_SMALL, root, day=1, as_of=td.CURRENT_SINCE, lines=early.mapInArrow(counted, early.schema))
    assert read.value == early.count()  # without a day before, one pass gives fact and rejects
    read.value = 0
    pipeline.run_star(spark, SF_SMALL, root, day=2, as_of=td.AS_OF, lines=lines.mapInArrow(counted, lines.schema))
    # one lookup; the others compare the batch, or its dates, with the lines that wait
    assert read.value <= 5 * lines.count()
    star = pipeline.read_star(spark, root)
    fact, left = star.table("fact_order_lines"), star.table("fact_rejects")
    assert fact.count() + left.count() >= lines.count() and left.filter("line IS NULL").count() == 0


def test_feeds_compose_to_the_net_change(spark, tmp_path):
    root = str(tmp_path / "wh")
    states = [[(1, "a"), (2, "b"), (3, "c"), (7, None)], [(1, "a"), (2, "B"), (4, "d"), (7, "x")],
              [(2, "b"), (5, "e"), (7, None)], [(2, "b"), (5, "E"), (1, "a2")]]
    publish(kv(spark, states[0]), "t", root=root)
    for s in states[1:]:
        base = current_snapshot(spark, "t", root)
        rows, feed = scd1_load(read_snapshot(spark, "t", base, root), kv(spark, s), "k", ["v"], null_mode="null_safe")
        publish(rows, "t", root=root, base=base, feed=feed, feed_keys="k")
    compact(spark, "t", root)
    for a in range(1, 5):
        for b in range(a, 5):
            net = changes(spark, "t", a, b, root)
            old, new = dict(states[a - 1]), dict(states[b - 1])
            want = {k: ("INSERT" if k not in old else "DELETE" if k not in new else "UPDATE", old.get(k), new.get(k))
                    for k in old.keys() | new.keys() if (k in old) != (k in new) or old.get(k) != new.get(k)}
            got = {} if net is None else {r.k: (r.merge_action, r.before and r.before.v, r.after and r.after.v) for r in net.collect()}
            assert got == want, (a, b)
    with pytest.raises(ValueError):
        changes(spark, "t", 0, 1, root)  # the first version has no feed
    feed, keys = stored_feeds(spark, "t", 1, 4, root)
    assert keys == ("k",) and feed.groupBy("k", "feed_version").count().filter("count > 1").count() == 0


@pytest.mark.parametrize("bound", ["0", "64m"])
def test_versioned_loads_and_their_feeds(spark, bound):
    spark.conf.set("stellate.merge.broadcastBytes", bound)
    try:
        d0, d1 = dt.date(2000, 1, 1), dt.date(2002, 1, 1)
        schema = "k long, v string, is_current boolean, effective_date date, ineffective_date date, sk long"
        t = kv(spark, [(1, "a", True, d0, None, 5), (2, "b", True, d0, None, 6), (3, "c", True, d0, None, 7),
                       (3, "old", False, dt.date(1999, 1, 1), dt.date(1999, 12, 31), 2)], schema)
        rows, feed = scd2_load(t, kv(spark, [(1, "a"), (2, "B"), (4, "d")]), "k", ["v"], d1, sk_col="sk", close_missing=True)
        assert sorted((r.k, r.v, r.is_current, r.sk) for r in rows.collect()) == [
            (1, "a", True, 5), (2, "B", True, 8), (2, "b", False, 6), (3, "c", False, 7), (3, "old", False, 2), (4, "d", True, 9)]
        got = {r.k: (r.merge_action, r.before and r.before.sk, r.after and r.after.sk) for r in feed.collect()}
        assert got == {2: ("UPDATE", 6, 8), 3: ("DELETE", 7, None), 4: ("INSERT", None, 9)}
        p = kv(spark, [(1, "a", None, None, 5)], "k long, v string, p string, pv string, sk long")
        rows, feed = scd3_load(p, kv(spark, [(1, "A"), (2, "n")]), "k", ["v"], {"v": ("p", "pv")}, d1, sk_col="sk")
        assert rows_of(rows) == [(1, "A", "a", "20011231", 5), (2, "n", None, None, 6)]
        assert {r.k: (r.merge_action, r.before and r.before.v, r.after.v) for r in feed.collect()} == {
            1: ("UPDATE", "a", "A"), 2: ("INSERT", None, "n")}
    finally:
        spark.conf.unset("stellate.merge.broadcastBytes")


def test_one_merge_per_load(spark):
    import re

    import __spark_entry__ as E
    plan = E.queries()["scd2_version_keys"](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"\bJoin\b", plan)) <= 6


# ---------------------------------------------------------------- chains

def chain(spark, root, n):
    for i in range(n):
        base = current_snapshot(spark, "t", root)
        publish(kv(spark, [(i, "a" * i)]), "t", root=root, base=base, keep=base)


def test_a_chain_is_one_scan_and_folds(spark, tmp_path):
    root = str(tmp_path / "wh")
    chain(spark, root, 24)
    want = sorted((i, "a" * i) for i in range(24))
    before = current_snapshot(spark, "t", root)
    df = read_table(spark, "t", root)
    assert df._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1 and rows_of(df) == sorted(want, key=str)
    version = compact(spark, "t", root)
    after = current_snapshot(spark, "t", root)
    assert version == after.version == 25 and len(after.folders) < 8 < len(before.folders) and after.rows == 24
    assert rows_of(read_table(spark, "t", root)) == sorted(want, key=str)
    assert rows_of(read_snapshot(spark, "t", before, root)) == sorted(want, key=str)  # a pinned reader's folders are still there
    gone = removable(spark, "t", root)
    assert set(gone) == set(before.folders) - set(after.folders)
    assert removable(spark, "t", root, pinned=(24,)) == [] and removable(spark, "t", root, pinned=[before]) == []
    with pytest.raises(ConcurrentPublish):
        publish(kv(spark, [(99, "late")]), "t", root=root, base=before, keep=before)


def test_folds_are_logarithmic():
    sizes, written = [], 0
    for i in range(400):
        sizes.append((f"f{i}", 100))
        for group in _folds(sizes, 4):
            total = sum(s for n, s in sizes if n in group)
            written += total
            sizes = [(n, s) for n, s in sizes if n not in group] + [(group[0], total)]
    assert len(sizes) <= 4 * 6 and sum(s for _, s in sizes) == 40_000
    assert written <= 40_000 * 6


def test_flagged_and_partitioned_chains_fold(spark, tmp_path):
    root = str(tmp_path / "wh")
    for i in range(6):  # each load writes the open row again and closes one
        base = current_snapshot(spark, "t", root)
        df = kv(spark, [(i, "open", True), (i, "closed", False)], "k long, v string, cur boolean")
        publish(df, "t", root=root, base=base, keep=base, flag="cur")
    want = rows_of(read_table(spark, "t", root))
    assert len(want) == 7
    compact(spark, "t", root)
    snap = current_snapshot(spark, "t", root)
    assert rows_of(read_table(spark, "t", root)) == want and len(snap.folders) < 6
    assert rows_of(read_snapshot(spark, "t", snap, root, open_only=True)) == [(5, "open", True)]
    for i in range(5):
        base = current_snapshot(spark, "p", root)
        publish(kv(spark, [(i, f"v{i}"), (None, "n")]), "p", root=root, partition_by="k", base=base, keep=base)
    want = rows_of(read_table(spark, "p", root))
    compact(spark, "p", root)
    assert rows_of(read_table(spark, "p", root)) == want and len(want) == 10
    assert compact(spark, "p", root) is None
    assert snapshot_at(spark, "p", 5, root).rows == 10


def test_net_changes_is_partial_before_the_exchange(spark):
    feed = spark.createDataFrame([(1, 1, None, ("a",)), (1, 2, ("a",), None), (2, 1, ("x",), ("y",)), (2, 3, ("y",), ("x",)),
                                  (3, 2, ("p",), ("q",))], "k long, feed_version int, before struct<v:string>, after struct<v:string>")
    net = net_changes(feed, "k")
    assert [(r.k, r.merge_action) for r in net.collect()] == [(3, "UPDATE")]
    assert "partial_min" in net._jdf.queryExecution().executedPlan().toString()
    assert net_changes(feed.filter(F.lit(False)), "k").count() == 0
