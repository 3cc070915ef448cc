"""Loads that must fail rather than lose data, and results that must not
depend on the size of the input."""

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stellate import session
from stellate.operators.append import append_idempotent, new_rows
from stellate.operators.merge import change_feed, choose_strategy, merge_actions
from stellate.operators.scd import scd2, scd2_actions, scd2_expired, scd3, scd4
from stellate.sources import landing
from stellate.sources import publish as publishing
from stellate.sources.publish import (
    ConcurrentPublish, current_snapshot, publish, put_new, read_snapshot, read_table, repair, warehouse_root,
)
from stellate.streaming import merge_loader

AS_OF = dt.date(2002, 1, 1)
HIST = "k long, v string, is_current boolean, effective_date date, ineffective_date date"
OLD, END = dt.date(2000, 1, 1), dt.date(2000, 12, 31)


def kv(spark, rows, schema="k long, v string"):
    return spark.createDataFrame(rows, schema)


# ---------------------------------------------------------------- publish

def test_an_unreadable_version_raises(spark, tmp_path):
    root = str(tmp_path / "wh")
    load = merge_loader("t", "k", ["v"], root=root)
    load(kv(spark, [(i, "a") for i in range(100)]), 0)
    (tmp_path / "wh/t/_current/part-0.gz").write_bytes(b"\x00junk")
    with pytest.raises(ValueError):
        load(kv(spark, [(1, "b")]), 1)
    (tmp_path / "wh/t/_current/part-0.gz").unlink()
    assert read_table(spark, "t", root).count() == 100
    # a version that isn't an entry is an error too, not "no table"
    (tmp_path / "wh/t/_current/00000000000000000002").write_text("{broken")
    with pytest.raises(Exception):
        current_snapshot(spark, "t", root)


def test_an_abandoned_entry_blocks_its_version_until_repair(spark, tmp_path):
    root = str(tmp_path / "wh")
    publish(kv(spark, [(1, "a")]), "t", root=root)
    base = current_snapshot(spark, "t", root)
    entry = tmp_path / "wh/t/_current/00000000000000000002"
    entry.write_text("")  # another load created it and has not yet written it, or never will
    assert [r.k for r in read_table(spark, "t", root).collect()] == [1]
    for how in ({}, {"base": base}):
        with pytest.raises(ConcurrentPublish):
            publish(kv(spark, [(2, "b")]), "t", root=root, **how)
    assert repair(spark, "t", root) == [2] and repair(spark, "t", root) == []
    assert publish(kv(spark, [(2, "b")]), "t", root=root, base=base) == 2
    assert [r.k for r in read_table(spark, "t", root).collect()] == [2]
    assert sorted(p.name for p in (tmp_path / "wh/t/_current").iterdir() if not p.name.startswith(".")) == [
        "00000000000000000001", "00000000000000000002"]


@pytest.mark.parametrize("way", ["_link_new", "_rename_new"])
def test_an_entry_is_put_whole_or_not_at_all(spark, tmp_path, monkeypatch, way):
    monkeypatch.setattr(publishing, "_link_new", getattr(publishing, way))
    path = f"{tmp_path}/entries/1"
    assert put_new(spark, path, "one") and not put_new(spark, path, "two")
    assert (tmp_path / "entries/1").read_text() == "one"


def test_of_two_loads_from_one_snapshot_the_second_fails(spark, tmp_path):
    root = str(tmp_path / "wh")
    publish(kv(spark, [(1, "a"), (2, "b")]), "t", root=root)
    base = current_snapshot(spark, "t", root)
    one = read_snapshot(spark, "t", base, root).withColumn("v", F.when(F.col("k") == 1, F.lit("x")).otherwise(F.col("v")))
    two = read_snapshot(spark, "t", base, root).withColumn("v", F.when(F.col("k") == 2, F.lit("y")).otherwise(F.col("v")))
    publish(one, "t", root=root, base=base)
    with pytest.raises(ConcurrentPublish):
        publish(two, "t", root=root, base=base)
    assert sorted(map(tuple, read_table(spark, "t", root).collect())) == [(1, "x"), (2, "b")]
    with pytest.raises(ConcurrentPublish):
        publish(one, "t", root=root, base=None)  # not the first version either


def test_append_adds_a_folder_and_counts(spark, tmp_path):
    root = str(tmp_path / "wh")
    publish(kv(spark, [(1, "a")]), "t", root=root)
    base = current_snapshot(spark, "t", root)
    publish(kv(spark, [(2, "b"), (3, "c")]), "t", root=root, base=base, keep=base)
    snap = current_snapshot(spark, "t", root)
    assert snap.rows == 3 and snap.tail == (base.head,) and snap.bytes > base.bytes
    assert sorted(r.k for r in read_table(spark, "t", root).collect()) == [1, 2, 3]


def test_shared_folders_are_required_off_local(spark, monkeypatch):
    monkeypatch.setattr(session, "is_local", lambda s: False)
    monkeypatch.setattr("stellate.sources.publish.is_local", lambda s: False)

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        def getConf(self):
            return Conf()

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    for call in (warehouse_root, session.shared_dir):
        with pytest.raises(ValueError):
            call(Session())


# ---------------------------------------------------------------- merges

@pytest.mark.parametrize("strategy", ["broadcast", "shuffle"])
def test_duplicate_source_keys_fail(spark, strategy):
    t = kv(spark, [(1, "a", True, OLD, None)], HIST)
    s = kv(spark, [(1, "b"), (1, "c"), (2, "d")])
    with pytest.raises(PySparkException, match="more than once"):
        merge_actions(t.select("k", "v"), s, "k", ["v"], strategy=strategy).collect()
    with pytest.raises(PySparkException, match="more than once"):
        scd2(t, s, "k", ["v"], AS_OF, actions=scd2_actions(t, s, "k", ["v"], strategy=strategy)).collect()
    cast = spark.createDataFrame([("01", "b"), ("1", "c")], "x string, v string").select(F.col("x").try_cast("bigint").alias("k"), "v")
    with pytest.raises(PySparkException, match="more than once"):
        merge_actions(t.select("k", "v"), cast, "k", ["v"], strategy=strategy).collect()


def test_actions_and_feeds_do_not_depend_on_the_strategy(spark):
    t = kv(spark, [(1, "a", True, OLD, None), (2, "z", False, OLD, END), (3, "c", True, OLD, None), (3, "b", False, OLD, END),
                   (3, "a", False, OLD, END), (None, "n", False, OLD, END), (4, "d", True, OLD, None)], HIST)
    s = kv(spark, [(1, "a2"), (5, "e"), (2, "new"), (4, "d")])
    frames, feeds = [], []
    for strategy in ("broadcast", "shuffle"):
        a = scd2_actions(t, s, "k", ["v"], strategy=strategy)
        frames.append(sorted(map(str, a.collect())))
        feeds.append(sorted(map(str, change_feed(a, "k", ["v"]).collect())))
    assert frames[0] == frames[1] and feeds[0] == feeds[1]
    assert sum("DELETE" in r for r in feeds[0]) == 1


def test_two_changes_under_one_date(spark):
    t = kv(spark, [(1, "a", True, OLD, None, 7)], HIST + ", sk long")
    once = scd2(t, kv(spark, [(1, "b")]), "k", ["v"], AS_OF, sk_col="sk")
    twice = scd2(once, kv(spark, [(1, "c")]), "k", ["v"], AS_OF, sk_col="sk")
    rows = sorted(map(tuple, twice.collect()), key=str)
    assert rows == [(1, "a", False, OLD, dt.date(2001, 12, 31), 7), (1, "c", True, AS_OF, None, 8)]
    a = scd2_actions(once, kv(spark, [(1, "c")]), "k", ["v"])
    assert scd2_expired(a, once, "k", AS_OF).count() == 0
    assert twice.filter("ineffective_date < effective_date").count() == 0


def test_scd3_and_scd4_number_inserts(spark):
    t = kv(spark, [(1, "A", None, None, 7)], "k long, v string, v_prev string, v_prev_to string, sk long")
    out = scd3(t, kv(spark, [(1, "B"), (3, "C"), (2, "D")]), "k", ["v"], {"v": ("v_prev", "v_prev_to")}, AS_OF, sk_col="sk")
    assert sorted((r.k, r.sk) for r in out.collect()) == [(1, 7), (2, 8), (3, 9)]
    t4 = kv(spark, [(1, "A", OLD, 7)], "k long, v string, valid_from date, sk long")
    cur, hist = scd4(t4, kv(spark, [(1, "B"), (2, "D")]), "k", ["v"], AS_OF, sk_col="sk")
    assert sorted((r.k, r.v, r.sk) for r in cur.collect()) == [(1, "B", 7), (2, "D", 8)]
    assert [(r.v, r.sk) for r in hist.collect()] == [("A", 7)]


@pytest.mark.parametrize("strategy", ["broadcast", "shuffle"])
def test_null_keys_are_not_appended_again(spark, strategy):
    b = kv(spark, [(1, None), (None, "x"), (None, None), (2, "y")])
    assert new_rows(b, b, ["k", "v"], strategy=strategy).count() == 0
    d = kv(spark, [(1, None), (2, dt.date(2001, 1, 1))], "k long, d date")
    assert append_idempotent(d, d, ["k", "d"], range_col="d", strategy=strategy).count() == 2


@pytest.mark.parametrize("strategy", ["broadcast", "shuffle"])
def test_only_rows_in_the_common_range_are_compared(spark, strategy):
    def dated(days):
        return kv(spark, [(n, None if n is None else dt.date(2001, 1, n)) for n in days], "k long, d date")
    batch, old = dated([3, 4, 5, 5, 8, 8, None]), dated([1, 2, 3, 5])
    got = new_rows(batch, old, ["k", "d"], "d", strategy)
    assert sorted(r.k or 0 for r in got.collect()) == [0, 4, 8, 8]
    assert "Union" in got._jdf.queryExecution().optimizedPlan().toString()  # later rows bypass the join
    assert sorted(r.k or 0 for r in new_rows(batch, dated([1, None]), ["k", "d"], "d", strategy).collect()) == [3, 4, 5, 5, 8, 8]
    assert new_rows(batch, dated([]), ["k", "d"], "d", strategy).count() == 7
    assert new_rows(dated([]), old, ["k", "d"], "d", strategy).count() == 0
    assert sorted(r.k or 0 for r in new_rows(dated([None, 1]), dated([None]), ["k", "d"], "d", strategy).collect()) == [1]


def test_a_source_that_strains_the_driver_is_not_broadcast(spark):
    wide = spark.range(20_000).select(F.col("id").alias("k"), F.repeat(F.lit("x"), 500).alias("v"))
    assert choose_strategy(wide) == "shuffle" and choose_strategy(wide.limit(1_000)) == "broadcast"


# ---------------------------------------------------------------- streams

def test_a_micro_batch_is_not_the_whole_source(spark, tmp_path):
    root = str(tmp_path / "wh")
    load = merge_loader("t", "k", ["v"], root=root)
    load(kv(spark, [(i, "a") for i in range(100)]), 0)
    load(kv(spark, [(5, "b")]), 1)
    assert read_table(spark, "t", root).count() == 100
    with pytest.raises(ValueError):
        merge_loader("t", "k", ["v"], root=root, delete_missing=True)


def test_a_versioned_load_needs_its_date(spark, tmp_path):
    for kind in ("scd2", "scd3"):
        with pytest.raises(ValueError):
            merge_loader("t", "k", ["v"], kind=kind)
    with pytest.raises(ValueError):
        scd2(kv(spark, [], HIST), kv(spark, [(1, "a")]), "k", ["v"], None)


def test_closed_history_stays_where_it_is(spark, tmp_path):
    root = str(tmp_path / "wh")

    def first(src):
        return src.select("k", "v", F.lit(True).alias("is_current"), F.lit(OLD).alias("effective_date"),
                          F.lit(None).cast("date").alias("ineffective_date"))
    load = merge_loader("t", "k", ["v"], kind="scd2", root=root, initial=first,
                        as_of=lambda batch, epoch: dt.date(2002, 1, 1 + epoch))
    for epoch, rows in enumerate([[(1, "a"), (2, "b")], [(1, "a1")], [(1, "a2"), (3, "c")]]):
        load(kv(spark, rows), epoch)
    snap = current_snapshot(spark, "t", root)
    assert len(snap.tail) == 2
    got = sorted((r.k, r.v, r.is_current, str(r.effective_date), str(r.ineffective_date)) for r in read_table(spark, "t", root).collect())
    assert got == [(1, "a", False, "2000-01-01", "2002-01-01"), (1, "a1", False, "2002-01-02", "2002-01-02"),
                   (1, "a2", True, "2002-01-03", "None"), (2, "b", True, "2000-01-01", "None"), (3, "c", True, "2002-01-03", "None")]
    assert sorted(r.k for r in read_snapshot(spark, "t", snap, root, open_only=True).collect()) == [1, 2, 3]


# ---------------------------------------------------------------- landing

def test_csv_is_bound_by_its_header(spark, tmp_path):
    p = tmp_path / "shippers.csv"
    p.write_text("Phone,ShipperID,CompanyName\n555,1,Speedy\n556,x1,nan\n")
    schema = T.StructType([T.StructField("ShipperID", T.IntegerType()), T.StructField("CompanyName", T.StringType()),
                           T.StructField("Phone", T.StringType())])
    rows = landing.load_entity(spark, str(p), schema, fmt="csv", header=True).collect()
    assert sorted(map(tuple, rows), key=str) == [(1, "Speedy", "555"), (None, "nan", "556")]
    loaded, rejected = landing.load_with_rejects(spark, str(p), schema, "ShipperID")
    assert loaded.count() == 2
    assert [tuple(r) for r in rejected.collect()] == [("x1", "ShipperID", "x1")]
    p.write_text("Phone,ShipperID\n555,1\n")
    with pytest.raises(ValueError):
        landing.load_entity(spark, str(p), schema, fmt="csv", header=True)


def test_star_load_keeps_keys(spark, tmp_path):
    from stellate.plans import pipeline
    from stellate.sources import testdata as td
    from conftest import SF_SMALL
    root = str(tmp_path / "wh")
    days = [td.star_sources(spark, SF_SMALL, day)["dim_customers"] for day in (1, 2)]
    keys = []
    for source, date in zip(days, (td.CURRENT_SINCE, AS_OF)):
        pipeline.load_dimension(spark, "dim_customers", source, date, root)
        keys.append({r.c_custkey: r.customer_key for r in read_table(spark, "dim_customers", root).collect()})
    assert all(keys[1][k] == sk for k, sk in keys[0].items())
    assert min(sk for k, sk in keys[1].items() if k not in keys[0]) == max(keys[0].values()) + 1
