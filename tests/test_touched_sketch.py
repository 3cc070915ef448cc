"""Copy-on-write merges by file, and audits through sketches."""

import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from stellate.operators import audit, sketch
from stellate.sources.feeds import changes
from stellate.sources.publish import compact, current_snapshot, data_files, publish, read_snapshot, read_table
from stellate.sources.touched import files_with, key_ranged, merge_touched


def ranged(spark, root, n=1000, files=20, **how):
    df = spark.range(n).select(F.col("id").alias("k"), F.concat(F.lit("v"), F.col("id")).alias("v"))
    publish(key_ranged(df, "k", files), "t", root=root, **how)


def content(spark, root):
    return {r.k: r.v for r in read_table(spark, "t", root).collect()}


def test_ten_keys_touch_ten_files_at_most(spark, tmp_path):
    root = str(tmp_path / "w h")  # a folder whose address is encoded
    ranged(spark, root)
    first = current_snapshot(spark, "t", root)
    before = data_files(spark, f"{root}/t/{first.head}")
    batch = spark.createDataFrame([(k, "new") for k in (3, 4, 5, 100, 333, 334, 700, 701, 999, 5000)], "k long, v string")
    version, touched = merge_touched(spark, "t", batch, "k", root=root)
    assert version == 2 and 0 < len(touched) <= 9 and set(touched) <= {f"{first.head}/{f}" for f in before}
    want = {**{i: f"v{i}" for i in range(1000)}, **{r.k: r.v for r in batch.collect()}}
    assert content(spark, root) == want
    snap = current_snapshot(spark, "t", root)
    assert snap.rows == 1001 and set(snap.skip) == set(touched) and read_table(spark, "t", root).count() == 1001
    assert data_files(spark, f"{root}/t/{first.head}") == before  # nothing is overwritten: the old snapshot still reads
    assert read_snapshot(spark, "t", first, root).filter("v = 'new'").count() == 0
    # the feed of the load, and a second load over both folders
    assert {r.k: r.merge_action for r in changes(spark, "t", 1, 2, root).collect()} == {
        **{r.k: "UPDATE" for r in batch.collect()}, 5000: "INSERT"}
    again = spark.createDataFrame([(4, "newer"), (5000, "newer"), (10, "newer")], "k long, v string")
    _, touched = merge_touched(spark, "t", again, "k", root=root)
    want.update({4: "newer", 5000: "newer", 10: "newer"})
    assert content(spark, root) == want and len(touched) <= 3
    assert read_table(spark, "t", root)._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_random_batches_and_compaction_keep_the_content(spark, tmp_path):
    root, rng = str(tmp_path / "wh"), random.Random(1)
    ranged(spark, root, 200, 8)
    want = {i: f"v{i}" for i in range(200)}
    for n in range(5):
        rows = {rng.randrange(0, 230): f"b{n}" for _ in range(rng.choice([1, 5, 60]))}
        merge_touched(spark, "t", spark.createDataFrame(list(rows.items()), "k long, v string"), "k", root=root)
        want.update(rows)
        if n == 3:
            compact(spark, "t", root, least=2)
        assert content(spark, root) == want and current_snapshot(spark, "t", root).rows == len(want)


def test_surrogate_keys_and_refusals(spark, tmp_path):
    root = str(tmp_path / "wh")
    df = spark.range(50).select(F.col("id").alias("k"), F.lit("a").alias("v"), (F.col("id") + 100).alias("sk"))
    publish(key_ranged(df, "k", 5), "t", root=root)
    merge_touched(spark, "t", spark.createDataFrame([(7, "b"), (90, "c"), (80, "d")], "k long, v string"), "k", root=root, sk_col="sk")
    got = {r.k: (r.v, r.sk) for r in read_table(spark, "t", root).collect()}
    assert got[7] == ("b", 107) and got[80] == ("d", 150) and got[90] == ("c", 151) and len(got) == 52
    with pytest.raises(ValueError):
        merge_touched(spark, "t", spark.createDataFrame([(None, "b")], "k long, v string"), "k", root=root)
    with pytest.raises(PySparkException, match="more than once"):
        merge_touched(spark, "t", spark.createDataFrame([(1, "b"), (1, "c")], "k long, v string"), "k", root=root)
    with pytest.raises(ValueError):
        merge_touched(spark, "none", df, "k", root=root)
    assert current_snapshot(spark, "t", root).version == 2


def test_the_scan_skips_files_by_their_footers(spark, tmp_path):
    root = str(tmp_path / "wh")
    ranged(spark, root)
    snap = current_snapshot(spark, "t", root)
    assert len(files_with(spark, "t", snap, spark.createDataFrame([(5,), (6,)], "k long"), "k", root)) <= 2
    assert files_with(spark, "t", snap, spark.createDataFrame([(5000,)], "k long"), "k", root) == []


# ---------------------------------------------------------------- sketches

def keys_of(spark, values):
    return spark.createDataFrame([(v,) for v in values], "k long")


def test_a_sketch_never_misses_and_seldom_lies(spark):
    rng = random.Random(2)
    present = rng.sample(range(10**9), 20_000)
    old = keys_of(spark, present + [None] * 5)
    made = sketch.key_sketch(old, "k", sketch.sketch_bits(20_000))
    assert sketch.maybe_present(old, "k", made).count() == 20_000
    absent = keys_of(spark, [v + 10**9 for v in present])
    assert sketch.maybe_present(absent, "k", made).count() < 1000
    # pieces of several folders, of different sizes
    two = sketch.key_sketch(keys_of(spark, [1, 2, 3]), "k", sketch.sketch_bits(3)).withColumn("folder", F.lit("a")).unionByName(
        made.withColumn("folder", F.lit("b")))
    assert sketch.maybe_present(keys_of(spark, [1, 2, 3, present[0]]), "k", two).count() == 4
    assert sketch.maybe_present(old, "k", made.limit(0)).count() == 0


def test_duplicates_and_orphans_equal_the_full_audit(spark):
    rng = random.Random(3)
    old = [(i, rng.choice([None, *range(40)])) for i in range(0, 400, 2)]
    new = [(rng.randrange(600), rng.choice([None, *range(60)])) for _ in range(120)] + [(None, 1)]
    parents, gone = set(range(50)) - {3, 17, 45}, {3, 17, 45}
    o, n = (spark.createDataFrame(x, "id long, ref long") for x in (old, new))
    p, g = keys_of(spark, parents), keys_of(spark, gone)
    bits = sketch.sketch_bits(len(old))
    calls = []

    def read_old():
        calls.append(1)
        return o
    dup = sketch.new_duplicates(n, "id", sketch.key_sketch(o, "id", bits), read_old)
    full = audit.duplicate_keys(o.unionByName(n), "id")
    assert sorted(r.id or -1 for r in dup.collect()) == sorted(r.id or -1 for r in full.collect())
    lost = sketch.new_orphans(n, "ref", p, "k", g, sketch.key_sketch(o, "ref", bits), read_old)
    want = [r for r in old if r[1] in gone] + [r for r in new if r[1] is not None and r[1] not in parents]
    assert sorted(map(str, (tuple(r) for r in lost.select("id", "ref").collect()))) == sorted(map(str, want))
    assert len(calls) == 2


def test_old_rows_are_not_read_without_a_candidate(spark):
    o = keys_of(spark, range(1000))
    made = sketch.key_sketch(o, "k", 1 << 24)

    def never():
        raise AssertionError("old rows were read")
    fresh = keys_of(spark, range(10**6, 10**6 + 20))
    assert sketch.new_duplicates(fresh, "k", made, never).count() == 0
    assert sketch.new_orphans(fresh, "k", fresh, "k", keys_of(spark, [10**7]), made, never).count() == 0
