"""Appends that are audited through stored sketches."""

import random

import pytest
from pyspark.sql import functions as F

from stellate.operators import audit
from stellate.operators.merge import scd1_load
from stellate.sources import sketches
from stellate.sources.publish import (
    ConcurrentPublish, checkpoint_table, compact, current_snapshot, publish, read_snapshot, read_table, removable,
)
from stellate.sources.sketches import append_checked, gone_keys, prepare_append
from stellate.sources.touched import merge_touched

REF = [("ref", "parents", "k")]


def lines(spark, rows, schema="id long, ref long"):
    return spark.createDataFrame(rows, schema)


def parents(spark, root, keys, feed=False):
    new = spark.createDataFrame([(k, f"p{k}") for k in sorted(keys)], "k int, v string")  # narrower than the child's
    base = current_snapshot(spark, "parents", root)
    if feed and base:
        out, changed = scd1_load(read_table(spark, "parents", root), new, "k", ["v"], delete_missing=True)
        return publish(out, "parents", root=root, base=base, feed=changed, feed_keys="k")
    return publish(new, "parents", root=root)


def violations(made):
    return {name: sorted(map(str, (tuple(r) for r in df.select("id", "ref") .collect()))) if name.startswith("orphan")
            else sorted(str(r.id) for r in df.collect()) for name, df in made.violations.items()}


def full_audit(spark, root, made):
    whole = checkpoint_table(read_snapshot(spark, "lines", made.snap, root), "whole")
    now = read_table(spark, "parents", root)
    return {"duplicate_id": sorted(str(r.id) for r in audit.duplicate_keys(whole, "id").collect()),
            "orphan_ref": sorted(map(str, (tuple(r) for r in audit.orphans(whole, "ref", now, "k").select("id", "ref").collect())))}


@pytest.fixture
def reads(monkeypatch):
    """Folders whose rows are read, by call."""
    seen, real = [], sketches.folder_rows
    monkeypatch.setattr(sketches, "folder_rows", lambda s, t, snap, folders, root: seen.append(tuple(folders)) or real(s, t, snap, folders, root))
    return seen


def test_only_folders_with_a_candidate_are_read(spark, tmp_path, reads):
    root = str(tmp_path / "wh")
    parents(spark, root, range(50))
    for n in range(4):
        append_checked(lines(spark, [(n * 100 + i, i % 50) for i in range(100)]), "lines", "id", REF, root)
    snap = current_snapshot(spark, "lines", root)
    assert snap.version == 4 and len(snap.folders) == 4 == len(snap.sketches) and snap.rows == 400
    third = snap.folders[1]  # newest first: the folder of the third load
    assert read_table(spark, "lines", root).count() == 400
    reads.clear()
    with pytest.raises(ValueError, match="duplicate_id"):
        append_checked(lines(spark, [(250, 1), (9000, 2)]), "lines", "id", REF, root)
    old = {f for call in reads for f in call if f in snap.folders}
    assert third in old and len(old) <= 2  # one more at most, by a bit that another key set
    reads.clear()
    assert append_checked(lines(spark, [(10_000 + i, i) for i in range(10)]), "lines", "id", REF, root) == 5
    assert len({f for call in reads for f in call if f in snap.folders}) <= 1
    with pytest.raises(ValueError, match="orphan_ref"):
        append_checked(lines(spark, [(20_000, 50)]), "lines", "id", REF, root)
    assert current_snapshot(spark, "lines", root).version == 5 and read_table(spark, "lines", root).count() == 410


@pytest.mark.parametrize("feed", [False, True])
def test_random_loads_equal_the_full_audit(spark, tmp_path, feed):
    root, rng = str(tmp_path / "wh"), random.Random(5)
    there = set(range(40))
    parents(spark, root, there)
    for n in range(3):
        rows = [(n * 1000 + i, rng.choice([None, *sorted(there)])) for i in range(80)]
        append_checked(lines(spark, rows), "lines", "id", REF, root)
        if n == 1:
            assert compact(spark, "lines", root, least=2)  # its folder gets a sketch by the next load
    for step in range(2):
        there = (there - {3, 17, 5 + step}) | {50 + step}
        parents(spark, root, there, feed)
    bad = [(rng.randrange(4000), rng.choice([None, *range(60)])) for _ in range(60)] + [(None, 1), (7, None), (7, None)]
    made = prepare_append(lines(spark, bad), "lines", "id", REF, root)
    got = violations(made)
    assert got == full_audit(spark, root, made) and got["duplicate_id"] and got["orphan_ref"]
    lost = gone_keys(spark, "parents", "k", 1, current_snapshot(spark, "parents", root).version, root)
    assert sorted(r.k for r in lost.collect()) == [3, 5, 6, 17]


def test_what_was_not_audited_is_audited_in_full(spark, tmp_path):
    root = str(tmp_path / "wh")
    parents(spark, root, range(10))
    publish(lines(spark, [(1, 1), (2, 99), (2, 3)]), "lines", root=root)  # unaudited: an orphan and a key twice
    made = prepare_append(lines(spark, [(5, 5)]), "lines", "id", REF, root)
    assert violations(made) == full_audit(spark, root, made) == {"duplicate_id": ["2"], "orphan_ref": ["(2, 99)"]}
    # a plain append after audited ones is not noted as audited
    append_checked(lines(spark, [(1, 1)]), "more", "id", REF, root)
    base = current_snapshot(spark, "more", root)
    publish(lines(spark, [(1, 77)]), "more", root=root, keep=base, base=base)
    made = prepare_append(lines(spark, [(8, 8)]), "more", "id", REF, root)
    assert violations(made) == {"duplicate_id": ["1"], "orphan_ref": ["(1, 77)"]}
    # another key of the same table
    assert violations(prepare_append(lines(spark, [(8, 8)]), "more", ["id", "ref"], (), root))["duplicate_id_ref"] == []


def test_edge_inputs(spark, tmp_path):
    root = str(tmp_path / "wh")
    with pytest.raises(FileNotFoundError):
        append_checked(lines(spark, [(1, 1)]), "lines", "id", REF, root)
    parents(spark, root, [])
    empty = lines(spark, [])
    assert append_checked(empty, "lines", "id", REF, root) == 1
    assert append_checked(lines(spark, [(1, None)]), "lines", "id", REF, root) == 2
    assert append_checked(empty, "lines", "id", REF, root) == 3
    assert [tuple(r) for r in read_table(spark, "lines", root).collect()] == [(1, None)]
    with pytest.raises(ValueError, match="duplicate_id"):
        append_checked(lines(spark, [(None, None)]), "lines", "id", REF, root)
    with pytest.raises(ValueError, match="types"):
        append_checked(lines(spark, [(1, 2)], "id int, ref long"), "lines", "id", REF, root)
    with pytest.raises(ValueError, match="floating"):
        append_checked(lines(spark, [(1.0, 2)], "id double, ref long"), "other", "id", (), root)
    # columns named like a sketch's
    odd = lambda *rows: spark.createDataFrame(list(rows), "folder long, bits long, piece string")
    append_checked(odd((1, 1, "a"), (1, 2, "b")), "odd", ["folder", "bits"], (), root)
    with pytest.raises(ValueError, match="duplicate_folder_bits"):
        append_checked(odd((1, 2, "c")), "odd", ["folder", "bits"], (), root)
    assert append_checked(odd((2, 1, "c")), "odd", ["folder", "bits"], (), root) == 2


def test_another_load_and_retention(spark, tmp_path):
    root = str(tmp_path / "wh")
    parents(spark, root, range(5))
    append_checked(lines(spark, [(1, 1)]), "lines", "id", REF, root)
    late = prepare_append(lines(spark, [(2, 2)]), "lines", "id", REF, root)
    append_checked(lines(spark, [(3, 3)]), "lines", "id", REF, root)
    with pytest.raises(ConcurrentPublish):
        sketches.switch(spark, "lines", root, late.snap, late.base)
    before = current_snapshot(spark, "lines", root)
    compact(spark, "lines", root, least=2)
    gone = removable(spark, "lines", root)
    assert {x[1] for x in before.sketches} <= set(gone) and set(before.folders) <= set(gone)
    append_checked(lines(spark, [(4, 4)]), "lines", "id", REF, root)
    now = current_snapshot(spark, "lines", root)
    assert not {x[1] for x in now.sketches} & set(removable(spark, "lines", root))
    assert sorted(r.id for r in read_table(spark, "lines", root).collect()) == [1, 3, 4]
    # a merge by file drops a folder's sketch with the folder, and notes nothing
    merge_touched(spark, "lines", lines(spark, [(4, 0), (9, 0)]), "id", root=root)
    snap = current_snapshot(spark, "lines", root)
    assert snap.checked == () and {x[0] for x in snap.sketches} <= set(snap.folders)
    with pytest.raises(ValueError, match="duplicate_id"):
        append_checked(lines(spark, [(9, 1)]), "lines", "id", REF, root)
    assert append_checked(lines(spark, [(10, 1)]), "lines", "id", REF, root) == snap.version + 1
