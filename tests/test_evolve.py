"""Schemas that change, tables from DDL, and lines that aren't rows."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import types as T

from stellate.sources import catalog, evolve, landing
from stellate.sources.publish import ConcurrentPublish


@pytest.mark.parametrize("old,new,fits", [
    ("int", "bigint", True), ("bigint", "int", False), ("int", "double", True), ("bigint", "double", False), ("float", "double", True),
    ("double", "float", False), ("decimal(12,2)", "decimal(19,4)", True), ("decimal(12,2)", "decimal(12,4)", False),
    ("decimal(12,4)", "decimal(19,2)", False), ("int", "decimal(12,2)", True), ("int", "decimal(9,0)", False), ("date", "timestamp_ntz", True),
    ("timestamp_ntz", "date", False), ("int", "string", False), ("string", "string", True), ("double", "decimal(38,18)", False),
    ("smallint", "float", True), ("int", "float", False)])
def test_types_widen_only_without_loss(spark, old, new, fits):
    assert evolve.widens(old, new) is fits


def test_columns_are_bound_by_id(spark, tmp_path):
    root = str(tmp_path)
    one = evolve.create(spark, "t", {"a": "int", "b": "string", "c": "float"}, root)
    evolve.append(spark.createDataFrame([(1, "x", 1.5), (None, None, None)], "a int, b string, c float"), one)
    # a and b change names with each other, c goes and comes back as another column
    two = evolve.alter(spark, one, rename={"a": "tmp"})
    two = evolve.alter(spark, two, rename={"b": "a"})
    two = evolve.alter(spark, two, rename={"tmp": "b"}, widen={"b": "bigint"}, drop=["c"])
    evolve.append(spark.createDataFrame([("y", 2**40)], "a string, b bigint"), two)
    three = evolve.alter(spark, two, add={"c": ("date", "2001-02-03"), "d": "int"})
    evolve.append(spark.sql("SELECT 'z' AS a, 3L AS b, DATE'2020-01-01' AS c, 4 AS d"), three)
    got = sorted(map(str, (tuple(r) for r in evolve.read(spark, "t", root).select("a", "b", "c", "d").collect())))
    assert got == sorted(map(str, (tuple(r) for r in spark.sql(
        "SELECT * FROM VALUES ('x', 1L, DATE'2001-02-03', CAST(NULL AS INT)), (NULL, NULL, DATE'2001-02-03', NULL), "
        "('y', 1099511627776L, DATE'2001-02-03', NULL), ('z', 3L, DATE'2020-01-01', 4)").collect())))
    assert evolve.read(spark, "t", root).dtypes == [("b", "bigint"), ("a", "string"), ("c", "date"), ("d", "int")]
    # one scan for each schema, and only the columns of the query
    plan = evolve.read(spark, "t", root).select("b")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 3 and "c2" not in plan
    # an older schema still reads, unless a later value doesn't fit it
    assert sorted(r.a for r in evolve.read(spark, "t", root, two.version).collect() if r.a) == ["x", "y", "z"]
    with pytest.raises(PySparkException):
        evolve.read(spark, "t", root, 1).collect()


def test_changes_that_lose_something_are_refused(spark, tmp_path):
    root = str(tmp_path)
    one = evolve.create(spark, "t", {"a": "bigint"}, root)
    for change in ({"widen": {"a": "int"}}, {"rename": {"x": "y"}}, {"drop": ["x"]}, {"add": {"a": "int"}}):
        with pytest.raises(ValueError):
            evolve.alter(spark, one, **change)
    two = evolve.alter(spark, one, add={"b": "int"})
    with pytest.raises(ConcurrentPublish):
        evolve.alter(spark, one, add={"c": "int"})  # of two changes of one schema the second fails
    for bad in ("1L AS a", "1L AS a, 2L AS b", "1L AS a, 1 AS b, 1 AS c"):
        with pytest.raises(ValueError):
            evolve.append(spark.sql(f"SELECT {bad}"), two)
    assert evolve.read(spark, "t", root).count() == 0
    with pytest.raises(FileNotFoundError):
        evolve.read(spark, "none", root)


def test_ddl_of_the_whole_registry(spark, tmp_path):
    entities = [*catalog.SOURCE, *catalog.STAR]
    order = [e.name for e in catalog.parents_first(entities)]
    for e in entities:
        assert all(order.index(p) < order.index(e.name) for _, p, _ in e.foreign_keys if p != e.name)
    db = "reg_test"
    made = catalog.apply_ddl(spark, entities, db, f"{tmp_path}/db")
    try:
        assert len(made) == 1 + len(entities) and len(catalog.apply_ddl(spark, entities, db)) == 1
        columns = catalog.declared_columns(spark, db, "order_details")
        assert [c[1] for c in columns if c[4]] == ["OrderID", "ProductID"] and columns[2][2] == "decimal(19,4)"
        told = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {db}.bridge_employee_territory").collect()}
        assert told["stellate.references"].startswith("employee_key->dim_employees(employee_key) cascade;")
        other = catalog.Entity("region", T.StructType([T.StructField("RegionID", T.LongType())]), ["RegionID"])
        with pytest.raises(ValueError):
            catalog.alter_table(spark, other, db)
        spark.sql(f"CREATE TABLE {db}.somebodys (x INT) USING parquet")
        with pytest.raises(PySparkException):
            catalog.drop_ddl(spark, entities, db)  # what isn't declared isn't dropped
        assert [t.name for t in spark.catalog.listTables(db)] == ["somebodys"]
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")


SCHEMA = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("name", T.StringType()), T.StructField("n", T.DoubleType())])


def test_malformed_lines_are_kept_with_their_place(spark, tmp_path):
    lines = ['1,a,1.5', '2,b', '3,c,2,extra', '', '4,"d,e",3', 'x,f,nan', '5,,', '6', ',,,,']
    (tmp_path / "a.csv").write_text("\n".join(lines) + "\n")
    (tmp_path / "b.csv").write_text("7,g,7\n8,h,8,9\n")
    rows, bad = landing.load_delimited(spark, str(tmp_path), SCHEMA)
    assert sorted(map(tuple, rows.collect()), key=str) == sorted(
        [(1, "a", 1.5), (4, "d,e", 3.0), (None, "f", None), (5, None, None), (7, "g", 7.0)], key=str)
    got = sorted((r.file_path.rsplit("/", 1)[1], r.block_start, r.line_in_block, r.line) for r in bad.collect())
    assert got == [("a.csv", 0, i, lines[i]) for i in (1, 2, 7, 8)] + [("b.csv", 0, 1, "8,h,8,9")]


def test_too_many_malformed_lines_stop_the_load(spark, tmp_path):
    (tmp_path / "a.csv").write_text("1,a,1\n2,b\n3,c,3\n4,d,4\n")
    with pytest.raises(ValueError, match="1 of 4"):
        landing.load_delimited(spark, str(tmp_path), SCHEMA, max_bad_share=0.2)
    rows, bad = landing.load_delimited(spark, str(tmp_path), SCHEMA, max_bad_share=0.25)
    assert (rows.count(), bad.count()) == (3, 1)
