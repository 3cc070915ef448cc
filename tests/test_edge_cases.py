"""Hand-made edge rows (FIXTURES.md section 5)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stellate.functions.dates import (
    date_key, day_number_1900, run_stamp_compat, week_of_month, week_of_year_sunday,
)
from stellate.functions.predicates import binary_changed, col_changed
from stellate.operators import audit
from stellate.operators.keys import lookup_key, unmatched
from stellate.operators.merge import merge_actions, scd1
from stellate.operators.scd import scd2, scd3
from stellate.sources.publish import publish, read_table

AS_OF = dt.date(2002, 1, 1)


def _one(spark, schema, rows, expr):
    return spark.createDataFrame(rows, schema).select(expr.alias("x")).first()["x"]


@pytest.mark.parametrize("mode,expect", [("sentinel", False), ("null_safe", True), ("sql", None)])
def test_null_vs_empty_string(spark, mode, expect):
    got = _one(spark, "t string, s string", [(None, "")],
               col_changed(F.col("t"), F.col("s"), T.StringType(), mode))
    assert got is expect if expect is not None else got is None


def test_null_vs_zero_and_day_zero(spark):
    assert _one(spark, "t int, s int", [(None, 0)],
                col_changed(F.col("t"), F.col("s"), T.IntegerType(), "sentinel")) is False
    assert _one(spark, "t timestamp_ntz, s timestamp_ntz", [(None, dt.datetime(1900, 1, 1))],
                col_changed(F.col("t"), F.col("s"), T.TimestampNTZType(), "sentinel")) is False


@pytest.mark.parametrize("mode,expect", [("sentinel", True), ("null_safe", True)])
def test_value_to_null(spark, mode, expect):
    assert _one(spark, "t string, s string", [("x", None)],
                col_changed(F.col("t"), F.col("s"), T.StringType(), mode)) is expect


def test_value_to_null_sql_is_not_a_change(spark):
    t = spark.createDataFrame([(1, "x")], "k long, v string")
    s = spark.createDataFrame([(1, None)], "k long, v string")
    a = merge_actions(t, s, "k", ["v"], null_mode="sql").first()
    assert a["merge_action"] == "KEEP"


def test_previous_address(spark):
    t = spark.createDataFrame([(1, "A", None, None), (2, "A", "Z", "19990101")],
                              "k long, addr string, addr_prev string, addr_prev_validto string")
    s = spark.createDataFrame([(1, "B"), (2, "A")], "k long, addr string")
    out = {r["k"]: r for r in scd3(t, s, "k", ["addr"], {"addr": ("addr_prev", "addr_prev_validto")},
                                   AS_OF, "sql").collect()}
    assert (out[1]["addr"], out[1]["addr_prev"], out[1]["addr_prev_validto"]) == ("B", "A", "20011231")
    assert (out[2]["addr"], out[2]["addr_prev"], out[2]["addr_prev_validto"]) == ("A", "Z", "19990101")


def test_unchanged_address_other_column_changed(spark):
    t = spark.createDataFrame([(1, "A", "n1", "P", "19990101")],
                              "k long, addr string, nm string, addr_prev string, addr_prev_validto string")
    s = spark.createDataFrame([(1, "A", "n2")], "k long, addr string, nm string")
    r = scd3(t, s, "k", ["addr", "nm"], {"addr": ("addr_prev", "addr_prev_validto")}, AS_OF, "sql").first()
    assert (r["nm"], r["addr_prev"], r["addr_prev_validto"]) == ("n2", "P", "19990101")


def test_text_key_cast(spark):
    src = spark.createDataFrame([("01581",), ("x1",)], "k_text string").withColumn(
        "k", F.col("k_text").try_cast("int"))
    dim = spark.createDataFrame([(1581,)], "k int")
    hit = src.join(dim, "k", "left_semi").collect()
    assert [r["k_text"] for r in hit] == ["01581"]
    assert src.filter(F.col("k").isNull()).first()["k_text"] == "x1"


def test_photo_differs_after_byte_30(spark):
    a, b = bytes(range(40)), bytes(range(39)) + b"\xff"
    df = spark.createDataFrame([(bytearray(a), bytearray(b))], "t binary, s binary")
    r = df.select(binary_changed(F.col("t"), F.col("s"), "prefix").alias("p"),
                  binary_changed(F.col("t"), F.col("s"), "digest").alias("d")).first()
    assert (r["p"], r["d"]) == (False, True)


HIST_SCHEMA = "k long, v string, is_current boolean, effective_date date, ineffective_date date"


def test_closed_only_key_is_left_alone(spark):
    t = spark.createDataFrame([(1, "old", False, dt.date(2000, 1, 1), dt.date(2000, 12, 31))], HIST_SCHEMA)
    s = spark.createDataFrame([(1, "new")], "k long, v string")
    out = scd2(t, s, "k", ["v"], AS_OF).collect()
    assert len(out) == 1 and out[0]["v"] == "old" and out[0]["is_current"] is False


def test_key_missing_from_source(spark):
    t1 = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    s = spark.createDataFrame([(1, "a")], "k long, v string")
    assert [r["k"] for r in scd1(t1, s, "k", ["v"]).collect()] == [1]
    t2 = spark.createDataFrame([(1, "a", True, dt.date(2001, 1, 1), None),
                                (2, "b", True, dt.date(2001, 1, 1), None)], HIST_SCHEMA)
    out = {r["k"]: r for r in scd2(t2, s, "k", ["v"], AS_OF).collect()}
    assert out[2]["is_current"] is True and out[2]["ineffective_date"] is None


def test_scd2_update_expires_and_opens(spark):
    t = spark.createDataFrame([(1, "a", True, dt.date(2001, 1, 1), None)], HIST_SCHEMA)
    s = spark.createDataFrame([(1, "b"), (2, "c")], "k long, v string")
    rows = sorted((r["k"], r["v"], r["is_current"], r["ineffective_date"]) for r in scd2(t, s, "k", ["v"], AS_OF)
                  .collect())
    assert rows == [(1, "a", False, dt.date(2001, 12, 31)), (1, "b", True, None), (2, "c", True, None)]


def test_duplicate_source_key_is_caught(spark):
    s = spark.createDataFrame([(1, "a"), (1, "b")], "k long, v string")
    with pytest.raises(ValueError):
        audit.assert_clean(audit.duplicate_keys(s, "k"), "source key")


def test_noon_rounding(spark):
    df = spark.createDataFrame([(dt.datetime(1996, 7, 4, 12, 0),), (dt.datetime(1996, 7, 4, 0, 0),),
                                (dt.datetime(1996, 7, 4, 11, 59, 59),)], "ts timestamp_ntz")
    assert [r[0] for r in df.select(day_number_1900("ts")).collect()] == [35249, 35248, 35248]


def test_week_numbers(spark):
    df = spark.createDataFrame([(dt.date(2022, 1, 1),), (dt.date(2022, 1, 2),), (dt.date(2000, 12, 31),)], "d date")
    assert [r[0] for r in df.select(week_of_year_sunday("d")).collect()] == [1, 2, 54]
    assert [r[0] for r in df.select(week_of_month("d")).collect()] == [1, 1, 5]
    assert [r[0] for r in df.select(date_key("d")).collect()] == [20220101, 20220102, 20001231]


def test_run_stamp_collision(spark):
    df = spark.createDataFrame([(dt.date(2021, 11, 5),), (dt.date(2022, 1, 5),)], "d date")
    assert [r[0] for r in df.select(run_stamp_compat("d")).collect()] == [2022105, 2022105]


def test_nullable_foreign_key(spark):
    fact = spark.createDataFrame([(1, 10), (2, None), (3, 99)], "order_id long, cust long")
    dim = spark.createDataFrame([(10, 1)], "cust_id long, customer_key long")
    assert [r["order_id"] for r in lookup_key(fact, dim, "cust", "cust_id", "customer_key").collect()] == [1]
    assert sorted(r["order_id"] for r in unmatched(fact, dim, "cust", "cust_id").collect()) == [2, 3]


def test_narrowing(spark):
    df = spark.createDataFrame([(1, "x" * 20), (2, "short")], "k long, ship_region string")
    out = audit.length_violations(df, "k", {"ship_region": 15}).collect()
    assert [(r["k"], r["length"]) for r in out] == [(1, 20)]


def test_rerun_changes_nothing(spark):
    t = spark.createDataFrame([(1, "a", True, dt.date(2001, 1, 1), None)], HIST_SCHEMA)
    s = spark.createDataFrame([(1, "b"), (2, None)], "k long, v string")
    once = scd2(t, s, "k", ["v"], AS_OF)
    twice = scd2(once, s, "k", ["v"], AS_OF)
    assert sorted(map(tuple, once.collect()), key=str) == sorted(map(tuple, twice.collect()), key=str)
    t1 = spark.createDataFrame([(1, "a")], "k long, v string")
    o1 = scd1(t1, s, "k", ["v"])
    assert sorted(map(tuple, o1.collect()), key=str) == sorted(map(tuple, scd1(o1, s, "k", ["v"]).collect()), key=str)


def test_publish_is_all_or_nothing(spark, tmp_path):
    root = str(tmp_path / "wh")
    good = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    publish(good, "t_publish", audits={"pk": lambda w: audit.duplicate_keys(w, "k")}, root=root)
    bad = spark.createDataFrame([(1, "a"), (1, "b")], "k long, v string")
    with pytest.raises(ValueError):
        publish(bad, "t_publish", audits={"pk": lambda w: audit.duplicate_keys(w, "k")}, root=root)
    assert sorted(r["k"] for r in read_table(spark, "t_publish", root).collect()) == [1, 2]


def test_cascade(spark):
    child = spark.createDataFrame([(1, 10), (2, 20)], "id long, parent long")
    gone = spark.createDataFrame([(10,)], "pk long")
    assert [r["id"] for r in audit.cascade_delete(child, "parent", gone, "pk").collect()] == [2]
    m = spark.createDataFrame([(20, 200)], "old_key long, new_key long")
    assert sorted((r["id"], r["parent"]) for r in audit.cascade_update(child, "parent", m).collect()) == \
        [(1, 10), (2, 200)]


def test_null_keys_bypass_the_merge_join(spark):
    t = spark.createDataFrame([(None, "a"), (1, "b")], "k long, v string")
    s = spark.createDataFrame([(None, "c"), (1, "b")], "k long, v string")
    got = sorted((r["k"] is None, r["merge_action"]) for r in merge_actions(t, s, "k", ["v"]).collect())
    assert got == [(False, "KEEP"), (True, "DELETE"), (True, "INSERT")]


def test_star_pipeline_publishes_audited_tables(spark, tmp_path):
    from conftest import SF_SMALL
    from stellate.plans import pipeline
    root = str(tmp_path / "wh")
    snaps = pipeline.run_star(spark, SF_SMALL, root)
    assert set(snaps) == set(pipeline.SUMMARY_KEYS) | {"fact_rejects"}
    fact = pipeline.read_star(spark, root).table("fact_order_lines")
    assert fact.count() == 6000 and "ship_year" in fact.columns
    rows = {r["table_name"]: (r["n_rows"], r["n_keys"]) for r in pipeline.summary(spark, root).collect()}
    assert rows["dim_customers"] == (150, 150) and rows["bridge_employee_territory"] == (50, 50)


def test_scd1_assigns_keys_to_inserts_above_max(spark):
    t = spark.createDataFrame([(1, "a", 10), (2, "b", 11)], "k long, v string, sk long")
    s = spark.createDataFrame([(1, "a"), (3, "c"), (4, "d")], "k long, v string")
    out = sorted((r["k"], r["sk"]) for r in scd1(t, s, "k", ["v"], sk_col="sk").collect())
    assert out == [(1, 10), (3, 12), (4, 13)]  # 2 deleted; its key 11 is not reused


def test_scd2_version_keys(spark):
    t = spark.createDataFrame([(1, "a", True, dt.date(2001, 1, 1), None, 5)], HIST_SCHEMA + ", sk long")
    s = spark.createDataFrame([(1, "b"), (2, "c")], "k long, v string")
    out = sorted((r["k"], r["v"], r["sk"]) for r in scd2(t, s, "k", ["v"], AS_OF, sk_col="sk").collect())
    assert out == [(1, "a", 5), (1, "b", 6), (2, "c", 7)]


def test_scd3_rerun_changes_nothing(spark):
    t = spark.createDataFrame([(1, "A", None, None), (2, "B", None, None)],
                              "k long, addr string, addr_prev string, addr_prev_validto string")
    s = spark.createDataFrame([(1, "A2"), (3, "C")], "k long, addr string")
    prev = {"addr": ("addr_prev", "addr_prev_validto")}
    once = scd3(t, s, "k", ["addr"], prev, AS_OF, "sql")
    twice = scd3(once, s, "k", ["addr"], prev, AS_OF, "sql")
    assert sorted(map(str, once.collect())) == sorted(map(str, twice.collect()))
    assert {r["k"]: r["addr_prev"] for r in once.collect()} == {1: "A", 2: None, 3: None}


@pytest.mark.parametrize("strategy", ["broadcast", "shuffle"])
def test_scd2_hot_key_history(spark, strategy):
    """Key 7 owns a third of the history; its closed versions reach the
    merge as one marker row and pass through unchanged."""
    from stellate.operators.scd import scd2_actions
    hist = spark.range(0, 3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") + 100).alias("k"),
        F.concat(F.lit("v"), F.col("id").cast("string")).alias("v"),
        (F.col("id") % 3 != 0).alias("is_current"),
        F.lit(dt.date(2000, 1, 1)).alias("effective_date"),
        F.when(F.col("id") % 3 == 0, F.lit(dt.date(2000, 12, 31))).alias("ineffective_date"))
    hist = hist.unionByName(spark.createDataFrame([(7, "cur", True, dt.date(2001, 1, 1), None)], HIST_SCHEMA))
    src = spark.createDataFrame([(7, "new"), (5, "x")], "k long, v string")
    a = scd2_actions(hist, src, "k", ["v"], strategy=strategy)
    out = scd2(hist, src, "k", ["v"], AS_OF, actions=a)
    assert out.count() == 3001 + 2  # key 7 expired + new version, key 5 inserted
    seven = out.filter("k = 7 and is_current").collect()
    assert [r["v"] for r in seven] == ["new"]
    assert out.filter("k = 7 and not is_current").count() == 1001


def test_publish_pointer_is_append_only(spark, tmp_path):
    root = str(tmp_path / "wh")
    a = spark.createDataFrame([(1,)], "k long")
    b = spark.createDataFrame([(2,)], "k long")
    s1 = publish(a, "t_ptr", root=root)
    s2 = publish(b, "t_ptr", root=root)
    assert s1 != s2
    assert [r["k"] for r in read_table(spark, "t_ptr", root).collect()] == [2]
    # both snapshots stay readable; only the pointer moved
    assert [r["k"] for r in read_table(spark, "t_ptr", root, s1).collect()] == [1]
    assert spark.read.text(f"{root}/t_ptr/_current").count() == 2
