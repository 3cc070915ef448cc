"""Registered queries: one per operator of the inventory, each a
``(spark, sf_dir) -> DataFrame`` over the whole provided tables.

Column names and types here are mirrored exactly by ``oracle.ORACLE_SQL``.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stellate.functions.dates import (
    date_key, date_key_str, day_diff_1900, day_number_1900, run_stamp_compat,
)
from stellate.functions.predicates import binary_changed, changed
from stellate.operators import audit, sketch
from stellate.operators.append import append_idempotent
from stellate.operators.asof import lookup_asof
from stellate.operators.calendar import calendar_from_bounds
from stellate.operators.keys import assign_surrogate_keys, extend_surrogate_keys, key_map, unmatched
from stellate.operators.graph import ancestors, cascade_closure
from stellate.operators.merge import ACTION, change_feed, merge_actions, scd1, scd1_load
from stellate.operators.scd import scd2, scd2_actions, scd2_expired, scd2_new_versions, scd3, scd4
from stellate.plans import pipeline, star
from stellate.session import shared_dir
from stellate.sources import catalog, evolve, landing, sketches, touched
from stellate.sources import testdata as td
from stellate.sources.feeds import changes
from stellate.sources.publish import checkpoint_table, compact, current_snapshot, publish, read_snapshot, read_table, warehouse_root

AS_OF = td.AS_OF
CUSTOMER_TRACKED = ["nm", "addr"]


# ---------------------------------------------------------------- fact / joins

def q_fact_order_lines(spark, d):
    return star.fact_order_lines(spark, d)


def q_fact_territory_fanout(spark, d):
    """The reference's fact shape: one row per order line and territory of
    the line's employee (fan-out x territories)."""
    lines = star.order_lines(spark, d)
    n = td.table(spark, d, "nation").select("n_nationkey", "n_regionkey")
    r = td.table(spark, d, "region").select(F.col("r_regionkey").alias("n_regionkey"))
    # the small side (territories of each employee, with their region) is
    # joined first; the fan-out happens once, in the last join
    terr = (td.employee_territories(spark, d).withColumnRenamed("s_suppkey", "l_suppkey")
            .join(n, "n_nationkey").join(r, "n_regionkey"))
    return (lines.join(terr, "l_suppkey")
            .select(F.col("l_orderkey").alias("order_id"),
                    F.col("l_linenumber").cast("bigint").alias("line_number"),
                    F.col("l_suppkey").alias("employee_id"),
                    F.col("n_nationkey").cast("bigint").alias("territory_id"),
                    F.col("n_regionkey").cast("bigint").alias("region_id"),
                    date_key("o_orderdate").alias("order_date_key"),
                    F.col("l_quantity").cast("bigint").alias("quantity")))


def q_fact_orders_compat(spark, d):
    """The reference's fact load as it is: one row per order line and
    territory of the employee, customer key looked up, natural employee /
    ship-via / product ids in the key columns, dates as day numbers rounded
    at noon, the product's list price as unit price."""
    n = td.table(spark, d, "nation").select("n_nationkey", "n_regionkey")
    r = td.table(spark, d, "region").select(F.col("r_regionkey").alias("n_regionkey"))
    terr = (td.employee_territories(spark, d).withColumnRenamed("s_suppkey", "l_suppkey")
            .join(n, "n_nationkey").join(r, "n_regionkey", "left_semi").select("l_suppkey"))
    emp = td.table(spark, d, "supplier").select(F.col("s_suppkey").alias("l_suppkey"))
    cust = star.customer_keys(spark, d).select(F.col("c_custkey").alias("o_custkey"), "customer_key")
    cats = td.categories(spark, d)
    prod = (td.table(spark, d, "part")
            .select(F.col("p_partkey").alias("l_partkey"), "p_retailprice", F.col("p_type").alias("category_name"))
            .join(cats, "category_name", "left_semi"))
    ship = star.small(td.shippers(spark, d).select(F.col("shipper_id").alias("ship_via")))
    # customer and shipper are looked up once per order, not once per line
    headers = (td.table(spark, d, "orders")
               .select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderdate", td.ship_via().alias("ship_via"))
               .join(cust, "o_custkey").join(ship, "ship_via"))
    lines = td.table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_shipdate")
    return (lines.join(headers, "l_orderkey").join(emp, "l_suppkey").join(prod, "l_partkey").join(terr, "l_suppkey")
            .select(F.col("l_orderkey").alias("order_id"), "customer_key",
                    F.col("l_suppkey").alias("employee_key"),
                    day_number_1900("o_orderdate").alias("order_date_key"),
                    day_number_1900("l_shipdate").alias("shipped_date"),
                    F.col("ship_via").alias("shipper_key"),
                    F.col("l_partkey").alias("product_key"),
                    F.col("p_retailprice").cast("decimal(19,4)").alias("unit_price"),
                    F.col("l_quantity").cast("bigint").alias("quantity"),
                    F.col("l_discount").alias("discount")))


def q_fact_key_lookup(spark, d):
    """Order-header grain: natural customer and shipper ids replaced by
    surrogate keys."""
    o = td.table(spark, d, "orders")
    cust = star.customer_keys(spark, d).select(F.col("c_custkey").alias("o_custkey"), "customer_key")
    ship = star.small(star.dim_shippers(spark, d).select(F.col("shipper_id").alias("ship_via"), "shipper_key"))
    return (o.select("o_orderkey", "o_custkey", "o_orderdate", td.ship_via().alias("ship_via"))
            .join(cust, "o_custkey").join(ship, "ship_via")
            .select(F.col("o_orderkey").alias("order_id"), "customer_key", "shipper_key",
                    date_key("o_orderdate").alias("order_date_key")))


def q_fact_semi_filters(spark, d):
    """Joins that only test existence, written as semi joins."""
    li = td.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    sup = td.table(spark, d, "supplier").select(F.col("s_suppkey").alias("l_suppkey"))
    cats = td.categories(spark, d)
    part = (td.table(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("category_name"))
            .join(cats, "category_name", "left_semi").select("l_partkey"))
    return (li.join(sup, "l_suppkey", "left_semi").join(part, "l_partkey", "left_semi")
            .select(F.col("l_orderkey").alias("order_id"),
                    F.col("l_linenumber").cast("bigint").alias("line_number"),
                    F.col("l_partkey").alias("part_id"), F.col("l_suppkey").alias("supplier_id")))


def q_fact_unmatched(spark, d):
    """Orders an inner-join fact load silently drops: NULL or dangling customer."""
    o = td.orders_nullable_customer(spark, d)
    c = td.table(spark, d, "customer")
    miss = unmatched(o, c, "o_custkey", "c_custkey")
    return miss.select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
                       F.when(F.col("o_custkey").isNull(), F.lit("NULL_KEY")).otherwise(F.lit("ORPHAN"))
                       .alias("reason"))


LINE_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
             "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


def q_fact_append_idempotent(spark, d):
    """Append a batch that overlaps what is loaded: only rows not already in
    the fact (by the whole line) are appended, so a rerun adds nothing."""
    li = td.table(spark, d, "lineitem").select(*LINE_COLS)
    existing = li.filter(F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp_ntz"))
    batch = li.filter(F.col("l_shipdate") >= F.lit("1997-01-01").cast("timestamp_ntz"))
    return append_idempotent(batch, existing, LINE_COLS, range_col="l_shipdate", batch_col="load_batch")


def q_fact_append_null_keys(spark, d):
    """Appending orders whose customer is NULL or dangling, half of them
    loaded already: a NULL in the key meets its own copy."""
    o = td.orders_nullable_customer(spark, d)
    existing = o.filter(F.col("o_orderkey") % 2 == 0)
    return append_idempotent(o, existing, ["o_orderkey", "o_custkey"], batch_col="load_batch")


# ---------------------------------------------------------------- scalars

def q_scalar_day_number(spark, d):
    e = td.table(spark, d, "events")
    return e.select("event_id", "ts", day_number_1900("ts").alias("day_number"),
                    day_diff_1900("ts").alias("day_diff"))


def q_scalar_date_keys(spark, d):
    o = td.table(spark, d, "orders")
    od = F.col("o_orderdate")
    return o.select(F.col("o_orderkey").alias("order_id"),
                    F.year(od).cast("bigint").alias("year"),
                    F.month(od).cast("bigint").alias("month"),
                    F.dayofmonth(od).cast("bigint").alias("day"),
                    date_key(od).alias("date_key"),
                    date_key_str(od).alias("date_key_str"),
                    date_key_str(F.date_sub(F.to_date(od), 1)).alias("prev_day_key_str"),
                    run_stamp_compat(od).alias("run_stamp_compat"))


def q_calendar_dim(spark, d):
    """Calendar covering every order and ship date of the data."""
    o = td.table(spark, d, "orders").agg(F.min(F.to_date("o_orderdate")).alias("start_date"),
                                         F.max(F.to_date("o_orderdate")).alias("end_date"))
    li = td.table(spark, d, "lineitem").agg(F.min(F.to_date("l_shipdate")).alias("start_date"),
                                            F.max(F.to_date("l_shipdate")).alias("end_date"))
    bounds = o.unionByName(li).agg(F.min("start_date").alias("start_date"), F.max("end_date").alias("end_date"))
    return calendar_from_bounds(bounds)


# ---------------------------------------------------------------- change predicates

def _customer_matched(spark, d):
    p = td.customer_prev(spark, d).select("k", F.col("nm").alias("t_nm"), F.col("addr").alias("t_addr"))
    s = td.customer_source(spark, d).select("k", F.col("nm").alias("s_nm"), F.col("addr").alias("s_addr"))
    return p.join(s, "k")


def _change_query(mode):
    def q(spark, d):
        m = _customer_matched(spark, d)
        pairs = [(F.col("t_nm"), F.col("s_nm"), T.StringType()), (F.col("t_addr"), F.col("s_addr"), T.StringType())]
        return m.select("k", changed(pairs, mode).alias("changed"))
    q.__name__ = f"q_change_{mode}"
    return q


def q_change_binary(spark, d):
    """Blob change test: whole-value digest vs the legacy 30-byte prefix."""
    doc = td.table(spark, d, "documents").select("doc_id", "text")
    k = F.col("doc_id")
    revised = (F.when(k % 5 == 0, F.concat(F.lit("[rev] "), F.col("text")))
               .when(k % 3 == 0, F.concat(F.col("text"), F.lit(" [rev]")))
               .otherwise(F.col("text")))
    t, s = F.encode(F.col("text"), "UTF-8"), F.encode(revised, "UTF-8")
    return doc.select("doc_id",
                      binary_changed(t, s, "prefix").alias("prefix_changed"),
                      binary_changed(t, s, "digest").alias("digest_changed"))


# ---------------------------------------------------------------- merge family

def _customer_actions(spark, d, mode="sentinel"):
    return merge_actions(td.customer_prev(spark, d), td.customer_source(spark, d), "k",
                         CUSTOMER_TRACKED, null_mode=mode)


def q_merge_actions(spark, d):
    a = _customer_actions(spark, d)
    return a.select("k", ACTION, F.col("t.nm").alias("t_nm"), F.col("t.addr").alias("t_addr"),
                    F.col("s.nm").alias("s_nm"), F.col("s.addr").alias("s_addr"))


def q_merge_cast_key(spark, d):
    """Text keys matched to an integer-keyed dimension with an explicit
    try_cast; non-numeric keys are rejected, not silently dropped."""
    src = td.customer_text_keys(spark, d).withColumn("k", F.col("k_text").try_cast("bigint"))
    dim = td.customer_prev(spark, d).select("k", F.lit(True).alias("_hit"))
    return (src.join(dim, "k", "left")
            .select("k_text", "k",
                    F.when(F.col("k").isNull(), F.lit("REJECT"))
                    .when(F.col("_hit"), F.lit("MATCH")).otherwise(F.lit("NEW")).alias("status")))


def q_scd1_merge(spark, d):
    return scd1(td.customer_prev(spark, d), td.customer_source(spark, d), "k", CUSTOMER_TRACKED,
                null_mode="sentinel", delete_missing=True)


def _hist_actions(spark, d):
    return scd2_actions(td.customer_hist(spark, d), td.customer_source(spark, d), "k", CUSTOMER_TRACKED,
                        null_mode="sentinel")


def q_scd2_merge(spark, d):
    return scd2(td.customer_hist(spark, d), td.customer_source(spark, d), "k", CUSTOMER_TRACKED, AS_OF)


def q_scd2_expire(spark, d):
    return scd2_expired(_hist_actions(spark, d), td.customer_hist(spark, d), "k", AS_OF)


def q_scd2_new_versions(spark, d):
    return scd2_new_versions(_hist_actions(spark, d), td.customer_hist(spark, d),
                             td.customer_source(spark, d), "k", AS_OF)


def q_scd2_change_feed(spark, d):
    return change_feed(_hist_actions(spark, d), "k", CUSTOMER_TRACKED, include=("INSERT", "UPDATE"))


def q_scd2_feed_full(spark, d):
    """The whole feed with its default actions: a key that left the source is
    one DELETE row, a key with closed versions only is none."""
    return change_feed(_hist_actions(spark, d), "k", CUSTOMER_TRACKED)


def q_scd2_same_day(spark, d):
    """A second change under one date replaces the version that the first opened."""
    once = scd2(td.customer_hist(spark, d), td.customer_source(spark, d), "k", CUSTOMER_TRACKED, AS_OF)
    again = td.customer_source(spark, d).withColumn(
        "addr", F.when(F.col("k") % 3 == 0, F.concat(F.coalesce("addr", F.lit("")), F.lit("!"))).otherwise(F.col("addr")))
    return scd2(once, again, "k", CUSTOMER_TRACKED, AS_OF)


def q_scd2_current_rows(spark, d):
    return q_scd2_merge(spark, d).filter(F.col("is_current"))


def q_scd2_version_keys(spark, d):
    """SCD2 with a per-version surrogate key: new versions are numbered above
    the dimension's largest key, existing versions keep theirs."""
    hist = assign_surrogate_keys(td.customer_hist(spark, d), ["k", "effective_date"], "version_key")
    return scd2(hist, td.customer_source(spark, d), "k", CUSTOMER_TRACKED, AS_OF, sk_col="version_key")


def q_scd2_region(spark, d):
    return scd2(td.region_dim_before(spark, d), td.region_source(spark, d), "region_id", ["description"], AS_OF)


def q_scd2_territory(spark, d):
    src = (td.territory_source_text(spark, d)
           .withColumn("territory_id", F.col("territory_text").try_cast("bigint"))
           .filter(F.col("territory_id").isNotNull())
           .select("territory_id", "description", "region_id"))
    return scd2(td.territory_dim_before(spark, d), src, "territory_id", ["description", "region_id"], AS_OF)


def q_scd2_employee(spark, d):
    out = scd2(td.employee_dim_before(spark, d), td.employees(spark, d), "employee_id",
               ["last_name", "nation_id", "acctbal", "photo", "reports_to"], AS_OF, binary_mode="digest")
    return out.select(*[F.sha2("photo", 256).alias("photo_sha256") if c == "photo" else F.col(c)
                        for c in out.columns])


def q_scd3_customer(spark, d):
    return scd3(td.customer_prev_scd3(spark, d), td.customer_source(spark, d), "k", CUSTOMER_TRACKED,
                previous={"addr": ("addr_prev", "addr_prev_validto")}, as_of=AS_OF, null_mode="sql",
                sk_col="customer_key")


def q_scd4_products(spark, d):
    _, hist = scd4(td.product_current_before(spark, d), td.product_source(spark, d), "product_id",
                   ["product_name", "unit_price", "category_name"], AS_OF)
    return hist


def q_scd4_current(spark, d):
    """The SCD4 current table after the load (overwritten in place; the old
    images went to the history table)."""
    cur, _ = scd4(td.product_current_before(spark, d), td.product_source(spark, d), "product_id",
                  ["product_name", "unit_price", "category_name"], AS_OF, sk_col="product_key")
    return cur


def q_surrogate_keys(spark, d):
    prev = key_map(td.customer_prev(spark, d), "k", "sk")
    return extend_surrogate_keys(prev, td.customer_source(spark, d), "k", "sk")


# ---------------------------------------------------------------- declared-only tables

def q_dim_products(spark, d):
    return star.dim_products_with_supplier(spark, d)


def q_bridge_employee_territory(spark, d):
    return star.bridge_employee_territory(spark, d)


# ---------------------------------------------------------------- audits

def q_audit_primary_key(spark, d):
    return audit.duplicate_keys(td.customer_hist(spark, d), "k")


def q_audit_composite_key(spark, d):
    li = td.table(spark, d, "lineitem")
    return audit.duplicate_keys(li, ["l_orderkey", "l_linenumber"])


def q_audit_unique_current(spark, d):
    """Keys with two current versions: every 50th key's is doubled here."""
    dim = q_scd2_merge(spark, d)
    return audit.unique_among(dim.unionByName(dim.filter("is_current and k % 50 = 0")), "k", "is_current")


def q_audit_declared(spark, d):
    """What the registry declares, run over tables with violations: rows found
    per table and constraint."""
    orders = td.orders_nullable_customer(spark, d)
    landed = td.customer_landed_with_nulls(spark, d)
    hist = td.customer_hist(spark, d)
    parents = {"customer": td.table(spark, d, "customer")}
    checks = [
        ("orders", orders, catalog.Entity("orders", catalog.fields(("o_orderkey", True), ("o_custkey", True)), ["o_orderkey"],
                                          [(["o_custkey"], "customer", ["c_custkey"])])),
        ("customer_landed", landed, catalog.Entity("customer_landed", catalog.fields(("nm", True), ("addr", True)), ["k"],
                                                   lengths={"nm": 10, "addr": 8})),
        ("customer_hist", hist, catalog.Entity("customer_hist", catalog.fields(("k", True)), ["k"], unique_current=["k"])),
    ]
    parts = [found(df).agg(F.count(F.lit(1)).cast("bigint").alias("n_rows")).select(
        F.lit(table).alias("table_name"), F.lit(name).alias("constraint_name"), "n_rows")
        for table, df, entity in checks for name, found in audit.declared(entity, parents).items()]
    return reduce(DataFrame.unionByName, parts)


def q_audit_foreign_key(spark, d):
    return audit.orphans(td.orders_nullable_customer(spark, d), "o_custkey",
                         td.table(spark, d, "customer"), "c_custkey")


def q_audit_self_fk(spark, d):
    e = td.employees(spark, d).select("employee_id", "reports_to")
    return audit.orphans(e, "reports_to", e, "employee_id")


def q_audit_not_null(spark, d):
    return audit.null_violations(td.customer_landed_with_nulls(spark, d), "k", ["nm", "addr", "nation"])


def q_audit_length(spark, d):
    p = td.table(spark, d, "part")
    return audit.length_violations(p, "p_partkey", {"p_name": 10, "p_brand": 7})


def q_cascade_delete(spark, d):
    """Delete the odd regions: their territories go, and so do the bridge
    rows of those territories."""
    region = td.table(spark, d, "region")
    nation = td.table(spark, d, "nation")
    gone_regions = region.filter(F.col("r_regionkey") % 2 == 1).select("r_regionkey")
    nation_left = audit.cascade_delete(nation, "n_regionkey", gone_regions, "r_regionkey")
    gone_nations = nation.join(nation_left.select("n_nationkey"), "n_nationkey", "left_anti")
    bridge = td.employee_territories(spark, d)
    left = audit.cascade_delete(bridge, "n_nationkey", gone_nations, "n_nationkey")
    return left.select(F.col("s_suppkey").alias("employee_id"),
                       F.col("n_nationkey").cast("bigint").alias("territory_id"))


def q_cascade_update(spark, d):
    """Renumber every region key by +100; territories follow."""
    region = td.table(spark, d, "region")
    key_map = region.select(F.col("r_regionkey").alias("old_key"), (F.col("r_regionkey") + 100).alias("new_key"))
    nation = td.table(spark, d, "nation")
    out = audit.cascade_update(nation, "n_regionkey", key_map)
    return out.select(F.col("n_nationkey").cast("bigint").alias("n_nationkey"), "n_name",
                      F.col("n_regionkey").cast("bigint").alias("n_regionkey"))


def q_cascade_update_bridge(spark, d):
    """Renumber every territory key by +100; the bridge rows follow."""
    nation = td.table(spark, d, "nation")
    key_map = nation.select(F.col("n_nationkey").alias("old_key"), (F.col("n_nationkey") + 100).alias("new_key"))
    out = audit.cascade_update(td.employee_territories(spark, d), "n_nationkey", key_map)
    return out.select(F.col("s_suppkey").alias("employee_id"),
                      F.col("n_nationkey").cast("bigint").alias("territory_id"))


# ---------------------------------------------------------------- landing

ORDER_TYPES = {"cust": "bigint", "od": "date", "fin": "boolean"}


def q_land_normalize(spark, d):
    raw = td.orders_landed_text(spark, d)
    return landing.normalize(raw, {"k": "bigint", **ORDER_TYPES})


def q_land_rejects(spark, d):
    return landing.rejects(td.orders_landed_text(spark, d), "k", {"k": "bigint", **ORDER_TYPES})


CUSTOMER_SCHEMA = T.StructType([T.StructField("c_custkey", T.LongType()), T.StructField("c_name", T.StringType()),
                                T.StructField("c_nationkey", T.LongType()), T.StructField("c_acctbal", T.DecimalType(19, 4)),
                                T.StructField("c_mktsegment", T.StringType())])


def _customer_csv(spark, d):
    """Customers as a headed CSV whose columns are in another order than declared."""
    path = f"{shared_dir(spark, 'landing')}/customer-{uuid.uuid4().hex}"
    td.customer_text_csv(spark, d).write.option("header", True).csv(path)
    return landing.load_with_rejects(spark, path, CUSTOMER_SCHEMA, "c_custkey")


def q_land_typed_csv(spark, d):
    return _customer_csv(spark, d)[0]


def q_land_typed_csv_rejects(spark, d):
    return _customer_csv(spark, d)[1]


def q_land_malformed(spark, d):
    """Lines with too many or too few fields are kept whole, all others loaded."""
    path = f"{shared_dir(spark, 'landing')}/lines-{uuid.uuid4().hex}"
    td.customer_lines(spark, d).write.text(path)
    rows, bad = landing.load_delimited(spark, path, CUSTOMER_SCHEMA, max_bad_share=0.1)
    return rows.select(F.lit("row").alias("kind"), *CUSTOMER_SCHEMA.names, F.lit(None).cast("string").alias("line")).unionByName(
        bad.select(F.lit("line").alias("kind"), "line"), allowMissingColumns=True)


def q_land_append(spark, d):
    """Two loads of one table, the second with its columns in another order:
    appended by name."""
    path = f"{shared_dir(spark, 'landing')}/append-{uuid.uuid4().hex}"
    c = td.table(spark, d, "customer")
    landing.append(c.filter(F.col("c_custkey") % 2 == 0), path)
    landing.append(c.filter(F.col("c_custkey") % 2 == 1).select(*reversed(c.columns)), path)
    return spark.read.schema(c.schema).parquet(path)


def _entities(spark, d):
    return landing.load_entities(spark, d, td.TABLES)


def q_land_preview(spark, d):
    return landing.preview(_entities(spark, d), catalog.PROVIDED_KEYS, n=15)


def q_land_preview_rows(spark, d):
    """The first 15 whole rows of every entity by key, all columns as text."""
    parts = []
    for name, df in _entities(spark, d).items():
        top = landing.preview_rows(df, catalog.PROVIDED_KEYS[name])
        parts.append(top.select(F.lit(name).alias("entity"), landing.row_text(df.schema).alias("row_text")))
    return reduce(DataFrame.unionByName, parts)


def q_land_entities(spark, d):
    return landing.entity_counts(landing.load_entities(spark, d, td.TABLES))


# ---------------------------------------------------------------- pipeline / publish / catalog

def q_star_pipeline(spark, d):
    """Load and publish every star table (audited), then report rows and
    distinct keys per published table."""
    root = f"{warehouse_root(spark)}/star-{uuid.uuid4().hex}"
    pipeline.run_star(spark, d, root)
    return pipeline.summary(spark, root)


RELOAD_CUT = "1997-01-01"  # lines shipped before are day 1's batch


def q_star_reload(spark, d):
    """Two daily loads into one warehouse: on day 2 sources have new, changed
    and missing keys.  Every row of every published table."""
    root = f"{warehouse_root(spark)}/reload-{uuid.uuid4().hex}"
    lines = td.table(spark, d, "lineitem")
    before = lines.filter(F.col("l_shipdate") < F.lit(RELOAD_CUT).cast("timestamp_ntz"))
    pipeline.run_star(spark, d, root, day=1, as_of=td.CURRENT_SINCE, lines=before)
    pipeline.run_star(spark, d, root, day=2, as_of=AS_OF, lines=lines)
    return pipeline.content(spark, root)


def q_star_commit(spark, d):
    """Day 2's load fails an audit over the fact when all its tables are
    written: every row of the star is still day 1's."""
    root = f"{warehouse_root(spark)}/commit-{uuid.uuid4().hex}"
    lines = td.table(spark, d, "lineitem")
    before = lines.filter(F.col("l_shipdate") < F.lit(RELOAD_CUT).cast("timestamp_ntz"))
    pipeline.run_star(spark, d, root, day=1, as_of=td.CURRENT_SINCE, lines=before)

    def checks(commit):
        return {"fact_dates": commit.table("fact_order_lines").filter(f"ship_date_key >= {RELOAD_CUT.replace('-', '')}")}
    try:
        pipeline.run_star(spark, d, root, day=2, as_of=AS_OF, lines=lines, checks=checks)
    except ValueError as e:
        if "fact_dates" not in str(e):
            raise
    return pipeline.content(spark, root)


def q_reject_replay(spark, d):
    """Each line is delivered once: day 1 those shipped before the cut, day 2
    the others.  Lines that lacked a key on day 1 become fact rows on day 2,
    once, if it exists by then."""
    root = f"{warehouse_root(spark)}/replay-{uuid.uuid4().hex}"
    lines = td.table(spark, d, "lineitem")
    early = F.col("l_shipdate") < F.lit(RELOAD_CUT).cast("timestamp_ntz")
    pipeline.run_star(spark, d, root, day=1, as_of=td.CURRENT_SINCE, lines=lines.filter(early))
    pipeline.run_star(spark, d, root, day=2, as_of=AS_OF, lines=lines.filter(~early))
    return pipeline.content(spark, root).filter(F.col("table_name").isin("fact_order_lines", "fact_rejects"))


def q_feed_between(spark, d):
    """Net change of a dimension over three loads: keys that the first load
    brings leave with the second, and changed values change back."""
    root = f"{warehouse_root(spark)}/feeds-{uuid.uuid4().hex}"
    name, first = "dim_customer_feed", td.customer_prev(spark, d)
    publish(first, name, root=root)
    second = td.customer_source(spark, d)
    k = F.col("k")
    third = td.customer_source_later(spark, d)
    last = third.withColumn("nm", F.when(k % 12 == 5, F.concat("nm", F.lit(" II"))).otherwise(F.col("nm")))
    for source in (second, third, last):
        base = current_snapshot(spark, name, root)
        rows, feed = scd1_load(read_snapshot(spark, name, base, root), source, "k", CUSTOMER_TRACKED)
        publish(rows, name, root=root, base=base, feed=feed, feed_keys="k")
    net = changes(spark, name, 1, 4, root)
    return net.select("k", ACTION, F.col("before.nm").alias("nm_before"), F.col("before.addr").alias("addr_before"),
                      F.col("after.nm").alias("nm_after"), F.col("after.addr").alias("addr_after"))


def q_publish_compacted(spark, d):
    """Six appends, folded together, read back."""
    root = f"{warehouse_root(spark)}/chain-{uuid.uuid4().hex}"
    c = td.table(spark, d, "customer")
    for i in range(6):
        base = current_snapshot(spark, "customers", root)
        publish(c.filter(F.col("c_custkey") % 6 == i), "customers", root=root, base=base, keep=base)
    compact(spark, "customers", root)
    return read_table(spark, "customers", root)


def q_fact_asof_lookup(spark, d):
    """Order lines with the customer's version of the order date, which is
    looked up once per order: of the lines only their key is moved."""
    o = td.table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderdate")
    found = lookup_asof(o, td.customer_versions(spark, d), "o_custkey", "o_orderdate", "c_custkey",
                        {"version_key": "version_key", "ineffective_date": "valid_to"}, how="left")
    lines = td.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber")
    return lines.join(found.drop("o_orderdate"), "l_orderkey").select(F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").cast("bigint").alias("line_number"),
                        F.col("o_custkey").alias("customer_id"), "version_key", F.col("valid_to").isNotNull().alias("ends_later"))


def q_employee_hierarchy(spark, d):
    """Every employee's managers at all distances, and who is in a cycle."""
    pairs, cycle = ancestors(td.employee_tree(spark, d), "employee_id", "reports_to", "manager_id")
    return pairs.select(F.lit("above").alias("kind"), "employee_id", "manager_id", "distance").unionByName(
        cycle.select(F.lit("cycle").alias("kind"), "employee_id"), allowMissingColumns=True)


def q_cascade_closure(spark, d):
    """The odd regions and every 13th employee are deleted: territories of the
    regions, all who report to a deleted employee, and the bridge rows of both
    go; the home territory of employees who stay becomes NULL."""
    region = td.table(spark, d, "region")
    staff = td.employee_tree(spark, d)
    n = td.table(spark, d, "nation")
    tables = {"region": region.select("r_regionkey"), "employee": staff,
              "territory": n.select(F.col("n_nationkey").cast("bigint").alias("territory_id"),
                                    F.col("n_regionkey").cast("bigint").alias("region_id")),
              "bridge": td.employee_territories(spark, d).select(F.col("s_suppkey").alias("employee_id"),
                                                                 F.col("n_nationkey").cast("bigint").alias("territory_id"))}
    left = cascade_closure(tables, catalog.CASCADES, {
        "region": region.filter("r_regionkey % 2 = 1").select("r_regionkey"),
        "employee": staff.filter("employee_id % 13 = 12").select("employee_id")})
    ids = {"region": ["r_regionkey"], "territory": ["territory_id", "region_id"], "employee": ["employee_id", "territory_id"],
           "bridge": ["employee_id", "territory_id"]}
    parts = [left[t].select(F.lit(t).alias("table_name"), F.col(cols[0]).cast("bigint").alias("id_1"),
                            (F.col(cols[1]) if len(cols) > 1 else F.lit(None)).cast("bigint").alias("id_2")) for t, cols in ids.items()]
    return reduce(DataFrame.unionByName, parts)


def q_evolve_read(spark, d):
    """Orders written under two schemas: between them the key and the price
    are widened, the price renamed, the status dropped and the priority added."""
    root, name = f"{warehouse_root(spark)}/evolve-{uuid.uuid4().hex}", "orders"
    o, k = td.table(spark, d, "orders"), F.col("o_orderkey")
    first = evolve.create(spark, name, {"order_id": "int", "customer_id": "bigint", "price": "decimal(12,2)", "status": "string"}, root)
    evolve.append(o.filter(k % 2 == 0).select(k.cast("int").alias("order_id"), F.col("o_custkey").alias("customer_id"),
                                              F.col("o_totalprice").cast("decimal(12,2)").alias("price"),
                                              F.col("o_orderstatus").alias("status")), first)
    second = evolve.alter(spark, first, add={"priority": ("string", "NONE")}, rename={"price": "total_price"},
                          widen={"order_id": "bigint", "total_price": "decimal(19,4)"}, drop=["status"])
    evolve.append(o.filter(k % 2 == 1).select(k.alias("order_id"), F.col("o_custkey").alias("customer_id"),
                                              F.col("o_totalprice").cast("decimal(19,4)").alias("total_price"),
                                              F.col("o_orderpriority").alias("priority")), second)
    return evolve.read(spark, name, root)


def q_schema_registry(spark, d):
    """Every provided table declared, created, filled and altered (a load date
    is added) by DDL: its columns as the catalog has them, and its rows."""
    tables = _entities(spark, d)
    entities = catalog.provided(spark, tables)
    database = f"registry_{uuid.uuid4().hex}"
    catalog.apply_ddl(spark, entities, database, f"{warehouse_root(spark)}/{database}")
    parts = []
    try:
        for name, df in tables.items():
            df.write.insertInto(f"{database}.{name}")
        for e in entities:
            e.schema = T.StructType([*e.schema.fields, T.StructField("loaded_on", T.DateType())])
        catalog.apply_ddl(spark, entities, database)
        for e in entities:
            columns = spark.createDataFrame([(e.name, *c) for c in catalog.declared_columns(spark, database, e.name)],
                                            "table_name string, ordinal_position bigint, column_name string, data_type string, "
                                            "is_nullable boolean, is_key boolean").drop("is_nullable")
            stats = spark.table(f"{database}.{e.name}").agg(F.count(F.lit(1)).alias("n_rows"), F.count("loaded_on").alias("n_loaded_on"))
            parts.append(columns.join(F.broadcast(stats)))  # one row
        return checkpoint_table(reduce(DataFrame.unionByName, parts), "registry")
    finally:
        catalog.drop_ddl(spark, entities, database)


def q_scd1_touched_files(spark, d):
    """A small batch (changed segments, new keys) merged into a dimension of
    twelve key-ranged files; files without a key of the batch stay."""
    root, name = f"{warehouse_root(spark)}/touched-{uuid.uuid4().hex}", "customers"
    c, k = td.table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment"), F.col("c_custkey")
    publish(touched.key_ranged(c, "c_custkey", 12), name, root=root)
    changed = c.filter(k % 150 == 7).withColumn("c_mktsegment", F.concat("c_mktsegment", F.lit("!")))
    new = c.filter(k % 300 == 9).withColumn("c_custkey", k + td.SHIFTED_KEY_OFFSET)
    touched.merge_touched(spark, name, changed.unionByName(new), "c_custkey", root=root)
    return read_table(spark, name, root)


def q_audit_incremental(spark, d):
    """Two batches of orders: the second repeats some keys, has orders without
    a customer, and comes with customers gone.  Old rows are read through
    sketches first; together with the first batch's violations the result is
    that of a full audit."""
    o, c, k = td.orders_nullable_customer(spark, d), td.table(spark, d, "customer").select("c_custkey"), F.col("o_orderkey")
    old, new = o.filter(k % 2 == 0), o.filter((k % 2 == 1) | (k % 100 == 0))
    later = c.filter(F.col("c_custkey") % 7 != 0)
    gone = c.filter(F.col("c_custkey") % 7 == 0)
    bits = sketch.sketch_bits(old.count())
    key_sketch = checkpoint_table(sketch.key_sketch(old, "o_orderkey", bits), "sketch")
    ref_sketch = checkpoint_table(sketch.key_sketch(old, "o_custkey", bits), "sketch")
    twice = sketch.new_duplicates(new, "o_orderkey", key_sketch, lambda: old)
    lost = sketch.new_orphans(new, "o_custkey", later, "c_custkey", gone, ref_sketch, lambda: old)
    before = audit.orphans(old, "o_custkey", c, "c_custkey").unionByName(lost)
    return before.select(F.lit("orphan").alias("violation"), "o_orderkey", "o_custkey").unionByName(
        twice.select(F.lit("duplicate").alias("violation"), "o_orderkey"), allowMissingColumns=True)


def q_append_audited(spark, d):
    """Orders appended in four loads, each audited against the others by the
    sketches that they left.  Then customers go, and a fifth load repeats some
    orders and has some without a customer: what its audit finds, in the new
    rows and in the old ones whose customer went."""
    root = f"{warehouse_root(spark)}/audited-{uuid.uuid4().hex}"
    c, k = td.table(spark, d, "customer").select("c_custkey", "c_name"), F.col("o_orderkey")
    o = td.orders_nullable_customer(spark, d)
    unknown = audit.orphans(o, "o_custkey", c, "c_custkey").select(*o.columns)
    valid = o.join(unknown.select(k), "o_orderkey", "left_anti")
    publish(c, "customers", root=root)
    how = {"keys": "o_orderkey", "references": [("o_custkey", "customers", "c_custkey")], "root": root}
    for part in range(4):
        sketches.append_checked(valid.filter(k % 4 == part), "orders", **how)
    base = current_snapshot(spark, "customers", root)
    left, feed = scd1_load(read_table(spark, "customers", root), c.filter(F.col("c_custkey") % 7 != 0), "c_custkey", ["c_name"],
                           delete_missing=True)
    publish(left, "customers", root=root, base=base, feed=feed, feed_keys="c_custkey")
    made = sketches.prepare_append(valid.filter(k % 100 == 0).unionByName(unknown), "orders", **how)
    return made.violations["orphan_o_custkey"].select(F.lit("orphan").alias("violation"), "o_orderkey", "o_custkey").unionByName(
        made.violations["duplicate_o_orderkey"].select(F.lit("duplicate").alias("violation"), "o_orderkey"), allowMissingColumns=True)


def q_publish_snapshot(spark, d):
    """Publish the customer dimension as a checked snapshot and read it back."""
    dim = td.table(spark, d, "customer")
    publish(dim, "dim_customer_snapshot",
            audits={"primary_key": lambda w: audit.duplicate_keys(w, "c_custkey"),
                    "not_null": lambda w: audit.null_violations(w, "c_custkey", ["c_name"])})
    return read_table(spark, "dim_customer_snapshot")


CATALOG_EXCLUDE = ("embeddings", "pages", "benchmark", "labels", "conversations")


def q_catalog_tables(spark, d):
    """Tables of the landing area (minus excluded ones), with row counts."""
    ents = landing.load_entities(spark, d, td.TABLES)
    catalog.register_views(spark, ents)
    names = catalog.list_tables(spark, exclude=CATALOG_EXCLUDE, only=td.TABLES)
    parts = [spark.table(n).agg(F.count(F.lit(1)).cast("bigint").alias("n_rows"))
             .select(F.lit(n).alias("table_name"), "n_rows") for n in names]
    return reduce(DataFrame.unionByName, parts)


def q_catalog_columns(spark, d):
    """Columns of each provided table in order, with their non-NULL counts
    (one aggregate pass per table, unpivoted to one row per column)."""
    parts = []
    for name, df in _entities(spark, d).items():
        cols = [c for _, c, _ in catalog.list_columns(df)]
        stats = df.agg(*[F.count(F.col(c)).cast("bigint").alias(c) for c in cols])
        parts.append(stats.unpivot([], cols, "column_name", "n_non_null").select(
            F.lit(name).alias("table_name"), "column_name",
            F.array_position(F.array(*[F.lit(c) for c in cols]), F.col("column_name")).cast("bigint")
            .alias("ordinal_position"),
            "n_non_null"))
    return reduce(DataFrame.unionByName, parts)


def q_catalog_primary_keys(spark, d):
    """Declared key of each table, checked against the data."""
    parts = []
    for name, df in _entities(spark, d).items():
        keys = catalog.PROVIDED_KEYS[name]
        parts.append(df.agg(F.count(F.lit(1)).cast("bigint").alias("n_rows"),
                            F.count_distinct(*[F.col(k) for k in keys]).cast("bigint").alias("n_keys"))
                     .select(F.lit(name).alias("table_name"), F.lit(",".join(keys)).alias("key_columns"),
                             "n_rows", "n_keys", (F.col("n_rows") == F.col("n_keys")).alias("is_unique")))
    return reduce(DataFrame.unionByName, parts)


QUERIES = {
    "fact_order_lines": q_fact_order_lines,
    "fact_territory_fanout": q_fact_territory_fanout,
    "fact_orders_compat": q_fact_orders_compat,
    "fact_key_lookup": q_fact_key_lookup,
    "fact_semi_filters": q_fact_semi_filters,
    "fact_unmatched": q_fact_unmatched,
    "fact_append_idempotent": q_fact_append_idempotent,
    "fact_append_null_keys": q_fact_append_null_keys,
    "scalar_day_number": q_scalar_day_number,
    "scalar_date_keys": q_scalar_date_keys,
    "calendar_dim": q_calendar_dim,
    "change_sentinel": _change_query("sentinel"),
    "change_sql": _change_query("sql"),
    "change_nullsafe": _change_query("null_safe"),
    "change_binary": q_change_binary,
    "merge_actions": q_merge_actions,
    "merge_cast_key": q_merge_cast_key,
    "scd1_merge": q_scd1_merge,
    "scd2_merge": q_scd2_merge,
    "scd2_expire": q_scd2_expire,
    "scd2_new_versions": q_scd2_new_versions,
    "scd2_change_feed": q_scd2_change_feed,
    "scd2_current_rows": q_scd2_current_rows,
    "scd2_feed_full": q_scd2_feed_full,
    "scd2_same_day": q_scd2_same_day,
    "scd2_version_keys": q_scd2_version_keys,
    "scd2_region": q_scd2_region,
    "scd2_territory": q_scd2_territory,
    "scd2_employee": q_scd2_employee,
    "scd3_customer": q_scd3_customer,
    "scd4_products": q_scd4_products,
    "scd4_current": q_scd4_current,
    "surrogate_keys": q_surrogate_keys,
    "dim_products": q_dim_products,
    "bridge_employee_territory": q_bridge_employee_territory,
    "audit_primary_key": q_audit_primary_key,
    "audit_composite_key": q_audit_composite_key,
    "audit_unique_current": q_audit_unique_current,
    "audit_declared": q_audit_declared,
    "audit_foreign_key": q_audit_foreign_key,
    "audit_self_fk": q_audit_self_fk,
    "audit_not_null": q_audit_not_null,
    "audit_length": q_audit_length,
    "cascade_delete": q_cascade_delete,
    "cascade_update": q_cascade_update,
    "cascade_update_bridge": q_cascade_update_bridge,
    "land_normalize": q_land_normalize,
    "land_rejects": q_land_rejects,
    "land_typed_csv": q_land_typed_csv,
    "land_typed_csv_rejects": q_land_typed_csv_rejects,
    "land_append": q_land_append,
    "land_malformed": q_land_malformed,
    "evolve_read": q_evolve_read,
    "schema_registry": q_schema_registry,
    "land_preview": q_land_preview,
    "land_preview_rows": q_land_preview_rows,
    "land_entities": q_land_entities,
    "star_pipeline": q_star_pipeline,
    "star_reload": q_star_reload,
    "star_commit": q_star_commit,
    "reject_replay": q_reject_replay,
    "feed_between": q_feed_between,
    "publish_compacted": q_publish_compacted,
    "scd1_touched_files": q_scd1_touched_files,
    "audit_incremental": q_audit_incremental,
    "append_audited": q_append_audited,
    "fact_asof_lookup": q_fact_asof_lookup,
    "employee_hierarchy": q_employee_hierarchy,
    "cascade_closure": q_cascade_closure,
    "publish_snapshot": q_publish_snapshot,
    "catalog_tables": q_catalog_tables,
    "catalog_columns": q_catalog_columns,
    "catalog_primary_keys": q_catalog_primary_keys,
}
