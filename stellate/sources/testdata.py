"""The reference's source entities, expressed over the provided tables.

The reference loads an order database (regions, territories, employees,
customers, shippers, categories, suppliers, products, orders, order lines)
from a workbook that is not available.  These functions build the same
entities from the provided parquet tables; every one is a lazy DataFrame
derived from the whole input, so its work grows with the data.

The "before" snapshots used to exercise the merges (``customer_prev``,
``customer_hist`` ...) are fixed derivations of the input, documented in
FIXTURES.md section 4; the DuckDB oracle uses the same definitions.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the derived fixtures (FIXTURES.md section 4).
AS_OF = _dt.date(2002, 1, 1)             # load date of every merge query
CURRENT_SINCE = _dt.date(2001, 1, 1)     # effective date of existing current versions
CLOSED_FROM = _dt.date(2000, 1, 1)       # closed history versions
CLOSED_TO = _dt.date(2000, 12, 31)
SHIFTED_KEY_OFFSET = 1000000             # keys of the "before" snapshot that left the source
ORPHAN_KEY_OFFSET = 9000000
NULL_TOKENS = ("nan", "NaT")             # how the workbook reader renders missing values

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# --------------------------------------------------------------------------
# customers: source ("after") and the dimension before the load
# --------------------------------------------------------------------------

def customer_source(spark, sf_dir) -> DataFrame:
    """Source customers: NULL attribute on every 17th key."""
    c = table(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").alias("k"), F.col("c_name").alias("nm"),
                    F.when(F.col("c_custkey") % 17 == 0, F.lit(None))
                    .otherwise(F.col("c_mktsegment")).alias("addr"))


def customer_prev(spark, sf_dir) -> DataFrame:
    """The dimension before the load: every 10th key missing (inserts), every
    7th changed, every 11th NULL, every 13th shifted away (deletes)."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    kept = c.filter(k % 10 != 0).select(
        k.alias("k"), F.col("c_name").alias("nm"),
        F.when(k % 11 == 0, F.lit(None))
         .when(k % 7 == 0, F.concat(F.lit("OLD_"), F.col("c_mktsegment")))
         .otherwise(F.col("c_mktsegment")).alias("addr"))
    gone = c.filter(k % 13 == 0).select((k + SHIFTED_KEY_OFFSET).alias("k"),
                                        F.col("c_name").alias("nm"),
                                        F.col("c_mktsegment").alias("addr"))
    return kept.unionByName(gone)


def customer_source_later(spark, sf_dir) -> DataFrame:
    """The source some loads later: every 10th key is gone, every 7th has its
    value of ``prev`` again, every 13th another name."""
    k = F.col("k")
    prev = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), "c_mktsegment")
    old = F.when(k % 11 == 0, F.lit(None)).when(k % 7 == 0, F.concat(F.lit("OLD_"), F.col("c_mktsegment"))).otherwise(F.col("addr"))
    return (customer_source(spark, sf_dir).join(prev, "k").filter(k % 10 != 0)
            .select("k", F.when(k % 13 == 0, F.upper("nm")).otherwise(F.col("nm")).alias("nm"),
                    F.when(k % 7 == 0, old).otherwise(F.col("addr")).alias("addr")))


def customer_hist(spark, sf_dir) -> DataFrame:
    """Versioned dimension: ``prev`` as current versions plus one closed
    version for keys with k % 5 = 1."""
    p = customer_prev(spark, sf_dir)
    cur = p.select("k", "nm", "addr", F.lit(True).alias("is_current"),
                   F.lit(CURRENT_SINCE).alias("effective_date"),
                   F.lit(None).cast("date").alias("ineffective_date"))
    closed = p.filter(F.col("k") % 5 == 1).select(
        "k", "nm", F.lit("HIST").alias("addr"), F.lit(False).alias("is_current"),
        F.lit(CLOSED_FROM).alias("effective_date"), F.lit(CLOSED_TO).alias("ineffective_date"))
    return cur.unionByName(closed)


def customer_prev_scd3(spark, sf_dir) -> DataFrame:
    """``prev`` with previous-address columns; every 3rd key already has one."""
    p = customer_prev(spark, sf_dir)
    has = F.col("k") % 3 == 0
    return p.select("k", "nm", "addr",
                    F.when(has, F.lit("PREV_ADDR")).alias("addr_prev"),
                    F.when(has, F.lit("20000101")).alias("addr_prev_validto"),
                    (F.col("k") * 10).alias("customer_key"))


def customer_landed_with_nulls(spark, sf_dir) -> DataFrame:
    """Customers as landed, with missing values in two nullable columns."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    return c.select(k.alias("k"),
                    F.when(k % 23 == 0, F.lit(None)).otherwise(F.col("c_name")).alias("nm"),
                    F.when(k % 17 == 0, F.lit(None)).otherwise(F.col("c_mktsegment")).alias("addr"),
                    F.col("c_nationkey").alias("nation"))


def customer_text_keys(spark, sf_dir) -> DataFrame:
    """Customer keys as landed text: zero padded, every 37th not numeric."""
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        F.when(k % 37 == 0, F.concat(F.lit("C"), k.cast("string")))
         .otherwise(F.lpad(k.cast("string"), 8, "0")).alias("k_text"))


# --------------------------------------------------------------------------
# small reference entities
# --------------------------------------------------------------------------

def shippers(spark, sf_dir) -> DataFrame:
    """Shippers = distinct order priorities; id = the leading digit."""
    o = table(spark, sf_dir, "orders")
    # min() keeps the choice deterministic (and retry-safe) if two
    # priorities ever shared a leading digit; partial aggregation keeps a
    # hot priority at one row per task
    return (o.groupBy(F.substring("o_orderpriority", 1, 1).cast("bigint").alias("shipper_id"))
            .agg(F.min("o_orderpriority").alias("company_name")))


def ship_via(col="o_orderpriority"):
    return F.substring(F.col(col), 1, 1).cast("bigint")


def categories(spark, sf_dir) -> DataFrame:
    """Categories = distinct part types."""
    return table(spark, sf_dir, "part").select(F.col("p_type").alias("category_name")).distinct()


def employee_territories(spark, sf_dir) -> DataFrame:
    """Bridge: every supplier (as employee) covers the five nations (as
    territories) with (s_suppkey + n_nationkey) % 5 = 0.  Written as an
    equi-join on the residue, not as a filtered cross product."""
    s = table(spark, sf_dir, "supplier").select(
        "s_suppkey", ((5 - F.col("s_suppkey") % 5) % 5).cast("int").alias("_r"))
    n = table(spark, sf_dir, "nation").select(
        "n_nationkey", (F.col("n_nationkey") % 5).cast("int").alias("_r"))
    return s.join(n, "_r").select("s_suppkey", "n_nationkey")


def employees(spark, sf_dir) -> DataFrame:
    """Suppliers as employees: a photo blob and a manager (reports_to).
    Every 10th has no manager; every 17th points at a missing one."""
    s = table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    return s.select(
        k.alias("employee_id"),
        F.col("s_name").alias("last_name"),
        F.col("s_nationkey").alias("nation_id"),
        F.col("s_acctbal").cast("decimal(19,4)").alias("acctbal"),
        F.encode(F.concat_ws("|", F.col("s_name"), F.col("s_name"), F.col("s_nationkey").cast("string")),
                 "UTF-8").alias("photo"),
        F.when(k % 10 == 0, F.lit(None).cast("bigint"))
         .when(k % 17 == 0, k + SHIFTED_KEY_OFFSET)
         .otherwise(k - k % 10).alias("reports_to"))


def employee_tree(spark, sf_dir) -> DataFrame:
    """Employees (suppliers) in a deep hierarchy: employee k reports to k / 2.
    Those with k % 29 = 27 and 28 report to each other (a cycle, where both
    exist), every 31st to a missing one.  Each has a home territory."""
    k = F.col("s_suppkey")
    manager = (F.when(k % 29 == 27, k + 1).when(k % 29 == 28, k - 1).when(k % 31 == 30, k + SHIFTED_KEY_OFFSET)
               .when(k > 0, F.floor(k / 2)))
    return table(spark, sf_dir, "supplier").select(k.alias("employee_id"), manager.cast("bigint").alias("reports_to"),
                                                   F.col("s_nationkey").cast("bigint").alias("territory_id"))


def customer_versions(spark, sf_dir) -> DataFrame:
    """Customers with one to four versions over the orders' dates: version i of
    customer k begins 500 i + 30 (k % 5) days after the first order date, and
    ends the day before the next; the last is open."""
    k = F.col("c_custkey")
    start = F.date_add(F.lit(_dt.date(1995, 1, 1)), (F.col("i") * 500 + (k % 5) * 30).cast("int"))
    return (table(spark, sf_dir, "customer").select(k, "c_mktsegment", F.explode(F.sequence(F.lit(0), (k % 4).cast("int"))).alias("i"))
            .select("c_custkey", (k * 10 + F.col("i")).alias("version_key"), start.alias("effective_date"),
                    F.when(F.col("i") < k % 4, F.date_add(start, 499)).alias("ineffective_date")))


def orders_nullable_customer(spark, sf_dir) -> DataFrame:
    """Orders whose customer reference is NULL (every 19th) or points at a
    missing customer (every 23rd)."""
    k = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        k, F.when(k % 19 == 0, F.lit(None).cast("bigint"))
            .when(k % 23 == 0, F.col("o_custkey") + ORPHAN_KEY_OFFSET)
            .otherwise(F.col("o_custkey")).alias("o_custkey"))


def orders_landed_text(spark, sf_dir) -> DataFrame:
    """Orders as a workbook reader renders them: everything text, missing
    numbers as 'nan', missing dates as 'NaT', booleans as 'True'/'False';
    every 31st key isn't a number."""
    k = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        F.when(k % 31 == 0, F.concat(F.lit("x"), k.cast("string"))).otherwise(k.cast("string")).alias("k"),
        F.when(k % 11 == 0, F.lit("nan")).when(k % 29 == 0, F.lit("bad"))
         .otherwise(F.col("o_custkey").cast("string")).alias("cust"),
        F.when(k % 13 == 0, F.lit("NaT"))
         .otherwise(F.col("o_orderdate").cast("date").cast("string")).alias("od"),
        F.when(F.col("o_orderstatus") == "F", F.lit("True")).otherwise(F.lit("False")).alias("fin"))


# --------------------------------------------------------------------------
# SCD2 targets for region / territory / employee
# --------------------------------------------------------------------------

def _versioned(df: DataFrame) -> DataFrame:
    return df.select("*", F.lit(True).alias("is_current"),
                     F.lit(CURRENT_SINCE).alias("effective_date"),
                     F.lit(None).cast("date").alias("ineffective_date"))


def region_source(spark, sf_dir) -> DataFrame:
    r = table(spark, sf_dir, "region")
    return r.select(F.col("r_regionkey").cast("bigint").alias("region_id"),
                    F.col("r_name").alias("description"))


def region_dim_before(spark, sf_dir) -> DataFrame:
    """DimRegion before the load: the last region missing, even ones renamed."""
    r = table(spark, sf_dir, "region")
    last = r.agg(F.max("r_regionkey").alias("r_regionkey"))
    k = F.col("r_regionkey")
    kept = r.join(last, "r_regionkey", "left_anti")
    return _versioned(kept.select(
        k.cast("bigint").alias("region_id"),
        F.when(k % 2 == 0, F.concat(F.lit("OLD_"), F.col("r_name"))).otherwise(F.col("r_name"))
         .alias("description")))


def territory_source_text(spark, sf_dir) -> DataFrame:
    """Territories as landed: text keys (zero padded), description, region."""
    n = table(spark, sf_dir, "nation")
    return n.select(F.lpad(F.col("n_nationkey").cast("string"), 5, "0").alias("territory_text"),
                    F.col("n_name").alias("description"),
                    F.col("n_regionkey").cast("bigint").alias("region_id"))


def territory_dim_before(spark, sf_dir) -> DataFrame:
    """DimTerritories before the load: keys with n % 7 = 6 missing, every 3rd
    renamed, every 4th in another region."""
    n = table(spark, sf_dir, "nation")
    k = F.col("n_nationkey")
    return _versioned(n.filter(k % 7 != 6).select(
        k.cast("bigint").alias("territory_id"),
        F.when(k % 3 == 0, F.concat(F.lit("OLD_"), F.col("n_name"))).otherwise(F.col("n_name"))
         .alias("description"),
        F.when(k % 4 == 0, (F.col("n_regionkey") + 1) % 5).otherwise(F.col("n_regionkey"))
         .cast("bigint").alias("region_id")))


def employee_dim_before(spark, sf_dir) -> DataFrame:
    """DimEmployees before the load: every 10th (k % 10 = 3) missing, every 4th
    renamed, every 9th with another balance, every 6th with a photo that
    differs only after byte 30."""
    e = employees(spark, sf_dir)
    k = F.col("employee_id")
    return _versioned(e.filter(k % 10 != 3).select(
        k,
        F.when(k % 4 == 0, F.concat(F.lit("OLD_"), F.col("last_name"))).otherwise(F.col("last_name"))
         .alias("last_name"),
        "nation_id",
        F.when(k % 9 == 0, F.col("acctbal") + F.lit(1).cast("decimal(19,4)")).otherwise(F.col("acctbal"))
         .cast("decimal(19,4)").alias("acctbal"),
        F.when(k % 6 == 0, F.concat(F.col("photo"), F.encode(F.lit("X"), "UTF-8"))).otherwise(F.col("photo"))
         .alias("photo"),
        "reports_to"))


def product_source(spark, sf_dir) -> DataFrame:
    """Products after the load: every 7th part repriced (+1.00), every 11th renamed."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    return p.select(
        k.alias("product_id"),
        F.when(k % 11 == 0, F.concat(F.col("p_name"), F.lit(" v2"))).otherwise(F.col("p_name")).alias("product_name"),
        (F.col("p_retailprice").cast("decimal(19,4)")
         + F.when(k % 7 == 0, F.lit(1)).otherwise(F.lit(0)).cast("decimal(19,4)")).cast("decimal(19,4)")
        .alias("unit_price"),
        F.col("p_type").alias("category_name"))


def product_current_before(spark, sf_dir) -> DataFrame:
    """Products before the load: every 9th missing."""
    p = table(spark, sf_dir, "part").filter(F.col("p_partkey") % 9 != 0)
    return p.select(F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"),
                    F.col("p_retailprice").cast("decimal(19,4)").alias("unit_price"),
                    F.col("p_type").alias("category_name"),
                    F.lit(CURRENT_SINCE).alias("valid_from"),
                    (F.col("p_partkey") * 10).alias("product_key"))


def customer_lines(spark, sf_dir) -> DataFrame:
    """Customers as lines of a CSV without a header: every 43rd has a field too
    many, every 47th one too few, every 53rd a balance that isn't a number."""
    c, k = table(spark, sf_dir, "customer"), F.col("c_custkey")
    balance = F.when(k % 53 == 0, F.lit("bad")).otherwise(F.col("c_acctbal").cast("decimal(19,4)").cast("string"))
    fields = F.concat_ws(",", k.cast("string"), F.col("c_name"), F.col("c_nationkey").cast("string"), balance, F.col("c_mktsegment"))
    return c.select(F.when(k % 43 == 0, F.concat(fields, F.lit(",extra")))
                    .when(k % 47 == 0, F.concat_ws(",", k.cast("string"), F.col("c_name"))).otherwise(fields).alias("value"))


def customer_text_csv(spark, sf_dir) -> DataFrame:
    """Customers as text in another column order than declared: every 41st key
    and every 31st balance isn't a number, every 19th balance is missing."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    return c.select(
        F.col("c_mktsegment"),
        F.when(k % 31 == 0, F.lit("bad")).when(k % 19 == 0, F.lit("nan"))
         .otherwise(F.col("c_acctbal").cast("decimal(19,4)").cast("string")).alias("c_acctbal"),
        F.when(k % 41 == 0, F.concat(F.lit("x"), k.cast("string"))).otherwise(k.cast("string")).alias("c_custkey"),
        F.col("c_nationkey").cast("string").alias("c_nationkey"),
        F.col("c_name"))


# --------------------------------------------------------------------------
# sources of the star load: as given, or as two days of a reload
# --------------------------------------------------------------------------

def _day(df: DataFrame, day, first, second) -> DataFrame:
    """``first`` / ``second`` filter the source of day 1 / day 2; None is the table as given."""
    return df if day is None else df.filter(first if day == 1 else second)


def _renamed(c: str, when, day) -> F.Column:
    return (F.when(when, F.concat(F.lit("OLD_"), F.col(c))).otherwise(F.col(c)).alias(c) if day == 1 else F.col(c))


def star_sources(spark, sf_dir, day=None) -> dict:
    """Source of each dimension.  On day 1 some keys are still missing and some
    rows have other values; on day 2 they are there as given, and other keys
    have left the source."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    ck = F.col("c_custkey")
    customers = _day(c, day, ck % 10 != 0, ck % 13 != 0).select(
        "c_custkey", "c_name", "c_nationkey", _renamed("c_mktsegment", ck % 7 == 0, day))

    pk = F.col("p_partkey")
    price = F.col("p_retailprice").cast("decimal(19,4)")
    if day == 2:
        price = (price + F.when(pk % 7 == 0, F.lit(1)).otherwise(F.lit(0)).cast("decimal(19,4)")).cast("decimal(19,4)")
    name = F.when(pk % 11 == 0, F.concat("p_name", F.lit(" v2"))).otherwise(F.col("p_name")) if day == 2 else F.col("p_name")
    products = _day(table(spark, sf_dir, "part"), day, pk % 9 != 0, F.lit(True)).select(
        pk.alias("product_id"), name.alias("product_name"), F.col("p_brand").alias("brand"),
        F.col("p_size").cast("bigint").alias("size"), price.alias("unit_price"), F.col("p_type").alias("category_name"))

    e, ek = employees(spark, sf_dir), F.col("employee_id")
    staff = _day(e, day, ek % 10 != 3, ek % 12 != 5).select(
        "employee_id", _renamed("last_name", ek % 4 == 0, day), "nation_id", "acctbal", "photo", "reports_to")

    n, nk = territory_source_text(spark, sf_dir), F.col("territory_id")
    t = n.select(F.col("territory_text").try_cast("bigint").alias("territory_id"), "description", "region_id")
    territories = _day(t, day, nk % 7 != 6, nk % 11 != 4).select(
        "territory_id", _renamed("description", nk % 3 == 0, day), "region_id")

    rk = F.col("region_id")
    regions = _day(region_source(spark, sf_dir), day, rk != 2, F.lit(True)).select(
        "region_id", _renamed("description", rk % 2 == 0, day))

    s, sk = shippers(spark, sf_dir), F.col("shipper_id")
    ships = _day(s, day, sk != 3, F.lit(True)).select("shipper_id", _renamed("company_name", sk == 2, day))
    if day == 1:  # one that is gone on day 2
        ships = ships.unionByName(s.filter(sk == 1).select((sk + 100).alias("shipper_id"), "company_name"))
    return {"dim_customers": customers, "dim_products": products, "dim_employees": staff,
            "dim_territories": territories, "dim_regions": regions, "dim_shippers": ships}
