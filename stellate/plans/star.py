"""The star schema built from the source entities.

Grain of the fact is the order line (the reference fans lines out once per
territory of the employee; ``fact_territory_fanout`` keeps that shape).  All
surrogate keys are looked up -- customer, employee, product, shipper -- and
date keys are yyyymmdd so they join the calendar.

Join strategy is left to Catalyst + AQE: the line-to-order join is a
sort-merge join on the order key; each key lookup is an equi-join that AQE
turns into a broadcast join when the dimension's key map is small at run
time, and whose skewed partitions (a customer with a third of all orders)
AQE splits.  Employees are broadcast up to a counted bound.  Nothing is
broadcast on a guess.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stellate.functions.dates import date_key
from stellate.operators.keys import key_map, with_surrogate_keys
from stellate.sources import testdata as td


def customer_keys(spark, sf_dir) -> DataFrame:
    return key_map(td.table(spark, sf_dir, "customer"), "c_custkey", "customer_key")


def dim_customers(spark, sf_dir) -> DataFrame:
    c = td.table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    return c.join(customer_keys(spark, sf_dir), "c_custkey")


def dim_categories(spark, sf_dir) -> DataFrame:
    return key_map(td.categories(spark, sf_dir), "category_name", "category_id")


def product_keys(spark, sf_dir) -> DataFrame:
    return key_map(td.table(spark, sf_dir, "part"), "p_partkey", "product_key")


def product_suppliers(spark, sf_dir) -> DataFrame:
    """The supplier of a product: the provided part table has no such column,
    so it is the least supplier among the product's order lines."""
    sup = (td.table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("product_id"))
           .agg(F.min("l_suppkey").alias("supplier_id")))
    s = td.table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("supplier_id"), F.col("s_name").alias("supplier_name"), F.col("s_nationkey").alias("n_nationkey"))
    n = td.table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("supplier_country"))
    return sup.join(s.join(n, "n_nationkey", "left").drop("n_nationkey"), "supplier_id")


def dim_products_with_supplier(spark, sf_dir) -> DataFrame:
    """Products with category and, where order lines name one, supplier."""
    return dim_products(spark, sf_dir).join(product_suppliers(spark, sf_dir), "product_id", "left")


def dim_products(spark, sf_dir, keys: DataFrame | None = None) -> DataFrame:
    """Products denormalised with their category (inner: a product without a
    known category is not loaded, as in the reference's join)."""
    p = td.table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_size", "p_retailprice",
                                               F.col("p_type").alias("category_name"))
    keys = keys if keys is not None else product_keys(spark, sf_dir)
    return (p.join(keys, "p_partkey").join(dim_categories(spark, sf_dir), "category_name")
            .select("product_key",
                    F.col("p_partkey").alias("product_id"),
                    F.col("p_name").alias("product_name"),
                    F.col("p_brand").alias("brand"),
                    F.col("p_size").cast("bigint").alias("size"),
                    F.col("p_retailprice").cast("decimal(19,4)").alias("unit_price"),
                    "category_id", "category_name"))


def employee_keys(spark, sf_dir) -> DataFrame:
    return key_map(td.table(spark, sf_dir, "supplier").withColumnRenamed("s_suppkey", "employee_id"),
                   "employee_id", "employee_key")


def dim_employees(spark, sf_dir) -> DataFrame:
    return td.employees(spark, sf_dir).join(employee_keys(spark, sf_dir), "employee_id")


def dim_shippers(spark, sf_dir) -> DataFrame:
    return with_surrogate_keys(td.shippers(spark, sf_dir), "shipper_id", "shipper_key")


def dim_territories(spark, sf_dir) -> DataFrame:
    n = td.table(spark, sf_dir, "nation")
    return with_surrogate_keys(
        n.select(F.col("n_nationkey").cast("bigint").alias("territory_id"), F.col("n_name").alias("description"),
                 F.col("n_regionkey").cast("bigint").alias("region_id")),
        "territory_id", "territory_key")


def bridge_employee_territory(spark, sf_dir, emp_dim: DataFrame | None = None,
                              terr_dim: DataFrame | None = None) -> DataFrame:
    """Bridge table in surrogate keys (both dimensions' current rows)."""
    b = td.employee_territories(spark, sf_dir)
    emp_dim = emp_dim if emp_dim is not None else dim_employees(spark, sf_dir)
    terr_dim = terr_dim if terr_dim is not None else dim_territories(spark, sf_dir)
    e = emp_dim.select(F.col("employee_id").alias("s_suppkey"), "employee_key")
    t = terr_dim.select(F.col("territory_id").alias("n_nationkey"), "territory_key")
    return b.join(e, "s_suppkey").join(t, "n_nationkey").select("employee_key", "territory_key")


def employees_with_territory(spark, sf_dir) -> DataFrame:
    """Employees that cover at least one territory of an existing region --
    the existence filter the reference's region/territory joins impose."""
    b = td.employee_territories(spark, sf_dir)
    n = td.table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    r = td.table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("n_regionkey"))
    return (b.join(n, "n_nationkey").join(r, "n_regionkey", "left_semi")
            .select(F.col("s_suppkey").alias("l_suppkey")).distinct())


def order_lines(spark, sf_dir) -> DataFrame:
    """Order lines joined to their order (the one big-big join)."""
    li = td.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_discount", "l_shipdate")
    o = td.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderdate", "o_orderpriority")
    return li.join(o, "l_orderkey")


def order_headers(spark, sf_dir, cust_dim: DataFrame | None = None,
                  ship_dim: DataFrame | None = None, how: str = "inner") -> DataFrame:
    """Orders with their order-level surrogate keys (customer, shipper).

    Looking these up on the order (1 row per order) instead of on the line
    (~4 rows per order, wider) shrinks the data each lookup shuffles.  A
    shipper dimension that counts at most ``SMALL_DIM_ROWS`` rows is broadcast:
    the lookup key has a handful of values, so a shuffle on it would land in a
    handful of tasks."""
    o = td.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate",
                                                 td.ship_via().alias("ship_via"))
    cust_dim = cust_dim if cust_dim is not None else customer_keys(spark, sf_dir)
    ship_dim = ship_dim if ship_dim is not None else dim_shippers(spark, sf_dir)
    cust = cust_dim.select(F.col("c_custkey").alias("o_custkey"), "customer_key")
    ship = small(ship_dim.select(F.col("shipper_id").alias("ship_via"), "shipper_key"))
    return (o.join(cust, "o_custkey", how).join(ship, "ship_via", how)
            .select(F.col("o_orderkey").alias("l_orderkey"), "customer_key", "shipper_key",
                    date_key("o_orderdate").alias("order_date_key")))


SMALL_DIM_ROWS = 10_000


#: rows of a key and its surrogate key (two longs) that are broadcast rather than all order lines exchanged
SMALL_KEY_ROWS = 500_000


def small(dim: DataFrame, most: int = SMALL_DIM_ROWS) -> DataFrame:
    """``dim`` marked for broadcast if it counts at most ``most`` rows."""
    return F.broadcast(dim) if dim.limit(most + 1).count() <= most else dim


def fact_order_lines(spark, sf_dir, dims: dict | None = None, lines: DataFrame | None = None,
                     how: str = "inner", keep_lines: bool = False) -> DataFrame:
    """Order-line fact.  Plan shape: order-level lookups on ``orders``, one
    sort-merge join of lines to orders on the order key, then the line-level
    lookups (product, employee).  Existence filters (category, territory)
    are applied to the dimensions before the lookup, never to the fact.

    ``dims`` may supply already-published dimensions (keys ``customers``,
    ``shippers``, ``products``, ``employees``); missing ones are built.
    ``lines`` is the batch (default: all lines); ``how="left"`` keeps lines
    without a match, with NULL keys; ``keep_lines`` adds the source line as
    the struct ``line``."""
    dims = dims or {}
    li = lines if lines is not None else td.table(spark, sf_dir, "lineitem")
    li = li.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                   "l_discount", "l_shipdate")
    prod_dim = dims.get("products")
    prod_dim = prod_dim if prod_dim is not None else dim_products(spark, sf_dir)
    emp_dim = dims.get("employees")
    if emp_dim is None:  # only the key map is needed for the lookup
        emp_dim = employee_keys(spark, sf_dir)
    prod = prod_dim.select(F.col("product_id").alias("l_partkey"), "product_key",
                           F.col("unit_price").alias("list_price"))
    emp = (emp_dim.select(F.col("employee_id").alias("l_suppkey"), "employee_key")
           .join(employees_with_territory(spark, sf_dir), "l_suppkey", "left_semi"))
    emp = small(emp, SMALL_KEY_ROWS)
    headers = order_headers(spark, sf_dir, dims.get("customers"), dims.get("shippers"), how)
    return (li.join(headers, "l_orderkey", how)
            .join(prod, "l_partkey", how)
            .join(emp, "l_suppkey", how)
            .select(F.col("l_orderkey").alias("order_id"),
                    F.col("l_linenumber").cast("bigint").alias("line_number"),
                    "customer_key", "employee_key", "product_key", "shipper_key",
                    "order_date_key",
                    date_key("l_shipdate").alias("ship_date_key"),
                    F.col("l_quantity").cast("bigint").alias("quantity"),
                    F.col("l_extendedprice").cast("decimal(19,4)").alias("line_price"),
                    "list_price",
                    F.col("l_discount").alias("discount"),
                    *([F.struct(*[F.col(c) for c in li.columns]).alias("line")] if keep_lines else [])))
