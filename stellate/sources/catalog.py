"""Declared schemas (the reference's DDL) and catalog metadata.

Parquet tables enforce neither keys nor NOT NULL, so the registry below is
the single place keys, references and length limits are declared; the audit
jobs read it.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def _f(name, dtype, nullable=True):
    return T.StructField(name, dtype, nullable)


INT, SMALL, STR, BOOL, BIN = T.IntegerType(), T.ShortType(), T.StringType(), T.BooleanType(), T.BinaryType()
MONEY, REAL, TS = T.DecimalType(19, 4), T.FloatType(), T.TimestampNTZType()


def fields(*named) -> T.StructType:
    """(name, required) pairs as a schema whose required columns are NOT NULL."""
    return T.StructType([_f(n, T.StringType(), not required) for n, required in named])


@dataclass
class Entity:
    name: str
    schema: T.StructType
    key: list
    foreign_keys: list = field(default_factory=list)   # (cols, parent, parent_cols)
    lengths: dict = field(default_factory=dict)        # col -> max characters
    unique_current: list = field(default_factory=list)  # unique among rows with is_current
    on_delete: dict = field(default_factory=dict)      # columns of a reference -> cascade, set null or restrict

    @property
    def not_null(self) -> list:
        return [f.name for f in self.schema.fields if not f.nullable]


# The source schema of the reference's order database
# (column names, types, NOT NULL, keys, references, text lengths).
SOURCE = [
    Entity("region", T.StructType([_f("RegionID", INT, False), _f("RegionDescription", STR, False)]),
           ["RegionID"], lengths={"RegionDescription": 50}),
    Entity("territories", T.StructType([_f("TerritoryID", STR, False), _f("TerritoryDescription", STR, False),
                                        _f("RegionID", INT, False)]),
           ["TerritoryID"], [(["RegionID"], "region", ["RegionID"])],
           {"TerritoryID": 20, "TerritoryDescription": 50}),
    Entity("suppliers", T.StructType([_f("SupplierID", INT, False), _f("CompanyName", STR, False),
                                      _f("ContactName", STR), _f("ContactTitle", STR), _f("Address", STR),
                                      _f("City", STR), _f("Region", STR), _f("PostalCode", STR),
                                      _f("Country", STR), _f("Phone", STR), _f("Fax", STR), _f("HomePage", STR)]),
           ["SupplierID"], lengths={"CompanyName": 40, "ContactName": 30, "ContactTitle": 30, "Address": 60,
                                    "City": 15, "Region": 15, "PostalCode": 10, "Country": 15, "Phone": 24,
                                    "Fax": 24}),
    Entity("categories", T.StructType([_f("CategoryID", INT, False), _f("CategoryName", STR, False),
                                       _f("Description", STR), _f("Picture", BIN)]),
           ["CategoryID"], lengths={"CategoryName": 15}),
    Entity("products", T.StructType([_f("ProductID", INT, False), _f("ProductName", STR), _f("SupplierID", INT, False),
                                     _f("CategoryID", INT, False), _f("QuantityPerUnit", STR, False),
                                     _f("UnitPrice", MONEY, False), _f("UnitsInStock", SMALL, False),
                                     _f("UnitsOnOrder", SMALL, False), _f("ReorderLevel", SMALL, False),
                                     _f("Discontinued", BOOL)]),
           ["ProductID"], [(["SupplierID"], "suppliers", ["SupplierID"]),
                           (["CategoryID"], "categories", ["CategoryID"])],
           {"ProductName": 40, "QuantityPerUnit": 20}),
    Entity("employees", T.StructType([_f("EmployeeID", INT, False), _f("LastName", STR, False),
                                      _f("FirstName", STR, False), _f("Title", STR), _f("TitleOfCourtesy", STR),
                                      _f("BirthDate", TS), _f("HireDate", TS), _f("Address", STR), _f("City", STR),
                                      _f("Region", STR), _f("PostalCode", STR), _f("Country", STR),
                                      _f("HomePhone", STR), _f("Extension", STR), _f("Photo", BIN),
                                      _f("Notes", STR), _f("ReportsTo", INT), _f("PhotoPath", STR)]),
           ["EmployeeID"], [(["ReportsTo"], "employees", ["EmployeeID"])],
           {"LastName": 20, "FirstName": 10, "Title": 30, "TitleOfCourtesy": 25, "Address": 60, "City": 15,
            "Region": 25, "PostalCode": 10, "Country": 15, "HomePhone": 24, "Extension": 4, "PhotoPath": 255}),
    Entity("employee_territories", T.StructType([_f("EmployeeID", INT, False), _f("TerritoryID", STR, False)]),
           ["EmployeeID", "TerritoryID"], [(["EmployeeID"], "employees", ["EmployeeID"]),
                                           (["TerritoryID"], "territories", ["TerritoryID"])],
           {"TerritoryID": 20}),
    Entity("customers", T.StructType([_f("CustomerID", STR, False), _f("CompanyName", STR, False),
                                      _f("ContactName", STR), _f("ContactTitle", STR), _f("Address", STR),
                                      _f("City", STR), _f("Region", STR), _f("PostalCode", STR),
                                      _f("Country", STR), _f("Phone", STR), _f("Fax", STR)]),
           ["CustomerID"], lengths={"CustomerID": 5, "CompanyName": 40, "ContactName": 30, "ContactTitle": 30,
                                    "Address": 60, "City": 15, "Region": 15, "PostalCode": 10, "Country": 15,
                                    "Phone": 24, "Fax": 24}),
    Entity("shippers", T.StructType([_f("ShipperID", INT, False), _f("CompanyName", STR, False), _f("Phone", STR)]),
           ["ShipperID"], lengths={"CompanyName": 40, "Phone": 24}),
    Entity("orders", T.StructType([_f("OrderID", INT, False), _f("CustomerID", STR), _f("EmployeeID", INT),
                                   _f("OrderDate", TS), _f("RequiredDate", TS), _f("ShippedDate", TS),
                                   _f("ShipVia", INT), _f("Freight", MONEY), _f("ShipName", STR),
                                   _f("ShipAddress", STR), _f("ShipCity", STR), _f("ShipRegion", STR),
                                   _f("ShipPostalCode", STR), _f("ShipCountry", STR)]),
           ["OrderID"], [(["CustomerID"], "customers", ["CustomerID"]),
                         (["EmployeeID"], "employees", ["EmployeeID"]),
                         (["ShipVia"], "shippers", ["ShipperID"])],
           {"CustomerID": 5, "ShipName": 40, "ShipAddress": 60, "ShipCity": 15, "ShipRegion": 25,
            "ShipPostalCode": 10, "ShipCountry": 15}),
    Entity("order_details", T.StructType([_f("OrderID", INT, False), _f("ProductID", INT, False),
                                          _f("UnitPrice", MONEY, False), _f("Quantity", SMALL, False),
                                          _f("Discount", REAL, False)]),
           ["OrderID", "ProductID"], [(["OrderID"], "orders", ["OrderID"]),
                                      (["ProductID"], "products", ["ProductID"])]),
]

# The star tables' narrower text columns that the source feeds.
STAR_LENGTHS = {"dim_employees": {"Region": 15, "PostalCode": 15}, "fact_orders": {"ShipRegion": 15}}

LONG, DATE, DBL = T.LongType(), T.DateType(), T.DoubleType()
_VERSION = [_f("is_current", BOOL, False), _f("effective_date", DATE, False), _f("ineffective_date", DATE)]

# The published star over the provided tables: keys, references, NOT NULL and
# the text lengths of the reference's star DDL for the columns that have one.
STAR = [
    Entity("dim_date", T.StructType([_f("date_key", LONG, False), _f("date", DATE, False)]), ["date_key"],
           lengths={"month_name": 10}),
    Entity("dim_customers", T.StructType([_f("customer_key", LONG, False), _f("c_custkey", LONG, False), _f("c_name", STR, False),
                                          _f("c_mktsegment", STR), _f("c_mktsegment_prev", STR),
                                          _f("c_mktsegment_prev_validto", STR)]),
           ["customer_key"], lengths={"c_name": 40, "c_mktsegment": 60, "c_mktsegment_prev": 60, "c_mktsegment_prev_validto": 8}),
    Entity("dim_products", T.StructType([_f("product_key", LONG, False), _f("product_id", LONG, False),
                                         _f("product_name", STR, False), _f("category_name", STR, False)]),
           ["product_key"], lengths={"product_name": 40}),
    Entity("dim_products_history", T.StructType([_f("product_id", LONG, False), _f("valid_to", DATE, False)]),
           ["product_id", "valid_from"], lengths={"product_name": 40}),
    Entity("dim_employees", T.StructType([_f("employee_key", LONG, False), _f("employee_id", LONG, False),
                                          _f("last_name", STR, False), *_VERSION]),
           ["employee_key"], lengths={"last_name": 40}, unique_current=["employee_id"]),
    Entity("dim_territories", T.StructType([_f("territory_key", LONG, False), _f("territory_id", LONG, False),
                                            _f("description", STR, False), _f("region_id", LONG, False), *_VERSION]),
           ["territory_key"], lengths={"description": 50}, unique_current=["territory_id"]),
    Entity("dim_regions", T.StructType([_f("region_key", LONG, False), _f("region_id", LONG, False),
                                        _f("description", STR, False), *_VERSION]),
           ["region_key"], lengths={"description": 50}, unique_current=["region_id"]),
    Entity("dim_shippers", T.StructType([_f("shipper_key", LONG, False), _f("shipper_id", LONG, False),
                                         _f("company_name", STR, False)]),
           ["shipper_key"], lengths={"company_name": 40}),
    Entity("bridge_employee_territory", T.StructType([_f("employee_key", LONG, False), _f("territory_key", LONG, False)]),
           ["employee_key", "territory_key"], [(["employee_key"], "dim_employees", ["employee_key"]),
                                               (["territory_key"], "dim_territories", ["territory_key"])],
           on_delete={("employee_key",): "cascade", ("territory_key",): "cascade"}),
    # the fact's grain is the source line, which the source doesn't keep unique
    Entity("fact_order_lines", T.StructType([_f(c, LONG, False) for c in (
        "order_id", "customer_key", "employee_key", "product_key", "shipper_key", "order_date_key", "quantity")]
        + [_f("list_price", MONEY, False), _f("discount", DBL, False)]), [],
           [(["customer_key"], "dim_customers", ["customer_key"]), (["employee_key"], "dim_employees", ["employee_key"]),
            (["product_key"], "dim_products", ["product_key"]), (["shipper_key"], "dim_shippers", ["shipper_key"]),
            (["order_date_key"], "dim_date", ["date_key"]), (["ship_date_key"], "dim_date", ["date_key"])]),
]

# The keys of the provided tables, and the references among the first seven.
PROVIDED_KEYS = {"region": ["r_regionkey"], "nation": ["n_nationkey"], "customer": ["c_custkey"], "supplier": ["s_suppkey"],
                 "part": ["p_partkey"], "orders": ["o_orderkey"], "lineitem": ["l_orderkey", "l_linenumber"],
                 "events": ["event_id"], "documents": ["doc_id"], "embeddings": ["vec_id"], "pages": ["page_id"],
                 "benchmark": ["item_id"], "labels": ["doc_id"], "conversations": ["conv_id", "turn"]}

# Territories of regions, employees of managers and their bridge, over the provided tables, with what a delete does.
CASCADES = [
    Entity("region", T.StructType([_f("r_regionkey", INT, False)]), ["r_regionkey"]),
    Entity("territory", T.StructType([_f("territory_id", LONG, False), _f("region_id", LONG)]), ["territory_id"],
           [(["region_id"], "region", ["r_regionkey"])], on_delete={("region_id",): "cascade"}),
    Entity("employee", T.StructType([_f("employee_id", LONG, False), _f("reports_to", LONG), _f("territory_id", LONG)]),
           ["employee_id"], [(["reports_to"], "employee", ["employee_id"]), (["territory_id"], "territory", ["territory_id"])],
           on_delete={("reports_to",): "cascade", ("territory_id",): "set null"}),
    Entity("bridge", T.StructType([_f("employee_id", LONG, False), _f("territory_id", LONG, False)]), ["employee_id", "territory_id"],
           [(["employee_id"], "employee", ["employee_id"]), (["territory_id"], "territory", ["territory_id"])],
           on_delete={("employee_id",): "cascade", ("territory_id",): "cascade"}),
]

# Load order: parents before children (self references are audited after).
LOAD_ORDER = ["employees", "region", "territories", "suppliers", "categories", "products",
              "employee_territories", "customers", "shippers", "orders", "order_details"]

REGISTRY = {e.name: e for e in [*SOURCE, *STAR]}


def schema_of(name: str) -> T.StructType:
    return REGISTRY[name].schema


def primary_key(name: str) -> list:
    """Declared key columns of an entity, ``[]`` when none is declared."""
    e = REGISTRY.get(name)
    return list(e.key) if e else []


def provided(spark: SparkSession, tables: dict) -> list[Entity]:
    """Entities of loaded tables: their columns, with the declared keys NOT NULL."""
    return [Entity(name, T.StructType([_f(f.name, f.dataType, f.name not in PROVIDED_KEYS[name]) for f in df.schema.fields]),
                   PROVIDED_KEYS[name]) for name, df in tables.items()]


# ---------------------------------------------------------------- DDL

def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def create_table(entity: Entity, database: str) -> str:
    """CREATE TABLE of an entity.  Keys, references and lengths, which Parquet
    tables can't enforce, are kept as properties for the audits."""
    columns = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}" for f in entity.schema.fields)
    told = {"stellate.key": ",".join(entity.key),
            "stellate.references": ";".join(f"{','.join(c)}->{p}({','.join(pc)}) {entity.on_delete.get(tuple(c), 'restrict')}"
                                            for c, p, pc in entity.foreign_keys),
            "stellate.lengths": ",".join(f"{c}:{n}" for c, n in entity.lengths.items())}
    properties = ", ".join(f"'{k}' = '{v}'" for k, v in told.items() if v)
    return (f"CREATE TABLE {_quoted(database)}.{_quoted(entity.name)} ({columns}) USING parquet"
            + (f" TBLPROPERTIES ({properties})" if properties else ""))


def alter_table(spark: SparkSession, entity: Entity, database: str) -> list[str]:
    """What brings an existing table to its declaration: new columns are added;
    a column that is gone or has another type can't be altered and raises."""
    have = {f.name: f.dataType.simpleString() for f in spark.table(f"{_quoted(database)}.{_quoted(entity.name)}").schema.fields}
    want = {f.name: f.dataType.simpleString() for f in entity.schema.fields}
    other = [c for c, t in have.items() if want.get(c) != t]
    if other:
        raise ValueError(f"{entity.name}: columns {', '.join(other)} differ from the declaration")
    new = ", ".join(f"{_quoted(c)} {t}" for c, t in want.items() if c not in have)
    return [f"ALTER TABLE {_quoted(database)}.{_quoted(entity.name)} ADD COLUMNS ({new})"] if new else []


def apply_ddl(spark: SparkSession, entities: list, database: str, location: str | None = None) -> list[str]:
    """Create or alter every entity's table, parents first; the statements that were run."""
    run = [f"CREATE DATABASE IF NOT EXISTS {_quoted(database)}" + (f" LOCATION '{location}'" if location else "")]
    spark.sql(run[0])
    for e in parents_first(entities):
        todo = (alter_table(spark, e, database) if spark.catalog.tableExists(f"{_quoted(database)}.{_quoted(e.name)}")
                else [create_table(e, database)])
        for statement in todo:
            spark.sql(statement)
        run += todo
    return run


def drop_ddl(spark: SparkSession, entities: list, database: str) -> list[str]:
    """Drop the entities' tables, children first, then the database if nothing else is in it."""
    run = [f"DROP TABLE IF EXISTS {_quoted(database)}.{_quoted(e.name)}" for e in reversed(parents_first(entities))]
    run.append(f"DROP DATABASE {_quoted(database)} RESTRICT")
    for statement in run:
        spark.sql(statement)
    return run


def parents_first(entities: list) -> list:
    """Entities so that each follows those that it refers to (self references and cycles aside)."""
    by_name, out, seen = {e.name: e for e in entities}, [], set()
    for e in entities:
        todo = [(e, False)]
        while todo:
            at, done = todo.pop()
            if done:
                out.append(at)
            elif at.name not in seen:
                seen.add(at.name)
                todo.append((at, True))
                todo += [(by_name[p], False) for _, p, _ in at.foreign_keys if p in by_name and p not in seen]
    return out


def declared_columns(spark: SparkSession, database: str, name: str) -> list:
    """(position, name, type, nullable, is key) of a table as the catalog has it."""
    table = f"{_quoted(database)}.{_quoted(name)}"
    told = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}  # a few properties
    key = told.get("stellate.key", "").split(",")
    return [(i + 1, f.name, f.dataType.simpleString(), f.nullable, f.name in key) for i, f in enumerate(spark.table(table).schema.fields)]


def register_views(spark: SparkSession, tables: dict) -> None:
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def list_tables(spark: SparkSession, exclude=(), only=None) -> list:
    """Names of the catalog's tables and views, minus ``exclude``."""
    names = [t.name for t in spark.catalog.listTables()]
    if only is not None:
        names = [n for n in names if n in set(only)]
    return sorted(n for n in names if n not in set(exclude))


def list_columns(df: DataFrame) -> list:
    """(position, name, type) of a DataFrame's columns."""
    return [(i + 1, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
