"""Declared schema registry (the reference's DDL) and catalog helpers."""

from stellate.sources import catalog


def test_primary_keys_and_unknown_table():
    assert catalog.primary_key("order_details") == ["OrderID", "ProductID"]
    assert catalog.primary_key("employee_territories") == ["EmployeeID", "TerritoryID"]
    assert catalog.primary_key("no_such_table") == []


def test_declared_types_and_references():
    od = catalog.schema_of("order_details")
    assert od["UnitPrice"].dataType.simpleString() == "decimal(19,4)"
    assert not od["Quantity"].nullable
    emp = catalog.REGISTRY["employees"]
    assert (["ReportsTo"], "employees", ["EmployeeID"]) in emp.foreign_keys
    assert catalog.STAR_LENGTHS["fact_orders"]["ShipRegion"] < emp.lengths["Region"]


def test_load_order_puts_parents_first():
    pos = {n: i for i, n in enumerate(catalog.LOAD_ORDER)}
    for e in catalog.SOURCE:
        for _, parent, _ in e.foreign_keys:
            if parent != e.name:  # self references are audited after the load
                assert pos[parent] < pos[e.name], (parent, e.name)


def test_list_tables_excludes(spark):
    spark.createDataFrame([(1,)], "a int").createOrReplaceTempView("cat_keep")
    spark.createDataFrame([(1,)], "a int").createOrReplaceTempView("cat_drop")
    got = catalog.list_tables(spark, exclude=("cat_drop",), only=("cat_keep", "cat_drop"))
    assert got == ["cat_keep"]


def test_command_line_lists_queries(capsys):
    from stellate.__main__ import main
    assert main(["list"]) == 0
    out = capsys.readouterr().out.split()
    assert "fact_order_lines" in out and "scd2_merge" in out
