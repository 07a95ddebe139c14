"""JDBC scans and discovery against an in-memory Derby database, which ships with Spark."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.sources import discovery
from tidemark.sources.external import (
    Source,
    count_in_source,
    extract_changes,
    read_source,
    register_source_views,
)

URL = "jdbc:derby:memory:warehouse;create=true"
PROPERTIES = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}


def statement(spark, sql):
    jvm = spark._jvm
    jvm.java.lang.Class.forName("org.apache.derby.iapi.jdbc.AutoloadedDriver")
    connection = jvm.java.sql.DriverManager.getConnection(URL)
    try:
        connection.createStatement().execute(sql)
    finally:
        connection.close()


@pytest.fixture(scope="module")
def derby(spark):
    for sql in (
        'CREATE SCHEMA "Dimension"',
        'CREATE TABLE "Dimension"."Stock Item" ("Stock Item Key" INT, "Stock Item" VARCHAR(20))',
        'INSERT INTO "Dimension"."Stock Item" VALUES (1, \'a\'), (2, \'b\'), (30, \'c\'), (NULL, \'d\')',
        'CREATE SCHEMA "INFORMATION_SCHEMA"',
        "CREATE TABLE information_schema.tables (table_schema VARCHAR(30), table_name VARCHAR(30), table_type VARCHAR(30))",
        "INSERT INTO information_schema.tables VALUES ('Fact', 'Sale', 'BASE TABLE'), "
        "('Dimension', 'Stock Item', 'BASE TABLE'), ('SYS', 'x', 'BASE TABLE'), ('Dimension', 'V', 'VIEW')",
        "CREATE TABLE information_schema.routines (routine_schema VARCHAR(30), routine_name VARCHAR(30), "
        "routine_type VARCHAR(30), routine_definition VARCHAR(90))",
        "INSERT INTO information_schema.routines VALUES ('shop', 'Load', 'PROCEDURE', 'BEGIN END'), "
        "('shop', 'F', 'FUNCTION', 'RETURN 1'), ('other', 'G', 'FUNCTION', 'RETURN 2')",
    ):
        statement(spark, sql)
    return Source("jdbc", URL, "shop", PROPERTIES)


def test_partitioned_scan(spark, derby):
    df = read_source(spark, derby, "Dimension", "Stock Item", "Stock Item Key", num_partitions=3)
    assert df.rdd.getNumPartitions() == 3
    assert df.count() == 4  # the NULL key is not lost
    assert rows(df.filter(F.col("Stock Item Key") > 1), "Stock Item") == [("b",), ("c",)]


def test_single_scan_and_views(spark, derby):
    views = register_source_views(spark, derby, [("Dimension", "Stock Item", "dim_stock_item")])
    assert views["dim_stock_item"].count() == spark.table("dim_stock_item").count() == 4


def test_discover_tables(spark, derby):
    found = discovery.discover_tables(discovery.catalog_tables(spark, derby))
    assert [(r["source_schema"], r["landing_name"]) for r in found.collect()] == [
        ("Dimension", "dim_stock_item"),
        ("Fact", "fact_sale"),
    ]


def test_discover_routines(spark, derby):
    found, reason = discovery.discover_routines(spark, derby)
    assert reason is None
    assert rows(found, "object_type", "source_name") == [("function", "F"), ("proc", "Load")]
    inventory = discovery.inventory(
        discovery.discover_tables(discovery.catalog_tables(spark, derby)), found, "r", "2024-01-01"
    )
    assert inventory.count() == 4 and inventory.filter("landing_name IS NULL").count() == 2


@pytest.mark.parametrize(
    "src",
    [
        Source("parquet", "/tmp"),
        Source("mysql", "jdbc:mysql://nowhere"),
        Source("sqlserver", "jdbc:sqlserver://nowhere"),
    ],
)
def test_routines_unavailable(spark, src):
    found, reason = discovery.discover_routines(spark, src)
    assert found.count() == 0 and reason


def test_routine_query_names_the_schemas():
    query = discovery.routine_query(Source("sqlserver", "x"))
    assert "'Integration', 'Configuration', 'Application'" in query
    assert "O''Brien" in discovery.routine_query(Source("mysql", "x", "O'Brien"))
    assert Source("sqlserver", "x").quoted("a", "b]c") == "[a].[b]]c]"


def test_source_smoke(spark, derby):
    catalog = discovery.catalog_tables(spark, derby)
    names = [(n,) for n in ("bronze", "silver", "gold", "ops", "source_fed", "default")]
    schemas = spark.createDataFrame(names, "schema_name string")
    row = discovery.source_smoke(catalog, schemas).first()
    assert row["foreign_base_tables"] == 2 and row["managed_schemas_ok"]
    fewer = schemas.filter("schema_name <> 'gold'")
    assert not discovery.source_smoke(catalog, fewer).first()["managed_schemas_ok"]


def test_counts_run_in_the_source(spark, derby, folder):
    tables = [
        ("Dimension", "Stock Item", "dim_stock_item"),
        ("INFORMATION_SCHEMA", "ROUTINES", "information_schema_routines"),
    ]
    counted = count_in_source(spark, derby, tables)
    assert rows(counted) == [("dim_stock_item", 4), ("information_schema_routines", 3)]
    spark.range(6).write.parquet(f"{folder}/a/b")
    files = count_in_source(spark, Source("parquet", folder), [("a", "b", "a_b")])
    assert rows(files) == [("a_b", 6)]


def test_register_filters_are_pushed_to_the_database(spark, derby):
    for sql in (
        'CREATE TABLE "Dimension"."Log" (n INT, changed TIMESTAMP)',
        "INSERT INTO \"Dimension\".\"Log\" VALUES (1, TIMESTAMP('2020-01-01 00:00:00')), "
        "(2, TIMESTAMP('2020-01-02 00:00:00')), (3, TIMESTAMP('2020-01-03 00:00:00'))",
    ):
        statement(spark, sql)
    log = read_source(spark, derby, "Dimension", "Log")
    df = extract_changes(log, "CHANGED", "2020-01-01", "2020-01-02")
    assert rows(df, "N") == [(2,)]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [*IsNotNull" in plan and "*GreaterThan" in plan
