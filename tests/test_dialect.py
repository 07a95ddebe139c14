"""One golden case per source idiom: the Spark expression that replaces it."""

from datetime import date, datetime as D

import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions.temporal import minute_of
from tidemark.operators import loads, tableops

CASES = [
    ("ISNULL / IFNULL", "coalesce(NULL, 3)", 3),
    ("CONVERT(DATE, x)", "cast('2020-05-06 07:08:09' AS DATE)", date(2020, 5, 6)),
    ("CONVERT(VARCHAR, x)", "cast(12.50 AS STRING)", "12.50"),
    ("TRY_CAST", "try_cast('x' AS INT)", None),
    ("DATE_FORMAT", "date_format(TIMESTAMP_NTZ'2020-05-06 07:08:09', 'yyyyMMddHHmmss')", "20200506070809"),
    ("STR_TO_DATE date", "to_date('06/05/2020', 'dd/MM/yyyy')", date(2020, 5, 6)),
    (
        "STR_TO_DATE timestamp",
        "cast(to_timestamp('06/05/2020 07', 'dd/MM/yyyy HH') AS TIMESTAMP_NTZ)",
        D(2020, 5, 6, 7),
    ),
    ("string concatenation", "'a' || 'b'", "ab"),
    ("datetime2(7) end of time", "cast('9999-12-31 23:59:59.9999999' AS TIMESTAMP_NTZ)", D(9999, 12, 31, 23, 59, 59, 999999)),
]


@pytest.mark.parametrize("idiom,expression,expected", CASES, ids=[c[0] for c in CASES])
def test_expression(spark, idiom, expression, expected):
    assert spark.sql(f"SELECT {expression}").first()[0] == expected


@pytest.fixture(scope="module")
def items(spark):
    df = spark.createDataFrame([(1, "b", 5), (1, "a", 7), (2, "c", 1)], "k int, v string, n int")
    df.createOrReplaceTempView("items")
    return df


def test_string_agg_is_ordered(spark, items):
    sql = "SELECT k, string_agg(v, ',') WITHIN GROUP (ORDER BY v) AS s FROM items GROUP BY k ORDER BY k"
    assert [r["s"] for r in spark.sql(sql).collect()] == ["a,b", "c"]


def test_top_n(spark, items):
    assert [r["v"] for r in spark.sql("SELECT v FROM items ORDER BY n DESC LIMIT 2").collect()] == ["a", "b"]


def test_outer_apply(spark, items):
    sql = """SELECT o.x, t.v FROM (SELECT explode(array(1, 3)) AS x) o
             LEFT JOIN LATERAL (SELECT v FROM items i WHERE i.k = o.x ORDER BY n LIMIT 1) t ON true ORDER BY 1"""
    assert [tuple(r) for r in spark.sql(sql).collect()] == [(1, "b"), (3, None)]


def test_temp_table_becomes_a_cte(spark, items):
    sql = "WITH t AS (SELECT k, sum(n) AS s FROM items GROUP BY k) SELECT max(s) FROM t"
    assert spark.sql(sql).first()[0] == 12


def test_cursor_becomes_a_set_operation(spark, items):
    sql = "SELECT sum(n) OVER (ORDER BY v) AS running FROM items ORDER BY v"
    assert [r[0] for r in spark.sql(sql).collect()] == [7, 12, 13]


def test_session_time(spark):
    row = spark.sql("SELECT current_timestamp() = now(), current_timestamp() IS NOT NULL").first()
    assert row[0] and row[1]


def test_minute_ignores_the_session_zone(spark):
    """02:30 does not exist in this zone on the night the clocks change."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.sql("SELECT TIMESTAMP_NTZ'2024-03-10 02:30:59.123456' AS ts")
        out = df.select(minute_of(F.col("ts")).alias("m"))
        assert out.schema["m"].dataType.simpleString() == "timestamp_ntz"
        assert out.first()["m"] == D(2024, 3, 10, 2, 30)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_merge_output_is_the_staged_side(spark):
    """MERGE … OUTPUT and ON DUPLICATE KEY UPDATE: the next state, and which keys were replaced or new."""
    target = spark.createDataFrame([("a", 1), ("b", 2)], "k string, n int")
    source = spark.createDataFrame([("b", 20), ("c", 30)], "k string, n int")
    state = tableops.upsert(target, source, ["k"], [F.col("n")])
    assert sorted(tuple(r) for r in state.collect()) == [("a", 1), ("b", 20), ("c", 30)]
    known = target.select("k", F.lit("UPDATE").alias("action"))
    output = source.join(known, "k", "left").select("k", F.coalesce("action", F.lit("INSERT")).alias("action"))
    assert sorted(tuple(r) for r in output.collect()) == [("b", "UPDATE"), ("c", "INSERT")]


def test_scope_identity_is_the_key_of_the_open_load(spark):
    lineage = spark.createDataFrame([], schemas.LOADS)
    first = loads.open_load(lineage, "City", "2024-01-01", "2024-01-02")
    second = loads.open_load(first, "Sale", "2024-01-01", "2024-01-02")
    assert loads.require_open_key(second, "City") == 1 and loads.require_open_key(second, "Sale") == 2
