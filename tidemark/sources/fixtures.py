"""Expectations counted from exported CSV fixtures."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions.temporal import Instant, instant
from tidemark.schemas import EXPECTATIONS

# Fixture, table it vouches for, note. The last file holds one number, not rows.
FIXTURES = (
    ("dim_city_snapshot", "gold.mart_city_dimension", "From dim_city_snapshot.csv"),
    (
        "dim_customer_after_migrate",
        "gold.mart_customer_current",
        "From dim_customer_after_migrate.csv (post Migrate*)",
    ),
    (
        "dim_stock_item_after_migrate",
        "gold.mart_stock_movements",
        "From dim_stock_item_after_migrate.csv (post Migrate*)",
    ),
    ("fact_sale_count", "bronze.fact_sale", "From fact_sale_count.csv"),
)
SINGLE_VALUE = "fact_sale_count"
COMPARE = "exact_when_expected_set"


def _expected(spark: SparkSession, path: str, single: bool) -> int | None:
    try:
        rows = spark.read.csv(path, header=True)
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    if single:
        first = rows.limit(1).collect()
        text = (first[0][0] or "").strip() if first else ""
        if text.isdigit():
            return int(text)
    return rows.count()


def stage_expectations(
    spark: SparkSession, folder: str, now: Instant, prefix: str = ""
) -> DataFrame:
    """The four expectations; a fixture that was not exported has none."""
    rows = [
        (
            name,
            f"{prefix}{table}",
            "row_count",
            _expected(spark, f"{folder}/{name}.csv", name == SINGLE_VALUE),
            COMPARE,
            note,
        )
        for name, table, note in FIXTURES
    ]
    names = EXPECTATIONS.fieldNames()[:-1]
    staged = spark.createDataFrame(
        rows, ", ".join(f"{n} {'bigint' if n == 'expected' else 'string'}" for n in names)
    )
    return staged.withColumn("staged_at", instant(now)).orderBy(F.col("fixture_name"))
