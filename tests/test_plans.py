"""Shapes of the physical plans that matter at scale."""

import re

import pytest
from pyspark.sql import functions as F

from tidemark.operators import conform, marts, scd, tableops
from tidemark.operators.lookups import Versions, lookup_key_asof
from tidemark.workload.queries import QUERIES

FORBIDDEN = (
    "CartesianProduct",
    "BroadcastNestedLoopJoin",
    "PythonUDF",
    "ArrowEvalPython",
    "BatchEvalPython",
    "MapInPandas",
    "FlatMapGroupsInPandas",
    "ObjectHashAggregate(keys=[]), functions=[collect",
    "collect_list",
    "collect_set",
)


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"assigned_keys"}))
def test_no_cross_join_no_python_no_collected_groups(spark, small, name):
    plan = physical(QUERIES[name](spark, small))
    assert not [word for word in FORBIDDEN if word in plan]
    # A window never runs over one single partition.
    assert not re.search(r"Window \[.*\n.*Sort.*\n.*SinglePartition", plan)


@pytest.fixture
def shuffled(spark):
    """No broadcast, and thresholds low enough for test data to count as skewed."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def hot(spark, rows=60000):
    """A third of the rows carry one key."""
    return spark.range(0, rows, 1, 8).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), F.col("id").alias("n")
    )


def split_hot_key(df):
    df.collect()
    return "skew=true" in physical(df)


def test_orphans_split_a_hot_missing_customer(spark, shuffled):
    facts = hot(spark).select(
        F.col("n").alias("Sale Key"), F.col("k").alias("Customer Key"), F.col("n").alias("Stock Item Key")
    )
    keys = spark.range(0, 60000)
    out = conform.fact_orphans(
        facts, keys.select(F.col("id").alias("customer_key")), keys.select(F.col("id").alias("stock_item_key"))
    )
    assert out.count() == 20000
    assert split_hot_key(out)


def test_fact_upsert_splits_a_hot_invoice(spark, shuffled):
    stage = spark.range(0, 100).select(F.col("id").alias("k"), F.lit(0).cast("bigint").alias("n"))
    out = tableops.replace_by_key(hot(spark), stage, "k")
    # Two thirds of the first hundred keys are facts of their own and go; the hundred staged rows come.
    assert out.count() == 60000 - 66 + 100
    assert split_hot_key(out)


def test_close_off_splits_a_hot_business_key(spark, shuffled):
    dim = hot(spark).select(
        F.col("k").alias("id"),
        "n",
        F.lit("9999-12-31 23:59:59.999999").cast("timestamp_ntz").alias("Valid To"),
    )
    stage = spark.range(-1, 5).select("id", F.lit("2024-01-01").cast("timestamp_ntz").alias("Valid From"))
    out = scd.close_off(dim, stage, "id")
    assert out.filter("`Valid To` < '2025-01-01'").count() == 20000 + 3
    assert split_hot_key(out)


def test_asof_splits_a_hot_key(spark, shuffled):
    stage = hot(spark).select("k", "n", F.lit("2020-03-01").cast("timestamp_ntz").alias("at"))
    dim = spark.range(-1, 60000).select(
        "id",
        (F.col("id") + 100).alias("key"),
        F.lit("2020-01-01").cast("timestamp_ntz").alias("vf"),
        F.lit("2021-01-01").cast("timestamp_ntz").alias("vt"),
    )
    out = lookup_key_asof(
        stage, dim, Versions("id", "key", "vf", "vt"), "k", "at", "found",
    )
    assert out.filter("found = k + 100").count() == 60000
    assert split_hot_key(out)


def test_daily_sales_shuffles_the_fact_once(spark, folder):
    fact = spark.range(0, 1000).select(
        F.lit("2020-01-01").cast("date").alias("invoice_date_key"),
        (F.col("id") % 7).alias("stock_item_key"),
        F.col("id").alias("quantity"),
        F.col("id").alias("total_including_tax"),
        F.col("id").alias("profit"),
        F.lit("wide").alias("unused"),
    )
    fact.write.parquet(f"{folder}/fact")
    dates = spark.range(1).select(F.lit("2020-01-01").cast("date").alias("date_key"))
    items = spark.range(7).select(
        F.col("id").alias("stock_item_key"), F.col("id").alias("stock_item_id"), F.lit("x").alias("stock_item_name")
    )
    out = marts.mart_daily_sales(spark.read.parquet(f"{folder}/fact"), F.broadcast(dates), F.broadcast(items))
    plan = physical(out)
    assert plan.count("Exchange hashpartitioning") == 1
    assert "partial_sum(quantity" in plan and "unused" not in plan


def test_hot_keys_on_the_right_are_reduced(spark, shuffled):
    """A staged hot key is one row of the join's right side, so nothing has to be split there."""
    fact = spark.range(0, 50).select(F.col("id").alias("k"), (F.col("id") + 100).alias("n"))
    stage = hot(spark).select("k", "n")
    replaced = tableops.replace_by_key(fact, stage, "k")
    assert replaced.count() == stage.count() + fact.join(stage, "k", "left_anti").count()
    kept = tableops.upsert(fact, stage, ["k"], [F.col("n")])
    assert kept.count() == stage.select("k").distinct().count() + fact.join(stage, "k", "left_anti").count()
    for out in (replaced, kept):
        joins = re.findall(r"Join.*", physical(out))
        assert joins and "Aggregate" in physical(out) or "WindowGroupLimit" in physical(out)
