"""Dimensions stored by segments, and facts found by few keys: cost by batch, equal results."""

import os
from datetime import datetime as D, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import rows
from test_runs import go, staged, warehouse  # noqa: F401
from tidemark.operators import scd, segments, tableops
from tidemark.plans import incremental as inc
from tidemark.sources import sinks

EOT = D(9999, 12, 31, 23, 59, 59, 999999)
DIM = "`Customer Key` int, `WWI Customer ID` int, Customer string, `Valid From` timestamp_ntz, `Valid To` timestamp_ntz, `Lineage Key` int"


def files(table):
    """Data files of a table by segment, with their sizes."""
    found = {}
    for path in table.select(F.input_file_name()).distinct().collect():
        path = path[0].removeprefix("file://").removeprefix("file:")
        name = path.split("Segment=")[1].split("/")[0]
        found.setdefault(name, {})[path] = os.path.getsize(path)
    return found


def test_equal_to_the_whole_dimension(spark):
    """Over batches with late, repeated, unknown and already ended versions the union of segments is the dimension."""
    start = D(2020, 1, 1)
    old = [(k, k % 7, f"n{k}", start + timedelta(days=9 * k), EOT if k % 3 else start + timedelta(days=9 * k + 40), 0) for k in range(60)]
    whole = spark.createDataFrame(old + [(99, 3, "x", start, None, 0), (98, None, "y", start, EOT, 0)], DIM)
    parts = segments.with_segment(whole)
    for batch in range(1, 4):
        staged_ = [(n % 9 if n else None, f"b{batch}", D(2021, batch, 1 + n), EOT if n % 4 else D(2021, batch + 3, 1)) for n in range(8)]
        stage = spark.createDataFrame(staged_, "`WWI Customer ID` int, Customer string, `Valid From` timestamp_ntz, `Valid To` timestamp_ntz")
        whole = scd.scd2_apply(whole, stage, "WWI Customer ID", batch)
        added = scd.staged_rows(parts.drop("Segment"), stage, batch)
        written = segments.batch_rows(parts, stage, added, "WWI Customer ID")
        touched = sorted({r[0] for r in segments.touched_segments(written).collect()} | {"open"})
        after = segments.next_segments(parts, written, touched)
        parts = parts.filter(~F.col("Segment").isin(*touched)).unionByName(after)
        schema = parts.schema
        parts = spark.createDataFrame(parts.collect(), schema)
        whole = spark.createDataFrame(whole.collect(), whole.schema)
        assert rows(parts.drop("Segment")) == rows(whole)
        assert rows(segments.current(parts).drop("Segment")) == rows(whole.filter(F.col("Valid To") == F.lit(EOT)))
        since = D(2021, 2, 15)
        reached = segments.reaching(parts, F.lit(since))
        needed = whole.filter((F.col("Valid To") > F.lit(since)) | F.col("Valid To").isNull())
        assert needed.join(reached, "Customer Key", "left_anti").filter("`Customer Key` IS NOT NULL").count() == 0


def test_segmented_run(spark, warehouse):  # noqa: F811
    warehouse.segment(inc.CUSTOMER)
    warehouse.segment(inc.CUSTOMER)
    go(warehouse, staged(spark))
    customer = warehouse.read("dimension.customer")
    assert rows(customer, "Customer Key", "WWI Customer ID", "Valid To", "Lineage Key", "Segment") == sorted(
        [(1, 7, D(2024, 1, 10), 0, "2024-01"), (2, 8, EOT, 0, "open"), (3, 7, EOT, 1, "open"), (4, 9, EOT, 1, "open")], key=repr
    )
    columns = ["WWI Invoice ID", "Customer Key", "Bill To Customer Key", "Stock Item Key", "Salesperson Key", "Quantity"]
    assert rows(warehouse.read("fact.sale"), *columns) == [
        (1000, 3, 3, 1, 9, 55), (1001, 2, 2, 1, 9, 7), (1002, 2, 2, 1, 9, 8), (2000, 4, 2, 0, 0, 66),
    ]


def test_crash_in_a_segmented_load(spark, warehouse):  # noqa: F811
    warehouse.segment(inc.CUSTOMER)
    stage = staged(spark)
    crash = inc.Incremental(spark, warehouse.root, "2024-02-01", warehouse.prefix)
    crash.finish = lambda key: (_ for _ in ()).throw(RuntimeError("lost"))
    with pytest.raises(RuntimeError, match="lost"):
        crash.dimension(inc.CUSTOMER, stage["Customer"], "2024-01-31")
    go(warehouse, stage)
    assert warehouse.read("dimension.customer").count() == 4


def test_a_batch_leaves_history_alone(spark, warehouse):  # noqa: F811
    """Bytes written by a batch are those of the open segment and one month, however long the history."""
    history = spark.range(20_000).select(
        F.col("id").cast("int").alias("Customer Key"), F.lit(1000).alias("WWI Customer ID"), F.md5(F.col("id").cast("string")).alias("Customer"),
        F.lit(D(2010, 1, 1)).cast("timestamp_ntz").alias("Valid From"),
        (F.lit(D(2010, 1, 1)).cast("timestamp_ntz") + F.make_dt_interval((F.col("id") % 3000).cast("int"))).alias("Valid To"),
        F.lit(0).alias("Lineage Key"),
    )
    dim = warehouse.read("dimension.customer")
    warehouse.publish("dimension.customer", spark.createDataFrame(dim.collect(), dim.schema).unionByName(history))
    warehouse.segment(inc.CUSTOMER)
    before = files(warehouse.read("dimension.customer"))
    warehouse.dimension(inc.CUSTOMER, staged(spark)["Customer"], "2024-01-31")
    table = warehouse.read("dimension.customer")
    after = files(table)
    changed = {name for name in after if after[name] != before.get(name)}
    assert changed == {"open", "2024-01"} and len(before) > 90 and table.count() == 20_004
    written = sum(sum(after[name].values()) for name in changed)
    assert written < 0.05 * sum(size for of in before.values() for size in of.values())
    for reader in (segments.current(table), segments.reaching(table, "2024-01-05")):
        plan = reader._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(Segment" in plan
        assert {p.split("Segment=")[1].split("/")[0] for p in reader.inputFiles()} <= {"open", "2024-01", *before}
    assert len(segments.reaching(table, "2024-01-05").select(F.input_file_name()).distinct().collect()) < 12


def scanned(df):
    """Rows that come out of the scan's row groups."""
    df.collect()
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    return leaf.metrics().apply("numOutputRows").value()


def test_few_keys_skip_row_groups(spark, folder):
    """Every date holds keys of the whole range, so only Bloom filters can tell that a key is not there."""
    sinks.create_layers(spark, folder, ("bl",), "p_")
    fact = spark.range(40_000).select(
        (F.col("id") * 2).cast("int").alias("invoice"), F.lit("x").alias("v"), (F.xxhash64("id") % 16).cast("string").alias("day")
    )
    table = sinks.refresh_partitions(fact, "p_bl.fact", folder, "day", [], find_by="invoice")
    stage = spark.createDataFrame([(20_000, "1"), (33_334, "2"), (33_333, "99")], "invoice int, day string")
    near = tableops.near_keys(table, stage, "invoice")
    found = tableops.touched_partitions(near, stage, "invoice", "day")
    assert rows(found) == rows(tableops.touched_partitions(table, stage, "invoice", "day"))
    assert scanned(near) < 0.3 * table.count()
    assert near.count() == 2
    many = spark.range(500).select((F.col("id") + 100).cast("int").alias("invoice"), F.lit("0").alias("day"))
    wide = tableops.near_keys(table, many, "invoice")
    assert rows(tableops.touched_partitions(wide, many, "invoice", "day")) == rows(tableops.touched_partitions(table, many, "invoice", "day"))
    assert wide.filter("invoice < 100 OR invoice > 599").count() == 0
    assert tableops.near_keys(table, stage.limit(0), "invoice").count() == 0
