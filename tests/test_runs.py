"""The two runs end to end, over parquet sources built from the smallest scale factor."""

import tempfile
from datetime import datetime as D

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators import tableops
from tidemark.plans import incremental as inc
from tidemark.plans.medallion import run_medallion
from tidemark.sources import sinks
from tidemark.sources.external import Source
from tidemark.workload.views import Views

EOT = "9999-12-31 23:59:59.999999"
RUN = "00000000-0000-4000-8000-000000000001"


@pytest.fixture(scope="module")
def source(spark, small):
    root, v = tempfile.mkdtemp(prefix="spark-"), Views(spark, small)
    tables = {
        ("Dimension", "City"): v.city,
        ("Dimension", "Customer"): v.customer,
        ("Dimension", "Stock Item"): v.stock_item,
        ("Dimension", "Date"): v.date,
        ("Fact", "Sale"): v.sale,
        ("Fact", "Stock Holding"): v.stock_holding,
        ("Application", "Extra Table"): v.table("region"),
    }
    for (schema, name), df in tables.items():
        df.write.parquet(f"{root}/{schema}/{name}")
    catalog = spark.createDataFrame(
        [(s, n, "BASE TABLE") for s, n in tables] + [("sys", "x", "BASE TABLE"), ("dbo", "v", "VIEW")],
        "table_schema string, table_name string, table_type string",
    )
    return Source("parquet", root), catalog


def test_medallion(spark, source, small):
    src, catalog = source
    root, fixtures = tempfile.mkdtemp(prefix="spark-"), tempfile.mkdtemp(prefix="spark-")
    with open(f"{fixtures}/dim_city_snapshot.csv", "w") as f:
        f.write("a\n" + "1\n" * 25)
    arguments = dict(
        catalog=catalog,
        fixture_folder=fixtures,
        skip={("Application", "Extra Table"): "not needed"},
        prefix="m_",
    )
    first = run_medallion(spark, src, root, RUN, "2024-01-01", **arguments).first()
    assert (first["gate"], first["tables_total"], first["tables_landed"]) == ("pass", 6, 6)

    read = lambda t: spark.table(f"m_{t}")
    lines = Views(spark, small).table("lineitem").count()
    sold = read("silver.fact_sale").count()
    assert sold + read("silver.fact_sale_orphan").count() == lines
    total = read("gold.mart_daily_internet_sales").agg(F.sum("transaction_count")).first()[0]
    assert total == sold
    assert read("gold.mart_stock_movements").count() == read("silver.dim_stock_item").count()
    assert read("ops.reconcile_results").filter("result <> 'pass'").count() == 0
    # The generated line items hold one exact repeat; its key check reports it.
    assert rows(read("ops.constraint_checks").filter("result = 'fail'"), "check_id", "violations") == [
        ("primary_key:fact_sale", 1)
    ]
    assert not spark.catalog.tableExists("m_bronze.application_extra_table")
    assert "City Key" in read("bronze.dim_city").columns
    city = read("gold.mart_city_dimension").first()["city_name"]
    assert read("gold.v_mart_city_dimension_ci").filter(F.col("city_name") == city.lower()).count() == 1

    # Every published table is counted and has its origins recorded.
    smoke = dict(rows(read("ops.smoke_results"), "check_name", "row_count"))
    assert smoke["fact_sale_ok"] == sold and smoke["dim_customer_undated"] == 0
    assert {"mart_city_dimension_ok", "dim_customer_scd2_quarantine_ok", "fact_sale_orphan_ok"} <= set(smoke)
    edges = set(rows(read("ops.table_lineage"), "source_table_full_name", "target_table_full_name"))
    assert {
        ("m_source_fed.dim_city", "m_bronze.dim_city"),
        ("m_silver.dim_stock_item", "m_silver.fact_sale_orphan"),
        ("m_bronze.dim_customer", "m_silver.dim_customer_scd2_quarantine"),
        ("m_gold.mart_city_dimension", "m_gold.v_mart_city_dimension_ci"),
    } <= edges
    control = read("ops.load_control").filter("started_at < ended_at AND started_at > '2024-06-01'")
    assert control.count() == 6

    # A second run of the same id replaces its rows; logs grow.
    run_medallion(spark, src, root, RUN, "2024-01-02", **arguments)
    assert read("ops.reconcile_results").count() == 6 + 4
    assert read("ops.load_control").count() == 12

    # A repetition, after a crash or not, leaves every log as it is.
    logs = ("load_control", "table_lineage", "agent_events")
    once = [read(f"ops.{t}").count() for t in logs]
    run_medallion(spark, src, root, RUN, "2024-01-02", **arguments)
    assert [read(f"ops.{t}").count() for t in logs] == once and min(once) > 0

    # Injected drift turns the gate red.
    drifted = tableops.perturb(
        read("ops.fixture_expectations"), F.col("fixture_name") == "fact_sale_count", 10**9
    )
    from tidemark.operators import gate, quality

    counted = quality.table_row_counts({"m_bronze.fact_sale": read("bronze.fact_sale")})
    results = quality.evaluate_expectations(
        drifted.filter("fixture_name = 'fact_sale_count'"), counted, RUN, "2024-01-03"
    )
    assert results.first()["result"] == "fail"
    assert gate.verdict(results.filter("result = 'fail'"), RUN).first()["gate"] == "fail"


def test_medallion_stops_on_colliding_names(spark, source):
    src, catalog = source
    clash = catalog.unionByName(
        spark.createDataFrame([("Dimension", "stock-item", "BASE TABLE")], catalog.schema)
    )
    with pytest.raises(RuntimeError, match="1 landing names collide"):
        run_medallion(
            spark, src, tempfile.mkdtemp(prefix="spark-"), RUN, "2024-01-01", catalog=clash, prefix="c_"
        )
    assert rows(spark.table("c_ops.landing_collisions")) == [("dim_stock_item", 2)]


def test_many_tables_need_a_confirmation(spark, source):
    src, catalog = source
    many = catalog.unionByName(
        spark.range(201).selectExpr("'dbo' AS table_schema", "concat('t', id) AS table_name", "'BASE TABLE' AS table_type")
    )
    with pytest.raises(RuntimeError, match="confirm"):
        run_medallion(
            spark, src, tempfile.mkdtemp(prefix="spark-"), RUN, "2024-01-01", catalog=many, prefix="d_"
        )


@pytest.fixture
def warehouse(spark, request):
    prefix = f"w{abs(hash(request.node.name)) % 10000}_"
    root = tempfile.mkdtemp(prefix="spark-")
    run = inc.Incremental(spark, root, "2024-02-01", prefix)
    run.prepare()
    ntz = "timestamp_ntz"
    eot = D(9999, 12, 31, 23, 59, 59, 999999)
    start = D(2020, 1, 1)
    run.publish(
        "dimension.city",
        spark.createDataFrame(
            [(1, 100, "Oslo", start, eot, 0)],
            f"`City Key` int, `WWI City ID` int, City string, `Valid From` {ntz}, `Valid To` {ntz}, `Lineage Key` int",
        ),
    )
    run.publish(
        "dimension.customer",
        spark.createDataFrame(
            [(1, 7, "a", start, eot, 0), (2, 8, "b", start, eot, 0)],
            f"`Customer Key` int, `WWI Customer ID` int, Customer string, `Valid From` {ntz}, `Valid To` {ntz}, `Lineage Key` int",
        ),
    )
    run.publish(
        "dimension.stock_item",
        spark.createDataFrame(
            [(1, 50, "cup", start, eot, 0)],
            f"`Stock Item Key` int, `WWI Stock Item ID` int, `Stock Item` string, `Valid From` {ntz}, `Valid To` {ntz}, `Lineage Key` int",
        ),
    )
    run.publish(
        "dimension.employee",
        spark.createDataFrame(
            [(9, 3, start, eot)],
            f"`Employee Key` int, `WWI Employee ID` int, `Valid From` {ntz}, `Valid To` {ntz}",
        ),
    )
    sale = (
        "`Sale Key` bigint, `City Key` int, `Customer Key` int, `Bill To Customer Key` int, `Stock Item Key` int, "
        "`Salesperson Key` int, `WWI Invoice ID` int, Quantity int, `Lineage Key` int, `Invoice Date Key` date"
    )
    old = [
        (1, 1, 1, 1, 1, 9, 1000, 5, 0, D(2024, 1, 1).date()),
        (2, 1, 1, 1, 1, 9, 1000, 6, 0, D(2024, 1, 1).date()),
        (3, 1, 2, 2, 1, 9, 1001, 7, 0, D(2024, 1, 1).date()),
        (4, 1, 2, 2, 1, 9, 1002, 8, 0, D(2024, 1, 2).date()),
    ]
    sinks.refresh_partitions(
        spark.createDataFrame(old, sale), f"{prefix}fact.sale", root, "Invoice Date Key", []
    )
    run.publish(
        "fact.stock_holding",
        spark.createDataFrame([(1, 10, 0)], "`Stock Item Key` int, `Quantity On Hand` int, `Lineage Key` int"),
    )
    names = ["City", "Customer", "Stock Item", "Sale", "Stock Holding"]
    run.publish("integration.etl_cutoff", spark.createDataFrame([(n, start) for n in names], schemas.CUTOFFS))
    return run


def staged(spark):
    ntz = "timestamp_ntz"
    eot = D(9999, 12, 31, 23, 59, 59, 999999)
    return {
        "Customer": spark.createDataFrame(
            [(7, "a2", D(2024, 1, 10), eot), (9, "c", D(2024, 1, 5), eot)],
            f"`WWI Customer ID` int, Customer string, `Valid From` {ntz}, `Valid To` {ntz}",
        ),
        "Sale": spark.createDataFrame(
            [
                (100, 7, 7, 50, 3, 1000, 55, D(2024, 1, 3).date(), D(2024, 1, 11)),
                (100, 9, 8, 51, 4, 2000, 66, D(2024, 1, 4).date(), D(2024, 1, 9)),
            ],
            f"`WWI City ID` int, `WWI Customer ID` int, `WWI Bill To Customer ID` int, `WWI Stock Item ID` int, "
            f"`WWI Salesperson ID` int, `WWI Invoice ID` int, Quantity int, `Invoice Date Key` date, `Last Modified When` {ntz}",
        ),
        "Stock Holding": spark.createDataFrame(
            [(50, 70), (51, 71)], "`WWI Stock Item ID` int, `Quantity On Hand` int"
        ),
    }


def go(run, stage):
    inc.run_incremental(
        run.spark, stage, run.root, "2024-01-31", "2024-02-01", run.prefix
    )


def test_incremental(spark, warehouse):
    go(warehouse, staged(spark))
    customer = warehouse.read("dimension.customer")
    assert rows(customer, "Customer Key", "WWI Customer ID", "Valid To", "Lineage Key") == sorted(
        [
            (1, 7, D(2024, 1, 10), 0),
            (2, 8, D(9999, 12, 31, 23, 59, 59, 999999), 0),
            (3, 7, D(9999, 12, 31, 23, 59, 59, 999999), 1),
            (4, 9, D(9999, 12, 31, 23, 59, 59, 999999), 1),
        ],
        key=repr,
    )
    sale = warehouse.read("fact.sale")
    columns = ["WWI Invoice ID", "Customer Key", "Bill To Customer Key", "Stock Item Key", "Salesperson Key", "Quantity"]
    assert rows(sale, *columns) == [
        (1000, 3, 3, 1, 9, 55),
        (1001, 2, 2, 1, 9, 7),
        (1002, 2, 2, 1, 9, 8),
        (2000, 4, 2, 0, 0, 66),
    ]
    assert sale.select("Sale Key").distinct().count() == 4
    # Invoice 1000 moved from one date to another; the untouched date keeps its files.
    assert rows(sale.filter("`Invoice Date Key` = date '2024-01-01'"), "WWI Invoice ID") == [(1001,)]
    assert rows(warehouse.read("fact.stock_holding"), "Stock Item Key", "Quantity On Hand") == [(0, 71), (1, 70)]
    lineage = warehouse.read("integration.lineage")
    assert lineage.filter("`Was Successful`").count() == 3
    cutoffs = dict(rows(warehouse.read("integration.etl_cutoff")))
    assert cutoffs["Sale"] == D(2024, 1, 31) and cutoffs["City"] == D(2020, 1, 1)


def test_replay_after_a_crash(spark, warehouse):
    """The dimension was published but the load not closed: the replay must not append twice."""
    stage = staged(spark)
    crash = inc.Incremental(spark, warehouse.root, "2024-02-01", warehouse.prefix)
    crash.finish = lambda key: (_ for _ in ()).throw(RuntimeError("lost"))
    with pytest.raises(RuntimeError, match="lost"):
        crash.dimension(inc.CUSTOMER, stage["Customer"], "2024-01-31")
    assert warehouse.read("dimension.customer").count() == 4
    go(warehouse, stage)
    assert warehouse.read("dimension.customer").count() == 4
    with pytest.raises(RuntimeError, match="lost"):
        crash.sale(stage["Sale"], "2024-01-31")
    go(warehouse, {"Sale": stage["Sale"]})
    assert warehouse.read("fact.sale").count() == 4


def test_resume_with_another_cutoff(spark, warehouse):
    """Before the data: the open load takes the new cutoff. After it: an error, and no doubled version."""
    stage = staged(spark)
    crash = inc.Incremental(spark, warehouse.root, "2024-02-01", warehouse.prefix)
    crash.begin("Customer", "2024-01-20")
    crash.begin("Customer", "2024-01-31")
    lineage = warehouse.read("integration.lineage")
    assert rows(lineage, "Source System Cutoff Time") == [(D(2024, 1, 31),)]
    crash.finish = lambda key: (_ for _ in ()).throw(RuntimeError("lost"))
    with pytest.raises(RuntimeError, match="lost"):
        crash.dimension(inc.CUSTOMER, stage["Customer"], "2024-01-31")
    again = inc.Incremental(spark, warehouse.root, "2024-02-01", warehouse.prefix)
    with pytest.raises(RuntimeError, match="its own cutoff"):
        again.dimension(inc.CUSTOMER, stage["Customer"], "2024-02-28")
    again.dimension(inc.CUSTOMER, stage["Customer"], "2024-01-31")
    assert warehouse.read("dimension.customer").count() == 4
    assert dict(rows(warehouse.read("integration.etl_cutoff")))["Customer"] == D(2024, 1, 31)


def test_changes_drive_the_run(spark, warehouse):
    source = staged(spark)["Customer"].withColumn("changed", F.col("Valid From"))
    arguments = (warehouse.root,)
    inc.run_changes(spark, {"Customer": (source, "changed")}, *arguments, "2024-01-07", "2024-02-01", warehouse.prefix)
    assert warehouse.read("dimension.customer").count() == 3
    inc.run_changes(spark, {"Customer": (source, "changed")}, *arguments, "2024-01-31", "2024-02-02", warehouse.prefix)
    assert warehouse.read("dimension.customer").count() == 4
    assert dict(rows(warehouse.read("integration.etl_cutoff")))["Customer"] == D(2024, 1, 31)


def test_partition_values_are_kept(spark, folder):
    sinks.create_layers(spark, folder, ("z",), "p_")
    values = ["007", "7", "a/b", "x=1", "it's", "50%", None]
    df = spark.createDataFrame(list(enumerate(values)), "n int, d string")
    table = sinks.refresh_partitions(df, "p_z.t", folder, "d", [])
    assert rows(table) == sorted(enumerate(values), key=repr)
    wider = df.filter("n < 2 OR d IS NULL").select(F.lit("new").alias("extra"), F.col("n") + 10, "d")
    wider = wider.select(F.col("(n + 10)").alias("n"), "d", "extra")
    after = sinks.refresh_partitions(wider, "p_z.t", folder, "d", ["007", "7", "a/b", None])
    kept = [(i, None, v) for i, v in enumerate(values) if v in ("x=1", "it's", "50%")]
    assert rows(after, "n", "extra", "d") == sorted(kept + [(10, "new", "007"), (11, "new", "7"), (16, "new", None)], key=repr)
    with pytest.raises(ValueError, match="columns changed"):
        sinks.refresh_partitions(df.withColumn("n", F.col("n").cast("string")), "p_z.t", folder, "d", [])


def test_changed_columns_take_over_the_name(spark, folder):
    sinks.create_layers(spark, folder, ("u",), "p_")
    sinks.refresh(spark.range(3), "p_u.t", folder)
    other = sinks.refresh(spark.range(2).selectExpr("cast(id AS string) AS name"), "p_u.t", folder)
    assert rows(other) == [("0",), ("1",)] and spark.table("p_u.t").columns == ["name"]
    listed = spark.sql("SHOW TABLES IN p_u").filter("NOT isTemporary").collect()
    assert [r["tableName"] for r in listed] == ["t"]


def test_unknown_load_is_an_error(spark, warehouse):
    with pytest.raises(LookupError):
        warehouse.begin("Nope", "2024-01-01")


def test_partition_without_rows_is_dropped(spark, folder):
    sinks.create_layers(spark, folder, ("x",), "p_")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "n int, d string")
    table = sinks.refresh_partitions(df, "p_x.t", folder, "d", [])
    after = sinks.refresh_partitions(df.filter("n = 2").withColumn("n", F.lit(5)), "p_x.t", folder, "d", ["a", "b"])
    assert rows(table) == rows(after) == [(5, "b")]


def test_refresh_may_read_the_table_it_replaces(spark, folder):
    sinks.create_layers(spark, folder, ("y",), "p_")
    sinks.refresh(spark.range(3), "p_y.t", folder)
    again = sinks.refresh(spark.table("p_y.t").withColumn("id", F.col("id") + 1), "p_y.t", folder)
    assert rows(again) == [(1,), (2,), (3,)]
    wider = sinks.refresh(again.withColumn("extra", F.lit("x")), "p_y.t", folder)
    assert wider.columns == ["id", "extra"] and wider.count() == 3
    sinks.append(wider, "p_y.t", folder)
    assert spark.table("p_y.t").count() == 6


def test_bucketed_fact_is_not_shuffled_by_the_upsert(spark):
    fact = spark.range(100).select(F.col("id").alias("invoice"), F.lit(1).alias("qty"))
    sinks.bucketed_copy(fact, "default.bucketed_fact", "invoice", 8)
    stage = spark.range(5).select(F.col("id").alias("invoice"), F.lit(2).alias("qty"))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = tableops.replace_by_key(spark.table("default.bucketed_fact"), stage, "invoice")
        assert out.agg(F.sum("qty")).first()[0] == 95 + 10
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1  # the staged keys only
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_event_log_layout(spark, folder):
    df = spark.range(1000).select(
        F.lit("r").alias("run_id"), F.col("id").cast("timestamp").cast("timestamp_ntz").alias("ts")
    )
    sinks.write_events(df, f"{folder}/log")
    assert spark.read.parquet(f"{folder}/log").count() == 1000


def test_append_missing(spark, folder):
    sinks.create_layers(spark, folder, ("am",), "p_")
    first = spark.createDataFrame([("r", "a", None), ("r", "b", 1)], "run string, k string, v int")
    within = F.col("run") == "r"
    for df in (first, first, first.unionByName(spark.createDataFrame([("r", "c", 2)], first.schema))):
        sinks.append_missing(df, "p_am.t", folder, ("run", "k", "v"), within)
    sinks.append_missing(first.withColumn("run", F.lit("s")), "p_am.t", folder, ("run", "k", "v"), F.col("run") == "s")
    assert rows(spark.table("p_am.t"), "run", "k") == [("r", "a"), ("r", "b"), ("r", "c"), ("s", "a"), ("s", "b")]
