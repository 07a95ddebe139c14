"""The registered queries: one per operator, over the bronze-shaped views."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions.naming import batch_id
from tidemark.functions.text import with_ci
from tidemark.operators import (
    backlog as bl,
    conform,
    counts,
    gate,
    landing,
    loads,
    lookups,
    marts,
    metrics,
    quality,
    records,
    reports,
    scd,
    segments,
    tableops,
    timeline,
)
from tidemark.sources import discovery
from tidemark.session import narrow_tasks
from tidemark.sources.external import extract_changes
from tidemark.workload.views import AS_OF, BATCH_START, LOADED_AT, Views, to_double, ts

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

CUSTOMER_VERSIONS = lookups.Versions("WWI Customer ID", "Customer Key")
LOOKUPS = (
    # staged business id, key to fill, dimension, its versions
    ("WWI City ID", "City Key", "city", lookups.Versions("WWI City ID", "City Key")),
    ("WWI Customer ID", "Customer Key", "customer_versions", CUSTOMER_VERSIONS),
    ("WWI Bill To Customer ID", "Bill To Customer Key", "customer_versions", CUSTOMER_VERSIONS),
    (
        "WWI Stock Item ID",
        "Stock Item Key",
        "stock_item",
        lookups.Versions("WWI Stock Item ID", "Stock Item Key"),
    ),
    (
        "WWI Salesperson ID",
        "Salesperson Key",
        "employee",
        lookups.Versions("WWI Employee ID", "Employee Key"),
    ),
)
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def query(build: Callable[[Views], DataFrame]) -> Callable[[Views], DataFrame]:
    QUERIES[build.__name__] = lambda spark, folder: build(Views(narrow_tasks(spark), folder))
    return build


def silver_fact(v: Views) -> DataFrame:
    return conform.fact_sale(
        v.sale,
        conform.dim_customer_scd2(v.customer, LOADED_AT),
        conform.dim_stock_item(v.stock_item),
    )


def daily_sales(v: Views) -> DataFrame:
    return marts.mart_daily_sales(
        silver_fact(v), conform.dim_date(v.date), conform.dim_stock_item(v.stock_item)
    )


def current_customers(v: Views) -> DataFrame:
    return marts.mart_customer_current(
        conform.dim_customer_scd2(v.customer, LOADED_AT), conform.dim_city(v.city)
    )


# Landing.


@query
def landing_names(v: Views) -> DataFrame:
    return landing.with_landing_names(v.inventory.select("source_schema", "source_name"))


@query
def discovered_tables(v: Views) -> DataFrame:
    return discovery.discover_tables(v.catalog).drop("skip_reason")


@query
def federation_smoke(v: Views) -> DataFrame:
    """Base tables of the source and whether the managed schemas exist."""
    names = v.table("nation").select(
        F.element_at(
            F.array(*(F.lit(n) for n in ("BRONZE", "silver", "gold", "ops", "source_fed", "extra"))),
            F.col("n_nationkey") % 6 + 1,
        ).alias("schema_name")
    )
    return discovery.source_smoke(v.catalog, names)


@query
def landing_collisions(v: Views) -> DataFrame:
    shorter = F.regexp_extract("source_name", r"^[^.]*", 0)
    return landing.landing_collisions(
        landing.with_landing_names(v.inventory.withColumn("source_name", shorter))
    )


@query
def bronze_land(v: Views) -> DataFrame:
    landed = landing.land(
        v.table("orders"),
        landing.SOURCE_SYSTEM["sqlserver"],
        batch_id(LOADED_AT),
        LOADED_AT,
    )
    return landed


@query
def load_control(v: Views) -> DataFrame:
    return landing.load_control_rows(
        {t: v.table(t) for t in TABLES}, batch_id(LOADED_AT), LOADED_AT, LOADED_AT
    )


@query
def extracted_changes(v: Views) -> DataFrame:
    return extract_changes(v.table("orders"), "o_orderdate", "1999-12-31", AS_OF)


# Silver.


@query
def dim_city(v: Views) -> DataFrame:
    return conform.dim_city(v.city)


@query
def dim_stock_item(v: Views) -> DataFrame:
    return conform.dim_stock_item(v.stock_item)


@query
def dim_date(v: Views) -> DataFrame:
    return conform.dim_date(v.date)


@query
def undated_customers(v: Views) -> DataFrame:
    """Customer versions without a start, which are neither admitted nor in quarantine."""
    lost = F.col("Buying Group") == "5-LOW"
    dated = v.customer.withColumn("Valid From", F.when(~lost, F.col("Valid From")))
    return conform.undated(dated, "Valid From").select(
        F.col("Customer Key").alias("customer_key"), F.col("WWI Customer ID").alias("customer_id")
    )


@query
def dim_customer_scd2(v: Views) -> DataFrame:
    return conform.dim_customer_scd2(v.customer, AS_OF)


@query
def customer_quarantine(v: Views) -> DataFrame:
    return conform.split_future(v.customer, "Valid From", AS_OF)[1]


@query
def city_ci_counts(v: Views) -> DataFrame:
    """Customers per case-insensitive customer category name; upper and lower case meet."""
    mixed = v.table("customer").select(
        F.when(F.col("c_acctbal") > 0, F.lower("c_mktsegment"))
        .otherwise(F.col("c_mktsegment"))
        .alias("customer_name")
    )
    grouped = with_ci(mixed, ["customer_name"]).groupBy("customer_name").agg(
        F.count("*").alias("customers")
    )
    plain = F.collate(F.col("customer_name"), "UTF8_BINARY")
    return grouped.select(F.lower(plain).alias("customer_name"), "customers")


@query
def fact_sale(v: Views) -> DataFrame:
    return to_double(silver_fact(v), "unit_price", "total_including_tax", "profit")


@query
def fact_sale_orphan(v: Views) -> DataFrame:
    return conform.fact_orphans(
        v.sale,
        conform.dim_customer_scd2(v.some_customer, LOADED_AT),
        conform.dim_stock_item(v.small_stock_item),
    )


# Gold.


@query
def mart_daily_sales(v: Views) -> DataFrame:
    return to_double(daily_sales(v), "gross_revenue", "profit")


@query
def mart_stock_movements(v: Views) -> DataFrame:
    return marts.mart_stock_movements(conform.dim_stock_item(v.stock_item), v.stock_holding)


@query
def mart_customer_current(v: Views) -> DataFrame:
    return current_customers(v)


@query
def mart_city_dimension(v: Views) -> DataFrame:
    return marts.mart_city_dimension(conform.dim_city(v.city))


@query
def mart_stock_holding(v: Views) -> DataFrame:
    return to_double(marts.mart_stock_holding(v.stock_holding, AS_OF), "last_cost_price")


@query
def metric_by_date(v: Views) -> DataFrame:
    view = metrics.daily_sales_metrics(silver_fact(v))
    out = view.query(["Invoice Date"], ["Transaction Count", "Quantity Sold", "Gross Revenue", "Profit"])
    return to_double(out, "Gross Revenue", "Profit").toDF(
        "invoice_date", "transaction_count", "quantity_sold", "gross_revenue", "profit"
    )


@query
def metric_by_customer(v: Views) -> DataFrame:
    view = metrics.daily_sales_metrics(silver_fact(v))
    out = view.query(["Customer Key", "Stock Item Key"], ["Transaction Count", "Quantity Sold"])
    return out.toDF("customer_key", "stock_item_key", "transaction_count", "quantity_sold")


@query
def metric_total(v: Views) -> DataFrame:
    view = metrics.daily_sales_metrics(silver_fact(v))
    out = view.query([], ["Transaction Count", "Quantity Sold", "Gross Revenue"])
    return to_double(out, "Gross Revenue").toDF(
        "transaction_count", "quantity_sold", "gross_revenue"
    )


@query
def top_items(v: Views) -> DataFrame:
    return to_double(marts.top_items(daily_sales(v), 10), "gross_revenue", "profit")


@query
def customers_by_country(v: Views) -> DataFrame:
    return marts.customers_by_country(current_customers(v))


@query
def fact_sample(v: Views) -> DataFrame:
    return marts.sample_fact(v.sale.select("Sale Key", "Quantity"), "Sale Key", 1000).toDF(
        "sale_key", "quantity"
    )


# Versioned dimensions and incremental loads.


@query
def asof_keys(v: Views) -> DataFrame:
    # The key's text is made of four numbers, two of them ids that are resolved here, so it is put together at the end.
    out, ready = v.sale_stage_parts, {}
    for business_key, key, dim, versions in LOOKUPS:
        if dim not in ready:
            ready[dim] = lookups.prepare_versions(getattr(v, dim), versions)
        out = lookups.lookup_prepared(out, ready[dim], business_key, "Last Modified When", key)
    return out.select(v.sale_key(), *(key for _, key, _, _ in LOOKUPS)).toDF(
        "sale_key",
        "city_key",
        "customer_key",
        "bill_to_customer_key",
        "stock_item_key",
        "salesperson_key",
    )


@query
def asof_keys_sliced(v: Views) -> DataFrame:
    """The customer lookup on a timeline over range partitions, as used for long histories."""
    return timeline.lookup_key_merged(
        v.sale_stage,
        v.customer_versions,
        CUSTOMER_VERSIONS,
        "WWI Customer ID",
        "Last Modified When",
        "Customer Key",
    ).select(F.col("Sale Key").alias("sale_key"), F.col("Customer Key").alias("customer_key"))


@query
def latest_keys(v: Views) -> DataFrame:
    stage = v.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return lookups.lookup_key_latest(
        stage, v.customer_versions, CUSTOMER_VERSIONS, "l_partkey", "customer_key"
    )


def _batches(v: Views) -> tuple[DataFrame, DataFrame]:
    orders = v.table("orders")
    return (
        orders.filter(F.col("o_orderdate") < ts(BATCH_START)),
        orders.filter(F.col("o_orderdate") >= ts(BATCH_START)),
    )


@query
def scd2_apply(v: Views) -> DataFrame:
    before, staged = _batches(v)
    dim = v.versions_of(before).withColumn("Lineage Key", F.lit(1).cast("bigint"))
    stage = v.versions_of(staged).drop("Customer Key")
    return scd.scd2_apply(dim, stage, "WWI Customer ID", 2).toDF(
        "customer_key", "customer_id", "buying_group", "valid_from", "valid_to", "lineage_key"
    )


@query
def dimension_segments(v: Views) -> DataFrame:
    """What a batch writes into a dimension stored by segments, per segment."""
    before, staged = _batches(v)
    dim = segments.with_segment(v.versions_of(before).withColumn("Lineage Key", F.lit(1).cast("bigint")))
    stage = v.versions_of(staged).drop("Customer Key")
    added = scd.staged_rows(dim.drop(segments.SEGMENT), stage, 2)
    rows = segments.batch_rows(dim, stage, added, "WWI Customer ID")
    return segments.touched_segments(rows).toDF("segment", "rows")


@query
def reaching_versions(v: Views) -> DataFrame:
    """Versions that a reader as of the batch's start may meet, by partitions alone."""
    dim = segments.with_segment(v.versions_of(v.table("orders")))
    return segments.reaching(dim, BATCH_START).select(
        F.col("WWI Customer ID").alias("customer_id"), F.col("Valid From").alias("valid_from"),
        F.col("Valid To").alias("valid_to"), F.col(segments.SEGMENT).alias("segment"),
    )


@query
def assigned_keys(v: Views) -> DataFrame:
    rows = v.table("orders").select("o_orderkey", "o_orderdate")
    return scd.assign_keys(rows, "order_seq", ["o_orderdate", "o_orderkey"], 1)


@query
def fact_upsert(v: Views) -> DataFrame:
    columns = ["Sale Key", "WWI Invoice ID", "Quantity", "Package", "Lineage Key"]
    resent = (
        v.sale.filter(
            (F.col("Invoice Date Key") >= F.lit(BATCH_START).cast("date")) & (F.col("Package") != "R")
        )
        .withColumns({"Quantity": F.col("Quantity") + 1, "Lineage Key": F.lit(2).cast("bigint")})
        .select(columns)
    )
    return tableops.replace_by_key(v.sale.select(columns), resent, "WWI Invoice ID").toDF(
        "sale_key", "invoice_id", "quantity", "package", "lineage_key"
    )


@query
def touched_partitions(v: Views) -> DataFrame:
    columns = ["WWI Invoice ID", "Invoice Date Key"]
    resent = v.sale.filter(F.col("Invoice Date Key") >= F.lit(BATCH_START).cast("date"))
    return tableops.touched_partitions(
        v.sale.select(columns), resent.select(columns), "WWI Invoice ID", "Invoice Date Key"
    ).toDF("invoice_date_key")


@query
def snapshot_replace(v: Views) -> DataFrame:
    stage = lookups.lookup_key_latest(
        v.stock_holding.drop("Stock Item Key"),
        v.small_stock_item,
        lookups.Versions("WWI Stock Item ID", "Stock Item Key"),
        "WWI Stock Item ID",
        "Stock Item Key",
    )
    columns = ["Stock Item Key", "Quantity On Hand", "Bin Location", "Target Stock Level"]
    fact = v.stock_holding.select(*columns, F.lit(1).cast("bigint").alias("Lineage Key"))
    return tableops.snapshot_replace(fact, stage, 2).toDF(
        "stock_item_key", "quantity_on_hand", "bin_location", "target_stock_level", "lineage_key"
    )


def _opened(v: Views) -> DataFrame:
    return loads.open_load(v.loads, "Customer 7", AS_OF, LOADED_AT)


@query
def lineage_open_close(v: Views) -> DataFrame:
    opened = _opened(v)
    key = loads.open_key(opened, "Customer 7").scalar()
    return loads.complete_load(opened, key, LOADED_AT).toDF(
        "lineage_key", "started", "table_name", "completed", "was_successful", "cutoff_time"
    )


@query
def etl_cutoffs(v: Views) -> DataFrame:
    opened = _opened(v)
    key = loads.open_key(opened, "Customer 7").scalar()
    return loads.advance_cutoff(v.cutoffs, opened, key).toDF("table_name", "cutoff_time")


@query
def changes_since_cutoff(v: Views) -> DataFrame:
    """What the next load reads: from the stored cutoff of its table to now."""
    opened = _opened(v)
    key = loads.open_key(opened, "Customer 7").scalar()
    last = loads.get_cutoff(loads.advance_cutoff(v.cutoffs, opened, key), "Customer 7")
    return extract_changes(v.table("orders"), "o_orderdate", last, LOADED_AT)


@query
def replace_run(v: Views) -> DataFrame:
    rechecked = (
        v.reconcile.filter((F.col("run_id") == "run-1") & F.col("check_id").startswith("fixture_"))
        .withColumns(
            {"actual": F.col("expected"), "delta": F.lit("0"), "result": F.lit("pass")}
        )
    )
    return tableops.replace_run(v.reconcile, rechecked, "run-1", "fixture_")


@query
def upsert(v: Views) -> DataFrame:
    target = v.table("orders").select(
        F.concat(F.lit("Load.Order"), "o_orderkey").alias("legacy_proc"),
        F.col("o_orderpriority").alias("target_path"),
        F.lit("draft").alias("status"),
        F.col("o_orderdate").alias("updated_at"),
    )
    source = v.table("lineitem").select(
        F.concat(F.lit("Load.Order"), "l_orderkey").alias("legacy_proc"),
        F.concat(F.lit("jobs/gold/"), "l_suppkey", F.lit(".sql")).alias("target_path"),
        F.when(F.col("l_linestatus") == "O", "final").otherwise("review").alias("status"),
        F.col("l_shipdate").alias("updated_at"),
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
    )
    order = [F.col(c) for c in ("updated_at", "l_linenumber", "l_partkey", "l_suppkey")]
    return tableops.upsert(target, source, ["legacy_proc"], order)


@query
def perturbed_expectations(v: Views) -> DataFrame:
    return tableops.perturb(v.expectations, F.col("fixture_name").startswith("SMALL"), 1000000).drop(
        "staged_at"
    )


@query
def restored_expectations(v: Views) -> DataFrame:
    named = F.col("fixture_name").startswith("SMALL")
    saved = tableops.snapshot_expectations(v.expectations, named)
    drifted = tableops.perturb(v.expectations, named, 1000000)
    return tableops.restore(drifted, saved).drop("staged_at")


@query
def run_events(v: Views) -> DataFrame:
    return tableops.run_events(v.runs, LOADED_AT)


# Reports.


@query
def inventory_counts(v: Views) -> DataFrame:
    return reports.inventory_counts(v.inventory)


@query
def inventory_thresholds(v: Views) -> DataFrame:
    return reports.thresholds(v.inventory)


@query
def reconcile_status(v: Views) -> DataFrame:
    return reports.reconcile_status(v.reconcile)


@query
def reconcile_summary(v: Views) -> DataFrame:
    return quality.reconcile_summary(v.reconcile, "run-1")


@query
def failed_checks(v: Views) -> DataFrame:
    return reports.failed_checks(v.reconcile, 20)


@query
def list_checks(v: Views) -> DataFrame:
    return reports.list_checks(v.reconcile, "run-1")


@query
def backlog_status(v: Views) -> DataFrame:
    return reports.backlog_status(v.backlog)


@query
def event_summary(v: Views) -> DataFrame:
    return reports.event_summary(v.events)


@query
def events_by_agent(v: Views) -> DataFrame:
    return reports.events_by_agent(v.events)


@query
def events_over_time(v: Views) -> DataFrame:
    now = v.events.agg(F.max("ts")).scalar()
    return reports.events_over_time(v.events, now)


@query
def latest_events(v: Views) -> DataFrame:
    return reports.latest_events(v.events, 100)


@query
def run_timeline(v: Views) -> DataFrame:
    return reports.timeline(v.events, "8")


@query
def lineage(v: Views) -> DataFrame:
    return reports.lineage(v.edges, "wh.", 50)


# Backlog, records and the verdict.


def _merged(v: Views) -> DataFrame:
    checked = records.validate_records(v.filed_texts, records.CONVERT_RESULT)
    results = checked.select("record_id", "parsed.*", "violations")
    return bl.merge_results(v.backlog, results, v.targets)


@query
def merged_results(v: Views) -> DataFrame:
    return _merged(v)


@query
def convert_summary(v: Views) -> DataFrame:
    return bl.convert_summary(_merged(v))


@query
def merged_backlog(v: Views) -> DataFrame:
    return bl.apply_merge(v.backlog, _merged(v))


@query
def conversion_map(v: Views) -> DataFrame:
    """The map keyed by target path, which many items share: the last of them in the backlog wins."""
    found = bl.conversion_map_rows(_merged(v), ts(LOADED_AT)).withColumn("legacy_proc", F.col("target_path"))
    return tableops.upsert(
        v.conversion_map, found, ["legacy_proc"], [F.col(c) for c in bl.MAP_ORDER]
    ).drop("updated_at")


@query
def backlog_violations(v: Views) -> DataFrame:
    return bl.check_backlog(v.backlog)


@query
def unwired_targets(v: Views) -> DataFrame:
    return bl.unwired_targets(v.backlog, v.tasks)


@query
def record_violations(v: Views) -> DataFrame:
    return _violations(v.record_texts, records.CONVERT_RESULT)


def _violations(texts: DataFrame, contract: records.Contract) -> DataFrame:
    return records.broken_rules(texts, contract, "record_id").select("record_id", "violation")


@query
def backlog_item_violations(v: Views) -> DataFrame:
    return _violations(v.backlog_texts, records.BACKLOG_ITEM)


@query
def context_violations(v: Views) -> DataFrame:
    return _violations(v.context_texts, records.context_contract())


@query
def reconcile_report_violations(v: Views) -> DataFrame:
    return _violations(v.report_texts, records.RECONCILE_REPORT)


@query
def manifest_violations(v: Views) -> DataFrame:
    return _violations(v.manifest_texts, records.MANIFEST)


@query
def check_not_null(v: Views) -> DataFrame:
    orders = v.table("orders").select(
        "o_orderkey",
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("o_orderpriority"),
        F.nullif("o_orderstatus", F.lit("P")).alias("o_orderstatus"),
    )
    return quality.check_not_null(orders, "orders", orders.columns)


@query
def check_unique(v: Views) -> DataFrame:
    lines = v.table("lineitem").select("l_orderkey", "l_linenumber")
    return counts.union_all(
        [
            quality.check_unique(v.sale, "fact_sale", ["Sale Key"]),
            quality.check_unique(lines, "lineitem", lines.columns),
        ]
    )


@query
def check_fk(v: Views) -> DataFrame:
    fact = v.sale.select(
        F.col("Customer Key").alias("customer_key"), F.col("Stock Item Key").alias("stock_item_key")
    )
    customer = conform.dim_customer_scd2(v.some_customer, LOADED_AT)
    item = conform.dim_stock_item(v.small_stock_item)
    return counts.union_all(
        [
            quality.check_fk(fact, customer, "fact_sale", "customer_key", "customer_key"),
            quality.check_fk(fact, item, "fact_sale", "stock_item_key", "stock_item_key"),
        ]
    )


@query
def reconcile_counts(v: Views) -> DataFrame:
    pairs = {t: (v.table(t), v.table(t)) for t in TABLES}
    pairs["orders"] = (v.table("orders"), v.table("orders").filter("o_orderstatus <> 'P'"))
    pairs["lineitem"] = (v.table("lineitem"), v.table("lineitem").filter("l_tax > 0"))
    return quality.reconcile_counts(pairs, "run-1", LOADED_AT)


@query
def expectations(v: Views) -> DataFrame:
    return quality.evaluate_expectations(v.expectations, v.item_counts, "run-1", LOADED_AT)


@query
def source_smoke(v: Views) -> DataFrame:
    return counts.smoke("source_ok", **{t: v.table(t) for t in TABLES})


@query
def gate_blockers(v: Views) -> DataFrame:
    return gate.gate_blockers(
        v.gate_inventory,
        v.bronze_tables,
        v.gate_reconcile,
        v.gate_backlog,
        v.conversion_map,
        v.targets,
        v.gate_events,
        "run-1",
    )


@query
def gate_verdict(v: Views) -> DataFrame:
    return gate.verdict(gate_blockers(v), "run-1")


@query
def blocked_items(v: Views) -> DataFrame:
    return gate.blocked_items(v.backlog)


@query
def run_summary(v: Views) -> DataFrame:
    return gate.run_summary(
        v.inventory, v.bronze_tables, v.reconcile, v.backlog, v.gate_events, "run-1"
    )


@query
def gate_hero(v: Views) -> DataFrame:
    summary = gate.run_summary(
        v.gate_inventory, v.bronze_tables, v.gate_reconcile, v.gate_backlog, v.gate_events, "run-1"
    )
    return reports.gate_hero(gate.manifest_row(gate_verdict(v), summary, LOADED_AT))
