"""Bronze-shaped views and control tables derived from the benchmark tables.

Each view is built by Spark from whole tables, so the work of a registered query grows with them.
The same views are written once more in SQL in ``oracle.py``.
"""

from __future__ import annotations

from decimal import Decimal
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidemark.functions.naming import landing_name
from tidemark.functions.temporal import END_OF_TIME

AS_OF = "2001-01-01 00:00:00"
LOADED_AT = "2024-02-01 12:30:45"
BATCH_START = "2000-01-01 00:00:00"
EPOCH = "1990-01-01"

# The tables' schemas. Declared, so that opening a table starts no job to read file footers.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
}


def ts(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def money(column: str | Column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("decimal(18,2)")


def to_double(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(f"`{c}`").cast("double") for c in columns})


def customer_key(custkey: str, date: str) -> Column:
    day = F.date_diff(F.col(date).cast("date"), F.lit(EPOCH).cast("date"))
    return F.col(custkey) * 100000 + day


class Views:
    """Lazily built frames over one scale factor."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.folder}/{name}.parquet")

    # Bronze.

    @cached_property
    def city(self) -> DataFrame:
        people = (
            self.table("customer").groupBy("c_nationkey").agg(F.count("*").alias("population"))
        )
        nation = self.table("nation").join(
            self.table("region"), F.col("n_regionkey") == F.col("r_regionkey")
        )
        return nation.join(
            people, F.col("n_nationkey") == F.col("c_nationkey"), "left"
        ).select(
            F.col("n_nationkey").alias("City Key"),
            F.col("n_nationkey").alias("WWI City ID"),
            F.col("n_name").alias("City"),
            F.col("r_name").alias("State Province"),
            F.col("r_name").alias("Country"),
            F.coalesce("population", F.lit(0)).alias("Latest Recorded Population"),
            ts("1990-01-01").alias("Valid From"),
            ts(END_OF_TIME).alias("Valid To"),
        )

    @cached_property
    def stock_item(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").alias("Stock Item Key"),
            F.col("p_partkey").alias("WWI Stock Item ID"),
            F.col("p_name").alias("Stock Item"),
            F.col("p_brand").alias("Brand"),
            F.col("p_size").cast("string").alias("Size"),
            (F.col("p_size") % 15).alias("Lead Time Days"),
            ts("1990-01-01").alias("Valid From"),
            ts(END_OF_TIME).alias("Valid To"),
        )

    @cached_property
    def small_stock_item(self) -> DataFrame:
        """Stock items as far as they have been landed: the large ones are still missing."""
        return self.stock_item.filter(F.col("Size").cast("int") <= 45)

    def versions_of(self, orders: DataFrame) -> DataFrame:
        """One customer version per order day; at most one row per customer and calendar day."""
        days = orders.groupBy("o_custkey", "o_orderdate").agg(
            F.max_by("o_orderpriority", "o_orderkey").alias("Buying Group")
        )
        following = Window.partitionBy("o_custkey").orderBy("o_orderdate")
        # Renamed behind the window, so that the partitioning by customer is kept and no id is shuffled twice.
        return days.withColumn("until", F.lead("o_orderdate").over(following)).select(
            customer_key("o_custkey", "o_orderdate").alias("Customer Key"),
            F.col("o_custkey").alias("WWI Customer ID"),
            "Buying Group",
            F.col("o_orderdate").alias("Valid From"),
            F.coalesce("until", ts(END_OF_TIME)).alias("Valid To"),
        )

    @cached_property
    def customer_versions(self) -> DataFrame:
        return self.versions_of(self.table("orders"))

    @cached_property
    def customer(self) -> DataFrame:
        who = self.table("customer").select(
            F.col("c_custkey").alias("WWI Customer ID"),
            F.col("c_name").alias("Customer"),
            F.col("c_name").alias("Bill To Customer"),
            F.col("c_mktsegment").alias("Category"),
            F.col("c_nationkey").alias("City"),
        )
        return self.customer_versions.join(who, "WWI Customer ID").select(
            "Customer Key",
            "WWI Customer ID",
            "Customer",
            "Bill To Customer",
            "Category",
            "Buying Group",
            "City",
            "Valid From",
            "Valid To",
        )

    @cached_property
    def some_customer(self) -> DataFrame:
        """Customers as far as they have been landed: one segment is still missing."""
        return self.customer.filter(F.col("Category") != "BUILDING")

    @cached_property
    def date(self) -> DataFrame:
        span = self.table("orders").agg(
            F.min("o_orderdate").cast("date").alias("lo"), F.max("o_orderdate").cast("date").alias("hi")
        )
        day = F.col("Date")
        return span.select(F.explode(F.sequence("lo", "hi")).alias("Date")).select(
            day,
            F.dayofmonth(day).alias("Day Number"),
            F.date_format(day, "EEEE").alias("Day"),
            F.date_format(day, "MMMM").alias("Month"),
            F.year(day).alias("Calendar Year"),
            F.month(day).alias("Calendar Month Number"),
            F.quarter(day).alias("Calendar Quarter"),
        )

    @cached_property
    def sale(self) -> DataFrame:
        net = money("l_extendedprice") * (1 - F.col("l_discount").cast("decimal(4,2)"))
        lines = self.table("lineitem").join(
            self.table("orders"), F.col("l_orderkey") == F.col("o_orderkey")
        )
        return lines.select(
            self.sale_key("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"),
            customer_key("o_custkey", "o_orderdate").alias("Customer Key"),
            F.col("l_partkey").alias("Stock Item Key"),
            F.col("l_suppkey").alias("Salesperson Key"),
            F.col("o_orderdate").cast("date").alias("Invoice Date Key"),
            F.col("l_quantity").cast("bigint").alias("Quantity"),
            money("l_extendedprice").alias("Unit Price"),
            money(net * (1 + F.col("l_tax").cast("decimal(4,2)"))).alias("Total Including Tax"),
            money(net * F.lit(Decimal("0.25"))).alias("Profit"),
            F.col("l_orderkey").alias("WWI Invoice ID"),
            F.col("o_custkey").alias("WWI Customer ID"),
            F.col("l_partkey").alias("WWI Stock Item ID"),
            F.col("l_suppkey").alias("WWI Salesperson ID"),
            F.col("l_shipdate").alias("Last Modified When"),
            F.col("l_returnflag").alias("Package"),
            F.lit(1).cast("bigint").alias("Lineage Key"),
        )

    @cached_property
    def stock_holding(self) -> DataFrame:
        return self.table("lineitem").select(
            F.col("l_partkey").alias("Stock Item Key"),
            F.col("l_partkey").alias("WWI Stock Item ID"),
            F.col("l_quantity").cast("bigint").alias("Quantity On Hand"),
            (F.col("l_quantity").cast("bigint") * F.round(F.col("l_discount") * 100).cast("bigint"))
            .alias("Quantity Allocated"),
            F.concat_ws("-", "l_orderkey", "l_linenumber", "l_suppkey").alias("Bin Location"),
            F.col("l_linenumber").cast("bigint").alias("Last Stocktake Quantity"),
            money("l_extendedprice").alias("Last Cost Price"),
            F.col("l_suppkey").alias("Reorder Level"),
            (F.col("l_quantity").cast("bigint") * 2).alias("Target Stock Level"),
            F.col("l_shipdate").alias("Last Edited When"),
        )

    @cached_property
    def employee(self) -> DataFrame:
        rich = F.col("s_acctbal") >= 5000
        return self.table("supplier").select(
            (F.col("s_suppkey") + 1).alias("Employee Key"),
            F.col("s_suppkey").alias("WWI Employee ID"),
            ts("1996-06-01").alias("Valid From"),
            F.when(rich, ts(END_OF_TIME)).otherwise(ts("2000-01-01")).alias("Valid To"),
        )

    @staticmethod
    def sale_key(invoice: str = "WWI Invoice ID", line: str = "Line", item: str = "WWI Stock Item ID", seller: str = "WWI Salesperson ID") -> Column:
        """The key of a sale, as ``sale`` has it, from its parts."""
        return F.concat_ws("-", *(F.col(f"`{c}`") for c in (invoice, line, item, seller))).alias("Sale Key")

    @cached_property
    def sale_stage_parts(self) -> DataFrame:
        """Staged sales with the five business ids to resolve, their key in parts."""
        customer = self.table("customer").select("c_custkey", "c_nationkey")
        lines = self.table("lineitem").join(self.table("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        return lines.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
            F.col("l_orderkey").alias("WWI Invoice ID"),
            F.col("l_linenumber").alias("Line"),
            F.col("c_nationkey").alias("WWI City ID"),
            F.col("o_custkey").alias("WWI Customer ID"),
            F.col("l_partkey").alias("WWI Bill To Customer ID"),
            F.col("l_partkey").alias("WWI Stock Item ID"),
            F.col("l_suppkey").alias("WWI Salesperson ID"),
            F.col("l_shipdate").alias("Last Modified When"),
        )

    @cached_property
    def sale_stage(self) -> DataFrame:
        return self.sale_stage_parts.select(
            self.sale_key(),
            "WWI City ID",
            "WWI Customer ID",
            "WWI Bill To Customer ID",
            "WWI Stock Item ID",
            "WWI Salesperson ID",
            "Last Modified When",
        )

    # Control tables.

    @cached_property
    def inventory(self) -> DataFrame:
        kind = F.col("p_type")
        schema = (
            F.when(kind == "STANDARD", "Dimension").when(kind == "PROMO", "Fact").otherwise(F.col("p_brand"))
        )
        name = F.concat("p_name", F.lit("."), "p_brand", F.lit("- "), "p_partkey")
        skip = F.col("p_size") > 45
        return self.table("part").select(
            F.lit("run-1").alias("run_id"),
            F.when(kind == "ECONOMY", "proc").otherwise("table").alias("object_type"),
            schema.alias("source_schema"),
            name.alias("source_name"),
            F.when(kind != "ECONOMY", landing_name(schema, name)).alias("landing_name"),
            skip.alias("skip"),
            F.when(skip, "too large").alias("skip_reason"),
            ts(LOADED_AT).alias("discovered_at"),
            "p_retailprice",
        )

    @cached_property
    def bronze_tables(self) -> DataFrame:
        return self.inventory.filter("landing_name IS NOT NULL AND p_retailprice >= 950").select(
            F.col("landing_name").alias("table_name")
        )

    def _layer(self) -> Column:
        status = F.col("o_orderstatus")
        return F.when(status == "F", "silver").when(status == "O", "gold").otherwise("n/a")

    @cached_property
    def backlog(self) -> DataFrame:
        rank = F.substring("o_orderpriority", 1, 1)
        status = (
            F.when(rank == "1", "pending")
            .when(rank == "2", "in_progress")
            .when(rank == "3", "converted")
            .when(rank == "4", "blocked")
            .otherwise("done")
        )
        layer = self._layer()
        year = F.year("o_orderdate")
        path = (
            F.when(year == 1995, F.concat(F.lit("jobs/converted/mart_"), "o_custkey", F.lit(".sql")))
            .when(year == 1996, F.lit(""))
            .otherwise(
                F.concat(F.lit("jobs/"), layer, F.lit("/mart_"), "o_custkey", F.lit(".sql"))
            )
        )
        return self.table("orders").select(
            F.concat(F.lit("item-"), "o_orderkey").alias("item_id"),
            F.concat(F.lit("Load.Order"), "o_orderkey").alias("legacy_proc"),
            layer.alias("target_layer"),
            path.alias("target_path"),
            status.alias("status"),
        )

    @cached_property
    def record_texts(self) -> DataFrame:
        """Conversion records as JSON, one per order; some break the contract."""
        rank = F.substring("o_orderpriority", 1, 1)
        year = F.year("o_orderdate")
        status = (
            F.when(rank == "1", "final")
            .when(rank == "2", "review")
            .when(rank == "3", "draft")
            .when(rank == "4", "blocked")
            .otherwise("unknown")
        )
        folder = F.when(year == 1997, "bronze").otherwise(self._layer())
        item = F.concat(F.lit("item-"), "o_orderkey")
        return (
            self.table("orders")
            .select(
                "o_totalprice",
                item.alias("record_id"),
                F.to_json(
                    F.struct(
                        F.when(year == 1998, F.lit("item-x")).otherwise(item).alias("item_id"),
                        F.concat(F.lit("Load.Order"), "o_orderkey").alias("legacy_proc"),
                        F.concat(
                            F.lit("jobs/"), folder, F.lit("/mart_"), "o_custkey", F.lit(".sql")
                        ).alias("target_path"),
                        status.alias("status"),
                        F.when(year != 1999, F.lit("ok")).alias("notes"),
                        F.array(F.lit("snapshot")).alias("patterns_used"),
                        F.when(year == 2000, F.lit("x")).alias("extra"),
                    )
                ).alias("record"),
            )
        )

    @cached_property
    def filed_texts(self) -> DataFrame:
        """The records that have been filed; those of cheap orders are missing."""
        return self.record_texts.filter("o_totalprice >= 100000").drop("o_totalprice")

    @cached_property
    def targets(self) -> DataFrame:
        layers = F.explode(F.array(F.lit("silver"), F.lit("gold")))
        return self.table("customer").filter("c_acctbal >= 0").select("c_custkey", layers.alias("layer")).select(
            F.concat(F.lit("jobs/"), "layer", F.lit("/mart_"), "c_custkey", F.lit(".sql")).alias(
                "target_path"
            )
        )

    @cached_property
    def tasks(self) -> DataFrame:
        return self.table("customer").filter("c_mktsegment <> 'BUILDING'").select(
            F.concat(F.lit("../_rendered/gold/mart_"), "c_custkey", F.lit(".sql")).alias("path")
        )

    @cached_property
    def conversion_map(self) -> DataFrame:
        rank = F.substring("o_orderpriority", 1, 1)
        status = F.when(rank == "1", "final").when(rank == "2", "draft").otherwise("blocked")
        return self.table("orders").filter("o_totalprice >= 100000").select(
            F.concat(F.lit("Load.Order"), "o_orderkey").alias("legacy_proc"),
            F.concat(F.lit("jobs/gold/mart_"), "o_custkey", F.lit(".sql")).alias("target_path"),
            status.alias("status"),
            ts(LOADED_AT).alias("updated_at"),
        )

    @cached_property
    def reconcile(self) -> DataFrame:
        expected = F.count("*")
        actual = F.count_if(F.col("o_orderstatus") != "P")
        run = F.concat(F.lit("run-"), F.substring("o_orderpriority", 1, 1))
        kind = F.when(F.col("expected") >= 3, "bronze_vs_source:").otherwise("fixture_")
        return (
            self.table("orders")
            .groupBy("o_custkey", run.alias("run_id"))
            .agg(
                expected.alias("expected"),
                actual.alias("actual"),
                F.max("o_orderdate").alias("ts"),
            )
            .select(
                F.concat(kind, F.lit("customer_"), "o_custkey").alias("check_id"),
                F.concat(F.lit("bronze.customer_"), "o_custkey").alias("table_name"),
                F.col("expected").cast("string").alias("expected"),
                F.col("actual").cast("string").alias("actual"),
                (F.col("actual") - F.col("expected")).cast("string").alias("delta"),
                F.when(F.col("actual") == F.col("expected"), "pass").otherwise("fail").alias("result"),
                "run_id",
                "ts",
            )
        )

    @cached_property
    def expectations(self) -> DataFrame:
        size = F.col("p_size").cast("bigint")
        # Only gold tables are counted.
        layer = F.when(F.col("p_type") == "ECONOMY", "silver").otherwise("gold")
        return self.table("part").select(
            F.concat("p_type", F.lit("_"), "p_partkey").alias("fixture_name"),
            F.concat(layer, F.lit(".item_"), "p_partkey").alias("target_table"),
            F.lit("row_count").alias("metric"),
            F.when(F.col("p_type") != "SMALL", size).alias("expected"),
            F.when(F.col("p_brand") == "Brand#3", "gte")
            .otherwise("exact_when_expected_set")
            .alias("compare"),
            F.col("p_name").alias("notes"),
            ts(LOADED_AT).alias("staged_at"),
        )

    @cached_property
    def catalog(self) -> DataFrame:
        """A source catalog: parts as tables, the small ones as views, some in system schemas."""
        system = F.when(F.col("p_size") % 9 == 0, "SYS").when(F.col("p_size") % 9 == 1, "information_schema")
        return self.table("part").select(
            F.coalesce(system, F.col("p_brand")).alias("table_schema"),
            F.concat("p_name", F.lit(" "), "p_partkey").alias("table_name"),
            F.when(F.col("p_size") < 5, "VIEW").otherwise("BASE TABLE").alias("table_type"),
        )

    @cached_property
    def gate_reconcile(self) -> DataFrame:
        """Reconcile results that also hold a passing count of most landed tables."""
        compared = self.inventory.filter("landing_name IS NOT NULL AND p_retailprice >= 930").select(
            F.concat(F.lit("bronze_vs_source:"), "landing_name").alias("check_id"),
            F.concat(F.lit("bronze."), "landing_name").alias("table_name"),
            F.lit("1").alias("expected"),
            F.lit("1").alias("actual"),
            F.lit("0").alias("delta"),
            F.lit("pass").alias("result"),
            F.lit("run-1").alias("run_id"),
            ts(LOADED_AT).alias("ts"),
        )
        # Small customers' failures come without a result, or with one that no reader knows.
        known = F.when(F.col("result") == "pass", "pass").when(F.col("expected") != "1", "fail")
        unclear = F.coalesce(known, F.when(F.col("check_id").endswith("7"), "passed"))
        return self.reconcile.withColumn("result", unclear).unionByName(compared)

    @cached_property
    def gate_inventory(self) -> DataFrame:
        """The inventory with rows nobody decided about; they are not skipped."""
        decided = F.when(F.floor("p_retailprice") % 7 != 0, F.col("skip"))
        return self.inventory.withColumn("skip", decided)

    @cached_property
    def gate_backlog(self) -> DataFrame:
        """The backlog with unknown states and layers; what is unknown still owes a conversion."""
        number = F.regexp_extract("item_id", "[0-9]+", 0).cast("bigint")
        return self.backlog.withColumns(
            {
                "status": F.when(number % 11 != 0, F.col("status")),
                "target_layer": F.when(number % 13 != 0, F.col("target_layer")),
            }
        )

    @cached_property
    def backlog_texts(self) -> DataFrame:
        """Backlog items as JSON; some have unknown values, numbers for text, or lack a field."""
        urgent = F.substring("o_orderpriority", 1, 1)
        return self.table("orders").select(
            F.col("o_orderkey").alias("record_id"),
            F.concat(
                F.lit('{"item_id":"item-'), "o_orderkey", F.lit('","legacy_proc":'),
                F.when(F.col("o_orderkey") % 7 == 0, "5").otherwise('"p"'),
                F.lit(',"classification":"'), F.when(urgent == "5", "unsure").otherwise("migrate"),
                F.lit('","reads":"","writes":"","target_layer":"'), self._layer(),
                F.lit('","target_path":null,'),
                F.when(F.col("o_orderstatus") == "P", "").otherwise('"priority":"high",'),
                F.lit('"risk_flags":"","status":"pending"}'),
            ).alias("record"),
        )

    @cached_property
    def context_texts(self) -> DataFrame:
        """Run contexts as JSON, by customer."""
        key = F.col("c_custkey")
        return self.table("customer").select(
            key.alias("record_id"),
            F.concat(
                F.lit('{"run_id":"'), F.lpad(key.cast("string"), 36, "0"),
                F.when(key % 5 == 0, "z").otherwise(""), F.lit('","source_type":"'),
                F.when(F.col("c_mktsegment") == "BUILDING", "oracle").otherwise("mysql"),
                F.lit('","foreign_catalog":"'), F.when(F.col("c_acctbal") < 0, "").otherwise("f"),
                F.lit('","uc_catalog":"c","scoped_tables":["a",'),
                F.when(key % 4 == 0, "7").otherwise('"b"'), F.lit('],"workspace_host":"h","max_retries":'),
                (key % 8).cast("string"), F.lit(',"routines_skipped_reason":null}'),
            ).alias("record"),
        )

    @cached_property
    def report_texts(self) -> DataFrame:
        """Reconcile reports as JSON, by order; faults lie in the second of two checks."""
        key = F.col("o_orderkey")
        check = '{"check_id":"c","table":"t","expected":"1","actual":"1","delta":"0","result":"pass"}'
        second = (
            F.when(key % 8 == 0, "5")
            .when(key % 8 == 1, check.replace('"pass"', '"maybe"'))
            .when(key % 8 == 2, check.replace('"check_id":"c"', '"check_id":7'))
            .when(key % 8 == 3, check.replace('"expected":"1"', '"expected":null'))
            .when(key % 8 == 4, check.replace('"delta":"0",', ""))
            .when(key % 8 == 5, check.replace("}", ',"x":1}'))
            .otherwise(check)
        )
        extra = F.when(key % 5 == 0, ',"more":1').otherwise("")
        return self.table("orders").select(
            key.alias("record_id"),
            F.concat(
                F.lit('{"run_id":"r","checks":['), F.lit(check), F.lit(","), second,
                F.lit('],"summary":{"passed":2,"failed":0,"total":'), (key % 3).cast("string"), extra, F.lit("}}"),
            ).alias("record"),
        )

    @cached_property
    def manifest_texts(self) -> DataFrame:
        """Manifests as JSON, by part."""
        key = F.col("p_partkey")
        blocker = (
            F.when(key % 6 == 0, '"x"')
            .when(key % 6 == 1, '{"id":5,"message":null}')
            .when(key % 6 == 2, '{"id":"b"}')
            .otherwise('{"id":"b","message":"m"}')
        )
        artifact = (
            F.when(key % 5 == 0, "3")
            .when(key % 5 == 1, '{"legacy_proc":"p","target_path":"x","status":"no"}')
            .otherwise('{"legacy_proc":"p","target_path":"x","status":"final"}')
        )
        return self.table("part").select(
            key.alias("record_id"),
            F.concat(
                F.lit('{"run_id":"'), F.lpad(key.cast("string"), 36, "0"), F.lit('","gate":"fail","blockers":['),
                blocker, F.lit('],"converted_artifacts":['), artifact, F.lit('],"attempt":'),
                (F.col("p_size") - 3).cast("string"), F.lit(',"summary":{"tables_total":'),
                F.when(key % 7 == 0, '"1"').otherwise("1"), F.lit(',"other":2}}'),
            ).alias("record"),
        )

    @cached_property
    def item_counts(self) -> DataFrame:
        """Counts of the items' tables. Tables of other layers are never counted."""
        return (
            self.table("lineitem")
            .groupBy("l_partkey")
            .agg(F.count("*").alias("rows"))
            .select(F.concat(F.lit("gold.item_"), "l_partkey").alias("target_table"), "rows")
        )

    @cached_property
    def events(self) -> DataFrame:
        return self.table("events").select(
            F.col("user_id").cast("string").alias("run_id"),
            F.col("event_type").alias("agent"),
            F.lit("completed").alias("event"),
            F.col("event_id").cast("string").alias("tool"),
            F.col("props").alias("detail"),
            "ts",
        )

    @cached_property
    def gate_events(self) -> DataFrame:
        agent = (
            F.when(F.col("event_type") == "view", "coordinator")
            .when(F.col("event_type") == "click", "assess")
            .when(F.col("event_type") == "error", "convert")
            .when(F.col("event_type") == "purchase", "test")
            .otherwise("observer")
        )
        return self.table("events").select(
            F.concat(F.lit("run-"), F.col("user_id") % 5 + 1).alias("run_id"), agent.alias("agent")
        )

    @cached_property
    def runs(self) -> DataFrame:
        procs = (
            self.table("orders")
            .groupBy("o_custkey")
            .agg(
                F.count_if((F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "1-URGENT"))
                .alias("procs_total")
            )
        )
        segment = F.col("c_mktsegment")
        return self.table("customer").join(
            procs, F.col("c_custkey") == F.col("o_custkey"), "left"
        ).select(
            F.col("c_custkey").cast("string").alias("run_id"),
            F.coalesce("procs_total", F.lit(0)).alias("procs_total"),
            F.when(segment == "BUILDING", "no client").when(segment == "MACHINERY", "").alias(
                "routines_skipped_reason"
            ),
        )

    @cached_property
    def loads(self) -> DataFrame:
        """One load per customer and order day; the latest ones are still open."""
        day = F.col("o_orderdate")
        done = day < ts("2001-06-01")
        return self.table("orders").select("o_custkey", "o_orderdate").distinct().select(
            customer_key("o_custkey", "o_orderdate").alias("Lineage Key"),
            day.alias("Data Load Started"),
            F.concat(F.lit("Customer "), "o_custkey").alias("Table Name"),
            F.when(done, day).alias("Data Load Completed"),
            done.alias("Was Successful"),
            day.alias("Source System Cutoff Time"),
        )

    @cached_property
    def cutoffs(self) -> DataFrame:
        return self.table("customer").select(
            F.concat(F.lit("Customer "), "c_custkey").alias("Table Name"),
            ts("1990-01-01").alias("Cutoff Time"),
        )

    @cached_property
    def edges(self) -> DataFrame:
        source = F.when(F.col("l_returnflag") == "R", "old.bronze.part_").otherwise("wh.bronze.part_")
        target = F.when(F.col("l_linestatus") == "O", "wh.silver.supplier_").otherwise("ext.supplier_")
        return self.table("lineitem").select(
            F.concat(source, "l_partkey").alias("source_table_full_name"),
            F.concat(target, "l_suppkey").alias("target_table_full_name"),
            F.col("l_shipdate").alias("event_time"),
        )
