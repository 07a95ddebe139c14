"""The medallion run: smoke, land, conform, marts, checks, lineage, verdict."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime, timezone
from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark import schemas
from tidemark.functions.naming import batch_id
from tidemark.functions.temporal import Instant, instant
from tidemark.operators import conform, gate, landing, marts, metrics, quality, reports, tableops
from tidemark.operators.counts import count_by_label, union_all
from tidemark.sources import discovery, fixtures, sinks
from tidemark.sources.external import Source, count_in_source, register_source_views

LAYERS = ("source_fed", "bronze", "silver", "gold", "ops")

# Fixed value: above this many source tables a run has to be confirmed.
CONFIRM_ABOVE = 200


def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


@dataclass
class Medallion:
    """One run over one source. ``prefix`` separates the layers of several catalogs."""

    spark: SparkSession
    source: Source
    root: str
    run_id: str
    as_of: Instant
    prefix: str = ""
    workers: int = 4
    # Column to split the scan of a large source table by: {(schema, table): column}.
    split_by: dict[tuple[str, str], str] = field(default_factory=dict)
    # When things happened, for the load control; everything else is dated by ``as_of``.
    clock: Callable[[], Instant] = utc_now
    # (read, written) of every table published so far.
    edges: list[tuple[str, str]] = field(default_factory=list)

    def name(self, table: str) -> str:
        return self.prefix + table

    def read(self, table: str) -> DataFrame:
        return self.spark.table(self.name(table))

    def publish(self, table: str, df: DataFrame, *reads: str) -> DataFrame:
        """Publish a table; ``reads`` names what it is made of, for the lineage."""
        published = sinks.refresh(df, self.name(table), self.root)
        self.edges += [(self.name(source), self.name(table)) for source in reads]
        return published

    def together(self, steps: Sequence[Callable[[], object]]) -> list:
        """Independent writes from a few driver threads; each is a Spark job of its own."""
        with ThreadPoolExecutor(max_workers=self.workers) as pool:
            return [f.result() for f in [pool.submit(step) for step in steps]]

    # Steps, in order.

    def smoke(self, catalog: DataFrame) -> None:
        sinks.create_layers(self.spark, self.root, LAYERS, self.prefix)
        databases = self.spark.sql("SHOW DATABASES").select(
            F.regexp_replace("namespace", f"^{self.prefix}", "").alias("schema_name")
        )
        found = discovery.source_smoke(catalog, databases).first()
        if not found["foreign_base_tables"] or not found["managed_schemas_ok"]:
            raise RuntimeError(f"source smoke failed: {found.asDict()}")

    def inventory(
        self, catalog: DataFrame, routines: DataFrame, skip: dict[tuple[str, str], str]
    ) -> DataFrame:
        tables = discovery.discover_tables(catalog)
        for (schema, name), reason in skip.items():
            hit = (F.col("source_schema") == schema) & (F.col("source_name") == name)
            tables = tables.withColumns(
                {
                    "skip": F.when(hit, True).otherwise(F.col("skip")),
                    "skip_reason": F.when(hit, reason).otherwise(F.col("skip_reason")),
                }
            )
        new = discovery.inventory(tables, routines, self.run_id, self.as_of)
        # Rows without a run are leftovers; they go with the run's own earlier rows.
        published = sinks.refresh_partitions(
            new, self.name("ops.migration_inventory"), self.root, "run_id", [self.run_id, None]
        )
        mine = published.filter(F.col("run_id") == self.run_id)
        clashes = self.publish("ops.landing_collisions", landing.landing_collisions(mine))
        if count := clashes.count():
            raise RuntimeError(
                f"{count} landing names collide; all are in {self.name('ops.landing_collisions')}"
            )
        return mine

    def confirm(self, inventory: DataFrame, confirmed: bool) -> None:
        """A source of many tables is landed only when someone has said so."""
        found = reports.thresholds(inventory, CONFIRM_ABOVE).first()
        if found["requires_confirm"] and not confirmed:
            raise RuntimeError(
                f"{found['tables_total']} source tables are more than {CONFIRM_ABOVE}; confirm the run"
            )

    def land(self, inventory: DataFrame) -> list[tuple[str, str, str]]:
        """Full refresh of every live table; returns ``(schema, table, landing)`` of each."""
        # Catalog metadata: one row per source table.
        live = inventory.filter("object_type = 'table' AND skip = false").collect()
        tables = [(r["source_schema"], r["source_name"], r["landing_name"]) for r in live]
        system = landing.SOURCE_SYSTEM.get(self.source.kind, self.source.kind)
        batch, started = batch_id(self.as_of), self.clock()

        def one(schema: str, table: str, name: str) -> None:
            views = register_source_views(
                self.spark, self.source, [(schema, table, name)], self.split_by, f"{self.prefix}source_fed_"
            )
            self.publish(
                f"bronze.{name}", landing.land(views[name], system, batch, self.as_of), f"source_fed.{name}"
            )

        self.together([partial(one, *t) for t in tables])
        landed = {name: self.read(f"bronze.{name}") for _, _, name in tables}
        rows = landing.load_control_rows(landed, batch, started, self.clock())
        sinks.append_missing(
            rows, self.name("ops.load_control"), self.root, ("batch_id", "table_name"), F.col("batch_id") == batch
        )
        return tables

    def conform(self) -> None:
        bronze = lambda t: self.read(f"bronze.{t}")
        silver = lambda name, df, *reads: partial(self.publish, f"silver.{name}", df, *reads)
        future = conform.split_future(bronze("dim_customer"), "Valid From", self.as_of)[1]
        self.together(
            [
                silver("dim_city", conform.dim_city(bronze("dim_city")), "bronze.dim_city"),
                silver(
                    "dim_stock_item",
                    conform.dim_stock_item(bronze("dim_stock_item")),
                    "bronze.dim_stock_item",
                ),
                silver("dim_date", conform.dim_date(bronze("dim_date")), "bronze.dim_date"),
                silver(
                    "dim_customer_scd2",
                    conform.dim_customer_scd2(bronze("dim_customer"), self.as_of),
                    "bronze.dim_customer",
                ),
                silver("dim_customer_scd2_quarantine", future, "bronze.dim_customer"),
            ]
        )
        customer, item = self.read("silver.dim_customer_scd2"), self.read("silver.dim_stock_item")
        made_of = ("bronze.fact_sale", "silver.dim_customer_scd2", "silver.dim_stock_item")
        sales = bronze("fact_sale")
        self.together(
            [
                silver("fact_sale", conform.fact_sale(sales, customer, item), *made_of),
                silver("fact_sale_orphan", conform.fact_orphans(sales, customer, item), *made_of),
            ]
        )

    def marts(self, tie_breakers: tuple[str, ...]) -> metrics.MetricView:
        fact, city = self.read("silver.fact_sale"), self.read("silver.dim_city")
        item, holding = self.read("silver.dim_stock_item"), self.read("bronze.fact_stock_holding")
        customer = self.read("silver.dim_customer_scd2")
        gold = lambda name, df, *reads: partial(self.publish, f"gold.{name}", df, *reads)
        self.together(
            [
                gold(
                    "mart_daily_internet_sales",
                    marts.mart_daily_sales(fact, self.read("silver.dim_date"), item),
                    "silver.fact_sale",
                    "silver.dim_date",
                    "silver.dim_stock_item",
                ),
                gold(
                    "mart_stock_movements",
                    marts.mart_stock_movements(item, holding, tie_breakers),
                    "silver.dim_stock_item",
                    "bronze.fact_stock_holding",
                ),
                gold(
                    "mart_customer_current",
                    marts.mart_customer_current(customer, city),
                    "silver.dim_customer_scd2",
                    "silver.dim_city",
                ),
                gold("mart_city_dimension", marts.mart_city_dimension(city), "silver.dim_city"),
                gold(
                    "mart_stock_holding",
                    marts.mart_stock_holding(holding, self.as_of),
                    "bronze.fact_stock_holding",
                ),
            ]
        )
        for mart, names in (
            ("mart_customer_current", ("customer_name", "city_name")),
            ("mart_city_dimension", ("city_name",)),
        ):
            columns = ", ".join(
                f"{c} COLLATE UTF8_LCASE AS {c}" if c in names else c
                for c in self.read(f"gold.{mart}").columns
            )
            self.spark.sql(
                f"CREATE OR REPLACE VIEW {self.name('gold.v_' + mart + '_ci')} AS "
                f"SELECT {columns} FROM {self.name('gold.' + mart)}"
            )
            self.edges.append((self.name(f"gold.{mart}"), self.name(f"gold.v_{mart}_ci")))
        return metrics.daily_sales_metrics(fact)

    def smoke_rows(self) -> DataFrame:
        """Row counts of every silver and gold table of the run, and of undated customer versions.

        All in one job; ``check_name`` is the table's name with ``_ok``.
        """
        written = sorted({t for _, t in self.edges if ".v_" not in t and "bronze." not in t})
        frames = {(f"{t.rsplit('.', 1)[1]}_ok",): self.spark.table(t) for t in written}
        frames[("dim_customer_undated",)] = conform.undated(self.read("bronze.dim_customer"), "Valid From")
        rows = count_by_label(frames, ["check_name"]).select(
            "check_name",
            F.col("rows").alias("row_count"),
            F.lit(self.run_id).alias("run_id"),
            instant(self.as_of).alias("ts"),
        )
        return self.publish("ops.smoke_results", rows)

    def constraints(self) -> DataFrame:
        """Key checks of the silver layer; reported beside the verdict, as keys are not enforced."""
        keys = {
            "dim_city": "city_key",
            "dim_stock_item": "stock_item_key",
            "dim_customer_scd2": "customer_key",
            "dim_date": "date_key",
            "fact_sale": "sale_key",
        }
        silver = {t: self.read(f"silver.{t}") for t in keys}
        fact = silver["fact_sale"]
        required = {t: [k] for t, k in keys.items()}
        required["fact_sale"] = ["sale_key", "customer_key", "stock_item_key"]
        checks = [quality.check_not_null(silver[t], t, cols) for t, cols in required.items()]
        checks += [quality.check_unique(silver[t], t, [k]) for t, k in keys.items()]
        checks += [
            quality.check_fk(
                fact, silver["dim_customer_scd2"], "fact_sale", "customer_key", "customer_key"
            ),
            quality.check_fk(
                fact, silver["dim_stock_item"], "fact_sale", "stock_item_key", "stock_item_key"
            ),
        ]
        return self.publish("ops.constraint_checks", union_all(checks))

    def reconcile(
        self, tables: list[tuple[str, str, str]], expectations: DataFrame | None
    ) -> DataFrame:
        source = count_in_source(self.spark, self.source, tables)
        bronze = count_by_label(
            {(name,): self.read(f"bronze.{name}") for _, _, name in tables}, ["landing"]
        )
        sides = source.withColumn("side", F.lit("source")).unionByName(
            bronze.withColumn("side", F.lit("bronze"))
        )
        new = quality.reconcile_sides(sides, self.run_id, self.as_of)
        if expectations is not None:
            targets = [target for _, target, _ in fixtures.FIXTURES]
            actual = quality.table_row_counts({self.name(t): self.read(t) for t in targets})
            new = new.unionByName(
                quality.evaluate_expectations(expectations, actual, self.run_id, self.as_of)
            )
        return sinks.refresh_partitions(
            new, self.name("ops.reconcile_results"), self.root, "run_id", [self.run_id]
        )

    def lineage(self) -> None:
        """One edge per table read and written, as recorded when it was published."""
        edges = [F.struct(F.lit(s), F.lit(t)) for s, t in dict.fromkeys(self.edges)]
        rows = self.spark.range(0, 1, 1, 1).select(F.inline(F.array(*edges)))
        columns = ("source_table_full_name", "target_table_full_name")
        sinks.append_missing(
            rows.toDF(*columns).withColumn("event_time", instant(self.as_of)),
            self.name("ops.table_lineage"), self.root, (*columns, "event_time"), F.col("event_time") == instant(self.as_of),
        )

    def events(self, procs_total: int, skip_reason: str | None) -> None:
        run = self.spark.range(0, 1, 1, 1).select(
            F.lit(self.run_id).alias("run_id"),
            F.lit(procs_total).alias("procs_total"),
            F.lit(skip_reason).cast("string").alias("routines_skipped_reason"),
        )
        done = [
            F.struct(F.lit(agent).alias("agent"), F.lit(event).alias("event"))
            for agent, event in (("assess", "completed"), ("test", "completed"), ("gate", "started"))
        ]
        rest = run.select("run_id", F.inline(F.array(*done))).select(
            "run_id",
            "agent",
            "event",
            F.lit(None).cast("string").alias("tool"),
            F.lit(None).cast("string").alias("detail"),
            instant(self.as_of).alias("ts"),
        )
        rows = tableops.run_events(run, self.as_of).unionByName(rest)
        sinks.append_missing(
            rows, self.name("ops.agent_events"), self.root, tuple(rows.columns), F.col("run_id") == self.run_id,
            cluster=("run_id", "ts"),
        )

    def verdict(
        self,
        inventory: DataFrame,
        reconcile: DataFrame,
        procs_total: int,
        skip_reason: str | None,
        targets: DataFrame | None,
    ) -> DataFrame:
        empty = lambda schema: self.spark.createDataFrame([], schema)
        existing = lambda t, s: (
            self.read(t) if sinks.table_exists(self.spark, self.name(t)) else empty(s)
        )
        landed = self.spark.sql(f"SHOW TABLES IN {self.name('bronze')}").select(
            F.col("tableName").alias("table_name")
        )
        backlog = existing("ops.migration_backlog", schemas.BACKLOG)
        mapped = existing("ops.proc_conversion_map", schemas.CONVERSION_MAP)
        events = self.read("ops.agent_events")
        blockers = gate.gate_blockers(
            inventory,
            landed,
            reconcile,
            backlog,
            mapped,
            # The map's own paths prove nothing; without a list of files none exists.
            targets if targets is not None else mapped.select("target_path").limit(0),
            events,
            self.run_id,
            skip_reason,
            procs_total,
        )
        blockers = self.publish("ops.gate_blockers", blockers)
        decision = gate.verdict(blockers, self.run_id)
        summary = gate.run_summary(inventory, landed, reconcile, backlog, events, self.run_id)
        return self.publish(
            "ops.migration_manifest_current", gate.manifest_row(decision, summary, self.as_of)
        )


def run_medallion(
    spark: SparkSession,
    source: Source,
    root: str,
    run_id: str,
    as_of: Instant,
    catalog: DataFrame | None = None,
    fixture_folder: str | None = None,
    skip: dict[tuple[str, str], str] | None = None,
    tie_breakers: tuple[str, ...] = ("Bin Location",),
    prefix: str = "",
    split_by: dict[tuple[str, str], str] | None = None,
    targets: DataFrame | None = None,
    confirmed: bool = False,
) -> DataFrame:
    """Run everything in dependency order; returns the one-row manifest.

    ``targets`` lists the files of converted routines that exist, as ``target_path``; a run that owes
    conversions needs it. ``confirmed`` lets a source of more than ``CONFIRM_ABOVE`` tables pass.
    """
    run = Medallion(spark, source, root, run_id, as_of, prefix, split_by=split_by or {})
    catalog = discovery.catalog_tables(spark, source) if catalog is None else catalog
    run.smoke(catalog)
    expectations = None
    if fixture_folder:
        expectations = run.publish(
            "ops.fixture_expectations",
            fixtures.stage_expectations(spark, fixture_folder, as_of, prefix),
        )
    routines, skip_reason = discovery.discover_routines(spark, source)
    inventory = run.inventory(catalog, routines, skip or {})
    procs_total = inventory.filter("object_type <> 'table'").count()
    run.confirm(inventory, confirmed)
    tables = run.land(inventory)
    run.conform()
    run.marts(tie_breakers)
    run.smoke_rows()
    run.constraints()
    reconcile = run.reconcile(tables, expectations)
    run.lineage()
    run.events(procs_total, skip_reason)
    return run.verdict(inventory, reconcile, procs_total, skip_reason, targets)
