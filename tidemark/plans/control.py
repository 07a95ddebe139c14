"""Upkeep of the control tables: backlog, conversion results, events and injected drift."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark import schemas
from tidemark.functions.temporal import Instant, instant
from tidemark.operators import backlog as bl
from tidemark.operators import counts, records, reports, tableops
from tidemark.sources import sinks

# The control tables and their schemas.
TABLES = {
    "ops.load_control": schemas.LOAD_CONTROL,
    "ops.migration_inventory": schemas.INVENTORY,
    "ops.migration_backlog": schemas.BACKLOG,
    "ops.proc_conversion_map": schemas.CONVERSION_MAP,
    "ops.reconcile_results": schemas.RECONCILE,
    "ops.fixture_expectations": schemas.EXPECTATIONS,
    "ops.migration_manifest_current": schemas.MANIFEST,
    "ops.agent_events": schemas.EVENTS,
    "ops.table_lineage": schemas.LINEAGE_EDGES,
}
# Histories of which one run at a time is replaced.
BY_RUN = ("ops.migration_inventory", "ops.reconcile_results")
FAULTS = "ops.injected_faults"


@dataclass
class Control:
    spark: SparkSession
    root: str
    now: Instant
    prefix: str = ""

    def name(self, table: str) -> str:
        return self.prefix + table

    def read(self, table: str) -> DataFrame:
        return self.spark.table(self.name(table))

    def publish(self, table: str, df: DataFrame) -> DataFrame:
        return sinks.refresh(df, self.name(table), self.root)

    def create_tables(self) -> DataFrame:
        """Create what is missing; existing tables keep their rows."""
        sinks.create_layers(self.spark, self.root, ("ops",), self.prefix)
        for table, schema in TABLES.items():
            if not sinks.table_exists(self.spark, self.name(table)):
                empty = self.spark.createDataFrame([], schema)
                if table in BY_RUN:
                    sinks.refresh_partitions(empty, self.name(table), self.root, "run_id", [])
                else:
                    self.publish(table, empty)
        return counts.smoke("ops_and_views_ok", agent_events=self.read("ops.agent_events"))

    def record_event(
        self,
        run_id: str,
        agent: str,
        event: str,
        tool: str | None = None,
        detail: str | None = None,
    ) -> None:
        row = self.spark.range(0, 1, 1, 1).select(
            *(
                F.lit(value).cast("string").alias(name)
                for name, value in zip(schemas.EVENTS.names, (run_id, agent, event, tool, detail))
            ),
            instant(self.now).alias("ts"),
        )
        sinks.append(row, self.name("ops.agent_events"), self.root, cluster=("run_id", "ts"))

    def persist_backlog(self, texts: DataFrame) -> DataFrame:
        """Replace the backlog by JSON items (column ``record``); one bad item rejects the batch.

        Every violation of a rejected batch is in ``ops.backlog_rejections``, one row each.
        """
        checked = records.validate_records(texts, records.BACKLOG_ITEM)
        good, _ = records.split_records(checked)
        rejections = self.publish(
            "ops.backlog_rejections", records.violation_rows(checked, "record")
        )
        faults = rejections.count()
        if faults:
            example = rejections.orderBy("record", "violation").first()["violation"]
            raise ValueError(
                f"backlog items break their contract {faults} times, such as {example}; "
                f"all in {self.name('ops.backlog_rejections')}"
            )
        items = good.select("parsed.*", instant(self.now).alias("updated_at"))
        return self.publish("ops.migration_backlog", items)

    def merge_conversions(
        self, texts: DataFrame, targets: DataFrame, run_id: str | None = None
    ) -> DataFrame:
        """Merge conversion records (``record_id``, ``record``) into the map, then into the backlog.

        With ``run_id`` the run's convert event is recorded once both are published.

        The map comes first: if it cannot be published, the backlog still asks for the conversion.
        Returns the summary row.
        """
        checked = records.validate_records(texts, records.CONVERT_RESULT)
        backlog = self.read("ops.migration_backlog")
        merged = bl.merge_results(
            backlog, checked.select("record_id", "parsed.*", "violations"), targets
        )
        # The merge feeds two tables and a summary, so it is stored once.
        merged = self.publish("ops.convert_merge", merged)
        rows = bl.conversion_map_rows(merged, instant(self.now))
        self.publish(
            "ops.proc_conversion_map",
            tableops.upsert(
                self.read("ops.proc_conversion_map"),
                rows,
                ["legacy_proc"],
                [F.col(c) for c in bl.MAP_ORDER],
            ),
        )
        self.publish("ops.migration_backlog", bl.apply_merge(backlog, merged))
        if run_id is not None:
            self.record_event(run_id, "convert", "completed")
        return bl.convert_summary(merged)

    def inject_drift(self, fixture: str, delta: int) -> None:
        """Raise one expectation; the original row is kept until ``revert_drift``."""
        table = self.read("ops.fixture_expectations")
        named = F.col("fixture_name") == fixture
        if sinks.table_exists(self.spark, self.name(FAULTS)) and self.read(FAULTS).head(1):
            raise RuntimeError("a drift is already injected; revert it first")
        saved = tableops.snapshot_expectations(table, named)
        if not saved.head(1):
            raise LookupError(f"no expectation named {fixture!r}")
        self.publish(FAULTS, saved)
        self.publish("ops.fixture_expectations", tableops.perturb(table, named, delta))

    def revert_drift(self) -> None:
        saved = self.read(FAULTS)
        if not saved.head(1):
            raise LookupError("nothing to revert")
        self.publish(
            "ops.fixture_expectations", tableops.restore(self.read("ops.fixture_expectations"), saved)
        )
        self.publish(FAULTS, saved.limit(0))

    def datasets(self) -> dict[str, DataFrame]:
        """The datasets of the operations dashboard."""
        events = self.read("ops.agent_events")
        return {
            "gate_hero": reports.gate_hero(self.read("ops.migration_manifest_current")),
            "inventory_counts": reports.inventory_counts(self.read("ops.migration_inventory")),
            "reconcile_status": reports.reconcile_status(self.read("ops.reconcile_results")),
            "backlog_status": reports.backlog_status(self.read("ops.migration_backlog")),
            "event_summary": reports.event_summary(events),
            "events_by_agent": reports.events_by_agent(events),
            "events_over_time": reports.events_over_time(events, self.now),
            "latest_events": reports.latest_events(events),
        }
