"""Ship / no-ship: blocker rows, verdict and the run summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.temporal import Instant, instant
from tidemark.operators.backlog import CONVERTED, _low
from tidemark.operators.counts import union_all
from tidemark.operators.keysets import own_exchange
from tidemark.operators.quality import BRONZE_CHECK

# Fixed value: the agents every run must have heard from.
REQUIRED_AGENTS = ("coordinator", "assess", "convert", "test", "gate")


def _blockers(df: DataFrame, prefix: str, subject: Column, message: Column, item=None) -> DataFrame:
    return df.select(
        F.concat(F.lit(prefix), subject).alias("id"),
        message.alias("message"),
        (F.lit(None).cast("string") if item is None else item).alias("backlog_item_id"),
    )


def is_live() -> Column:
    """Inventory rows that take part; only a stated ``skip`` leaves one out."""
    return ~F.coalesce("skip", F.lit(False))


def is_passed() -> Column:
    return F.col("result").eqNullSafe(F.lit("pass"))


def gate_blockers(
    inventory: DataFrame,
    bronze: DataFrame,
    reconcile: DataFrame,
    backlog: DataFrame,
    conversion_map: DataFrame,
    targets: DataFrame,
    events: DataFrame,
    run_id: str,
    routines_skipped_reason: str | None = None,
    procs_total: int | None = None,
    required_agents: tuple[str, ...] = REQUIRED_AGENTS,
) -> DataFrame:
    """Everything that stops the run; no rows means the gate passes.

    ``bronze`` lists landed tables as ``table_name``, ``targets`` existing files as ``target_path``.
    A table-only run (routines skipped, or none found) owes no conversions, and an empty
    backlog yields none. What is unknown does not pass: a NULL ``skip`` is a live table, and a NULL or
    unknown ``result`` a failed check.
    """
    landed = bronze.select(F.col("table_name").alias("landing_name"))
    live = inventory.filter((F.col("object_type") == "table") & is_live())
    absent = live.join(landed, "landing_name", "left_anti")
    this_run = reconcile.filter(F.col("run_id") == run_id)
    failed = this_run.filter(~is_passed())
    # A live table that nobody compared has not passed either.
    compared = own_exchange(this_run.select(F.col("check_id").alias("_check")).distinct())
    uncompared = live.withColumn("check_id", F.concat(F.lit(BRONZE_CHECK), "landing_name")).join(
        compared, F.col("check_id") == F.col("_check"), "left_anti"
    )
    # One row per agent, however many events the run has.
    heard = own_exchange(events.filter(F.col("run_id") == run_id).select("agent").distinct())
    spark = inventory.sparkSession
    agents = spark.range(1).select(
        F.explode(F.array(*(F.lit(a) for a in required_agents))).alias("agent")
    )
    silent = agents.join(heard, "agent", "left_anti")
    parts = [
        _blockers(
            absent,
            "bronze_missing:",
            F.col("landing_name"),
            F.concat(F.lit("not landed: "), "landing_name"),
        ),
        _blockers(
            failed,
            "reconcile_fail:",
            F.col("check_id"),
            F.concat(
                F.lit("expected "),
                F.coalesce("expected", F.lit("NULL")),
                F.lit(", actual "),
                F.coalesce("actual", F.lit("NULL")),
            ),
        ),
        _blockers(
            uncompared,
            "reconcile_fail:",
            F.col("check_id"),
            F.concat(F.lit("not compared: "), "landing_name"),
        ),
        _blockers(
            silent,
            "events_missing:",
            F.col("agent"),
            F.concat(F.lit("no event from "), "agent"),
        ),
    ]
    if not routines_skipped_reason and procs_total != 0:
        owed = backlog.filter(
            (_low("status") != "blocked") & (_low("target_layer") != "n/a")
        )
        mapped = own_exchange(
            conversion_map.filter(F.col("status").isin(*CONVERTED)).select("legacy_proc").distinct()
        )
        on_disk = own_exchange(targets.select("target_path").distinct())
        # Both joins on the map share one shuffle of the backlog.
        unmapped = owed.join(mapped, "legacy_proc", "left_anti").select("item_id")
        fileless = (
            owed.join(mapped, "legacy_proc", "left_semi")
            .join(on_disk, "target_path", "left_anti")
            .select("item_id")
        )
        missing = unmapped.unionByName(fileless)
        parts.append(
            _blockers(
                missing,
                "convert_missing:",
                F.col("item_id"),
                F.lit("no conversion record or file"),
                F.col("item_id"),
            )
        )
    return union_all(parts)


def blocked_items(backlog: DataFrame) -> DataFrame:
    """Items still blocked. Shown beside the verdict; they do not decide it."""
    return _blockers(
        backlog.filter(F.lower("status") == "blocked"),
        "convert_blocked:",
        F.col("item_id"),
        F.lit("blocked after conversion"),
        F.col("item_id"),
    )


def verdict(blockers: DataFrame, run_id: str) -> DataFrame:
    return blockers.agg(F.count("*").alias("blockers")).select(
        F.lit(run_id).alias("run_id"),
        F.when(F.col("blockers") == 0, "pass").otherwise("fail").alias("gate"),
        "blockers",
    )


def run_summary(
    inventory: DataFrame,
    bronze: DataFrame,
    reconcile: DataFrame,
    backlog: DataFrame,
    events: DataFrame,
    run_id: str,
) -> DataFrame:
    """One row of run totals; every table is reduced to partial counts before they meet."""

    def counts(df: DataFrame, **measures: Column) -> DataFrame:
        one = df.agg(*(m.alias(name) for name, m in measures.items()))
        pairs = F.array(
            *(F.struct(F.lit(n).alias("name"), F.col(n).alias("value")) for n in measures)
        )
        return one.select(F.explode(pairs).alias("p")).select("p.name", "p.value")

    is_table = (F.col("object_type") == "table") & is_live()
    landed = (
        inventory.filter(is_table)
        .select("landing_name")
        .join(bronze.select(F.col("table_name").alias("landing_name")), "landing_name", "left_semi")
    )
    this_run = F.col("run_id") == run_id
    measures = union_all(
        [
            counts(
                inventory,
                tables_total=F.count_if(is_table),
                procs_total=F.count_if((F.col("object_type") != "table") & is_live()),
            ),
            counts(landed, tables_landed=F.count("*")),
            counts(
                backlog,
                backlog_total=F.count("*"),
                backlog_converted=F.count_if(F.col("status").isin("converted", "tested", "done")),
                procs_converted=F.count_if(F.col("status") == "converted"),
            ),
            counts(
                reconcile.filter(this_run),
                reconcile_passed=F.count_if(is_passed()),
                reconcile_failed=F.count_if(~is_passed()),
            ),
            counts(events.filter(this_run), agent_events_recorded=F.count("*")),
        ]
    )
    names = [
        "backlog_total",
        "backlog_converted",
        "tables_total",
        "tables_landed",
        "procs_total",
        "procs_converted",
        "reconcile_passed",
        "reconcile_failed",
        "agent_events_recorded",
    ]
    return measures.agg(
        *(F.max(F.when(F.col("name") == n, F.col("value"))).alias(n) for n in names)
    )


def manifest_row(decision: DataFrame, summary: DataFrame, now: Instant) -> DataFrame:
    """The single row of the current-manifest table, from two one-row frames."""
    totals = summary.withColumn("run_id", F.lit(None).cast("string"))
    decided = decision.select("run_id", "gate")
    both = decided.unionByName(totals, allowMissingColumns=True)
    one = both.agg(*(F.max(c).alias(c) for c in both.columns))
    return one.select(
        "run_id",
        "gate",
        *(
            F.col(c).cast("int").alias(c)
            for c in ("tables_total", "tables_landed", "procs_total", "procs_converted")
        ),
        F.to_json(F.struct(*summary.columns)).alias("summary_json"),
        instant(now).alias("updated_at"),
    )
