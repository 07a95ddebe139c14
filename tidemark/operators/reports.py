"""Operations reports over the control tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.temporal import Instant, instant, minute_of


def _count_by(df: DataFrame, column: str, name: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias(name))


def inventory_counts(inventory: DataFrame) -> DataFrame:
    return _count_by(inventory.filter(~F.col("skip")), "object_type", "n")


def reconcile_status(results: DataFrame) -> DataFrame:
    return _count_by(results, "result", "checks")


def backlog_status(backlog: DataFrame) -> DataFrame:
    return _count_by(backlog, "status", "items")


def event_summary(events: DataFrame) -> DataFrame:
    """Events, runs and agents.

    Counting per (run, agent) first reduces the log inside the tasks, so the two distinct counts
    expand only those pairs and not every event.
    """
    pairs = events.groupBy("run_id", "agent").agg(F.count("*").alias("n"))
    return pairs.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_events"),
        F.count_distinct("run_id").alias("runs"),
        F.count_distinct("agent").alias("agents"),
    )


def events_by_agent(events: DataFrame) -> DataFrame:
    return _count_by(events, "agent", "events").orderBy(F.desc("events"), "agent")


def events_over_time(events: DataFrame, now: Instant | Column, hours: int = 24) -> DataFrame:
    """Events per minute and agent over the last hours; ``now`` may be a scalar subquery."""
    since = instant(now) - F.expr(f"INTERVAL {hours} HOURS")
    return (
        events.filter(F.col("ts") >= since)
        .groupBy(minute_of(F.col("ts")).alias("minute"), "agent")
        .agg(F.count("*").alias("events"))
        .orderBy("minute", "agent")
    )


def latest_events(events: DataFrame, n: int = 100) -> DataFrame:
    columns = ["run_id", "agent", "event", "tool", "detail", "ts"]
    order = [F.col(c).asc_nulls_last() for c in columns[:-1]]
    return events.select(columns).orderBy(F.desc("ts"), *order).limit(n)


def gate_hero(manifest: DataFrame) -> DataFrame:
    columns = [
        "run_id",
        "gate",
        "tables_landed",
        "tables_total",
        "procs_converted",
        "procs_total",
        "updated_at",
    ]
    return manifest.select(columns).orderBy(F.desc("updated_at"), F.desc("run_id")).limit(1)


def timeline(events: DataFrame, run_id: str) -> DataFrame:
    return (
        events.filter(F.col("run_id") == run_id)
        .select("agent", "event", "detail", "ts")
        .orderBy("ts", "agent", "event")
    )


def list_checks(results: DataFrame, run_id: str) -> DataFrame:
    return (
        results.filter(F.col("run_id") == run_id)
        .select("check_id", "table_name", "expected", "actual", "delta", "result")
        .orderBy("check_id")
    )


def failed_checks(results: DataFrame, n: int = 20) -> DataFrame:
    return (
        results.filter(F.col("result") == "fail")
        .orderBy(F.desc("ts"), "check_id", "run_id")
        .select("check_id", "table_name", "expected", "actual", "delta", "run_id", "ts")
        .limit(n)
    )


def lineage(edges: DataFrame, prefix: str, n: int = 50) -> DataFrame:
    """The latest edges that touch the catalog on either side."""
    inside = F.col("target_table_full_name").startswith(prefix) | F.col(
        "source_table_full_name"
    ).startswith(prefix)
    return (
        edges.filter(inside)
        .select("source_table_full_name", "target_table_full_name", "event_time")
        .orderBy(F.desc("event_time"), "source_table_full_name", "target_table_full_name")
        .limit(n)
    )


def thresholds(inventory: DataFrame, warn_above: int = 200) -> DataFrame:
    """Table and routine counts with the confirm flag and the demo acceptance flags."""
    live = ~F.col("skip")
    is_table = F.col("object_type") == "table"
    counts = inventory.agg(
        F.count_if(is_table).alias("tables_total"),
        F.count_if(~is_table).alias("procs_total"),
        F.count_if(is_table & live).alias("tables_live"),
    )
    # Acceptance asks for 10 tables and 5 routines.
    return counts.withColumns(
        {
            "requires_confirm": F.col("tables_total") > warn_above,
            "accepts_tables": F.col("tables_total") >= 10,
            "accepts_procs": F.col("procs_total") >= 5,
        }
    )
