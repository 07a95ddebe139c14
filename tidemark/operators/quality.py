"""Key checks, row-count reconciliation and expectations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.temporal import Instant, instant
from tidemark.operators.counts import count_by_label

BRONZE_CHECK = "bronze_vs_source:"


def _verdict(ok: Column) -> Column:
    return F.when(ok, "pass").otherwise("fail")


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def check_not_null(df: DataFrame, table: str, cols: Sequence[str]) -> DataFrame:
    """One row per column with its NULL count; a single pass over the named columns only."""
    counts = df.agg(*(F.count_if(_q(c).isNull()).alias(c) for c in cols))
    pairs = F.array(
        *(F.struct(F.lit(c).alias("column_name"), _q(c).alias("violations")) for c in cols)
    )
    return counts.select(F.explode(pairs).alias("r")).select(
        F.concat(F.lit(f"not_null:{table}."), "r.column_name").alias("check_id"),
        F.col("r.violations").alias("violations"),
        _verdict(F.col("r.violations") == 0).alias("result"),
    )


def check_unique(df: DataFrame, table: str, cols: Sequence[str]) -> DataFrame:
    """Key values that occur more than once. Counting per task first keeps a hot key small."""
    repeated = df.groupBy(*(_q(c) for c in cols)).agg(F.count("*").alias("n")).filter("n > 1")
    return repeated.agg(F.count("*").alias("violations")).select(
        F.lit(f"primary_key:{table}").alias("check_id"),
        "violations",
        _verdict(F.col("violations") == 0).alias("result"),
    )


def check_fk(fact: DataFrame, dim: DataFrame, table: str, on: str, dim_key: str) -> DataFrame:
    """Rows whose non-NULL key is missing from the dimension."""
    orphans = (
        fact.select(_q(on).alias("k"))
        .filter(F.col("k").isNotNull())
        .join(dim.select(_q(dim_key).alias("k")), "k", "left_anti")
    )
    return orphans.agg(F.count("*").alias("violations")).select(
        F.lit(f"foreign_key:{table}.{on}").alias("check_id"),
        "violations",
        _verdict(F.col("violations") == 0).alias("result"),
    )


def check_rows(
    counted: DataFrame, check_id: Column, table_name: Column, ok: Column, run_id: str, now: Instant
) -> DataFrame:
    """``(expected, actual)`` counts as reconcile rows; the delta is actual minus expected."""
    return counted.select(
        check_id.alias("check_id"),
        table_name.alias("table_name"),
        F.col("expected").cast("string").alias("expected"),
        F.col("actual").cast("string").alias("actual"),
        (F.col("actual") - F.col("expected")).cast("string").alias("delta"),
        _verdict(ok).alias("result"),
        F.lit(run_id).alias("run_id"),
        instant(now).alias("ts"),
    )


def reconcile_counts(
    pairs: Mapping[str, tuple[DataFrame, DataFrame]], run_id: str, now: Instant
) -> DataFrame:
    """Source against bronze, ``{landing: (source, bronze)}``; each side is counted once."""
    frames = {}
    for landing, (source, bronze) in pairs.items():
        frames[(landing, "source")] = source
        frames[(landing, "bronze")] = bronze
    return reconcile_sides(count_by_label(frames, ["landing", "side"]), run_id, now)


def reconcile_sides(sides: DataFrame, run_id: str, now: Instant) -> DataFrame:
    """The same over counts already made: ``(landing, side, rows)``, side "source" or "bronze"."""
    counted = sides.groupBy("landing").agg(
        F.sum(F.when(F.col("side") == "source", F.col("rows"))).alias("expected"),
        F.sum(F.when(F.col("side") == "bronze", F.col("rows"))).alias("actual"),
    )
    return check_rows(
        counted,
        F.concat(F.lit(BRONZE_CHECK), "landing"),
        F.concat(F.lit("bronze."), "landing"),
        F.col("expected") == F.col("actual"),
        run_id,
        now,
    )


def evaluate_expectations(
    expectations: DataFrame, actual: DataFrame, run_id: str, now: Instant
) -> DataFrame:
    """Compare expectations with ``actual(target_table, rows)``.

    ``exact_when_expected_set``: no expectation passes, otherwise equality. ``gte``: at least the
    expected number. A table that was not counted has no actual number and fails what it has to meet.
    """
    counted = expectations.join(actual, "target_table", "left").select(
        "fixture_name",
        "target_table",
        "compare",
        "expected",
        F.col("rows").alias("actual"),
    )
    ok = (
        F.when(F.col("expected").isNull(), True)
        .when(F.col("compare") == "gte", F.col("actual") >= F.col("expected"))
        .when(F.col("compare") == "exact_when_expected_set", F.col("actual") == F.col("expected"))
        .otherwise(False)
    )
    ok = F.coalesce(ok, F.lit(False))
    # An unset expectation reports the whole count as its difference.
    rows = check_rows(
        counted,
        F.concat(F.lit("fixture_"), "fixture_name"),
        F.col("target_table"),
        ok,
        run_id,
        now,
    )
    return rows.withColumn("delta", F.coalesce("delta", "actual"))


def reconcile_summary(results: DataFrame, run_id: str) -> DataFrame:
    return results.filter(F.col("run_id") == run_id).agg(
        F.lit(run_id).alias("run_id"),
        F.count_if(F.col("result") == "pass").alias("passed"),
        F.count_if(F.col("result") == "fail").alias("failed"),
        F.count("*").alias("total"),
    )


def table_row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``(target_table, rows)`` for ``evaluate_expectations``."""
    return count_by_label({(name,): df for name, df in tables.items()}, ["target_table"])
