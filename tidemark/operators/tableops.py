"""Next states of tables: delete-and-insert, upsert, run replacement, drift injection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.temporal import Instant, instant
from tidemark.operators.keysets import own_exchange
from tidemark.operators.lookups import latest_per_key

# Fixed value: how an injected drift is marked in the notes.
FAULT_MARKER = "[INJECTED-FAULT]"


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def replace_by_key(fact: DataFrame, stage: DataFrame, key: str) -> DataFrame:
    """Delete the facts whose key is staged, append all staged rows. NULL keys are never deleted."""
    # Distinct staged keys, so that a hot key of the stage is one row of the right side.
    staged = own_exchange(stage.select(_q(key)).distinct())
    kept = fact.join(staged, key, "left_anti").select(*(_q(c) for c in fact.columns))
    return kept.unionByName(stage.select(*(_q(c) for c in fact.columns)))


# Staged keys that are looked up one by one; beyond that their range is.
FEW_KEYS = 200


def near_keys(fact: DataFrame, stage: DataFrame, key: str) -> DataFrame:
    """A part of the fact that holds all rows of staged keys, cut so that the scan can skip row groups.

    Few keys are compared one by one, which Bloom filters and statistics in the files answer; many are bounded by
    their least and greatest, which the statistics answer. At most ``FEW_KEYS`` keys reach the driver.
    """
    found = [row[0] for row in stage.select(_q(key)).filter(_q(key).isNotNull()).distinct().limit(FEW_KEYS + 1).collect()]
    if not found:
        return fact.filter(F.lit(False))
    kind = fact.schema[key].dataType
    if len(found) <= FEW_KEYS:
        # Single comparisons, as a long IN list is pushed down as its range.
        same = [_q(key) == F.lit(value).cast(kind) for value in found]
        while len(same) > 1:
            same = [a | b for a, b in zip(same[::2], same[1::2], strict=False)] + same[len(same) // 2 * 2 :]
        return fact.filter(same[0])
    low, high = stage.agg(F.min(_q(key)), F.max(_q(key))).first()
    return fact.filter(_q(key).between(F.lit(low).cast(kind), F.lit(high).cast(kind)))


def touched_partitions(fact: DataFrame, stage: DataFrame, key: str, partition: str) -> DataFrame:
    """Partitions of the fact that hold a staged key or receive a staged row.

    Only these need rewriting. The search reads two columns of the fact.
    """
    staged = own_exchange(stage.select(_q(key)).distinct())
    holding = fact.select(_q(key), _q(partition)).join(staged, key, "left_semi")
    return (
        holding.select(_q(partition)).unionByName(stage.select(_q(partition))).distinct()
    )


def snapshot_replace(
    fact: DataFrame, stage: DataFrame, lineage_key: int | Column | None = None
) -> DataFrame:
    """Truncate and insert: the staged rows in the shape of the fact."""
    rows = stage
    if lineage_key is not None:
        stamp = lineage_key if isinstance(lineage_key, Column) else F.lit(lineage_key)
        rows = rows.withColumn("Lineage Key", stamp)
    return rows.select(*(_q(f.name).cast(f.dataType).alias(f.name) for f in fact.schema.fields))


def replace_run(
    table: DataFrame,
    new: DataFrame,
    run_id: str,
    prefix: str | None = None,
    drop_null_run: bool = False,
) -> DataFrame:
    """Replace the rows of one run, or those of its checks that start with ``prefix``."""
    doomed = F.col("run_id") == run_id
    if prefix is not None:
        doomed = doomed & F.col("check_id").startswith(prefix)
    if drop_null_run:
        doomed = doomed | F.col("run_id").isNull()
    return table.filter(~F.coalesce(doomed, F.lit(False))).unionByName(new)


def upsert(
    target: DataFrame, source: DataFrame, keys: list[str], order: list[Column]
) -> DataFrame:
    """Insert or replace by key; of several source rows with one key the last in ``order`` wins."""
    latest = latest_per_key(source, keys, [c.desc() for c in order])
    # The reduced source is both what is added and, by key, what is replaced.
    replaced = own_exchange(latest.select(*(_q(k) for k in keys)))
    kept = target.join(replaced, keys, "left_anti")
    return kept.select(*(_q(c) for c in target.columns)).unionByName(
        latest.select(*(_q(c) for c in target.columns))
    )


def snapshot_expectations(expectations: DataFrame, named: Column) -> DataFrame:
    """The rows about to be perturbed, as JSON that keeps a NULL expectation."""
    return expectations.filter(named).select(
        "fixture_name",
        F.to_json(
            F.struct("fixture_name", "expected", "compare", "notes"), {"ignoreNullFields": "false"}
        ).alias("row_json"),
    )


def perturb(expectations: DataFrame, named: Column, delta: int) -> DataFrame:
    """Inject drift: raise the expectation by ``delta``, require at least that, mark the note."""
    if delta < 0:
        raise ValueError("delta must not be negative")
    # Fixed value: the wording of the note.
    note = F.concat(
        F.lit(f"{FAULT_MARKER} was expected="),
        F.coalesce(F.col("expected").cast("string"), F.lit("NULL")),
        F.lit(" compare="),
        F.col("compare"),
        F.lit(" | "),
        F.coalesce("notes", F.lit("")),
    )
    hit = F.coalesce(named, F.lit(False))
    return expectations.withColumns(
        {
            "expected": F.when(hit, F.coalesce("expected", F.lit(0)) + delta).otherwise(
                F.col("expected")
            ),
            "compare": F.when(hit, F.lit("gte")).otherwise(F.col("compare")),
            "notes": F.when(hit, note).otherwise(F.col("notes")),
        }
    )


def restore(expectations: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Undo ``perturb`` from its snapshot, NULL expectations included."""
    saved = snapshot.select(
        F.from_json("row_json", "fixture_name string, expected bigint, compare string, notes string")
        .alias("was")
    ).select(F.col("was.fixture_name").alias("fixture_name"), "was")
    hit = F.col("was").isNotNull()
    columns = expectations.columns
    return (
        expectations.join(saved, "fixture_name", "left")
        .withColumns(
            {
                c: F.when(hit, F.col(f"was.{c}")).otherwise(F.col(c))
                for c in ("expected", "compare", "notes")
            }
        )
        .select(columns)
    )


def run_events(runs: DataFrame, now: Instant) -> DataFrame:
    """Opening events of runs given as ``(run_id, procs_total, routines_skipped_reason)``.

    Always coordinator/started; also convert/skipped when there is nothing to convert.
    """
    reason = F.nullif(F.col("routines_skipped_reason"), F.lit(""))
    skipped = (F.coalesce("procs_total", F.lit(0)) == 0) | reason.isNotNull()

    def event(agent: str, name: str, detail: Column) -> Column:
        return F.struct(
            F.lit(agent).alias("agent"), F.lit(name).alias("event"), detail.alias("detail")
        )

    # Agents, events and the default details.
    started = event("coordinator", "started", F.lit("ensure_run_events"))
    no_convert = event(
        "convert", "skipped", F.coalesce(reason, F.lit("no backlog / routines skipped"))
    )
    return (
        runs.select(
            "run_id",
            F.explode(
                F.when(skipped, F.array(started, no_convert)).otherwise(F.array(started))
            ).alias("e"),
        )
        .select(
            "run_id",
            "e.agent",
            "e.event",
            F.lit(None).cast("string").alias("tool"),
            "e.detail",
            instant(now).alias("ts"),
        )
    )
