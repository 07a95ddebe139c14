"""Conversion backlog: result merge, path rules, deployment check."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.operators.keysets import key_set, own_exchange

# States that count as converted, and states that need no conversion.
CONVERTED = ("draft", "review", "final")
SETTLED = ("done", "n/a")
# A file directly under a silver or gold folder.
TARGET_PATTERN = r"^[^/]+/(silver|gold)/[^/]+\.sql$"
RETIRED_FOLDER = "converted/"


def _low(column: str) -> Column:
    return F.lower(F.coalesce(column, F.lit("")))


def convertible(backlog: DataFrame) -> DataFrame:
    return backlog.filter(~_low("status").isin(*SETTLED) & (_low("target_layer") != "n/a"))


def settled(backlog: DataFrame) -> DataFrame:
    return backlog.filter(_low("status").isin(*SETTLED) | (_low("target_layer") == "n/a"))


# In what order map rows of one routine are applied.
MAP_ORDER = ("position", "item_id")


def backlog_position(backlog: DataFrame) -> Column:
    """Place of an item in its backlog: a ``position`` column if there is one, else the item's number.

    Numbered ids are compared as numbers, so ``item-10`` comes after ``item-9``.
    """
    if "position" in backlog.columns:
        return F.col("position").cast("bigint")
    return F.expr("try_cast(regexp_extract(item_id, '([0-9]+)$', 1) AS BIGINT)")


def merge_results(backlog: DataFrame, results: DataFrame, targets: DataFrame) -> DataFrame:
    """Resolve every convertible item against its conversion record.

    ``results`` holds one record per ``record_id`` (the item it was filed under) with the record's
    fields and ``violations``, the array of its contract violations; ``targets`` lists the existing
    ``target_path`` values. ``status`` is the item's next state, ``map_status`` that of its
    conversion-map row, NULL where the record may not enter the map.
    """
    known = key_set(targets.select(F.col("target_path").alias("r_path")), "deployed")
    record = results.select(
        "record_id",
        F.col("item_id").alias("r_item"),
        F.col("legacy_proc").alias("r_proc"),
        F.col("target_path").alias("r_path"),
        F.col("status").alias("r_status"),
        F.col("notes").alias("r_notes"),
        "violations",
        F.lit(True).alias("found"),
    )
    joined = (
        convertible(backlog)
        .select("item_id", "legacy_proc", "target_path", backlog_position(backlog).alias("position"))
        .join(record, F.col("item_id") == F.col("record_id"), "left")
        .join(known, "r_path", "left")
    )
    missing = F.col("found").isNull()
    invalid = F.coalesce(F.size("violations") > 0, F.lit(False))
    mismatch = ~F.col("r_item").eqNullSafe(F.col("item_id"))
    converted = F.col("r_status").isin(*CONVERTED)
    absent = converted & F.col("deployed").isNull()
    accepted = ~missing & ~invalid & ~mismatch & ~absent
    # The texts of the four notes.
    problem = (
        F.when(missing, "missing convert result file")
        .when(
            invalid,
            F.concat(F.lit("invalid convert result: "), F.array_join("violations", "; ")),
        )
        .when(
            mismatch,
            F.concat(
                F.lit("result item_id "),
                F.coalesce("r_item", F.lit("NULL")),
                F.lit(" != backlog "),
                "item_id",
            ),
        )
        .when(absent, F.concat(F.lit("target_path missing on disk: "), "r_path"))
    )
    done = accepted & converted
    return joined.select(
        "item_id",
        F.when(accepted, F.col("r_proc")).otherwise(F.col("legacy_proc")).alias("legacy_proc"),
        F.when(done, "converted").otherwise("blocked").alias("status"),
        F.when(accepted, F.col("r_status")).alias("map_status"),
        F.when(missing, F.col("target_path"))
        .otherwise(F.coalesce("r_path", "target_path"))
        .alias("target_path"),
        F.coalesce(problem, "r_notes", F.lit("")).alias("notes"),
        missing.alias("missing"),
        "position",
    )


def conversion_map_rows(merged: DataFrame, now: Column) -> DataFrame:
    """Rows to upsert by ``legacy_proc``; the item further down the backlog wins (``MAP_ORDER``)."""
    return merged.filter(F.col("map_status").isNotNull()).select(
        "legacy_proc",
        "target_path",
        F.col("map_status").alias("status"),
        now.alias("updated_at"),
        "position",
        "item_id",
    )


def apply_merge(backlog: DataFrame, merged: DataFrame) -> DataFrame:
    """Backlog with the resolved states; a converted item takes the path of its record."""
    resolved = merged.select(
        "item_id",
        F.col("status").alias("_status"),
        F.when(F.col("status") == "converted", F.col("target_path")).alias("_path"),
    )
    return (
        backlog.join(own_exchange(resolved), "item_id", "left")
        .withColumns(
            {
                "status": F.coalesce("_status", "status"),
                "target_path": F.coalesce("_path", "target_path"),
            }
        )
        .select(backlog.columns)
    )


def convert_summary(merged: DataFrame) -> DataFrame:
    """A missing record counts as blocked as well."""
    return merged.agg(
        F.count_if(F.col("status") == "converted").alias("converted"),
        F.count_if(F.col("status") == "blocked").alias("blocked"),
        F.count_if("missing").alias("missing_results"),
        F.count("*").alias("total"),
    )


def check_backlog(backlog: DataFrame, pattern: str = TARGET_PATTERN) -> DataFrame:
    """Path violations, one row per item and rule.

    A shared path yields one row per item that uses it, with the number of its users, and not one
    list per path: the users of a popular path need not fit into one task.
    """
    items = convertible(backlog).select(
        F.coalesce(F.nullif(F.col("item_id"), F.lit("")), F.lit("<missing-item_id>")).alias("item_id"),
        F.coalesce("target_path", F.lit("")).alias("target_path"),
    )
    path = F.col("target_path")
    empty = path == ""
    rules = F.array_compact(
        F.array(
            F.when(empty, F.lit("missing_path")),
            F.when(~empty & path.contains(RETIRED_FOLDER), F.lit("retired_folder")),
            F.when(~empty & ~path.rlike(pattern), F.lit("path_pattern")),
        )
    )
    broken = items.select(
        "item_id", F.explode(rules).alias("rule"), "target_path", F.lit(1).cast("bigint").alias("users")
    )
    named = items.filter(~empty)
    shared = named.groupBy("target_path").agg(F.count("*").alias("users")).filter("users > 1")
    duplicate = named.join(own_exchange(shared), "target_path").select(
        "item_id", F.lit("duplicate_path").alias("rule"), "target_path", "users"
    )
    return broken.unionByName(duplicate)


def deployed_path(path: Column) -> Column:
    """Layer and file name, whatever folder a task list renders them to."""
    tail = F.regexp_extract(path, r"(silver|gold)/[^/]+\.sql$", 0)
    return F.when(tail == "", path).otherwise(tail)


def unwired_targets(backlog: DataFrame, tasks: DataFrame) -> DataFrame:
    """Backlog paths that no deployed task runs; ``tasks`` has a ``path`` column."""
    wanted = backlog.filter(
        (_low("status") != "blocked") & (_low("target_layer") != "n/a")
    ).filter(F.coalesce("target_path", F.lit("")) != "")
    run = own_exchange(tasks.select(deployed_path(F.col("path")).alias("p")).distinct())
    return (
        wanted.select("target_path", deployed_path(F.col("target_path")).alias("p"))
        .join(run, "p", "left_anti")
        .select("target_path")
        .distinct()
        .orderBy("target_path")
    )
