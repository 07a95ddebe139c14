"""Load bookkeeping: cutoffs and the lineage of loads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.temporal import Instant, instant
from tidemark.operators.keysets import own_exchange


def get_cutoff(cutoffs: DataFrame, table: str):
    """Cutoff of one table; reads its single row. An unknown table is an error."""
    rows = cutoffs.filter(F.col("`Table Name`") == table).select("`Cutoff Time`").limit(1).collect()
    if not rows:
        raise LookupError(f"no ETL cutoff for table {table!r}")
    return rows[0][0]


def open_load(lineage: DataFrame, table: str, cutoff: Instant, now: Instant) -> DataFrame:
    """Lineage with one more, unfinished load whose key is the next free one."""
    types = {f.name: f.dataType for f in lineage.schema.fields}
    values = {
        "Lineage Key": F.coalesce(F.max("`Lineage Key`"), F.lit(0)) + 1,
        "Data Load Started": instant(now),
        "Table Name": F.lit(table),
        "Data Load Completed": F.lit(None),
        "Was Successful": F.lit(False),
        "Source System Cutoff Time": instant(cutoff),
    }
    new = lineage.agg(*(values[name].cast(kind).alias(name) for name, kind in types.items()))
    return lineage.unionByName(new)


def has_cutoff(lineage: DataFrame, key: int, cutoff: Instant) -> bool:
    """Whether a load was opened for this cutoff; reads its single row."""
    mine = lineage.filter(F.col("`Lineage Key`") == key)
    return bool(mine.filter(F.col("`Source System Cutoff Time`") == instant(cutoff)).head(1))


def restamp(lineage: DataFrame, key: int, cutoff: Instant) -> DataFrame:
    """The lineage with another cutoff for one load."""
    stamped = F.when(F.col("`Lineage Key`") == key, instant(cutoff)).otherwise(
        F.col("`Source System Cutoff Time`")
    )
    return lineage.withColumn("Source System Cutoff Time", stamped)


def open_key(lineage: DataFrame, table: str) -> DataFrame:
    """Greatest key of the unfinished loads of a table, NULL if there is none."""
    return lineage.filter(
        (F.col("`Table Name`") == table) & F.col("`Data Load Completed`").isNull()
    ).agg(F.max("`Lineage Key`").alias("lineage_key"))


def require_open_key(lineage: DataFrame, table: str) -> int:
    """``open_key`` as a number. Without an open load a run must not touch the cutoff."""
    key = open_key(lineage, table).first()["lineage_key"]
    if key is None:
        raise LookupError(f"no open load for table {table!r}")
    return key


def complete_load(lineage: DataFrame, key: int | Column, now: Instant) -> DataFrame:
    done = F.col("`Lineage Key`") == key
    return lineage.withColumns(
        {
            "Data Load Completed": F.when(
                done, instant(now, lineage.schema["Data Load Completed"].dataType)
            ).otherwise(F.col("`Data Load Completed`")),
            "Was Successful": F.when(done, F.lit(True)).otherwise(F.col("`Was Successful`")),
        }
    )


def advance_cutoff(cutoffs: DataFrame, lineage: DataFrame, key: int | Column) -> DataFrame:
    """Set the cutoff of the load's table to the one the load was opened with."""
    load = lineage.filter(F.col("`Lineage Key`") == key).select(
        "`Table Name`", F.col("`Source System Cutoff Time`").alias("_reached"), F.lit(1).alias("_hit")
    )
    return (
        cutoffs.join(own_exchange(load), "Table Name", "left")
        .withColumn(
            "Cutoff Time",
            F.when(F.col("_hit").isNotNull(), F.col("_reached")).otherwise(F.col("`Cutoff Time`")),
        )
        .select(*(f"`{c}`" for c in cutoffs.columns))
    )


def close_load(
    lineage: DataFrame, cutoffs: DataFrame, key: int | Column, now: Instant
) -> tuple[DataFrame, DataFrame]:
    """Completed lineage and advanced cutoffs; publish them in this order, after the data."""
    return complete_load(lineage, key, now), advance_cutoff(cutoffs, lineage, key)
