"""Bronze landing: audit columns, batch id and the load-control rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions import naming
from tidemark.functions.temporal import Instant, instant
from tidemark.operators.counts import count_by_label

# How a source type is named in the audit column.
SOURCE_SYSTEM = {"sqlserver": "azure_sql", "mysql": "mysql"}


def land(df: DataFrame, source_system: str, batch: str | Column, loaded_at: Instant) -> DataFrame:
    """``SELECT *`` plus three audit columns; spaced source names are kept as they are."""
    return df.withColumns(
        {
            "_bronze_loaded_at": instant(loaded_at),
            "_source_system": F.lit(source_system),
            "_batch_id": batch if isinstance(batch, Column) else F.lit(batch),
        }
    )


def load_control_rows(
    landed: Mapping[str, DataFrame], batch: str | Column, started: Instant, ended: Instant
) -> DataFrame:
    """One audit row per landed table."""
    counts = count_by_label({(name,): frame for name, frame in landed.items()}, ["landing"])
    return counts.select(
        F.concat(F.lit("bronze."), "landing").alias("table_name"),
        (batch if isinstance(batch, Column) else F.lit(batch)).alias("batch_id"),
        F.col("rows").alias("row_count"),
        instant(started).alias("started_at"),
        instant(ended).alias("ended_at"),
        F.lit("ok").alias("status"),
    )


def with_landing_names(tables: DataFrame) -> DataFrame:
    return tables.withColumn(
        "landing_name", naming.landing_name(F.col("source_schema"), F.col("source_name"))
    )


def landing_collisions(inventory: DataFrame) -> DataFrame:
    """Landing names shared by several source tables; a run must stop when there is any."""
    return (
        inventory.filter("object_type = 'table' AND skip = false")
        .groupBy("landing_name")
        .agg(F.count("*").alias("tables"))
        .filter("tables > 1")
    )
