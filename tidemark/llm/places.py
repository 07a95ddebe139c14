"""Positions of rows inside their groups, for groups of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tidemark.operators.keysets import own_exchange
from tidemark.session import cut_lineage


def placed(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """Add ``place`` (from 0, in the given order inside the group) and ``n`` (rows of the group).

    The rows are range-partitioned by group and order, NULL first, so a hot group lies over many tasks. Each row
    gets its position in its partition; a checkpoint keeps the layout as it is under a retry. Counts per (group,
    partition), at most one row per partition more than there are groups, are summed up to offsets. Rows that
    equal each other in group and order are numbered in any order.
    """
    columns = [c for c in rows.columns if c not in ("place", "n")]
    keys = [F.col(c).asc_nulls_first() for c in (group, *order)]
    at = cut_lineage(
        rows.select(*columns).repartitionByRange(*keys).sortWithinPartitions(*keys)
        .withColumn("_at", F.monotonically_increasing_id())
    )
    part = F.shiftright("_at", 33)
    counts = at.groupBy(F.col(group).alias("_group"), part.alias("_part")).agg(
        F.min("_at").alias("_first"), F.count("*").alias("_n")
    )
    whole = W.partitionBy("_group")
    offsets = counts.select(
        "_group",
        "_part",
        (F.sum("_n").over(whole.orderBy("_part")) - F.col("_n") - F.col("_first")).alias("_offset"),
        F.sum("_n").over(whole).alias("n"),
    )
    met: Column = F.col(group).eqNullSafe(F.col("_group")) & (part == F.col("_part"))
    return at.join(own_exchange(offsets), met).select(
        *columns, (F.col("_at") + F.col("_offset")).alias("place"), "n"
    )
