"""Row counts of many tables in one job."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda left, right: left.unionByName(right), frames)


def count_by_label(frames: Mapping[tuple[str, ...], DataFrame], labels: Sequence[str]) -> DataFrame:
    """One row per labelled frame, ``(*labels, rows)``, empty frames included.

    Each scan is pruned to no columns at all and every task emits one partial count per frame, so
    a single small shuffle serves any number of tables.
    """
    spark = next(iter(frames.values())).sparkSession
    keys = list(frames)
    zeros = [
        F.struct(
            *(F.lit(value).alias(name) for name, value in zip(labels, key)),
            F.lit(0).cast("bigint").alias("n"),
        )
        for key in keys
    ]
    seed = spark.range(0, 1, 1, 1).select(F.inline(F.array(*zeros)))
    tagged = [
        frame.select(
            *(F.lit(value).alias(name) for name, value in zip(labels, key)),
            F.lit(1).cast("bigint").alias("n"),
        )
        for key, frame in frames.items()
    ]
    return union_all([seed, *tagged]).groupBy(*labels).agg(F.sum("n").alias("rows"))


def smoke(check_name: str, **tables: DataFrame) -> DataFrame:
    """``(check_name, <name>_rows …)``: several table counts in one row."""
    counts = count_by_label({(name,): frame for name, frame in tables.items()}, ["name"])
    return counts.agg(
        F.lit(check_name).alias("check_name"),
        *(
            F.sum(F.when(F.col("name") == name, F.col("rows"))).alias(f"{name}_rows")
            for name in tables
        ),
    ).select("check_name", *(f"{name}_rows" for name in tables))
