"""Reduced right sides for joins with a possibly skewed left side."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def own_exchange(reduced: DataFrame) -> DataFrame:
    """Detach a grouped frame from the partitioning of its group keys.

    AQE splits a hot key of a shuffled join only where both inputs come straight from the join's own
    exchange. A grouped or windowed side already has the right partitioning, so Spark would skip
    that exchange and leave the hot key in one task. The rebalance costs one more shuffle of the
    reduced side, and its measured size also decides about a broadcast.
    """
    return reduced.hint("rebalance")


def key_set(keys: DataFrame, flag: str) -> DataFrame:
    """Distinct keys with a presence flag, for a left join that must not multiply rows."""
    return own_exchange(keys.distinct().withColumn(flag, F.lit(True)))
