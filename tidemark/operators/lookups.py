"""Surrogate-key lookups against versioned dimensions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import DataType

from tidemark.operators.keysets import own_exchange

UNKNOWN_KEY = 0
# Longest history that a join compares with each row of its key; longer ones go on a timeline.
LONG_HISTORY = 512


@dataclass(frozen=True)
class Versions:
    """Where a dimension keeps its business key, surrogate key and validity."""

    business_key: str
    key: str
    valid_from: str = "Valid From"
    valid_to: str = "Valid To"


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def effective_versions(dim: DataFrame, v: Versions) -> DataFrame:
    """Disjoint intervals ``(vf, vt]`` of each business key, earliest version first.

    Where versions overlap, the one that starts first owns the overlap, so every instant belongs to
    at most one interval: a version is cut back to what follows the latest end before it.
    """
    rows = dim.select(
        _q(v.business_key).alias("bk"),
        _q(v.key).alias("key"),
        _q(v.valid_from).alias("vf"),
        _q(v.valid_to).alias("vt"),
    ).filter("bk IS NOT NULL AND vf < vt")
    earlier = Window.partitionBy("bk").orderBy("vf", "key").rowsBetween(Window.unboundedPreceding, -1)
    return (
        rows.withColumn("vf", F.greatest(F.col("vf"), F.max("vt").over(earlier)))
        .filter("vf < vt")
        .select("bk", "key", "vf", "vt")
    )


@dataclass(frozen=True)
class Prepared:
    """A dimension's disjoint versions, ready for lookups by any column of a stage."""

    rows: DataFrame
    key_type: DataType


def prepare_versions(dim: DataFrame, v: Versions) -> Prepared:
    """Versions of ``dim`` for as-of lookups; several lookups may share them."""
    return Prepared(effective_versions(dim, v), dim.schema[v.key].dataType)


def lookup_prepared(
    stage: DataFrame,
    versions: Prepared,
    business_key: str,
    ts: str,
    out: str,
    default: int = UNKNOWN_KEY,
) -> DataFrame:
    """``lookup_key_asof`` with versions already prepared."""
    columns = stage.columns
    at = F.col(f"stg.`{ts}`")
    staged = stage.alias("stg")
    match = (
        (F.col(f"stg.`{business_key}`") == F.col("ver.bk"))
        & (at > F.col("ver.vf"))
        & (at <= F.col("ver.vt"))
    )
    return staged.join(own_exchange(versions.rows).alias("ver"), match, "left").select(
        *(F.col(f"stg.`{c}`") for c in columns if c != out),
        F.coalesce(F.col("ver.key"), F.lit(default).cast(versions.key_type)).alias(out),
    )


def lookup_key_asof(
    stage: DataFrame,
    dim: DataFrame,
    v: Versions,
    business_key: str,
    ts: str,
    out: str,
    default: int = UNKNOWN_KEY,
) -> DataFrame:
    """Add ``out``: the key of the version with ``valid_from < ts <= valid_to``, else ``default``.

    The intervals are disjoint, so the left join keeps one row per staged row and no row id or
    second pass over the stage is needed. The business key stays an equality, so the plan is a hash
    or merge join with the range as residual condition. A small dimension is broadcast by its
    statistics and the stage is not shuffled; otherwise AQE may split a hot business key.

    A row is compared with all versions of its key. ``timeline.lookup_key_merged`` finds the same keys where
    histories are long.
    """
    return lookup_prepared(stage, prepare_versions(dim, v), business_key, ts, out, default)


def lookup_key_latest(
    stage: DataFrame,
    dim: DataFrame,
    v: Versions,
    business_key: str,
    out: str,
    default: int = UNKNOWN_KEY,
) -> DataFrame:
    """Add ``out``: the key of the version that ends last, whatever the time; else ``default``."""
    latest = (
        dim.filter(_q(v.business_key).isNotNull())
        .groupBy(_q(v.business_key).alias("bk"))
        .agg(F.max(F.struct(_q(v.valid_to).alias("vt"), _q(v.key).alias("key"))).alias("last"))
        .select("bk", F.col("last.key").alias("key"))
    )
    key_type = dim.schema[v.key].dataType
    columns = [F.col(f"stg.`{c}`") for c in stage.columns if c != out]
    return (
        stage.alias("stg")
        .join(
            own_exchange(latest).alias("ver"),
            F.col(f"stg.`{business_key}`") == F.col("ver.bk"),
            "left",
        )
        .select(*columns, F.coalesce("ver.key", F.lit(default).cast(key_type)).alias(out))
    )


def longest_history(dim: DataFrame, v: Versions) -> int:
    """Versions of the business key that has most of them; 0 for an empty dimension."""
    counted = dim.groupBy(_q(v.business_key).alias("bk")).agg(F.count("*").alias("n"))
    return counted.agg(F.max("n").alias("n")).first()["n"] or 0


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """First row per key in the given order.

    ``row_number() = 1`` lets Spark keep one row per key and task before the shuffle, so a hot key
    moves at most one row per map task.
    """
    ranked = Window.partitionBy(*(_q(k) for k in keys)).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(ranked)).filter("_rn = 1").drop("_rn")
