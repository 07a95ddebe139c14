"""Applying a staged batch to a type-2 dimension, and numbering its new rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.temporal import END_OF_TIME, instant_like
from tidemark.operators.keysets import own_exchange
from tidemark.session import cut_lineage


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def close_off(
    dim: DataFrame,
    stage: DataFrame,
    business_key: str,
    valid_from: str = "Valid From",
    valid_to: str = "Valid To",
) -> DataFrame:
    """End the open rows of every staged business key at its first staged change.

    Rows already closed bypass the join: at scale they are nearly the whole table, and only the open
    ones need to meet the staged minima.
    """
    open_row = _q(valid_to) == instant_like(dim, valid_to, END_OF_TIME)
    first = stage.groupBy(_q(business_key).alias("bk")).agg(
        F.min(_q(valid_from)).alias("first_change")
    )
    closed = dim.filter(~open_row | _q(valid_to).isNull())
    ended = (
        dim.filter(open_row)
        .join(own_exchange(first), _q(business_key) == F.col("bk"), "left")
        .withColumn(valid_to, F.coalesce("first_change", _q(valid_to)))
        .select(*(_q(c) for c in dim.columns))
    )
    return closed.unionByName(ended)


def staged_rows(dim: DataFrame, stage: DataFrame, lineage_key: int | Column) -> DataFrame:
    """All staged rows in the shape of the dimension; a missing surrogate key is NULL."""
    stamp = lineage_key if isinstance(lineage_key, Column) else F.lit(lineage_key)
    values = {c: _q(c) for c in stage.columns}
    values["Lineage Key"] = stamp
    return stage.select(
        *(
            values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
            for f in dim.schema.fields
        )
    )


def scd2_apply(
    dim: DataFrame,
    stage: DataFrame,
    business_key: str,
    lineage_key: int | Column,
    valid_from: str = "Valid From",
    valid_to: str = "Valid To",
) -> DataFrame:
    """Next state of the dimension: open rows closed off, every staged row appended unchanged.

    An unchanged row still makes a new version, and rows with a NULL business key are appended
    without closing anything. Applying the same batch twice would append it twice; the incremental
    run checks ``already_applied`` first.
    """
    return close_off(dim, stage, business_key, valid_from, valid_to).unionByName(
        staged_rows(dim, stage, lineage_key)
    )


def already_applied(dim: DataFrame, lineage_key: int) -> DataFrame:
    """One row if the load has already been published into the dimension, else none."""
    return dim.filter(F.col("`Lineage Key`") == lineage_key).select("`Lineage Key`").limit(1)


def assign_keys(
    rows: DataFrame, key: str, order: list[str], start: int | Column = 1
) -> DataFrame:
    """Number the rows ``start, start+1, …`` in the given order without a one-partition sort.

    The rows are range-partitioned and sorted, each gets its position inside its partition, and the
    result is checkpointed, so the layout cannot change under a retry. The offsets are running sums
    of one count per partition. ``order`` should be a total order.
    """
    columns = [c for c in rows.columns if c != key]
    placed = cut_lineage(
        rows.repartitionByRange(*(_q(c) for c in order))
        .sortWithinPartitions(*(_q(c) for c in order))
        .select(*(_q(c) for c in columns), F.monotonically_increasing_id().alias("_place"))
    )
    # The upper bits of the id are the partition, the lower 33 the position in it.
    part = F.shiftright("_place", 33)
    counts = placed.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    # One row per partition of the numbered rows: bounded by the partition count, not by the data.
    sizes = {row["part"]: row["n"] for row in counts.collect()}
    offset, offsets = 0, []
    for number in sorted(sizes):
        offsets.append((number, offset))
        offset += sizes[number]
    spark = rows.sparkSession
    table = spark.createDataFrame(offsets, "part bigint, before bigint")
    first = start if isinstance(start, Column) else F.lit(start)
    place = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        placed.withColumn("part", part)
        .join(F.broadcast(table), "part")
        .select(*(_q(c) for c in columns), (first + F.col("before") + place).alias(key))
    )
