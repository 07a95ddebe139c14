"""Versions of a type-2 dimension stored by when they ended: one open segment, one segment per closing month.

The segment is a function of the end alone, so it is a partition column: ``open`` for versions without an end, the
month for closed ones, ``undated`` for an unknown end. A batch ends open versions and adds new ones, so what changes
is the open segment and the months in which something ends; older months keep their files. A reader of current rows
takes the open segment, a reader as of some time what may still hold then, and both leave whole partitions unread.

The names sort behind all months, so "this month or later" is one comparison of the partition column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.temporal import END_OF_TIME, instant, instant_like
from tidemark.operators.scd import close_off

SEGMENT = "Segment"
# Names of the segments that are no months.
OPEN, UNDATED = "open", "undated"


def _month(at: Column) -> Column:
    return F.date_format(at.cast("timestamp_ntz").cast("date"), "yyyy-MM")


def segment_of(dim: DataFrame, valid_to: str = "Valid To") -> Column:
    end = F.col(f"`{valid_to}`")
    return (
        F.when(end.isNull(), UNDATED)
        .when(end == instant_like(dim, valid_to, END_OF_TIME), OPEN)
        .otherwise(_month(end))
    )


def with_segment(dim: DataFrame, valid_to: str = "Valid To") -> DataFrame:
    return dim.withColumn(SEGMENT, segment_of(dim, valid_to))


def current(dim: DataFrame) -> DataFrame:
    """The open segment alone."""
    return dim.filter(F.col(SEGMENT) == OPEN)


def reaching(dim: DataFrame, since: Column | str) -> DataFrame:
    """Segments whose versions may still hold at ``since`` or later; a superset of those that do."""
    at = since if isinstance(since, Column) else instant(since)
    return dim.filter(F.col(SEGMENT) >= _month(at))


def batch_rows(
    dim: DataFrame, stage: DataFrame, added: DataFrame, business_key: str, valid_from: str = "Valid From",
    valid_to: str = "Valid To",
) -> DataFrame:
    """What a batch writes anew: the open segment after it, the versions it ends, and the rows it adds.

    Closed history is not read. ``added`` are the staged rows in the dimension's shape.
    """
    opened = current(dim).drop(SEGMENT)
    after = close_off(opened, stage, business_key, valid_from, valid_to)
    return with_segment(after.unionByName(added.select(*(f"`{c}`" for c in after.columns))), valid_to)


def touched_segments(rows: DataFrame) -> DataFrame:
    """Segments that a batch's rows belong to, with their number of rows; the open one is always rewritten."""
    return rows.groupBy(SEGMENT).agg(F.count("*").alias("rows"))


def next_segments(dim: DataFrame, rows: DataFrame, touched: list[str]) -> DataFrame:
    """Next content of the touched segments: what they hold already, but for the open one, and the batch's rows."""
    held = dim.filter(F.col(SEGMENT).isin(*touched) & (F.col(SEGMENT) != OPEN))
    return held.unionByName(rows.select(*(f"`{c}`" for c in dim.columns)))
