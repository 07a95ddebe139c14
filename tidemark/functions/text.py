"""Case-insensitive views of string columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F


def with_ci(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Collate the named columns; equality and grouping on them then ignore case.

    Meant for views over finished marts. The collation also changes join equality, so it is kept
    out of the stored tables.
    """
    return df.withColumns({c: F.collate(F.col(c), "UTF8_LCASE") for c in cols})
