"""Time literals and version-validity predicates.

Every operator takes "now" as an argument, so that two runs over the same tables agree. Source
``datetime2(7)`` columns are ``TIMESTAMP_NTZ`` here; the seventh digit of the end-of-time literal is
below Spark's microsecond and is dropped.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DataType

# Open versions end here.
END_OF_TIME = "9999-12-31 23:59:59.999999"
OPEN_DATE = "9999-12-31"

Instant = str | datetime | Column


def instant(value: Instant, dtype: str | DataType = "timestamp_ntz") -> Column:
    if isinstance(value, Column):
        return value.cast(dtype)
    text = value if isinstance(value, str) else value.isoformat(sep=" ")
    return F.lit(text).cast(dtype)


def instant_like(df: DataFrame, column: str, value: Instant) -> Column:
    """Literal of the column's own type, so the comparison needs no cast and reaches the scan."""
    return instant(value, df.schema[column].dataType)


def is_open(valid_to: Column) -> Column:
    """True for a version without an end; never NULL."""
    return F.when(
        valid_to.isNull() | (valid_to.cast("date") == F.lit(OPEN_DATE).cast("date")), True
    ).otherwise(False)


def minute_of(ts: Column) -> Column:
    """Start of the minute. ``date_trunc`` would pass zone-less times through the session zone."""
    return ts - F.make_dt_interval(secs=F.extract(F.lit("SECOND"), ts))
