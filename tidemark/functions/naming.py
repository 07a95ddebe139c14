"""Landing names and batch ids as native expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tidemark.functions.temporal import Instant, instant

# Name prefixes of the two warehouse schemas, and of a batch.
SCHEMA_PREFIX = {"dimension": "dim_", "fact": "fact_"}
BATCH_PREFIX = "bronze-all-"


def snake(text: Column) -> Column:
    """Lower case; every run of other characters becomes one underscore, none at the ends."""
    joined = F.regexp_replace(F.lower(text), "[^a-z0-9]+", "_")
    return F.regexp_replace(joined, "^_|_$", "")


def landing_name(schema: Column, name: Column) -> Column:
    label = F.lower(F.trim(schema))
    prefix = F.concat(snake(schema), F.lit("_"))
    for known, short in SCHEMA_PREFIX.items():
        prefix = F.when(label == known, F.lit(short)).otherwise(prefix)
    # Bound once through a one-element array; written out it would be copied into every branch.
    bound = F.transform(
        F.array(F.concat(prefix, snake(name))),
        lambda raw: F.when(raw == "", F.lit("object"))
        .when(raw.rlike("^[0-9]"), F.concat(F.lit("t_"), raw))
        .otherwise(raw),
    )
    return bound[0]


def batch_id(ts: Instant) -> Column:
    return F.concat(F.lit(BATCH_PREFIX), F.date_format(instant(ts), "yyyyMMddHHmmss"))
