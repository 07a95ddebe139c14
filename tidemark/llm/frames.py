"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
import re
import shutil
import tempfile
from collections.abc import Callable
from functools import lru_cache

import pyarrow as pa
from pyspark import SparkContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

# A word is a run of characters other than the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
# Rows of an Arrow batch that are Python objects at a time.
SLICE_ROWS = 512
# Most of an Arrow batch: some MB of ordinary documents, and a bound for long ones.
BATCH_ROWS, BATCH_BYTES = 2048, "16m"
WORD_RE = re.compile(WORD)
WORD_RE_BYTES = re.compile(WORD.encode())


@lru_cache(maxsize=8)
def _ship(application: str) -> None:
    import tidemark

    top = os.path.dirname(os.path.abspath(tidemark.__path__[0]))
    archive = os.path.join(tempfile.mkdtemp(prefix="spark-"), "tidemark_package")
    path = shutil.make_archive(archive, "zip", top, "tidemark")
    SparkContext.getOrCreate().addPyFile(path)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, as functions of it run in their tasks.

    Also bounds the Arrow batches of the session, which both the JVM and Python hold in memory, unless it
    has smaller ones already.
    """
    _ship(spark.sparkContext.applicationId)
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


_REMEMBERED: dict[str, Callable[[], None]] = {}


def remember_as(owner: str, forget: Callable[[], None]) -> None:
    """Say how to drop what an operator remembers in this Python worker between tasks.

    Workers outlive operators. When one operator's tasks begin, what the others remembered goes.
    """
    _REMEMBERED[owner] = forget


def forget_others(owner: str) -> None:
    for name in [n for n in _REMEMBERED if n != owner]:
        _REMEMBERED.pop(name)()


def arrow_column(function: Callable, returns: str | T.DataType, *columns: str | Column) -> Column:
    """``function(list, …) -> pyarrow array`` as a column, one Arrow batch at a time.

    Marked as not deterministic, so that Catalyst does not evaluate it once for a filter and once
    more for the projection.
    """
    def batch(*arrays: pa.Array) -> pa.Array:
        forget_others(function.__module__)
        # Slices keep what lies between Arrow and Arrow small, however large the batch.
        starts = range(0, max(1, len(arrays[0])), SLICE_ROWS)
        parts = [function(*(a.slice(i, SLICE_ROWS).to_pylist() for a in arrays)) for i in starts]
        whole = pa.concat_arrays(parts)
        del parts
        pa.default_memory_pool().release_unused()
        return whole

    ship_package(SparkSession.getActiveSession())
    # The annotations decide the kind of UDF, so they are set for the number of inputs at hand.
    if len(columns) == 1:

        def one(a: pa.Array) -> pa.Array:
            return batch(a)

        wrapped = F.arrow_udf(one, returns)
    else:

        def two(a: pa.Array, b: pa.Array) -> pa.Array:
            return batch(a, b)

        wrapped = F.arrow_udf(two, returns)
    return wrapped.asNondeterministic()(*columns)


def empty_like(df: DataFrame, schema: str) -> DataFrame:
    return df.sparkSession.createDataFrame([], schema)


def local_table(spark: SparkSession, columns: dict[str, tuple[list, pa.DataType]]) -> DataFrame:
    """A bounded list as a local relation: Spark knows its bytes and weighs them before broadcasting."""
    return spark.createDataFrame(pa.table({n: pa.array(v, kind) for n, (v, kind) in columns.items()}))
