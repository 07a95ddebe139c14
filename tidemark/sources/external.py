"""Read-only scans of source systems, fixtures and JSON records."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tidemark.functions.temporal import Instant, instant_like
from tidemark.operators.counts import count_by_label

# Identifier quotes of each dialect; "jdbc" is the SQL standard.
QUOTES = {"sqlserver": ("[", "]"), "mysql": ("`", "`"), "jdbc": ('"', '"')}


@dataclass(frozen=True)
class Source:
    """A source system: ``sqlserver``, ``mysql`` or ``jdbc`` with a URL, or ``parquet`` with a folder."""

    kind: str
    location: str
    database: str = ""
    options: dict[str, str] = field(default_factory=dict)

    def quoted(self, *parts: str) -> str:
        left, right = QUOTES[self.kind]
        return ".".join(left + p.replace(right, right * 2) + right for p in parts)


# Rows of one range of a split JDBC scan, and the most that may come through one connection.
ROWS_PER_RANGE = 1_000_000
UNSPLIT_ROWS = 5_000_000


def read_query(spark: SparkSession, src: Source, query: str) -> DataFrame:
    """Run a query inside the source, e.g. a catalog join."""
    return (
        spark.read.format("jdbc")
        .options(**src.options)
        .option("url", src.location)
        .option("query", query)
        .load()
    )


def read_source(
    spark: SparkSession,
    src: Source,
    schema: str,
    table: str,
    partition_col: str | None = None,
    num_partitions: int | None = None,
    fetch_size: int = 10_000,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Scan one source table.

    With ``partition_col`` (numeric, date or timestamp) the JDBC read is split into ranges of that
    column between its bounds, about ``rows_per_range`` rows each; bounds and number of rows are one
    aggregate query in the source. Without it a JDBC table arrives through a single connection, so one of
    more than ``UNSPLIT_ROWS`` rows is refused.
    """
    if src.kind == "parquet":
        return spark.read.parquet(f"{src.location}/{schema}/{table}")
    name = src.quoted(schema, table)
    reader = (
        spark.read.format("jdbc")
        .options(**src.options)
        .option("url", src.location)
        .option("dbtable", name)
        .option("fetchsize", str(fetch_size))
    )
    if partition_col:
        column = src.quoted(partition_col)
        low, high, n = read_query(
            spark, src, f"SELECT MIN({column}) AS lo, MAX({column}) AS hi, COUNT(*) AS n FROM {name}"
        ).first()
        if low is not None:
            ranges = num_partitions or max(1, -(-int(n) // rows_per_range))
            reader = reader.options(
                partitionColumn=partition_col,
                lowerBound=str(low),
                upperBound=str(high),
                numPartitions=str(ranges),
            )
    else:
        (n,) = read_query(spark, src, f"SELECT COUNT(*) AS n FROM {name}").first()
        if n > UNSPLIT_ROWS:
            raise ValueError(f"{schema}.{table} has {n} rows; name a column to split its scan by")
    return reader.load()


def count_in_source(
    spark: SparkSession, src: Source, tables: list[tuple[str, str, str]]
) -> DataFrame:
    """``(landing, rows)`` of ``(schema, table, landing)``.

    A database counts its own tables and sends one number each; files are counted by Spark.
    """
    if src.kind == "parquet":
        frames = {(landing,): read_source(spark, src, s, t) for s, t, landing in tables}
        return count_by_label(frames, ["landing"])
    parts = [
        f"SELECT '{landing}' AS landing, COUNT(*) AS n FROM {src.quoted(s, t)}"
        for s, t, landing in tables
    ]
    return read_query(spark, src, " UNION ALL ".join(parts)).select(
        F.trim(F.col("landing")).alias("landing"), F.col("n").cast("bigint").alias("rows")
    )


def register_source_views(
    spark: SparkSession,
    src: Source,
    tables: list[tuple[str, str, str]],
    split_by: Mapping[tuple[str, str], str] | None = None,
    prefix: str = "",
) -> dict[str, DataFrame]:
    """One pass-through view per ``(schema, table, landing_name)``, named by prefix and landing name.

    ``split_by`` names the column that splits a table's scan, by (schema, table).
    """
    views = {}
    for schema, table, landing in tables:
        df = read_source(spark, src, schema, table, (split_by or {}).get((schema, table)))
        df.createOrReplaceTempView(f"{prefix}{landing}")
        views[landing] = df
    return views


def extract_changes(df: DataFrame, ts_col: str, last: Instant, new: Instant) -> DataFrame:
    """Rows changed after the last cutoff up to and including the new one.

    The bounds are literals of the column's type, so the filter is pushed into the scan.
    """
    changed = F.col(f"`{ts_col}`")
    return df.filter(
        (changed > instant_like(df, ts_col, last)) & (changed <= instant_like(df, ts_col, new))
    )


def read_fixture_csv(
    spark: SparkSession, path: str, schema: StructType | str, order_by: str | None = None
) -> DataFrame:
    df = spark.read.csv(path, header=True, schema=schema, timestampFormat="yyyy-MM-dd HH:mm:ss[.SSSSSS]")
    return df.orderBy(f"`{order_by}`") if order_by else df


def read_records(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """JSON records, one document or array of documents per file; a broken one is all NULL."""
    return spark.read.schema(schema).json(path, multiLine=True, mode="PERMISSIVE")


def read_record_texts(spark: SparkSession, path: str) -> DataFrame:
    """Whole JSON documents as text with the name they were filed under, for validation."""
    file = F.element_at(F.split(F.col("_metadata.file_name"), "/"), -1)
    return spark.read.text(path, wholetext=True).select(
        F.regexp_replace(file, r"\.json$", "").alias("record_id"), F.col("value").alias("record")
    )
