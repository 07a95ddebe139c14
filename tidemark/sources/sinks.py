"""Table sinks.

Plain parquet tables cannot be replaced while a plan reads them, and an overwrite in place leaves
readers without files. A full refresh therefore writes a new version folder and then points the
table at it; a reader sees the old version or the new one. Over several tables there is no
atomicity, so callers publish in dependency order.
"""

from __future__ import annotations

import time
import uuid
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructField

from tidemark.operators.keysets import own_exchange


def create_layers(spark: SparkSession, root: str, layers: tuple[str, ...], prefix: str = "") -> None:
    for layer in layers:
        spark.sql(
            f"CREATE DATABASE IF NOT EXISTS `{prefix}{layer}` LOCATION '{root}/{prefix}{layer}.db'"
        )


def table_exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table)


def refresh(df: DataFrame, table: str, root: str) -> DataFrame:
    """Full refresh; returns the table as published. ``df`` may read the table itself.

    New columns behind the known ones are added to the definition. Any other change of columns makes a
    new definition beside the old one, complete with its files, which then takes over the name.
    """
    spark = df.sparkSession
    version = _version()
    folder = f"{root}/{table.replace('.', '/')}/v={version}"
    df.write.mode("errorifexists").parquet(folder)
    added = _added_columns(spark, table, df) if table_exists(spark, table) else None
    if added is not None:
        _add_columns(spark, table, added)
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{folder}'")
        spark.catalog.refreshTable(table)
    elif table_exists(spark, table):
        successor = f"{table}__{version.replace('-', '_')}"
        spark.catalog.createTable(successor, path=folder, source="parquet")
        take_over(spark, successor, table)
    else:
        spark.catalog.createTable(table, path=folder, source="parquet")
    return spark.table(table)


def take_over(spark: SparkSession, successor: str, table: str) -> None:
    """Give a table's name to its complete successor. External: dropping the old definition leaves its files."""
    spark.sql(f"DROP TABLE {table}")
    spark.sql(f"ALTER TABLE {successor} RENAME TO {table}")
    spark.catalog.refreshTable(table)


def _version() -> str:
    return f"{time.time_ns()}-{uuid.uuid4().hex[:8]}"


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def written_partitions(spark: SparkSession, folder: str, partition: str) -> dict[str | None, str]:
    """Partition values of a folder Spark has written, with their paths, from the folder names alone.

    One entry per partition folder; no file is opened and no type is guessed.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = {}
    for status in files.listStatus(path):
        name = status.getPath().getName()
        if status.isDirectory() and "=" in name:
            # Spark escapes special characters as %XX. The fixed name stands for NULL.
            value = unquote(name.split("=", 1)[1])
            found[None if value == "__HIVE_DEFAULT_PARTITION__" else value] = f"{folder}/{name}"
    return found


def known_partitions(spark: SparkSession, table: str) -> set[str | None]:
    listed = spark.sql(f"SHOW PARTITIONS {table}").collect()
    values = {unquote(row[0].split("=", 1)[1]) for row in listed}
    return {None if v in ("__HIVE_DEFAULT_PARTITION__", "null") else v for v in values}


def refresh_partitions(
    df: DataFrame, table: str, root: str, partition: str, touched: list[str | None], find_by: str | None = None
) -> DataFrame:
    """Replace the ``touched`` partitions of a table with the rows of ``df``; others keep their files.

    All rows go to one new version folder in one job. Then the catalog is edited by one statement that
    takes out the old partitions and one that puts in the new ones. A touched partition without rows is
    gone. The rebalance packs a partition into few files and splits one that holds most rows. Columns
    behind the known ones are added; any other change of columns is an error, as it concerns all partitions.

    ``find_by`` names a key by which rows will be looked up: rows of a file are sorted by it and its row groups
    carry a Bloom filter of it, so that a lookup of few keys skips most of them.
    """
    spark = df.sparkSession
    folder = f"{root}/{table.replace('.', '/')}/v={_version()}"
    columns = [c for c in df.columns if c != partition]
    ordered = df.select(*(F.col(f"`{c}`") for c in [*columns, partition]))
    if not table_exists(spark, table):
        declared = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ordered.schema.fields)
        spark.sql(
            f"CREATE TABLE {table} ({declared}) USING parquet PARTITIONED BY (`{partition}`) "
            f"LOCATION '{root}/{table.replace('.', '/')}/base'"
        )
    if partition not in {c.name for c in spark.catalog.listColumns(table) if c.isPartition}:
        raise ValueError(f"{table} is not partitioned by {partition}; publish it anew")
    added = _added_columns(spark, table, ordered, partition)
    if added is None:
        raise ValueError(f"{table}: columns changed; publish the whole table with refresh")
    packed = ordered.hint("rebalance", F.col(f"`{partition}`"))
    if find_by:
        packed = packed.sortWithinPartitions(F.col(f"`{partition}`"), F.col(f"`{find_by}`"))
    writer = packed.write.partitionBy(partition).mode("errorifexists")
    if find_by:
        writer = writer.option(f"parquet.bloom.filter.enabled#{find_by}", "true")
    writer.parquet(folder)
    _add_columns(spark, table, added)
    written = written_partitions(spark, folder, partition)
    spec = lambda v: f"PARTITION (`{partition}` = {'null' if v is None else _literal(v)})"
    order = lambda values: sorted(values, key=lambda v: (v is not None, v or ""))
    gone = order((set(touched) | set(written)) & known_partitions(spark, table))
    if gone:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS " + ", ".join(map(spec, gone)))
    if written:
        placed = (f"{spec(v)} LOCATION {_literal(written[v])}" for v in order(written))
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS " + " ".join(placed))
    spark.catalog.refreshTable(table)
    return spark.table(table)


def _added_columns(
    spark: SparkSession, table: str, df: DataFrame, partition: str | None = None
) -> list[StructField] | None:
    """Columns of ``df`` behind those of the table, or None if it is not the table's columns and more."""
    plain = lambda schema: [f for f in schema.fields if f.name != partition]
    old, new = plain(spark.table(table).schema), plain(df.schema)
    known = [(f.name, f.dataType) for f in old]
    return new[len(old) :] if known == [(f.name, f.dataType) for f in new[: len(old)]] else None


def _add_columns(spark: SparkSession, table: str, fields: list[StructField]) -> None:
    if fields:
        declared = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({declared})")


def append(df: DataFrame, table: str, root: str, cluster: tuple[str, ...] = ()) -> None:
    """Append to a log table, creating it on first use.

    ``cluster`` sorts what is appended by range, so that file statistics can skip files of the log.
    """
    spark = df.sparkSession
    if cluster:
        df = df.repartitionByRange(*cluster).sortWithinPartitions(*cluster)
    if not table_exists(spark, table):
        refresh(df, table, root)
        return
    columns = spark.table(table).columns
    df.select(*(f"`{c}`" for c in columns)).write.mode("append").insertInto(table)


def append_missing(
    df: DataFrame, table: str, root: str, keys: tuple[str, ...], within: Column, cluster: tuple[str, ...] = ()
) -> None:
    """Append the rows whose ``keys`` the log does not hold yet, so that a step may be repeated.

    ``within`` bounds where such rows can be, by columns the log's files are told apart by. NULL keys are equal. An append
    is one job with one commit, so a crash leaves all of it or nothing, and a repetition adds what is missing.
    """
    spark = df.sparkSession
    if table_exists(spark, table):
        known = spark.table(table).filter(within).select(*(F.col(f"`{k}`").alias(f"_{i}") for i, k in enumerate(keys)))
        met = [F.col(f"`{k}`").eqNullSafe(F.col(f"_{i}")) for i, k in enumerate(keys)]
        df = df.join(own_exchange(known.distinct()), met, "left_anti")
    append(df, table, root, cluster)


def write_events(df: DataFrame, path: str, mode: str = "append") -> None:
    """Write the event log clustered by run and time, so that file statistics can skip files.

    The ranges include the time, so a run with most of the events is spread over many files.
    """
    (
        df.repartitionByRange("run_id", "ts")
        .sortWithinPartitions("run_id", "ts")
        .write.mode(mode)
        .parquet(path)
    )


def bucketed_copy(df: DataFrame, table: str, key: str, buckets: int) -> None:
    """Store a table bucketed by a key, so that joins and deletes on the key need no shuffle of it."""
    df.write.bucketBy(buckets, key).sortBy(key).mode("overwrite").format("parquet").saveAsTable(table)
