"""What a source system holds: base tables and routines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions.naming import landing_name
from tidemark.functions.temporal import Instant, instant
from tidemark.operators.counts import union_all
from tidemark.sources.external import Source, read_query

# Schemas never migrated, schemas of the managed catalog, routine schemas.
SYSTEM_SCHEMAS = (
    "sys",
    "information_schema",
    "guest",
    "db_owner",
    "db_accessadmin",
    "db_securityadmin",
    "db_ddladmin",
    "db_backupoperator",
    "db_datareader",
    "db_datawriter",
    "db_denydatareader",
    "db_denydatawriter",
    "mysql",
    "performance_schema",
)
MANAGED_SCHEMAS = ("bronze", "silver", "gold", "ops", "source_fed")
ROUTINE_SCHEMAS = ("Integration", "Configuration", "Application")

ROUTINES = "object_type string, source_schema string, source_name string, definition string"


def catalog_tables(spark: SparkSession, src: Source) -> DataFrame:
    return read_query(
        spark,
        src,
        "SELECT table_schema, table_name, table_type FROM information_schema.tables",
    ).toDF("table_schema", "table_name", "table_type")


def base_tables(catalog: DataFrame) -> DataFrame:
    return catalog.filter(
        (F.col("table_type") == "BASE TABLE")
        & ~F.lower("table_schema").isin(*SYSTEM_SCHEMAS)
    )


def discover_tables(catalog: DataFrame) -> DataFrame:
    """Inventory rows of the base tables, with their landing names."""
    return (
        base_tables(catalog)
        .select(
            F.lit("table").alias("object_type"),
            F.col("table_schema").alias("source_schema"),
            F.col("table_name").alias("source_name"),
            landing_name(F.col("table_schema"), F.col("table_name")).alias("landing_name"),
            F.lit(False).alias("skip"),
            F.lit(None).cast("string").alias("skip_reason"),
        )
        .orderBy("source_schema", "source_name")
    )


def routine_query(src: Source) -> str:
    """Procedures and functions with their text, joined inside the source."""
    if src.kind == "sqlserver":
        schemas = ", ".join(f"'{s}'" for s in ROUTINE_SCHEMAS)
        return (
            "SELECT 'proc' AS object_type, sch.name AS source_schema, obj.name AS source_name, "
            "mod.definition AS definition FROM sys.objects obj "
            "JOIN sys.schemas sch ON sch.schema_id = obj.schema_id "
            "JOIN sys.sql_modules mod ON mod.object_id = obj.object_id "
            f"WHERE obj.type = 'P' AND sch.name IN ({schemas})"
        )
    database = src.database.replace("'", "''")
    return (
        "SELECT CASE routine_type WHEN 'PROCEDURE' THEN 'proc' ELSE 'function' END AS object_type, "
        "routine_schema AS source_schema, routine_name AS source_name, "
        "routine_definition AS definition FROM information_schema.routines "
        f"WHERE routine_schema = '{database}'"
    )


def discover_routines(spark: SparkSession, src: Source) -> tuple[DataFrame, str | None]:
    """Routines of the source, or none and the reason they are skipped."""
    nothing = spark.createDataFrame([], ROUTINES)
    if src.kind == "parquet":
        return nothing, "files have no routines"
    if not src.location or (src.kind == "mysql" and not src.database):
        return nothing, "source settings incomplete; routines skipped"
    try:
        # Spark connects while it reads the schema, so an unreachable source fails here.
        found = read_query(spark, src, routine_query(src))
    except Exception as problem:
        first_line = (str(problem).splitlines() or ["unknown error"])[0]
        return nothing, f"routine list failed; routines skipped ({first_line})"
    named = found.toDF("object_type", "source_schema", "source_name", "definition")
    # Some sources pad the CASE literals to one length.
    return named.withColumn("object_type", F.trim("object_type")), None


def inventory(
    tables: DataFrame, routines: DataFrame, run_id: str, now: Instant
) -> DataFrame:
    """Control-table rows of one run."""
    procs = routines.select(
        "object_type",
        "source_schema",
        "source_name",
        F.lit(None).cast("string").alias("landing_name"),
        F.lit(False).alias("skip"),
        F.lit(None).cast("string").alias("skip_reason"),
    )
    return tables.unionByName(procs).select(
        F.lit(run_id).alias("run_id"), "*", instant(now).alias("discovered_at")
    )


def source_smoke(catalog: DataFrame, schemas: DataFrame) -> DataFrame:
    """Base tables in the source, and whether all managed schemas (``schema_name``) exist."""
    tables = base_tables(catalog).select(
        F.lit(1).cast("bigint").alias("t"), F.lit(None).cast("string").alias("s")
    )
    managed = schemas.filter(F.lower("schema_name").isin(*MANAGED_SCHEMAS)).select(
        F.lit(None).cast("bigint").alias("t"), F.lower("schema_name").alias("s")
    )
    return union_all([tables, managed]).agg(
        F.lit("federation_smoke_ok").alias("check_name"),
        F.count("t").alias("foreign_base_tables"),
        (F.count_distinct("s") == len(MANAGED_SCHEMAS)).alias("managed_schemas_ok"),
    )
