"""Schemas of the control tables and of the JSON records. Column names and order are fixed values."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

_TYPES = {
    "string": StringType(),
    "bigint": LongType(),
    "int": IntegerType(),
    "boolean": BooleanType(),
    "timestamp_ntz": TimestampNTZType(),
}


def _table(columns: str) -> StructType:
    """Schema from ``name type [not null]`` items; unlike DDL parsing it needs no session."""
    fields = []
    for item in columns.replace("`", "").split(","):
        declared = item.strip().removesuffix(" not null")
        name, kind = declared.rsplit(" ", 1)
        fields.append(StructField(name, _TYPES[kind], nullable=declared == item.strip()))
    return StructType(fields)


LOAD_CONTROL = _table(
    "table_name string not null, batch_id string not null, row_count bigint, "
    "started_at timestamp_ntz not null, ended_at timestamp_ntz, status string not null"
)
INVENTORY = _table(
    "run_id string, object_type string not null, source_schema string not null, "
    "source_name string not null, landing_name string, skip boolean not null, skip_reason string, "
    "discovered_at timestamp_ntz not null"
)
BACKLOG = _table(
    "item_id string not null, legacy_proc string not null, classification string not null, "
    "reads string, writes string, target_layer string, target_path string, priority string, "
    "risk_flags string, status string not null, updated_at timestamp_ntz not null"
)
CONVERSION_MAP = _table(
    "legacy_proc string not null, target_path string not null, status string not null, "
    "updated_at timestamp_ntz not null"
)
RECONCILE = _table(
    "check_id string not null, table_name string not null, expected string, actual string, "
    "delta string, result string not null, run_id string not null, ts timestamp_ntz not null"
)
EXPECTATIONS = _table(
    "fixture_name string not null, target_table string not null, metric string not null, "
    "expected bigint, compare string not null, notes string, staged_at timestamp_ntz not null"
)
MANIFEST = _table(
    "run_id string not null, gate string not null, tables_total int, tables_landed int, "
    "procs_total int, procs_converted int, summary_json string, updated_at timestamp_ntz not null"
)
EVENTS = _table(
    "run_id string, agent string not null, event string not null, tool string, detail string, "
    "ts timestamp_ntz not null"
)
LINEAGE_EDGES = _table(
    "source_table_full_name string, target_table_full_name string, event_time timestamp_ntz"
)
LOADS = _table(
    "`Lineage Key` bigint, `Data Load Started` timestamp_ntz, `Table Name` string, "
    "`Data Load Completed` timestamp_ntz, `Was Successful` boolean, "
    "`Source System Cutoff Time` timestamp_ntz"
)
CUTOFFS = _table("`Table Name` string, `Cutoff Time` timestamp_ntz")

# JSON records, as DDL for the JSON reader.
BACKLOG_RECORD = (
    "item_id string, legacy_proc string, classification string, reads string, writes string, "
    "target_layer string, target_path string, priority string, risk_flags string, status string"
)
CONVERT_RESULT = (
    "item_id string, legacy_proc string, target_path string, status string, notes string, "
    "patterns_used array<string>"
)
def context_record(host_field: str) -> str:
    return (
        "run_id string, source_type string, foreign_catalog string, uc_catalog string, "
        "source_database string, legacy_proc_schema string, scoped_tables array<string>, "
        f"`{host_field}` string, max_retries int, attempt int, demo_mode boolean, "
        "routines_skipped_reason string"
    )


RECONCILE_REPORT = (
    "run_id string, checks array<struct<check_id:string,`table`:string,expected:string,"
    "actual:string,delta:string,result:string>>, "
    "summary struct<passed:bigint,failed:bigint,total:bigint>"
)
MANIFEST_RECORD = (
    "run_id string, gate string, "
    "blockers array<struct<id:string,message:string,backlog_item_id:string>>, "
    "converted_artifacts array<struct<legacy_proc:string,target_path:string,status:string>>, "
    "attempt int, summary struct<backlog_total:bigint,backlog_converted:bigint,"
    "tables_total:bigint,tables_landed:bigint,procs_total:bigint,procs_converted:bigint,"
    "reconcile_passed:bigint,reconcile_failed:bigint,agent_events_recorded:bigint>"
)
