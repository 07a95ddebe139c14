import json
import tempfile
from datetime import datetime as D

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators import reports
from tidemark.plans.control import BY_RUN, Control, TABLES


@pytest.fixture
def control(spark, request):
    prefix = f"k{abs(hash(request.node.name)) % 10000}_"
    c = Control(spark, tempfile.mkdtemp(prefix="spark-"), "2024-01-02 00:00:00", prefix)
    assert c.create_tables().first()["agent_events_rows"] == 0
    return c


def item(n, **changes):
    doc = {
        "item_id": f"item-{n}",
        "legacy_proc": f"p{n}",
        "classification": "migrate",
        "reads": "a",
        "writes": "b",
        "target_layer": "gold",
        "target_path": f"jobs/gold/{n}.sql",
        "priority": "high",
        "risk_flags": "",
        "status": "pending",
    }
    return json.dumps({**doc, **changes})


def result(n, status="final"):
    return json.dumps(
        {
            "item_id": f"item-{n}",
            "legacy_proc": f"p{n}",
            "target_path": f"jobs/gold/{n}.sql",
            "status": status,
            "notes": "ok",
            "patterns_used": [],
        }
    )


def test_create_is_idempotent(spark, control):
    control.record_event("r", "coordinator", "started")
    assert control.create_tables().first()["agent_events_rows"] == 1
    for table, schema in TABLES.items():
        # A table partitioned by run has the run behind its other columns.
        behind = lambda f: table in BY_RUN and f.name == "run_id"  # noqa: E731, B023
        assert [(f.name, f.dataType) for f in control.read(table).schema] == [
            (f.name, f.dataType) for f in sorted(schema, key=behind)
        ]


def test_backlog_to_conversion_map(spark, control):
    texts = lambda docs: spark.createDataFrame([(d,) for d in docs], "record string")
    control.persist_backlog(texts([item(1), item(2), item(3), item(4, status="done")]))
    with pytest.raises(ValueError, match="priority: not allowed"):
        control.persist_backlog(texts([item(1), item(9, priority="now")]))
    assert control.read("ops.migration_backlog").count() == 4

    found = spark.createDataFrame(
        [("item-1", result(1)), ("item-2", result(2, "blocked"))], "record_id string, record string"
    )
    targets = spark.createDataFrame([("jobs/gold/1.sql",)], "target_path string")
    for _ in range(2):  # merging twice changes nothing more
        summary = control.merge_conversions(found, targets).first()
        assert summary.asDict() == {"converted": 1, "blocked": 2, "missing_results": 1, "total": 3}
    assert rows(control.read("ops.proc_conversion_map"), "legacy_proc", "status") == [
        ("p1", "final"),
        ("p2", "blocked"),
    ]
    assert rows(control.read("ops.migration_backlog"), "item_id", "status") == [
        ("item-1", "converted"),
        ("item-2", "blocked"),
        ("item-3", "blocked"),
        ("item-4", "done"),
    ]


def test_drift_is_reverted(spark, control):
    rows_ = [
        ("f", "t", "row_count", None, "exact_when_expected_set", "n", D(2024, 1, 1)),
        ("g", "t", "row_count", 5, "gte", None, D(2024, 1, 1)),
    ]
    before = control.publish(
        "ops.fixture_expectations", spark.createDataFrame(rows_, schemas.EXPECTATIONS)
    )
    wanted = rows(before)
    control.inject_drift("f", 10)
    assert control.read("ops.fixture_expectations").filter("expected = 10").count() == 1
    with pytest.raises(RuntimeError):
        control.inject_drift("g", 1)
    control.revert_drift()
    assert rows(control.read("ops.fixture_expectations")) == wanted
    with pytest.raises(LookupError):
        control.revert_drift()
    with pytest.raises(LookupError):
        control.inject_drift("nope", 1)


def test_datasets(spark, control):
    control.record_event("r1", "gate", "started", detail="d")
    control.record_event("r1", "test", "completed")
    data = control.datasets()
    assert data["event_summary"].first().asDict() == {"total_events": 2, "runs": 1, "agents": 2}
    assert rows(data["events_by_agent"]) == [("gate", 1), ("test", 1)]
    assert data["events_over_time"].count() == 2
    assert data["latest_events"].count() == 2
    assert data["gate_hero"].count() == 0
    assert data["inventory_counts"].count() == 0
    assert [r["agent"] for r in reports.timeline(control.read("ops.agent_events"), "r1").collect()] == [
        "gate",
        "test",
    ]


def test_reports_on_empty_tables(spark, control):
    assert reports.event_summary(control.read("ops.agent_events")).first()["total_events"] == 0
    flags = reports.thresholds(control.read("ops.migration_inventory")).first()
    assert (flags["requires_confirm"], flags["accepts_tables"]) == (False, False)


def test_failed_checks_and_lineage(spark):
    checks = spark.createDataFrame(
        [(f"c{n}", "t", "1", "2", "1", "fail", "r", D(2024, 1, n)) for n in range(1, 29)]
        + [("ok", "t", "1", "1", "0", "pass", "r", D(2025, 1, 1))],
        schemas.RECONCILE,
    )
    newest = reports.failed_checks(checks, 20).collect()
    assert len(newest) == 20 and newest[0]["check_id"] == "c28"
    assert reports.list_checks(checks, "r").count() == 29
    edges = spark.createDataFrame(
        [("wh.a", "x.b", D(2024, 1, 1)), ("x.a", "wh.b", D(2024, 1, 2)), ("x.a", "x.b", D(2024, 1, 3))],
        schemas.LINEAGE_EDGES,
    )
    found = reports.lineage(edges, "wh.").collect()
    assert [r["event_time"].day for r in found] == [2, 1]
    assert edges.filter(F.col("event_time") > "2024-01-02").count() == 1
