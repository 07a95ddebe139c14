import json

import pytest

from tidemark.operators import backlog as bl, records
from conftest import rows
from tidemark.sources.external import read_record_texts, read_records
from tidemark import schemas

CHECK = {"check_id": "c", "table": "t", "expected": "1", "actual": "1", "delta": "0", "result": "pass"}
GOOD = {
    "context": {
        "run_id": "7d1f3a52-9c04-4e6b-8a7e-2f60c1b9d3e8",
        "source_type": "sqlserver",
        "foreign_catalog": "f",
        "uc_catalog": "c",
        "scoped_tables": ["a", "b"],
        "workspace_host": "https://example.test",
        "max_retries": 2,
        "attempt": 0,
        "demo_mode": True,
        "routines_skipped_reason": None,
    },
    "convert_result": {
        "item_id": "task-17",
        "legacy_proc": "p",
        "target_path": "jobs/gold/x.sql",
        "status": "final",
        "notes": "",
        "patterns_used": ["scd2"],
    },
    "migration_backlog": {
        "item_id": "task-17",
        "legacy_proc": "p",
        "classification": "migrate",
        "reads": "a",
        "writes": "b",
        "target_layer": "gold",
        "target_path": "x",
        "priority": "high",
        "risk_flags": "",
        "status": "converted",
    },
    "reconcile_report": {
        "run_id": "r",
        "checks": [CHECK],
        "summary": {"passed": 1, "failed": 0, "total": 1},
    },
    "migration_manifest": {
        "run_id": "7d1f3a52-9c04-4e6b-8a7e-2f60c1b9d3e8",
        "gate": "fail",
        "blockers": [{"id": "b", "message": "m"}],
        "converted_artifacts": [{"legacy_proc": "p", "target_path": "x", "status": "final"}],
        "attempt": 0,
        "summary": {"tables_total": 1},
    },
}


def without(doc, key):
    return {k: v for k, v in doc.items() if k != key}


BAD = [
    ("context", {"run_id": "short"}, "run_id: pattern"),
    ("context", {"source_type": "oracle"}, "source_type: not allowed"),
    ("context", {"foreign_catalog": ""}, "foreign_catalog: too short"),
    ("context", {"max_retries": 6}, "max_retries: above 5"),
    ("context", {"max_retries": -1}, "max_retries: below 0"),
    ("context", {"max_retries": "2"}, "max_retries: type"),
    ("context", {"max_retries": 1.5}, "max_retries: type"),
    ("context", {"max_retries": 10**20}, "max_retries: above 5"),
    ("context", {"max_retries": -(10**60)}, "max_retries: below 0"),
    ("context", {"attempt": -3000000000}, "attempt: below 0"),
    ("context", {"attempt": 3000000000}, "attempt: outside its type"),
    ("reconcile_report", {"summary": {"passed": 10**19, "failed": 0, "total": 1}}, "summary.passed: outside its type"),
    ("reconcile_report", {"summary.total": 0}, "unknown: summary.total"),
    ("reconcile_report", {"summary": None}, "summary: type"),
    ("reconcile_report", {"checks": {"check_id": 1}}, "checks: type"),
    ("context", {"demo_mode": "yes"}, "demo_mode: type"),
    ("context", {"scoped_tables": ["a", 1]}, "scoped_tables[]: type"),
    ("context", {"surprise": 1}, "unknown: surprise"),
    ("convert_result", {"status": "done"}, "status: not allowed"),
    ("convert_result", {"target_path": "jobs/bronze/x.sql"}, "target_path: pattern"),
    ("convert_result", {"notes": None}, "notes: type"),
    ("convert_result", {"notes": 5}, "notes: type"),
    ("migration_backlog", {"priority": "urgent"}, "priority: not allowed"),
    ("reconcile_report", {"checks": []}, "checks: too few items"),
    ("reconcile_report", {"checks": [{"check_id": "c"}]}, "checks[].result: missing"),
    ("reconcile_report", {"summary": {"passed": 1, "failed": 0}}, "summary.total: missing"),
    ("reconcile_report", {"summary": {"passed": 1, "failed": 0, "total": 0}}, "summary.total: below 1"),
    ("reconcile_report", {"checks": [5]}, "checks[]: type"),
    ("reconcile_report", {"checks": [{**CHECK, "result": "maybe"}, "x"]}, "checks[].result: not allowed"),
    ("reconcile_report", {"checks": [{**CHECK, "result": "maybe"}, "x"]}, "checks[]: type"),
    ("reconcile_report", {"checks": [{**CHECK, "check_id": 7}]}, "checks[].check_id: type"),
    ("reconcile_report", {"checks": [{**CHECK, "result": None}]}, "checks[].result: type"),
    ("reconcile_report", {"checks": [{**CHECK, "expected": None}]}, "checks[].expected: type"),
    (
        "reconcile_report",
        {"summary": {"passed": 1, "failed": 0, "total": 1, "more": 1}},
        "summary.unknown: more",
    ),
    ("migration_manifest", {"blockers": ["x"]}, "blockers[]: type"),
    ("migration_manifest", {"converted_artifacts": [3]}, "converted_artifacts[]: type"),
    ("migration_manifest", {"blockers": [{"id": 5, "message": None}]}, "blockers[].id: type"),
    ("migration_manifest", {"blockers": [{"id": 5, "message": None}]}, "blockers[].message: type"),
    ("migration_manifest", {"gate": "maybe"}, "gate: not allowed"),
    ("migration_manifest", {"blockers": [{"id": "b", "message": "m", "x": 1}]}, "blockers[]: unknown"),
    (
        "migration_manifest",
        {"converted_artifacts": [{"legacy_proc": "p", "target_path": "x", "status": "no"}]},
        "converted_artifacts[].status: not allowed",
    ),
]


@pytest.mark.parametrize("name", list(GOOD))
def test_contract(spark, name):
    contract = records.CONTRACTS[name]
    docs = [(0, json.dumps(GOOD[name]), None)]
    docs += [
        (n, json.dumps({**GOOD[name], **change}), want)
        for n, (which, change, want) in enumerate(BAD, 1)
        if which == name
    ]
    required = [f.name for f in contract.fields if f.required]
    docs += [
        (100 + n, json.dumps(without(GOOD[name], key)), f"{key}: missing")
        for n, key in enumerate(required)
    ]
    docs += [(200, "[1]", "not a JSON object"), (201, "{broken", "not a JSON object")]
    df = spark.createDataFrame([d[:2] for d in docs], "n int, record string")
    found = {r["n"]: r["violations"] for r in records.validate_records(df, contract).collect()}
    for n, _, want in docs:
        if want is None:
            assert found[n] == []
        else:
            assert want in found[n], (n, want, found[n])
    good, rejected = records.split_records(records.validate_records(df, contract))
    assert good.count() == 1 and rejected.count() == len(docs) - 1


def test_whole_numbers_and_order(spark):
    """1.0 is an integer; violations stand in the order of the fields, unknown members last."""
    good = {**GOOD["context"], "max_retries": 1.0, "attempt": 2147483647}
    bad = {**without(GOOD["context"], "foreign_catalog"), "z": 1, "a": 2, "max_retries": 9, "run_id": "short"}
    df = spark.createDataFrame([(1, json.dumps(good)), (2, json.dumps(bad)), (3, None), (4, ""), (2, json.dumps(bad))], "n int, record string")
    found = records.validate_records(df, records.CONTRACTS["context"]).collect()
    by = {r["n"]: r["violations"] for r in found}
    assert len(found) == 5 and by[1] == [] and by[3] == by[4] == ["not a JSON object"]
    ends = records.Contract("o", "a struct<b:struct<c:int>>", (records.Field("a", "object", properties=(
        records.Field("b", "object", properties=(records.Field("c", "integer"),)),)),))
    nested = spark.createDataFrame([('{"a": {"b": {"c": 1, "x": 1}, "y": 1}, "z": 1}',)], "record string")
    assert records.validate_records(nested, ends).first()["violations"] == ["a.b.unknown: x", "a.unknown: y", "unknown: z"]
    assert by[2] == ["run_id: pattern", "foreign_catalog: missing", "max_retries: above 5", "unknown: a,z"]


def test_another_contract_is_other_rows(spark):
    """Deeper nesting than any shipped contract has, columns that clash, and distinct violations per key."""
    part = records.Field("part", "object", required=True, properties=(records.Field("size", "integer", minimum=1),))
    lines = records.Field("lines", "array", min_items=1, items=(part, records.Field("tags", "array", item_kind="string")))
    contract = records.Contract("order", "lines array<struct<part:struct<size:int>>>", (lines,))
    docs = [
        ("a", {"lines": [{"part": {"size": 1}, "tags": ["x"]}]}), ("b", {"lines": [{"part": {"size": 0}}, {"part": {"size": -1, "q": 1}}]}),
        ("c", {"lines": [{"part": 5}, {"tags": [1, 2]}, 7]}), ("c", {"lines": []}),
    ]
    df = spark.createDataFrame([(k, json.dumps(d), "p", "n") for k, d in docs], "kind string, record string, parent string, pos string")
    assert rows(records.broken_rules(df, contract, "kind"), "kind", "violation") == [
        ("b", "lines[].part.size: below 1"), ("b", "lines[].part: unknown"), ("c", "lines: too few items"),
        ("c", "lines[].part: missing"), ("c", "lines[].part: type"), ("c", "lines[].tags[]: type"), ("c", "lines[]: type"),
    ]
    checked = records.validate_records(df, contract)
    listed = {r["violations"][0] if r["violations"] else None: r["violations"] for r in checked.collect()}
    assert listed["lines[].part.size: below 1"] == ["lines[].part.size: below 1", "lines[].part: unknown"]
    assert checked.columns == ["kind", "record", "parent", "pos", "parsed", "violations"] and checked.count() == 4
    assert records.validate_records(df.limit(0), contract).collect() == []


def test_good_objects_are_not_opened(spark):
    """An object of plain members that is good by its shape gives no rows; one that is not is opened."""
    good = {"run_id": "r", "checks": [CHECK] * 3, "summary": {"passed": 1, "failed": 0, "total": 1}}
    odd = {**good, "summary": {"passed": 1.0, "failed": 0, "total": 1}}
    texts = spark.createDataFrame([(1, json.dumps(good)), (2, json.dumps(odd))], "id int, record string")
    nodes = records.record_nodes(texts, records.contract_rules(records.RECONCILE_REPORT), "id")
    assert {r["id"]: r["count"] for r in nodes.groupBy("id").count().collect()} == {1: 3, 2: 7}
    assert records.broken_rules(texts, records.RECONCILE_REPORT, "id").collect() == []


def test_a_name_like_a_path_is_unknown(spark):
    """A member whose name looks like the path of another place has no rules of that place."""
    record = {"run_id": "r", "checks": [CHECK], "summary": {"passed": 1, "failed": 0, "total": 1}, "checks[]": {"table": 5}}
    texts = spark.createDataFrame([(1, json.dumps(record))], "id int, record string")
    assert rows(records.broken_rules(texts, records.RECONCILE_REPORT, "id"), "violation") == [("unknown: checks[]",)]


def test_record_folder_to_merge(spark, folder):
    """Files on disk, validated and merged: two converted, one missing, one filed under a wrong name."""
    for number, item in ((1, "item-1"), (2, "item-2"), (3, "item-9")):
        doc = {**GOOD["convert_result"], "item_id": item, "legacy_proc": f"p{number}"}
        with open(f"{folder}/item-{number}.json", "w") as f:
            json.dump(doc, f, indent=2)
    texts = read_record_texts(spark, folder)
    checked = records.validate_records(texts, records.CONVERT_RESULT)
    backlog = spark.createDataFrame(
        [(f"item-{n}", f"p{n}", "gold", "old.sql", "pending") for n in (1, 2, 3, 4)]
        + [("item-5", "p5", "n/a", "", "pending"), ("item-6", "p6", "gold", "", "done")],
        "item_id string, legacy_proc string, target_layer string, target_path string, status string",
    )
    targets = spark.createDataFrame([("jobs/gold/x.sql",)], "target_path string")
    merged = bl.merge_results(backlog, checked.select("record_id", "parsed.*", "violations"), targets)
    assert rows(merged, "item_id", "status", "missing") == [
        ("item-1", "converted", False),
        ("item-2", "converted", False),
        ("item-3", "blocked", False),
        ("item-4", "blocked", True),
    ]
    assert bl.convert_summary(merged).first().asDict() == {
        "converted": 2,
        "blocked": 2,
        "missing_results": 1,
        "total": 4,
    }
    after = bl.apply_merge(backlog, merged)
    assert rows(after, "item_id", "target_path", "status")[0] == (
        "item-1",
        "jobs/gold/x.sql",
        "converted",
    )
    assert rows(after.filter("item_id = 'item-6'"), "status") == [("done",)]
    assert read_records(spark, folder, schemas.CONVERT_RESULT).count() == 3


def test_backlog_rules(spark):
    backlog = spark.createDataFrame(
        [
            ("a", "gold", "jobs/gold/x.sql", "pending"),
            ("b", "gold", "jobs/gold/x.sql", "pending"),
            ("c", "gold", "jobs/converted/x.sql", "pending"),
            ("d", "gold", None, "pending"),
            ("e", "gold", "jobs/gold/deep/x.sql", "Done"),
            ("f", "N/A", "", "pending"),
            (None, "silver", "nowhere", "pending"),
        ],
        "item_id string, target_layer string, target_path string, status string",
    )
    assert rows(bl.check_backlog(backlog), "item_id", "rule", "users") == [
        ("<missing-item_id>", "path_pattern", 1),
        ("a", "duplicate_path", 2),
        ("b", "duplicate_path", 2),
        ("c", "path_pattern", 1),
        ("c", "retired_folder", 1),
        ("d", "missing_path", 1),
    ]


def test_unwired_targets(spark):
    backlog = spark.createDataFrame(
        [
            ("gold", "jobs/gold/a.sql", "pending"),
            ("gold", "jobs/gold/b.sql", "pending"),
            ("gold", "jobs/gold/b.sql", "pending"),
            ("gold", "jobs/gold/c.sql", "blocked"),
        ],
        "target_layer string, target_path string, status string",
    )
    tasks = spark.createDataFrame([("../_rendered/gold/a.sql",)], "path string")
    assert rows(bl.unwired_targets(backlog, tasks)) == [("jobs/gold/b.sql",)]
