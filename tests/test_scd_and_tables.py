from datetime import datetime as D

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.operators import loads, scd, tableops

EOT = D(9999, 12, 31, 23, 59, 59, 999999)
DIM = (
    "`City Key` bigint, `WWI City ID` bigint, City string, `Valid From` timestamp_ntz, "
    "`Valid To` timestamp_ntz, `Lineage Key` bigint"
)
STAGE = "`WWI City ID` bigint, City string, `Valid From` timestamp_ntz, `Valid To` timestamp_ntz"


@pytest.fixture(scope="module")
def dim(spark):
    return spark.createDataFrame(
        [
            (1, 1, "a", D(2019, 1, 1), D(2020, 1, 1), 1),
            (2, 1, "b", D(2020, 1, 1), EOT, 1),
            (3, 2, "c", D(2020, 1, 1), EOT, 1),
            (4, 3, "d", D(2020, 1, 1), D(2020, 2, 1), 1),  # closed, no open row
            (5, None, "n", D(2020, 1, 1), EOT, 1),
            (6, 4, "z", D(2020, 1, 1), None, 1),
        ],
        DIM,
    )


def apply(spark, dim, staged, key=2):
    return scd.scd2_apply(dim, spark.createDataFrame(staged, STAGE), "WWI City ID", key)


def test_two_staged_versions_close_at_the_first(spark, dim):
    staged = [
        (1, "b2", D(2021, 3, 1), D(2021, 5, 1)),
        (1, "b3", D(2021, 5, 1), EOT),
    ]
    out = rows(apply(spark, dim, staged), "City Key", "City", "Valid To", "Lineage Key")
    assert (2, "b", D(2021, 3, 1), 1) in out
    assert (1, "a", D(2020, 1, 1), 1) in out
    assert (None, "b2", D(2021, 5, 1), 2) in out and (None, "b3", EOT, 2) in out
    assert len(out) == 8


def test_empty_stage_changes_nothing(spark, dim):
    assert rows(apply(spark, dim, [])) == rows(dim)


def test_closed_and_null_rows(spark, dim):
    staged = [(3, "d2", D(2021, 1, 1), EOT), (None, "n2", D(2021, 1, 1), EOT)]
    out = rows(apply(spark, dim, staged), "City", "Valid To")
    assert ("d", D(2020, 2, 1)) in out  # already closed
    assert ("n", EOT) in out and ("n2", EOT) in out  # a NULL key closes nothing
    assert ("z", None) in out


def test_unchanged_row_makes_a_version(spark, dim):
    out = apply(spark, dim, [(2, "c", D(2021, 1, 1), EOT)])
    assert out.filter("City = 'c'").count() == 2


def test_already_applied(spark, dim):
    assert scd.already_applied(dim, 1).count() == 1
    assert scd.already_applied(dim, 2).count() == 0


def test_assigned_keys_are_dense_and_ordered(spark):
    data = spark.range(0, 5000, 1, 8).select(F.col("id"), (F.col("id") * 7919 % 5003).alias("o"))
    out = scd.assign_keys(data, "k", ["o", "id"], 101)
    got = out.orderBy("k").collect()
    assert [r["k"] for r in got] == list(range(101, 5101))
    assert [(r["o"], r["id"]) for r in got] == sorted((r["o"], r["id"]) for r in got)


FACT = "invoice bigint, line int, qty bigint"


def test_fact_upsert_with_fewer_lines(spark):
    fact = spark.createDataFrame([(1, 1, 5), (1, 2, 6), (2, 1, 7), (None, 1, 8)], FACT)
    stage = spark.createDataFrame([(1, 1, 9), (3, 1, 1), (None, 2, 2)], FACT)
    out = rows(tableops.replace_by_key(fact, stage, "invoice"))
    assert out == sorted(
        [(1, 1, 9), (2, 1, 7), (None, 1, 8), (3, 1, 1), (None, 2, 2)], key=repr
    )
    assert rows(tableops.replace_by_key(fact, stage.limit(0), "invoice")) == rows(fact)


def test_upsert_last_row_wins(spark):
    schema = "k string, v string, n int"
    target = spark.createDataFrame([("a", "old", 0), ("b", "old", 0)], schema)
    source = spark.createDataFrame([("a", "x", 1), ("a", "y", 2), ("c", "z", 1)], schema)
    out = rows(tableops.upsert(target, source, ["k"], [F.col("n")]))
    assert out == [("a", "y", 2), ("b", "old", 0), ("c", "z", 1)]


def test_replace_run(spark):
    schema = "run_id string, check_id string"
    table = spark.createDataFrame(
        [("1", "bronze_vs_source:a"), ("1", "fixture_a"), ("2", "bronze_vs_source:a"), (None, "x")],
        schema,
    )
    new = spark.createDataFrame([("1", "bronze_vs_source:b")], schema)
    out = rows(tableops.replace_run(table, new, "1", "bronze_vs_source:"))
    assert ("1", "bronze_vs_source:a") not in out and ("1", "fixture_a") in out and len(out) == 4
    assert rows(tableops.replace_run(table, new, "1", drop_null_run=True)) == [
        ("1", "bronze_vs_source:b"),
        ("2", "bronze_vs_source:a"),
    ]


def test_perturb_and_restore_null(spark):
    schema = "fixture_name string, expected bigint, compare string, notes string"
    table = spark.createDataFrame(
        [("f", None, "exact_when_expected_set", "n"), ("g", 5, "gte", None)], schema
    )
    named = F.col("fixture_name") == "f"
    saved = tableops.snapshot_expectations(table, named)
    assert '"expected":null' in saved.first()["row_json"]
    drifted = tableops.perturb(table, named, 10)
    row = drifted.filter(named).first()
    assert (row["expected"], row["compare"]) == (10, "gte")
    assert row["notes"] == (
        "[INJECTED-FAULT] was expected=NULL compare=exact_when_expected_set | n"
    )
    assert rows(tableops.restore(drifted, saved)) == rows(table)
    with pytest.raises(ValueError):
        tableops.perturb(table, named, -1)


def test_run_events(spark):
    runs = spark.createDataFrame(
        [("a", 0, None), ("b", 3, None), ("c", 3, "no client"), ("d", 3, "")],
        "run_id string, procs_total int, routines_skipped_reason string",
    )
    out = rows(tableops.run_events(runs, "2024-01-01"), "run_id", "agent", "detail")
    assert ("a", "convert", "no backlog / routines skipped") in out
    assert ("c", "convert", "no client") in out
    assert [r[0] for r in out].count("b") == 1 and [r[0] for r in out].count("d") == 1


def test_load_bookkeeping(spark):
    from tidemark import schemas

    lineage = spark.createDataFrame([], schemas.LOADS)
    cutoffs = spark.createDataFrame([("City", D(2020, 1, 1)), ("Sale", D(2020, 1, 1))], schemas.CUTOFFS)
    assert loads.get_cutoff(cutoffs, "City") == D(2020, 1, 1)
    with pytest.raises(LookupError):
        loads.get_cutoff(cutoffs, "Nope")
    with pytest.raises(LookupError):
        loads.require_open_key(lineage, "City")
    opened = loads.open_load(lineage, "City", "2021-01-01", "2021-01-02")
    opened = loads.open_load(opened, "Sale", "2022-01-01", "2021-01-02")
    assert loads.require_open_key(opened, "Sale") == 2
    closed, moved = loads.close_load(opened, cutoffs, 1, "2021-01-03")
    done = closed.filter("`Lineage Key` = 1").first()
    assert done["Was Successful"] and done["Data Load Completed"] == D(2021, 1, 3)
    assert rows(moved) == [("City", D(2021, 1, 1)), ("Sale", D(2020, 1, 1))]
