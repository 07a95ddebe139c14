from datetime import date, datetime as D

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.functions import naming
from tidemark.functions.text import with_ci
from tidemark.operators import conform, counts, gate, landing, marts, metrics, quality, reports
from tidemark.sources import fixtures
from tidemark.sources.external import extract_changes, read_fixture_csv


@pytest.mark.parametrize(
    "schema,name,landed",
    [
        ("Dimension", "Stock Item", "dim_stock_item"),
        (" dimension ", "City", "dim_city"),
        ("Fact", "Sale", "fact_sale"),
        ("dbo", "2024-Sales", "dbo_2024_sales"),
        ("2024", "Sales", "t_2024_sales"),
        ("dbo", "  a..b -- c!  ", "dbo_a_b_c"),
        ("Sales.EU", "Größe", "sales_eu_gr_e"),
    ],
)
def test_landing_name(spark, schema, name, landed):
    df = spark.createDataFrame([(schema, name)], "s string, n string")
    assert df.select(naming.landing_name(F.col("s"), F.col("n"))).first()[0] == landed


def test_collisions(spark):
    inventory = landing.with_landing_names(
        spark.createDataFrame(
            [("table", "a", "x y", False), ("table", "a", "x-y", False), ("table", "a", "z", False)],
            "object_type string, source_schema string, source_name string, skip boolean",
        )
    )
    assert rows(landing.landing_collisions(inventory)) == [("a_x_y", 2)]


def test_land_keeps_spaced_names(spark):
    df = spark.createDataFrame([(1,)], "`City Key` int")
    row = landing.land(df, "mysql", naming.batch_id("2024-01-02 03:04:05"), "2024-01-02").first()
    assert row["City Key"] == 1 and row["_source_system"] == "mysql"
    assert row["_batch_id"] == "bronze-all-20240102030405"
    assert row["_bronze_loaded_at"] == D(2024, 1, 2)


def test_counts_include_empty_tables(spark):
    full, empty = spark.range(5), spark.range(0)
    assert rows(counts.count_by_label({("a",): full, ("b",): empty}, ["t"])) == [("a", 5), ("b", 0)]
    assert counts.smoke("ok", a=full, b=empty).first().asDict() == {
        "check_name": "ok",
        "a_rows": 5,
        "b_rows": 0,
    }


def test_extract_window_is_half_open_and_pushed(spark, folder):
    data = [(D(2020, 1, d),) for d in (1, 2, 3, 4)]
    spark.createDataFrame(data, "at timestamp_ntz").write.parquet(f"{folder}/t")
    out = extract_changes(spark.read.parquet(f"{folder}/t"), "at", "2020-01-01", "2020-01-03")
    assert [r[0].day for r in out.orderBy("at").collect()] == [2, 3]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(at" in plan and "LessThanOrEqual(at" in plan


CUSTOMER = (
    "`Customer Key` int, `WWI Customer ID` int, Customer string, `Bill To Customer` string, "
    "Category string, `Buying Group` string, City int, `Valid From` timestamp_ntz, `Valid To` timestamp_ntz"
)


def test_quarantine_and_current_flag(spark):
    df = spark.createDataFrame(
        [
            (1, 1, "a", "a", "x", "g", 1, D(2020, 1, 1), D(2020, 6, 1)),
            (2, 1, "a", "a", "x", "g", 1, D(2020, 6, 1), D(9999, 12, 31, 23, 59, 59)),
            (3, 2, "b", "b", "x", "g", 1, D(2020, 1, 1), None),
            (4, 2, "b", "b", "x", "g", 1, D(2030, 1, 1), None),
            (5, 2, "b", "b", "x", "g", 1, None, None),
        ],
        CUSTOMER,
    )
    ok, later = conform.split_future(df, "Valid From", "2021-01-01")
    assert ok.count() == 3 and later.count() == 1
    assert conform.undated(df, "Valid From").count() == 1
    silver = conform.dim_customer_scd2(df, "2021-01-01")
    assert rows(silver, "customer_key", "is_current") == [(1, False), (2, True), (3, True)]


SALE = (
    "`Sale Key` int, `Invoice Date Key` date, `Customer Key` int, `Stock Item Key` int, Quantity int, "
    "`Unit Price` decimal(18,2), `Total Including Tax` decimal(18,2), Profit decimal(18,2), "
    "`WWI Invoice ID` int, `WWI Customer ID` int, `WWI Stock Item ID` int"
)


def sale(key, customer, item, day=1):
    return (key, date(2020, 1, day), customer, item, 2, None, None, None, 1, 1, 1)


def test_orphans_with_duplicate_dimension_keys(spark):
    facts = spark.createDataFrame(
        [sale(1, 1, 1), sale(2, 1, 9), sale(3, 9, 1), sale(4, 9, 9), sale(5, None, 1)], SALE
    )
    customers = spark.createDataFrame([(1,), (1,)], "customer_key int")
    items = spark.createDataFrame([(1,)], "stock_item_key int")
    assert conform.fact_sale(facts, customers, items).count() == 2  # multiplied
    assert rows(conform.fact_orphans(facts, customers, items), "sale_key", "orphan_reason") == [
        (2, "stock_unmatched"),
        (3, "customer_unmatched"),
        (4, "customer_and_stock_unmatched"),
        (5, "customer_unmatched"),
    ]


def test_daily_sales_with_duplicate_dates(spark):
    """A repeated date row counts its sales twice, as a plain join would."""
    fact = spark.createDataFrame(
        [(date(2020, 1, 1), 1, 2, 10, 1), (date(2020, 1, 1), 1, 3, 10, 1), (date(2020, 1, 2), 1, 1, 1, 1)],
        "invoice_date_key date, stock_item_key int, quantity int, total_including_tax int, profit int",
    )
    dates = spark.createDataFrame([(date(2020, 1, 1),), (date(2020, 1, 1),)], "date_key date")
    items = spark.createDataFrame(
        [(1, 7, "n")], "stock_item_key int, stock_item_id int, stock_item_name string"
    )
    out = marts.mart_daily_sales(fact, dates, items)
    assert rows(out, "quantity_sold", "transaction_count") == [(10, 4)]


def test_customer_mart_joins_only_the_open_city(spark):
    customers = spark.createDataFrame(
        [(1, 1, "a", "a", "c", "g", 5, True), (2, 2, "b", "b", "c", "g", 6, True)],
        "customer_key int, customer_id int, customer_name string, bill_to_customer_id string, "
        "category string, buying_group_id string, city_id int, is_current boolean",
    )
    cities = spark.createDataFrame(
        [(5, "old", "s", "c", D(2020, 1, 1)), (5, "new", "s", "c", D(9999, 12, 31))],
        "city_id int, city_name string, state_province string, country string, valid_to timestamp_ntz",
    )
    assert rows(marts.mart_customer_current(customers, cities), "customer_key", "city_name") == [
        (1, "new"),
        (2, None),
    ]


def test_case_insensitive_view(spark):
    df = with_ci(spark.createDataFrame([("Oslo",), ("OSLO",), ("Bergen",)], "n string"), ["n"])
    assert df.filter("n = 'oslo'").count() == 2
    assert df.groupBy("n").count().count() == 2


def test_metric_view_rejects_unknown_names(spark):
    view = metrics.daily_sales_metrics(
        spark.createDataFrame(
            [(date(2020, 1, 1), 1, 1, 2, 3, 4)],
            "invoice_date_key date, stock_item_key int, customer_key int, quantity int, "
            "total_including_tax int, profit int",
        )
    )
    with pytest.raises(KeyError):
        view.query(["Nope"], ["Profit"])
    assert view.query([], ["Profit"], "quantity > 5").first()["Profit"] is None


def test_key_checks(spark):
    df = spark.createDataFrame([(1, None), (1, 2), (3, 4)], "a int, b int")
    assert rows(quality.check_not_null(df, "t", ["a", "b"]), "violations", "result") == [
        (0, "pass"),
        (1, "fail"),
    ]
    assert quality.check_unique(df, "t", ["a"]).first()["violations"] == 1
    dim = spark.createDataFrame([(2,)], "k int")
    assert quality.check_fk(df, dim, "t", "b", "k").first()["violations"] == 1


def test_reconcile_delta_is_actual_minus_expected(spark):
    out = quality.reconcile_counts({"x": (spark.range(5), spark.range(3))}, "r", "2024-01-01").first()
    assert (out["check_id"], out["expected"], out["actual"], out["delta"], out["result"]) == (
        "bronze_vs_source:x",
        "5",
        "3",
        "-2",
        "fail",
    )


@pytest.mark.parametrize(
    "expected,compare,actual,result",
    [
        (None, "exact_when_expected_set", 7, "pass"),
        (None, "gte", 7, "pass"),
        (7, "exact_when_expected_set", 7, "pass"),
        (8, "exact_when_expected_set", 7, "fail"),
        (8, "gte", 7, "fail"),
        (7, "gte", 7, "pass"),
        (6, "gte", 7, "pass"),
    ],
)
def test_expectations(spark, expected, compare, actual, result):
    exp = spark.createDataFrame(
        [("f", "t", "row_count", expected, compare, "n")],
        "fixture_name string, target_table string, metric string, expected bigint, compare string, notes string",
    )
    counted = spark.createDataFrame([("t", actual)], "target_table string, rows bigint")
    row = quality.evaluate_expectations(exp, counted, "r", "2024-01-01").first()
    assert row["result"] == result and row["check_id"] == "fixture_f"


def test_staged_expectations_from_csv(spark, folder):
    with open(f"{folder}/dim_city_snapshot.csv", "w") as f:
        f.write("a,b\n1,2\n3,4\n")
    with open(f"{folder}/fact_sale_count.csv", "w") as f:
        f.write("row_count\n228265\n")
    staged = fixtures.stage_expectations(spark, folder, "2024-01-01")
    assert rows(staged, "fixture_name", "expected") == [
        ("dim_city_snapshot", 2),
        ("dim_customer_after_migrate", None),
        ("dim_stock_item_after_migrate", None),
        ("fact_sale_count", 228265),
    ]
    city = read_fixture_csv(spark, f"{folder}/dim_city_snapshot.csv", "a int, b int", "a")
    assert [r["a"] for r in city.collect()] == [1, 3]


def frames(spark, **changes):
    """A run with nothing wrong, with the named tables replaced."""
    base = dict(
        inventory=[("table", "a", False), ("table", "b", True), ("proc", None, False)],
        bronze=[("a",)],
        reconcile=[("r", "c1", "1", "1", "pass"), ("r", "bronze_vs_source:a", "1", "1", "pass")],
        backlog=[("i1", "p1", "gold", "jobs/gold/x.sql", "converted")],
        conversion_map=[("p1", "final")],
        targets=[("jobs/gold/x.sql",)],
        events=[("r", a) for a in gate.REQUIRED_AGENTS],
    )
    base.update(changes)
    schema = dict(
        inventory="object_type string, landing_name string, skip boolean",
        bronze="table_name string",
        reconcile="run_id string, check_id string, expected string, actual string, result string",
        backlog="item_id string, legacy_proc string, target_layer string, target_path string, status string",
        conversion_map="legacy_proc string, status string",
        targets="target_path string",
        events="run_id string, agent string",
    )
    return [spark.createDataFrame(base[k], schema[k]) for k in base]


@pytest.mark.parametrize(
    "changes,options,expected",
    [
        ({}, {}, []),
        ({"bronze": []}, {}, ["bronze_missing:a"]),
        (
            {"reconcile": [("r", "bronze_vs_source:a", "2", "1", "fail"), ("q", "c2", "1", "2", "fail")]},
            {},
            ["reconcile_fail:bronze_vs_source:a"],
        ),
        ({"reconcile": []}, {}, ["reconcile_fail:bronze_vs_source:a"]),
        ({"reconcile": [("q", "bronze_vs_source:a", "1", "1", "pass")]}, {}, ["reconcile_fail:bronze_vs_source:a"]),
        ({"backlog": [("i1", "p9", "gold", "x", None)]}, {}, ["convert_missing:i1"]),
        ({"backlog": [("i1", "p9", None, "x", "pending")]}, {}, ["convert_missing:i1"]),
        ({"targets": []}, {}, ["convert_missing:i1"]),
        ({"conversion_map": [("p1", "blocked")]}, {}, ["convert_missing:i1"]),
        ({"conversion_map": []}, {"routines_skipped_reason": "no client"}, []),
        ({"conversion_map": []}, {"procs_total": 0}, []),
        ({"backlog": [], "conversion_map": []}, {}, []),
        ({"backlog": [("i1", "p1", "gold", "x", "blocked"), ("i2", "p2", "n/a", "x", "pending")]}, {}, []),
        ({"events": [("r", a) for a in gate.REQUIRED_AGENTS[:-1]]}, {}, ["events_missing:gate"]),
    ],
)
def test_gate(spark, changes, options, expected):
    blockers = gate.gate_blockers(*frames(spark, **changes), "r", **options)
    assert [r[0] for r in rows(blockers, "id")] == expected
    assert gate.verdict(blockers, "r").first()["gate"] == ("fail" if expected else "pass")


def test_manifest_row(spark):
    inventory, bronze, reconcile, backlog, _, _, events = frames(spark)
    summary = gate.run_summary(inventory, bronze, reconcile, backlog, events, "r")
    decision = gate.verdict(gate.gate_blockers(*frames(spark), "r"), "r")
    row = gate.manifest_row(decision, summary, "2024-01-01").first()
    assert (row["run_id"], row["gate"], row["tables_total"], row["tables_landed"]) == ("r", "pass", 1, 1)
    assert '"agent_events_recorded":5' in row["summary_json"]
    manifest = gate.manifest_row(decision, summary, "2024-01-01")
    later = manifest.withColumns({"updated_at": F.lit("2025-01-01").cast("timestamp_ntz")})
    assert reports.gate_hero(manifest.unionByName(later)).first()["updated_at"] == D(2025, 1, 1)


def test_gate_fails_closed(spark):
    """An undecided table is live, and a check passes by saying so alone."""
    inventory = spark.createDataFrame(
        [("table", "dim_a", None), ("table", "dim_b", True), ("proc", None, None)],
        "object_type string, landing_name string, skip boolean",
    )
    reconcile = spark.createDataFrame(
        [("bronze_vs_source:dim_a", "1", "1", "pass", "r"), ("x", None, None, None, "r"), ("y", "1", "1", "PASS", "r")],
        "check_id string, expected string, actual string, result string, run_id string",
    )
    empty = lambda ddl: spark.createDataFrame([], ddl)
    events = spark.createDataFrame([("r", a) for a in gate.REQUIRED_AGENTS], "run_id string, agent string")
    backlog = empty("item_id string, legacy_proc string, target_layer string, target_path string, status string")
    found = gate.gate_blockers(
        inventory, empty("table_name string"), reconcile, backlog, empty("legacy_proc string, status string"),
        empty("target_path string"), events, "r",
    )
    assert rows(found, "id") == [("bronze_missing:dim_a",), ("reconcile_fail:x",), ("reconcile_fail:y",)]
    totals = gate.run_summary(inventory, empty("table_name string"), reconcile, backlog, events, "r").first()
    assert (totals["tables_total"], totals["procs_total"], totals["reconcile_failed"]) == (1, 1, 2)
