"""What one task holds and what is shuffled, where tables grow."""

import re

import pytest

from tidemark.operators import lookups, records
from tidemark.session import ADVISORY
from tidemark.workload.queries import CUSTOMER_VERSIONS, QUERIES
from tidemark.workload.views import Views


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def conf(spark):
    names = (ADVISORY, "spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")
    before = {k: spark.conf.get(k, None) for k in names}
    yield spark.conf
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_queries_merge_partitions_to_narrow_ones(spark, small, conf):
    conf.unset(ADVISORY)
    QUERIES["metric_by_customer"](spark, small)
    assert conf.get(ADVISORY) == "16m"


def test_a_size_that_the_session_names_stays(spark, small, conf):
    conf.set(ADVISORY, "20m")
    QUERIES["metric_by_customer"](spark, small)
    assert conf.get(ADVISORY) == "20m"


def test_versions_are_dealt_out_by_customer_once(spark, small):
    rows = lookups.effective_versions(Views(spark, small).customer_versions, CUSTOMER_VERSIONS)
    # By (customer, day) for the grouping, by customer for both windows.
    assert len(re.findall(r"Exchange hashpartitioning", physical(rows))) == 2


def test_asof_keys_shuffles_no_text_of_the_key(spark, small, conf):
    conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    plan = physical(QUERIES["asof_keys"](spark, small))
    assert "concat_ws" in plan.partition("Exchange")[0] and "concat_ws" not in plan.partition("Exchange")[2]


def test_stage_and_its_parts_make_the_same_key(spark, small):
    v = Views(spark, small)
    keys = [sorted(r[0] for r in df.select("Sale Key").collect()) for df in (v.sale, v.sale_stage)]
    assert keys[0] == keys[1]


@pytest.mark.parametrize("name", sorted(records.CONTRACTS))
def test_rules_are_tested_in_code_that_the_jvm_compiles(spark, conf, name):
    conf.set("spark.sql.adaptive.enabled", "false")
    texts = spark.createDataFrame([(1, "{}")], "id int, record string")
    found = records.broken_rules(texts, records.CONTRACTS[name], "id")
    assert re.search(r"\*\(\d+\) BroadcastHashJoin", physical(found)) and "SortAggregate" not in physical(found)
    code = spark._jvm.PythonSQLUtils.explainString(found._jdf.queryExecution(), "codegen")
    # HotSpot interprets longer methods.
    assert max(int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", code)) < 8000


def test_packed_places_keep_their_order(spark):
    places = [(0, 1, 0), (0, 9, 0), (3, 0, 0), (3, 9, -3), (3, 9, -2), (70000, 9, -70000)]
    df = spark.createDataFrame([(p,) for p in places], "place struct<pos:int,step:int,inner:int>")
    packed = df.select("place", records._packed(df["place"]).alias("at"))
    assert [tuple(r[0]) for r in packed.orderBy("at").collect()] == places
    assert [tuple(r[0]) for r in packed.select(records._unpacked(packed["at"]).alias("p")).collect()] == places
