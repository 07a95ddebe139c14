from datetime import datetime as D

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.operators import lookups, timeline
from tidemark.operators.lookups import Versions

V = Versions("id", "key", "vf", "vt")
EOT = D(9999, 12, 31, 23, 59, 59, 999999)
DIM = "id bigint, key bigint, vf timestamp_ntz, vt timestamp_ntz"
STAGE = "n int, id bigint, at timestamp_ntz"


@pytest.fixture(scope="module")
def dim(spark):
    return spark.createDataFrame(
        [
            (1, 10, D(2020, 1, 1), D(2020, 6, 1)),
            (1, 11, D(2020, 6, 1), EOT),
            (2, 20, D(2020, 1, 1), D(2020, 12, 1)),
            (2, 21, D(2020, 3, 1), EOT),  # overlaps 20
            (2, 22, D(2020, 4, 1), D(2020, 5, 1)),  # inside 20
            (3, 30, D(2020, 5, 1), D(2020, 5, 1)),  # empty
            (4, 41, D(2020, 1, 1), D(2020, 2, 1)),  # same start: lower key first
            (4, 40, D(2020, 1, 1), D(2020, 3, 1)),
            (None, 99, D(2020, 1, 1), EOT),
            (5, 50, None, EOT),
        ],
        DIM,
    )


CASES = [
    (1, 1, D(2020, 1, 1), 0),  # equal to valid_from: no match
    (2, 1, D(2020, 1, 1, 0, 0, 1), 10),
    (3, 1, D(2020, 6, 1), 10),  # equal to valid_to: match
    (4, 1, D(2021, 1, 1), 11),
    (5, 1, None, 0),
    (6, 1, D(2019, 1, 1), 0),
    (7, 2, D(2020, 4, 15), 20),  # overlap: the earliest start wins
    (8, 2, D(2020, 12, 1), 20),
    (9, 2, D(2020, 12, 2), 21),
    (10, 3, D(2020, 5, 1), 0),
    (11, None, D(2020, 4, 1), 0),
    (12, 77, D(2020, 4, 1), 0),
    (13, 4, D(2020, 1, 15), 40),
    (14, 4, D(2020, 2, 15), 40),
    (15, 5, D(2020, 2, 15), 0),
]


WAYS = pytest.mark.parametrize("lookup", [lookups.lookup_key_asof, timeline.lookup_key_merged])


@WAYS
@pytest.mark.parametrize("parts", [1, 7])
def test_asof_boundaries(spark, dim, lookup, parts):
    far = [(90, 1, D(9998, 1, 1), 11), (91, 1, D(1, 1, 2), 0), (92, 2, D(9999, 12, 31, 23), 21)]
    stage = spark.createDataFrame([c[:3] for c in CASES + far], STAGE).repartition(parts)
    out = lookup(stage, dim, V, "id", "at", "found")
    assert rows(out, "n", "found") == sorted([(c[0], c[3]) for c in CASES + far], key=repr)
    assert out.columns == ["n", "id", "at", "found"]


def test_shared_versions(spark, dim):
    stage = spark.createDataFrame([c[:3] for c in CASES], STAGE)
    ready = lookups.prepare_versions(dim, V)
    out = lookups.lookup_prepared(stage, ready, "id", "at", "a")
    out = lookups.lookup_prepared(out, ready, "id", "at", "b")
    assert rows(out.filter("a = b"), "n", "a") == sorted([(c[0], c[3]) for c in CASES], key=repr)


@WAYS
def test_asof_empty_sides(spark, dim, lookup):
    stage = spark.createDataFrame([c[:3] for c in CASES], STAGE)
    assert lookup(stage.limit(0), dim, V, "id", "at", "k").count() == 0
    assert {r["k"] for r in lookup(stage, dim.limit(0), V, "id", "at", "k").collect()} == {0}


@WAYS
def test_asof_clashing_columns_and_repeats(spark, dim, lookup):
    """Columns named like working ones, an output that is there already, and repeated rows."""
    staged = [(n, i, at, "b", "p", -1) for n, i, at, _ in CASES + CASES]
    stage = spark.createDataFrame(staged, "part int, vf bigint, moment timestamp_ntz, bk string, `a.b` string, found int")
    out = lookup(stage, dim, V, "vf", "moment", "found")
    assert out.columns == ["part", "vf", "moment", "bk", "a.b", "found"]
    assert rows(out, "part", "found") == sorted([(c[0], c[3]) for c in CASES + CASES], key=repr)


def test_one_key_lies_over_many_tasks(spark):
    """A key with all versions and all rows: the ranges split it, and each row finds its version across them."""
    dim = spark.range(30_000).select(
        F.lit(1).cast("bigint").alias("id"), F.col("id").alias("key"),
        (F.lit(D(2020, 1, 1)).cast("timestamp_ntz") + F.make_dt_interval(hours=F.col("id").cast("int"))).alias("vf"),
        (F.lit(D(2020, 1, 1)).cast("timestamp_ntz") + F.make_dt_interval(hours=(F.col("id") + 1).cast("int"))).alias("vt"),
    )
    stage = spark.range(40_000).select(
        F.col("id").alias("n"), F.lit(1).cast("bigint").alias("id"),
        (F.lit(D(2020, 1, 1)).cast("timestamp_ntz") + F.make_dt_interval(hours=F.col("id").cast("int"), mins=F.lit(30))).alias("at"),
    )
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = timeline.lookup_key_merged(stage, dim, V, "id", "at", "k", default=-1)
        assert out.filter(F.col("k") != F.when(F.col("n") < 30_000, F.col("n")).otherwise(-1)).count() == 0
        assert out.count() == 40_000
        spread = out.select("n", F.spark_partition_id().alias("p")).groupBy("p").count()
        assert spread.count() > 3 and spread.agg(F.max("count")).first()[0] < 30_000
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_asof_against_brute_force(spark):
    """Random overlapping versions and instants, compared with the definition."""
    import random

    pick = random.Random(7)
    versions = [
        (pick.randrange(5), k, D(2020, pick.randrange(1, 13), pick.randrange(1, 28)),
         D(2020, pick.randrange(1, 13), pick.randrange(1, 28)))
        for k in range(1, 80)
    ]
    staged = [(n, pick.randrange(6), D(2020, pick.randrange(1, 13), pick.randrange(1, 28))) for n in range(300)]

    def expected(i, at):
        hits = [(vf, k) for b, k, vf, vt in versions if b == i and vf < at <= vt]
        return min(hits)[1] if hits else 0

    want = sorted([(n, expected(i, at)) for n, i, at in staged], key=repr)
    dim, stage = spark.createDataFrame(versions, DIM), spark.createDataFrame(staged, STAGE)
    for lookup in (lookups.lookup_key_asof, timeline.lookup_key_merged):
        got = lookup(stage, dim, V, "id", "at", "k")
        assert rows(got, "n", "k") == want


def test_latest_lookup(spark, dim):
    stage = spark.createDataFrame([(1, 1), (2, 2), (3, 5), (4, None), (5, 9)], "n int, id bigint")
    out = lookups.lookup_key_latest(stage, dim, V, "id", "k")
    assert rows(out, "n", "k") == [(1, 11), (2, 21), (3, 50), (4, 0), (5, 0)]


def test_longest_history(spark, dim):
    assert lookups.longest_history(dim, V) == 3 and lookups.longest_history(dim.limit(0), V) == 0


def test_latest_per_key_prunes_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    out = lookups.latest_per_key(df, ["k"], [F.desc("id")])
    assert rows(out) == [(0, 999), (1, 997), (2, 998)]
    plan = out._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_asof_hot_key_is_split(spark):
    """Shuffled as-of join: AQE splits the partition of a business key with most of the rows."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        at = F.lit("2020-03-01").cast("timestamp_ntz")
        stage = spark.range(0, 60000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("bk"),
            F.col("id").alias("n"),
            at.alias("at"),
        )
        dim = spark.range(0, 60000).select(
            F.col("id").alias("id"),
            (F.col("id") + 100).alias("key"),
            F.lit("2020-01-01").cast("timestamp_ntz").alias("vf"),
            F.lit("2021-01-01").cast("timestamp_ntz").alias("vt"),
        )
        out = lookups.lookup_key_asof(stage, dim, V, "bk", "at", "k")
        assert out.filter("k = bk + 100").count() == 60000
        out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
