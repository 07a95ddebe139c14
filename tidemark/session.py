"""Session settings and the reliable checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

# AQE sizes the reduce side at run time and splits skewed join partitions. Broadcasts are left to
# Spark's own size check (autoBroadcastJoinThreshold on file and shuffle statistics), so a dimension
# that outgrows the limit falls back to a sort-merge join without a code change.
# AQE merges reduce partitions and never makes more, so it starts from many: at 100 TB each of these
# many holds some GB of a full shuffle, and a small shuffle is merged down to the advisory size.
INITIAL_PARTITIONS = "20000"

SETTINGS = {
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": INITIAL_PARTITIONS,
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(app: str = "tidemark", master: str | None = None, **extra: str) -> SparkSession:
    """A session for a cluster; a local master starts from ``spark.sql.shuffle.partitions`` instead."""
    if master and master.startswith("local"):
        extra.setdefault(
            "spark.sql.adaptive.coalescePartitions.initialPartitionNum",
            extra.get("spark.sql.shuffle.partitions", "200"),
        )
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**SETTINGS, **extra}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


# Rows of a few numbers take 20 to 30 times their compressed bytes once they are sorted and grouped, so Spark's 64 MB
# of shuffled bytes become more than a GB in one task.
ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
NARROW_ROWS = "16m"


def narrow_tasks(spark: SparkSession) -> SparkSession:
    """The session, whose shuffle partitions are merged to 16 MB at most if it names no size of its own."""
    if spark.conf.get(ADVISORY, None) is None:
        spark.conf.set(ADVISORY, NARROW_ROWS)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the shared folder the cluster names. A temporary one stands in for it on a local master alone,
    where driver and executors are one process."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    folder = spark.conf.get("spark.checkpoint.dir", "")
    if not folder:
        if not context.master.startswith("local[") and context.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="spark-")
    context.setCheckpointDir(folder)
    return folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the result survives the loss of the executors that computed it."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
